"""Packing along a space-filling curve: neighbouring documents share sequences.

A document's vector counts its tokens in hashed buckets; a fixed matrix of signs projects it to a few dimensions, and
its place in their grid becomes its Hilbert key, so that documents with near keys have near vectors. Documents are
range-sorted by that key, and the line of all their tokens is cut every ``limit`` tokens. The few tokens that remain
at its end are cut into powers of two, which need no padding.

Only a number and a key for each document are sorted. Rows with equal keys, such as copies, are ordered by a hash, so
that ranges can part them: a run of copies that holds a third of all rows is spread like any others. A document's place
on the line is its range's first token, from one sum a range, and the tokens before it in its range.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from billweave.llm.common import BATCH_BYTES, map_batches, schema_of, stored

BUCKETS, DIMENSIONS, BITS = 256, 4, 12
#: Projections of unit vectors on signs lie within +-16 and mostly within this span; what lies outside goes to the rim.
SPAN = 8.0
ENCODED = "doc_id long, n long, curve long, ids binary"
PIECES = "doc_id long, doc_tokens long, curve long, start long, length long, sequence_id long, offset long, ids binary"


def hilbert_keys(places: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid points (a row each, coordinates below ``2**bits``) on the Hilbert curve.

    From the top bit down, each coordinate with a set bit mirrors the first one below that bit, each without swaps those
    low bits with it; the Gray code of what results, read across the dimensions, is the key.
    """
    x = places.astype(np.int64).T.copy()
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for row in x:
            is_set = row >> bit & 1 == 1
            swapped = np.where(is_set, 0, (x[0] ^ row) & low)
            mirrored = np.where(is_set, low, 0)
            row ^= swapped
            x[0] ^= swapped | mirrored
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1 == 1, (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for row in x:
            key = key << 1 | row >> bit & 1
    return key


class Projector:
    """Hilbert keys of documents from their token ids. Buckets and signs come from fixed seeds."""

    def __init__(self, ids: int):
        rng = np.random.default_rng(12)
        self.bucket = rng.integers(0, BUCKETS, ids)
        self.signs = rng.choice(np.array([-1.0, 1.0]), (BUCKETS, DIMENSIONS))

    def keys(self, documents: list[np.ndarray]) -> np.ndarray:
        counts = np.zeros((len(documents), BUCKETS))
        for row, ids in zip(counts, documents, strict=True):
            row += np.bincount(self.bucket[ids], minlength=BUCKETS)
        vectors = np.sqrt(counts)  # a frequent token counts for less than its number
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        scaled = (vectors @ self.signs / (2 * SPAN) + 0.5) * (1 << BITS)
        return hilbert_keys(np.clip(scaled, 0, (1 << BITS) - 1).astype(np.int64), BITS)


def byte_pair_encoder(vocabulary: str) -> Callable[[str], list[int]]:
    """Gives the ids of a text under a byte-level vocabulary of the ``tokenizers`` library.

    The vocabulary's merges are handed to ``tiktoken``, which applies the same ones several times faster. Added tokens
    split a text first, as in the library. The caller compares texts with the library's own ids.
    """
    import re

    import public_tokenizers
    import tiktoken

    made = vocabulary_file(vocabulary)
    if made["normalizer"] or made["pre_tokenizer"]["type"] != "ByteLevel" or made["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError("not a plain byte-level vocabulary")
    # Printable bytes stand for themselves, the others in order for the code points from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of_char = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    ranks = {bytes(of_char[c] for c in token): k for token, k in made["model"]["vocab"].items()}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    added = {token["content"]: token["id"] for token in made["added_tokens"]}
    at_added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

    def encode(text: str) -> list[int]:
        if not at_added or not at_added.search(text):
            return fast.encode_ordinary(text)
        ids: list[int] = []
        for k, part in enumerate(at_added.split(text)):
            ids += [added[part]] if k % 2 else fast.encode_ordinary(part)
        return ids

    return encode


def vocabulary_file(vocabulary: str) -> dict:
    with open(vocabulary, encoding="utf-8") as file:
        return json.load(file)


def id_limit(vocabulary: str, end_id: int) -> int:
    """A number above every id."""
    made = vocabulary_file(vocabulary)
    return 1 + max([end_id, *made["model"]["vocab"].values(), *(token["id"] for token in made["added_tokens"])])


def encoded(docs: DataFrame, vocabulary: str, end_id: int, ids_below: int, kind: str) -> DataFrame:
    """Token ids of each text with the end id after them, as numbers of ``kind``, how many, and the Hilbert key.

    One text of every batch, the one with the least hash, is also encoded by the ``tokenizers`` library itself; other
    ids there end the job. A null text is an empty one: the end id alone.
    """

    def make() -> Callable[[dict], Iterable[dict]]:
        import zlib

        from tokenizers import Tokenizer

        encode, library, projector = byte_pair_encoder(vocabulary), Tokenizer.from_file(vocabulary), Projector(ids_below)

        def step(batch: dict) -> Iterable[dict]:
            texts = [text or "" for text in batch["text"]]
            lists = [encode(text) for text in texts]
            drawn = min(range(len(texts)), key=lambda k: zlib.crc32(texts[k].encode("utf-8", "surrogatepass")))
            if library.encode(texts[drawn], add_special_tokens=False).ids != lists[drawn]:
                raise ValueError(f"ids of document {batch['doc_id'][drawn]} differ from the library's")
            arrays = [np.array([*one, end_id], dtype=kind) for one in lists]
            yield {
                "doc_id": batch["doc_id"], "n": [len(a) for a in arrays], "curve": projector.keys(arrays),
                "ids": [a.tobytes() for a in arrays],
            }

        return step

    return map_batches(docs.select("doc_id", "text"), make, ENCODED, BATCH_BYTES)


def placed_on_line(rows: DataFrame, order: list[str], size: str, name: str) -> DataFrame:
    """``rows`` range-sorted by ``order``, with ``name``: the sum of ``size`` over all rows before each one.

    ``order`` must tell rows apart. The ranges are summed as they are written; one number a range is then added up.
    """
    schema = schema_of(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", _before long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, arrow = 0, to_arrow_schema(schema)
        for batch in batches:
            sizes = batch.column(size).to_numpy(zero_copy_only=False).astype(np.int64)
            before = seen + np.cumsum(sizes) - sizes
            seen += int(sizes.sum())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], schema=arrow)

    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)
    ranges = stored(ranges.withColumn("_range", F.spark_partition_id()), "ranges")
    totals = ranges.groupBy("_range").agg(F.sum(size).alias("_total"))
    # One row a range, so at most as many as the shuffle has partitions.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select("_range", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_first"))
    placed = ranges.join(firsts, "_range")
    return placed.withColumn(name, F.col("_first") + F.col("_before")).drop("_range", "_first", "_before")


def sequence_starts(total: int, limit: int) -> tuple[int, np.ndarray]:
    """How many whole sequences there are, and where the sequences of the rest begin, powers of two in falling order."""
    whole = total // limit
    bits = [1 << b for b in range(limit.bit_length(), -1, -1) if (total - whole * limit) >> b & 1]
    return whole, whole * limit + np.concatenate(([0], np.cumsum(bits)))[: len(bits)].astype(np.int64)


def pack_along_curve(docs: DataFrame, vocabulary: str, limit: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of ``docs(doc_id, text)`` packed into sequences of ``limit`` tokens in the order of their Hilbert keys.

    Each piece has its document's ``doc_id``, ``doc_tokens`` and ``curve`` key, its ``start`` there, ``length`` and
    ``ids``, and its ``sequence_id`` and ``offset``. A document is cut where a sequence ends. All sequences are full, but
    for at most ``log2(limit)`` last ones, each a power of two long. Repeated rows, null ids and equal texts are documents
    of their own; a null or empty text is its end id alone; an empty table gives no piece.
    """
    row = "_row"
    ids_below = id_limit(vocabulary, end_id)
    kind = "<u2" if ids_below <= 1 << 16 else "<u4"  # as they are kept; pieces have 32 bits
    rows = stored(encoded(docs, vocabulary, end_id, ids_below, kind).withColumn(row, F.monotonically_increasing_id()), "encoded")
    narrow = rows.select(row, "n", "curve").withColumn("_tie", F.xxhash64(row))
    spots = stored(placed_on_line(narrow, ["curve", "_tie", row], "n", "at").select(row, "at"), "spots")
    total = rows.agg(F.sum("n").alias("n")).first().n or 0
    columns = schema_of(PIECES).names

    def make() -> Callable[[dict], Iterable[dict]]:
        whole, rest = sequence_starts(total, limit)

        def step(batch: dict) -> Iterable[dict]:
            out: dict[str, list] = {name: [] for name in columns}
            for doc_id, n, curve, ids, at in zip(*(batch[c] for c in ("doc_id", "n", "curve", "ids", "at")), strict=True):
                begins = np.arange(at // limit, min(whole, (at + n - 1) // limit + 1), dtype=np.int64)
                sequences = np.concatenate((begins, whole + np.flatnonzero(rest < at + n)))
                firsts = np.concatenate((begins * limit, rest[rest < at + n]))
                # Of the sequences that begin at or before this document the last one only.
                keep = max(int(np.searchsorted(firsts, at, side="right")) - 1, 0)
                sequences, firsts = sequences[keep:], firsts[keep:]
                starts, ids = np.maximum(firsts - at, 0), np.frombuffer(ids, dtype=kind).astype("<u4").tobytes()
                for sequence, first, start, end in zip(sequences, firsts, starts, [*starts[1:], n], strict=True):
                    piece = ids[4 * start : 4 * end]
                    values = (doc_id, n, curve, start, end - start, sequence, at + start - first, piece)
                    for column, value in zip(out, values, strict=True):
                        out[column].append(value)
            yield out

        return step

    return map_batches(rows.join(spots, row), make, PIECES, BATCH_BYTES)

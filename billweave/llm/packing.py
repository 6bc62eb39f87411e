"""Best-two-fit packing of token pieces into sequences of a fixed length.

A bin is filled greedily with the largest piece that fits; then its smallest piece is given back if two unpacked pieces
fill the widened gap more tightly. The choice depends on piece lengths alone, and there are only as many lengths as a
sequence has tokens. So the plan is made from the count of each length (a table of at most ``limit`` rows, whatever the
number of documents): a bin's pattern is repeated as long as its pieces last, which gives the same bins as one at a
time. Pieces are then ranked inside their length by Spark and take their place in the plan from their rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billweave.llm.common import BATCH_BYTES, map_batches, ranked, stored

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: How the vocabulary splits texts into words, and how it writes a word's end.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
#: A code point that is never assigned stands for the end of a word.
END_MARK = "\U0010ffff"
#: Line breaks, tabs, printable ASCII, Latin letters and signs, and marks of general punctuation.
PLAIN = r"\t\n\r\x20-\x7e\u00a1-\u024f\u2010-\u2027\u2030-\u205e"


def category_class(kind: str) -> str:
    """The letters (``L``) or digits (``N``) of plain texts in lower case, as ranges of a pattern's class."""
    import re
    import unicodedata

    plain = re.compile(f"[{PLAIN}]")
    lowered = {char for c in range(0x2100) if plain.match(chr(c)) for char in chr(c).lower()}
    found = sorted(ord(char) for char in lowered if unicodedata.category(char)[0] == kind)
    known = set(found)
    starts, ends = ([c for c in found if c + step not in known] for step in (-1, 1))
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(starts, ends, strict=True))


class WordIds:
    """Token ids of texts as the ``tokenizers`` library gives them, as little-endian bytes.

    The merges of the word vocabulary are handed to ``tiktoken``, which applies them several times faster. A word gets an
    end mark, a code point that stands in no text taken here; merges of the mark with the last byte come before all
    others, as in the vocabulary, whose last symbol of a word is another one from the start.

    Only texts of plain characters go this way: those that canonical composition leaves as they are, and for which lower
    case, letters, digits and white space are beyond doubt. Others, and texts that hold an added token, are encoded by the
    library, at any length.
    """

    def __init__(self, path: str):
        import json
        import re

        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        kinds = [part["type"] for part in made["normalizer"]["normalizers"]]
        split, model = made["pre_tokenizer"]["pretokenizers"][0], made["model"]
        known = split["pattern"]["Regex"] == WORD_PATTERN and split["invert"] and model["end_of_word_suffix"] == WORD_END
        if kinds != ["NFC", "Replace", "Lowercase"] or not known:
            raise ValueError("not a lower-case word vocabulary")
        # Printable bytes stand for themselves, the others in order for the code points from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        of_char = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
        mark = END_MARK.encode()

        def in_bytes(token: str) -> bytes:
            body = token.removesuffix(WORD_END)
            return bytes(of_char[c] for c in body) + (mark if body != token else b"")

        vocabulary = {in_bytes(token): k for token, k in model["vocab"].items()}
        merged = [in_bytes("".join(pair if isinstance(pair, list) else pair.split(" "))) for pair in model["merges"]]
        first = [mark[:k] for k in range(2, len(mark) + 1)] + [bytes([b]) + mark for b in range(256)]
        order = list(dict.fromkeys([*first, *(bytes([b]) for b in range(256)), *merged]))
        self.fast = tiktoken.Encoding(
            "words", pat_str=f"[^{END_MARK}]+{END_MARK}", mergeable_ranks={t: k for k, t in enumerate(order)}, special_tokens={}
        )
        self.ids_of = np.array([vocabulary.get(t, -1) for t in order], dtype=np.int64)
        letters, digits = category_class("L"), category_class("N")
        self.words = re.compile(f"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|[{digits}]|[^\\s{letters}{digits}]+")
        self.odd, self.added = re.compile(f"[^{PLAIN}]"), [token["content"] for token in made["added_tokens"]]

    def library_ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def is_plain(self, text: str) -> bool:
        return not self.odd.search(text) and not any(token in text for token in self.added)

    def ids(self, text: str) -> bytes:
        if not self.is_plain(text):
            return self.library_ids(text)
        words = self.words.findall(text.lower())
        if not words:
            return b""
        ids = self.ids_of[self.fast.encode_ordinary(END_MARK.join(words) + END_MARK)]
        if ids.min() < 0:
            raise ValueError("a word's end mark was not merged")
        return ids.astype("<u4").tobytes()


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per Python worker, as workers serve many tasks."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def cut_pieces(docs: DataFrame, vocabulary: str, limit: int = 2048, end_id: int = 0) -> DataFrame:
    """Encode ``docs(doc_id, text)``, add the end id, and cut what is longer than ``limit`` into pieces.

    One text of every batch, drawn by hash, is encoded by the library too; other ids there end the job. Texts of any
    length are encoded whole; null ids and repeated rows are rows like any others.
    """

    def make() -> Callable[[dict], Iterable[dict]]:
        encoder, end = word_ids(vocabulary), np.array([end_id], dtype="<u4").tobytes()

        def step(batch: dict) -> Iterable[dict]:
            out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            texts = [text or "" for text in batch["text"]]
            drawn = min(texts, key=lambda text: zlib.crc32(text.encode("utf-8", "surrogatepass")))
            if encoder.ids(drawn) != encoder.library_ids(drawn):
                raise ValueError("ids differ from the library's")
            for doc_id, text in zip(batch["doc_id"], texts, strict=True):
                ids = encoder.ids(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at : at + 4 * limit]
                    for column, value in zip(out, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        out[column].append(value)
            yield out

        return step

    return map_batches(docs.select("doc_id", "text"), make, PIECES, BATCH_BYTES)


def plan_bins(counts: dict[int, int], limit: int) -> list[tuple[int, list[int]]]:
    """Best-two-fit on a histogram of lengths: (how often, lengths in order) for each pattern of a bin.

    At most about ``limit * ln(limit)`` patterns: each one ends when a length has too few pieces left for it.
    """
    left = np.zeros(limit + 1, dtype=np.int64)
    for length, count in counts.items():
        left[length] = count
    lengths = np.arange(limit + 1)
    patterns = []
    while left.any():
        free, bin_, gap = left.copy(), [], limit
        while gap:
            fits = np.flatnonzero(free[: gap + 1])
            if not fits.size:
                break
            take = int(fits[-1])
            times = min(int(free[take]), gap // take)
            bin_ += [take] * times
            free[take] -= times
            gap -= take * times
        if gap and len(bin_) > 1 or gap and bin_:
            smallest = bin_[-1]
            space = gap + smallest
            largest = np.maximum.accumulate(np.where(free > 0, lengths, 0))  # largest free length up to each length
            one = np.flatnonzero(free[:space])
            one = one[one > 0]
            if one.size:
                other = largest[space - one]
                alone = (other == one) & (free[one] < 2)
                other = np.where(alone, largest[np.maximum(one - 1, 0)], other)
                total = np.where(other > 0, one + other, 0)
                best = int(total.argmax())
                if total[best] > smallest:
                    bin_[-1:] = sorted((int(one[best]), int(other[best])), reverse=True)
        need = np.bincount(bin_, minlength=limit + 1)
        used = need > 0
        times = int((left[used] // need[used]).min())
        left -= times * need
        patterns.append((times, bin_))
    return patterns


def places(patterns: list[tuple[int, list[int]]], limit: int) -> dict[str, np.ndarray]:
    """For each length and run of ranks: the first sequence, pieces of that length in each, and their first offset."""
    seen = np.zeros(limit + 1, dtype=np.int64)
    rows, sequence = [], 0
    for times, lengths in patterns:
        offset = 0
        for length, copies in dict.fromkeys(lengths, 0).items():
            copies = lengths.count(length)
            rows.append((length, int(seen[length]), copies, sequence, offset))
            seen[length] += times * copies
            offset += copies * length
        sequence += times
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "copies", "sequence", "offset"), table.T, strict=True))


def pack(pieces: DataFrame, limit: int = 2048) -> DataFrame:
    """Give each row of ``pieces`` (with ``doc_id``, ``piece``, ``length``) a ``sequence_id`` and ``offset``.

    Lengths must be from 1 to ``limit``. Repeated rows are packed as often as they occur; an empty table gives none.
    """
    columns = pieces.columns
    histogram = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``limit`` rows
    plan = places(plan_bins({r["length"]: r["n"] for r in histogram}, limit), limit)
    by_length = ranked(pieces, ["length"], ["doc_id", "piece"])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def make() -> Callable[[dict], Iterable[dict]]:
        starts = plan["length"] * (1 << 48) + plan["rank"]

        def step(batch: dict) -> Iterable[dict]:
            length, rank = np.array(batch["length"], dtype=np.int64), np.array(batch["rank"], dtype=np.int64)
            at = np.searchsorted(starts, length * (1 << 48) + rank, side="right") - 1
            inside = rank - plan["rank"][at]
            out = {c: batch[c] for c in columns}
            out["sequence_id"] = plan["sequence"][at] + inside // plan["copies"][at]
            out["offset"] = plan["offset"][at] + inside % plan["copies"][at] * length
            yield out

        return step

    return map_batches(by_length.select(*columns, "rank"), make, f"{ddl}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """Encode, cut and pack ``docs``. A null or empty text is one piece that holds the end id alone."""
    return pack(stored(cut_pieces(docs, vocabulary, limit), "pieces"), limit)

"""SentencePiece encoding and decoding for merge-type vocabularies, in Arrow batches.

An agenda holds adjacent symbol pairs whose union is a piece, best score first and leftmost among equals; taking one joins
its symbols and adds the two new neighbours. What is left and isn't in the vocabulary becomes byte pieces. Short chunks of
one length have their agendas in the rows of a table, from which one pair a row is taken at a time; others have a heap.
Pieces hold the space mark only at their start, and characters that occur in no longer piece never join: a text is cut
there into chunks that are encoded once and kept in a bounded cache. In each batch, all chunks that are new go to the
sentencepiece library as well, to be encoded and decoded; a difference raises an error.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import DataFrame

from billweave.llm.common import map_batches

SPACE = "▁"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Chunks that a worker remembers, in two halves: when the newer one is full, the older one goes.
CACHED_CHUNKS = 1_500_000
LONG_CHUNK = 200
#: Chunks of up to so many symbols have their agendas in a table.
SHORT_CHUNK = 24
#: So many new chunks make one text for the library.
CHECKED_TOGETHER = 500
NO_PAIR = np.int32(2**31 - 1)


class PieceCodec:
    """Encoder and decoder on the pieces and scores of a model file; identity normalization with a leading space."""

    def __init__(self, path: str, cached: int = CACHED_CHUNKS):
        from sentencepiece import SentencePieceProcessor

        self.library, self.cached = SentencePieceProcessor(model_file=path), cached
        model = self.library
        every = range(model.get_piece_size())
        self.pieces = [model.id_to_piece(i) for i in every]
        self.bytes = {i: int(self.pieces[i][3:5], 16) for i in every if model.is_byte(i)}
        self.byte_ids = {b: i for i, b in self.bytes.items()}
        plain = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.scores = {self.pieces[i]: model.get_score(i) for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids) or any("\n" in p for p in self.ids):
            raise ValueError("pieces across spaces or with line breaks: texts can't be cut into chunks")
        self.chunks = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
        self.known: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}
        self.numbers = [str(i) for i in every]
        self.spaced = [p.replace(SPACE, " ") for p in self.pieces]
        self.pair_table()

    def pair_table(self) -> None:
        """All pairs of pieces whose union is a piece: sorted keys, with the union's place by score and its id."""
        self.single = {p: i for p, i in self.ids.items() if len(p) == 1}
        places = {s: k for k, s in enumerate(sorted(set(self.scores.values()), reverse=True))}
        cuts = ((p[:k], p[k:], p) for p in self.ids for k in range(1, len(p)))
        known = [(self.ids[a], self.ids[b], places[self.scores[p]], self.ids[p]) for a, b, p in cuts if a in self.ids and b in self.ids]
        a, b, place, union = np.array(known or [(0, 0, NO_PAIR, 0)], np.int64).T
        key = a * len(self.pieces) + b
        order = np.argsort(key)
        self.pair_keys, self.pair_places, self.pair_unions = key[order], place[order].astype(np.int32), union[order].astype(np.int32)

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Row in the table of pairs of each (a, b), -1 where their union is no piece."""
        key = a.astype(np.int64) * len(self.pieces) + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, at, -1)

    def places(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at = self.pairs(a, b)
        return np.where(at >= 0, self.pair_places[at], NO_PAIR)

    def merge_table(self, chunks: list[str]) -> dict[str, list[int]]:
        """Ids of chunks of one length, all of characters that are pieces.

        A row of ``agenda`` has the places of a chunk's adjacent pairs. In each round every row gives its best pair, the
        leftmost among equals, and is one symbol shorter then; rows without a pair are done.
        """
        single, out, n = self.single, {}, len(chunks[0])
        row = np.arange(len(chunks))
        symbols = np.array([single[x] for c in chunks for x in c], np.int32).reshape(len(chunks), n)
        agenda = self.places(symbols[:, :-1], symbols[:, 1:])
        while len(row):
            best = agenda.argmin(1) if n > 1 else np.zeros(len(row), int)
            going = agenda[np.arange(len(row)), best] < NO_PAIR if n > 1 else np.zeros(len(row), bool)
            done = ~going
            for k, ids in zip(row[done].tolist(), symbols[done].tolist(), strict=True):
                out[chunks[k]] = ids
            row, symbols, agenda, best = row[going], symbols[going], agenda[going], best[going]
            if not len(row):
                break
            every = np.arange(len(row))
            symbols[every, best] = self.pair_unions[self.pairs(symbols[every, best], symbols[every, best + 1])]
            symbols = symbols[np.arange(n) != best[:, None] + 1].reshape(len(row), n - 1)
            agenda = agenda[np.arange(n - 1) != best[:, None]].reshape(len(row), n - 2)
            n -= 1
            for side in (best - 1, best):
                inside = np.flatnonzero((side >= 0) & (side < n - 1))
                at = side[inside]
                agenda[inside, at] = self.places(symbols[inside, at], symbols[inside, at + 1])
        return out

    def merge_all(self, chunks: list[str]) -> dict[str, list[int]]:
        tables: dict[int, list[str]] = {}
        out, single = {}, self.single.keys()
        for chunk in chunks:
            if len(chunk) <= SHORT_CHUNK and single >= set(chunk):
                tables.setdefault(len(chunk), []).append(chunk)
            else:
                out[chunk] = self.merge(chunk)
        for same in tables.values():
            out |= self.merge_table(same)
        return out

    def merge(self, chunk: str) -> list[int]:
        symbols: list[str] = list(chunk)
        n, scores = len(symbols), self.scores
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            joined = symbols[i] + symbols[i + 1]
            if joined in scores:
                agenda.append((-scores[joined], i, joined))
        heapq.heapify(agenda)
        while agenda:
            _, i, joined = heapq.heappop(agenda)
            j = right[i]
            # A symbol that was joined elsewhere since is empty or has grown.
            if j >= n or not symbols[i] or len(symbols[i]) + len(symbols[j]) != len(joined) or symbols[i] + symbols[j] != joined:
                continue
            symbols[i], symbols[j] = joined, ""
            right[i] = after = right[j]
            if after < n:
                left[after] = i
                wider = joined + symbols[after]
                if wider in scores:
                    heapq.heappush(agenda, (-scores[wider], i, wider))
            before = left[i]
            if before >= 0:
                wider = symbols[before] + joined
                if wider in scores:
                    heapq.heappush(agenda, (-scores[wider], before, wider))
        ids: list[int] = []
        for symbol in symbols:
            if symbol in self.ids:
                ids.append(self.ids[symbol])
            elif symbol:
                ids += [self.byte_ids[b] for b in symbol.encode()]
        return ids

    def split(self, text: str) -> list[str]:
        return self.chunks.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def learn(self, texts: list[list[str]]) -> list[str]:
        """Make the chunks of a batch known, those that are new after the library has agreed; these are returned."""
        wanted = set().union(*texts)
        if len(self.known) + len(wanted) > self.cached // 2:
            self.known, self.older = {}, self.known
        older, known = self.older, self.known
        known |= {c: older[c] for c in wanted if c in older and c not in known}
        new = [c for c in wanted if c not in known]
        fresh = self.merge_all(new)
        for c in new:
            ids = fresh[c]
            plain = self.bytes.keys().isdisjoint(ids)
            text = "".join([self.spaced[i] for i in ids]) if plain else self.decode([self.ids[SPACE], *ids])
            known[c] = (",".join([self.numbers[i] for i in ids]), text)
        # Line breaks never join, so between them each chunk is encoded as it is in its text.
        line, spaced = self.merge("\n"), [c for c in new if c != "\n"]
        if not spaced:
            return new
        parts = [spaced[at : at + CHECKED_TOGETHER] for at in range(0, len(spaced), CHECKED_TOGETHER)]
        ours = [[self.ids[SPACE], *(i for c in part for i in (*line, *fresh[c]))] for part in parts]
        if self.library.encode(["\n" + "\n".join(part).replace(SPACE, " ") for part in parts]) != ours:
            raise ValueError("ids differ from the library's")
        if self.library.decode(ours) != ["\n" + "\n".join([known[c][1] for c in part]) for part in parts]:
            raise ValueError("decoded text differs from the library's")
        return new

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids: marks become spaces, the first of them goes, runs of byte pieces are read as UTF-8."""
        out, run, first = [], bytearray(), True
        for i in ids:
            if i in self.bytes:
                run.append(self.bytes[i])
            else:
                if run:
                    out.append(run.decode("utf-8", "replace"))
                    run = bytearray()
                piece = self.pieces[i]
                out.append((piece[1:] if first and piece.startswith(SPACE) else piece).replace(SPACE, " "))
            first = False
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def encode(self, text: str) -> list[int]:
        return [i for c in self.split(text) for i in self.merge(c)]

    def digests(self, texts: list[str]) -> Iterable[tuple[int, str, str]]:
        """Count of ids, digest of the ids and digest of the decoded text, for each text of a batch."""
        split = [self.split(t) for t in texts]
        fresh = self.learn(split)
        known = self.known
        for text, chunks in zip(texts, split, strict=True):
            parts = [known[c] for c in chunks]
            listed = ",".join([ids for ids, _ in parts])
            decoded = "".join([part for _, part in parts])[1:] if chunks and chunks[0][0] == SPACE else ""
            n = listed.count(",") + 1 if listed else 0
            yield n, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
        for chunk in [c for c in fresh if len(c) > LONG_CHUNK]:
            del known[chunk]


_LOADED: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """One per Python worker, as workers serve many tasks."""
    if path not in _LOADED:
        _LOADED[path] = PieceCodec(path)
    return _LOADED[path]


def piece_digests(docs: DataFrame, model: str, batch_chars: int = 4_000_000) -> DataFrame:
    """Encode and decode ``docs(doc_id, text)``. Null and empty texts have no ids and decode to the empty text.

    Rows are taken together up to ``batch_chars`` characters, a longer text alone, which bounds what a batch holds.
    """

    def make() -> Callable[[dict], Iterable[dict]]:
        pieces = codec(model)

        def step(batch: dict) -> Iterable[dict]:
            texts, at = [t or "" for t in batch["text"]], 0
            while at < len(texts):
                end, chars = at + 1, len(texts[at])
                while end < len(texts) and chars + len(texts[end]) <= batch_chars:
                    chars += len(texts[end])
                    end += 1
                n, ids, decoded = zip(*pieces.digests(texts[at:end]), strict=True)
                yield {"doc_id": batch["doc_id"][at:end], "n_tokens": n, "ids_sha256": ids, "decoded_sha256": decoded}
                at = end

        return step

    return map_batches(docs.select("doc_id", "text"), make, DIGESTS)

"""Token counts of sections: documents are encoded once, as wholes, and tokens are joined to sections by their spans.

Each token's character span is matched to the sections that it overlaps (a sorted interval join inside the document). A
token that crosses a boundary goes to one section by an explicit rule: ``first`` or ``last`` of those that it overlaps,
or ``most``, the one that holds most of its characters, the earlier one if two hold as many. So the counts of the
sections of a document always add up to its tokens, which counting the sections apart doesn't give.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import DataFrame

from billweave.llm.common import map_batches

COUNTS = "doc_id long, section int, start long, end long, n_tokens long, n_crossing long"
#: A line with its line break.
LINES = r"[^\n]*\n|[^\n]+"
RULES = ("first", "last", "most")


def token_spans(text: str, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character spans of tokens from their lengths in bytes; a character cut in two belongs to both its tokens."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    char = np.cumsum((data & 0xC0) != 0x80) - 1
    ends = np.cumsum(lengths)
    return char[ends - lengths], char[ends - 1] + 1


def allot(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and boundary-crossing tokens of each section; ``bounds`` are the sections' starts."""
    first = np.searchsorted(bounds, starts, side="right") - 1
    last = np.searchsorted(bounds, ends - 1, side="right") - 1
    crossing = np.flatnonzero(first != last)
    home = last.copy() if rule == "last" else first.copy()
    if rule == "most":
        for k in crossing:
            edges = np.concatenate(([starts[k]], bounds[first[k] + 1 : last[k] + 1], [ends[k]]))
            home[k] = first[k] + int(np.diff(edges).argmax())
    n = len(bounds)
    return np.bincount(home, minlength=n), np.bincount(home[crossing], minlength=n)


def section_tokens(docs: DataFrame, vocabulary: str, sections: str = LINES, rule: str = "most") -> DataFrame:
    """A row per section of ``docs(doc_id, text)``: its span, its tokens and those of them that cross its bounds.

    ``vocabulary`` is a rank file of byte pairs. ``sections`` is a pattern whose matches cover each text without gaps.
    Null and empty texts have one empty section without tokens; repeated rows give repeated sections.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def make() -> Callable[[dict], Iterable[dict]]:
        import base64

        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        encoder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            size[rank] = len(token)
        pattern = re.compile(sections)

        def step(batch: dict) -> Iterable[dict]:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                found = [m.span() for m in pattern.finditer(text)] if text else [(0, 0)]
                spans = np.array([s for s in found if s[0] < s[1]] or [(0, 0)], dtype=np.int64)
                if text and (spans[0, 0] or spans[-1, 1] != len(text) or (spans[1:, 0] != spans[:-1, 1]).any()):
                    raise ValueError("sections must cover a text without gaps")
                starts, ends = token_spans(text, size[encoder.encode_ordinary(text)]) if text else (np.zeros(0, int),) * 2
                tokens, crossing = allot(starts, ends, spans[:, 0], rule)
                n = len(spans)
                yield {
                    "doc_id": [doc_id] * n, "section": np.arange(n), "start": spans[:, 0], "end": spans[:, 1],
                    "n_tokens": tokens, "n_crossing": crossing,
                }

        return step

    def gathered() -> Callable[[dict], Iterable[dict]]:
        step = make()

        def whole(batch: dict) -> Iterable[dict]:
            parts = list(step(batch))
            yield {c: np.concatenate([p[c] for p in parts]) if c != "doc_id" else [d for p in parts for d in p[c]] for c in parts[0]}

        return whole

    return map_batches(docs.select("doc_id", "text"), gathered, COUNTS)

"""Edge rows and small helpers of the operators' tests."""

from __future__ import annotations

SCHEMA = "doc_id long, text string"
LONG = "wordy " * 30_000 + "end."
EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "One."), (4, "One."), (5, LONG), (6, "One."), (None, "no id here at all"), (7, "x" * 5000)]


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}

"""Fill-in-middle transformation: documents cut at two line ranks and put together in another order.

The lines of a text form an indexable skip list. Its lowest lane links every line to the next, each higher lane about
half of the towers of the one below; a link carries the units that it passes over and their code points. A cut rank is
reached from the top lane: a link is taken while the units passed stay at or below the rank, else the search goes down
a lane. Both widths are added up on the way, so the place of the cut in the text is exact, in logarithmic time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billweave.llm.common import BATCH_BYTES, map_batches

#: The markers before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class SkipList:
    """Units of given code-point widths, found by their rank.

    A tower stands at the end of every unit. Heights are those of fair coins, drawn from a hash of the tower's number, so
    that equal texts have equal lists; ``lanes`` go from the highest to the lowest, each with the units and the code
    points of its links, and for each tower the place of that tower in the lane below.
    """

    def __init__(self, widths: np.ndarray):
        self.n = len(widths)
        numbers = np.arange(1, self.n + 1, dtype=np.uint64)
        mixed = (numbers * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        ends, self.lanes = np.concatenate(([0], np.cumsum(widths))), []
        towers = np.arange(self.n + 1)  # tower 0 is the head, in every lane
        down = towers
        for lane in range(33):
            self.lanes.append((np.diff(towers).tolist(), np.diff(ends[towers]).tolist(), down.tolist()))
            stays = np.concatenate(([True], (mixed[towers[1:] - 1] >> np.uint64(lane)) & np.uint64(1) == 1))
            if len(towers) < 3 or stays.all():
                break
            down = np.flatnonzero(stays)
            towers = towers[down]
        self.lanes.reverse()

    def code_points(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        units = points = at = 0
        for unit_widths, point_widths, down in self.lanes:
            while at < len(unit_widths) and units + unit_widths[at] <= rank:
                units += unit_widths[at]
                points += point_widths[at]
                at += 1
            at = down[at]
        return points


def line_widths(text: str) -> np.ndarray:
    """Code points of each line with its line feed; only a line feed ends a line."""
    ends = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4") == 10) + 1
    if not len(ends) or ends[-1] < len(text):
        ends = np.append(ends, len(text))
    return np.diff(ends, prepend=0) if text else ends[:0]


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers from 0 to 2**32 - 1 that depend on seed and id alone; a null id draws as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def transform(docs: DataFrame, seed: int = 7, percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """A row for each of ``docs(doc_id, text)``: ``n`` lines, ``form``, ``prefix_chars``, ``middle_chars``, ``output``.

    ``percent`` of the documents are cut at two line ranks, which their ids draw, and ``spm_percent`` of these get the
    form ``spm`` (suffix, prefix, middle), the others ``psm``. An empty text and one that holds a marker stay as they
    are, form ``plain`` with null lengths; a null text is an empty one. Repeated rows are transformed alike.
    """

    def make() -> Callable[[dict], Iterable[dict]]:
        def one(doc_id: int | None, text: str) -> tuple:
            widths = line_widths(text)
            n = len(widths)
            h1, h2, h3, h4 = draws(seed, doc_id)
            if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= percent:
                return n, "plain", None, None, text
            lines = SkipList(widths)
            first, second = (lines.code_points(rank) for rank in sorted((h1 % (n + 1), h2 % (n + 1))))
            prefix, middle, suffix = text[:first], text[first:second], text[second:]
            if h4 % 100 < spm_percent:
                form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
            else:
                form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
            return n, form, len(prefix), len(middle), output

        def step(batch: dict) -> Iterable[dict]:
            texts = [text or "" for text in batch["text"]]
            made = [one(*row) for row in zip(batch["doc_id"], texts, strict=True)]
            columns = zip(*made, strict=True)
            names = ("n", "form", "prefix_chars", "middle_chars", "output")
            yield {"doc_id": batch["doc_id"]} | dict(zip(names, columns, strict=True))

        return step

    return map_batches(docs.select("doc_id", "text"), make, CUTS, BATCH_BYTES)


def restored(output: Column, form: Column) -> Column:
    """The exact text from an output and its form.

    The parts hold no marker, nor can a part's end and the next marker's beginning make another one, so the output
    splits at its three markers and nowhere else.
    """
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    psm = F.concat(parts[1], parts[3], parts[2])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(F.concat(parts[2], parts[3], parts[1]))

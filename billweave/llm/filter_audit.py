"""Filter interaction audit: what every order of a set of filters removes, and where.

A document is known by the set of filters that it fails, its mask. In the lexicographic list of all orders of the
filters, the orders that begin alike are neighbours: a beginning of ``s`` of ``k`` filters holds ``(k - s)!`` ranks from
the rank that its Lehmer code gives. A document is removed at step ``s`` exactly in the orders whose first ``s - 1``
filters it passes and whose ``s``-th it fails, so its removals are a few intervals of ranks. Documents are first counted
by part and mask; each count is added where an interval begins and taken off where it ends, and one running sum over
the ranks gives the removals of all orders at once. No document is run through any order.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billweave.llm.common import stored

SPACES = r"[\x20\x09-\x0D]+"
#: The filters of :func:`failures`, in the order of their letters.
LETTERS = "ABCDE"
COUNTS = ["docs", "good", "toxic"]


def lehmer_rank(order: tuple[int, ...], k: int) -> int:
    """Rank of the first of all orders of ``k`` filters that begin with ``order``, in lexicographic order."""
    left, rank = list(range(k)), 0
    for step, f in enumerate(order):
        rank += left.index(f) * factorial(k - 1 - step)
        left.remove(f)
    return rank


def removal_ends(k: int) -> list[tuple[int, int, int, int, int]]:
    """Ends of the intervals of ranks in which a mask is removed: (mask, filter, step, rank, +1 or -1).

    For five filters 1,680 rows. An interval that ends after the last rank needs no end.
    """
    ends = []
    for step in range(1, k + 1):
        for start in permutations(range(k), step):
            passed, failed = sum(1 << f for f in start[:-1]), start[-1]
            first = lehmer_rank(start, k)
            for mask in range(1 << k):
                if mask >> failed & 1 and not mask & passed:
                    ends.append((mask, failed, step, first, 1))
                    if first + factorial(k - step) < factorial(k):
                        ends.append((mask, failed, step, first + factorial(k - step), -1))
    return ends


def failures(docs: DataFrame, others: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``others``, ``text_hash`` and ``mask``: the filters of A to D that a text fails, as bits.

    A: under 200 words; B: under half of the words are distinct; C: over 2% of the characters are A-Z; D: a character of
    ``#$%&*|``. A null text is an empty one: it fails A alone.
    """
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split("_text", SPACES), "")
    n_words, n_distinct = F.size("_words"), F.size(F.array_distinct("_words"))
    capitals = F.length("_text") - F.length(F.regexp_replace("_text", "[A-Z]+", ""))
    fails = [
        n_words < 200, 100 * n_distinct < 50 * n_words, 100 * capitals > 2 * F.length("_text"),
        F.col("_text").rlike(r"[#$%&*|]"),
    ]
    mask = sum((F.when(f, 1 << bit).otherwise(0) for bit, f in enumerate(fails)), F.lit(0))
    narrow = docs.select("doc_id", *others, text.alias("_text")).withColumn("_words", words)
    return narrow.select("doc_id", *others, F.unhex(F.sha2("_text", 256)).alias("text_hash"), mask.alias("mask"))


def masked(docs: DataFrame, part: Column) -> DataFrame:
    """Rows of ``docs(doc_id, text)`` by ``part``, ``doc_id``, text and mask, with the number ``n`` of equal rows.

    The fifth filter, E, fails where a smaller doc_id has the same text. A null id is not compared: it neither fails E
    nor makes others fail it. Repeated rows of the smallest id all pass. The smallest id of each text is found by a
    partial aggregate, and it is matched on text and id together, so that a text that a third of all rows share is a
    hot key nowhere.
    """
    rows = failures(docs.withColumn("_part", part), ("_part",))
    rows = rows.groupBy("_part", "doc_id", "text_hash", "mask").agg(F.count(F.lit(1)).alias("n"))
    rows = stored(rows, "audited")  # narrow; texts are read once
    firsts = rows.groupBy("text_hash").agg(F.min("doc_id").alias("doc_id")).withColumn("_first", F.lit(True))
    # Null ids match nothing; a salt from the text spreads them over the tasks of the join.
    salt = F.when(F.col("doc_id").isNull(), F.col("text_hash")).otherwise(F.lit(b""))
    both = ["doc_id", "text_hash"]
    found = rows.join(firsts, both, "left")
    repeated = F.col("doc_id").isNotNull() & F.col("_first").isNull()
    mask = F.col("mask") + F.when(repeated, 1 << LETTERS.index("E")).otherwise(0)
    return found.select(F.col("_part").alias("part"), "doc_id", salt.alias("salt"), mask.alias("mask"), "n")


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, good ones and toxic ones of each part and mask: at most 32 rows a part.

    A document is good or toxic if any of its rows in ``labels(doc_id, quality, toxic)`` says so.
    """
    known = labels.groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("is_good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("is_toxic"),
    )
    found = rows.join(known.withColumn("salt", F.lit(b"")), ["doc_id", "salt"], "left")
    total = lambda wanted: F.coalesce(F.sum(F.when(wanted, F.col("n"))), F.lit(0))
    return found.groupBy("part", "mask").agg(
        F.sum("n").alias("docs"), total(F.col("is_good")).alias("good"), total(F.col("is_toxic")).alias("toxic")
    )


def audit(counts: DataFrame, letters: str) -> DataFrame:
    """A row for each part, order of the filters and step from ``counts(part, mask, docs, good, toxic)``.

    ``letters`` names the filters by the bits of a mask, at most eight, as the orders are listed. ``kept`` and
    ``removed`` are documents after and at the step, ``redundant`` those that fail its filter but went earlier,
    ``unique_fails`` those that fail no other filter, ``good_lost`` and ``toxic_lost`` labelled ones removed at the step,
    ``shapley`` the removals of its filter, at any step, over all orders. Parts are those of ``counts``; zeros are rows.
    """
    spark, k = counts.sparkSession, len(letters)
    if not 0 < k <= 8 or sorted(set(letters)) != list(letters):
        raise ValueError("letters must be up to eight different ones in order")
    ends = spark.createDataFrame(removal_ends(k), "mask int, filter int, step int, rank int, sign int")
    ends = ends.groupBy("mask").agg(F.collect_list(F.struct("filter", "step", "rank", "sign")).alias("ends"))
    # One row a mask, 2**k at most: small enough for every executor.
    deltas = counts.join(F.broadcast(ends), "mask").select("part", F.inline("ends"), *COUNTS)
    deltas = deltas.groupBy("part", "filter", "step", "rank").agg(*[F.sum(F.col("sign") * F.col(c)).alias(c) for c in COUNTS])

    orders = ["".join(letters[f] for f in order) for order in permutations(range(k))]
    of_mask = lambda wanted: F.sum(F.when(wanted, F.col("docs")).otherwise(0))
    parts = counts.groupBy("part").agg(
        F.sum("docs").alias("total"),
        F.array(*[of_mask(F.col("mask").bitwiseAND(1 << f) != 0) for f in range(k)]).alias("fails"),
        F.array(*[of_mask(F.col("mask") == 1 << f) for f in range(k)]).alias("alone"),
    )
    # The places at which totals are read off: every rank and step, with the filter that stands there.
    order = F.element_at(F.split(F.lit(" ".join(orders)), " "), F.col("rank") + 1)
    places = parts.select("part", F.explode(F.sequence(F.lit(0), F.lit(factorial(k) - 1))).alias("rank"))
    places = places.select("part", "rank", order.alias("filter_order"), F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    places = places.withColumn("filter", F.instr(F.lit(letters), letter) - 1)

    # A part, filter and step has at most 2 * k! rows here.
    along = Window.partitionBy("part", "filter", "step").orderBy("rank").rangeBetween(Window.unboundedPreceding, 0)
    both = places.unionByName(deltas, allowMissingColumns=True)
    sums = [F.coalesce(F.sum(c).over(along), F.lit(0)).alias(c) for c in COUNTS]
    rows = both.select("part", "filter", "step", "rank", "filter_order", *sums).where("filter_order IS NOT NULL")
    in_order = Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("gone", F.sum("docs").over(in_order))
    rows = rows.withColumn("shapley", F.sum("docs").over(Window.partitionBy("part", "filter"))).join(parts, "part")
    at = lambda name: F.element_at(name, F.col("filter") + 1)
    long = {
        # A filter removes at its own step alone: what fails it and is not removed there went earlier.
        "kept": F.col("total") - F.col("gone"), "removed": F.col("docs"), "redundant": at("fails") - F.col("docs"),
        "unique_fails": at("alone"), "good_lost": F.col("good"), "toxic_lost": F.col("toxic"), "shapley": F.col("shapley"),
    }
    return rows.select("part", "filter_order", "step", *[c.cast("long").alias(name) for name, c in long.items()])


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """:func:`audit` of the five filters on ``docs(doc_id, text, source)``, a part for each source; a null one is ''.

    An empty table has no part and gives no row.
    """
    rows = masked(docs, F.coalesce("source", F.lit("")))
    return audit(stored(mask_counts(rows, labels), "mask_counts"), LETTERS)

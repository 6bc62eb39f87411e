"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in Spark expressions alone.

A text is cut into paragraphs (lines, long ones in parts); each distinct paragraph's digest goes into one cell in each of
``REGIONS`` regions of a small table. A cell holds how many digests it got, their exclusive or, and that of their checks.
Two versions' tables subtract cell by cell, and what they share cancels out. A cell left with one digest shows it; taking
that digest from its other cells (peeling) uncovers more, until the differing digests of both sides are known. Where
peeling gets stuck, a larger table is tried: the digests are dealt to four tables by two more bits of their hash, and
each of those that gets stuck to four more. So the work grows with the number of paragraphs, and no text is cut off.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

REGIONS, CELLS = 3, 8
PART_CHARS = 160
#: Doublings of two bits; with 2 * LEVELS bits of a hash even millions of paragraphs are a few in each table.
LEVELS = 12
ROUNDS = 8


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: Spark doesn't share what a lambda repeats."""
    return F.element_at(F.transform(F.array(value), body), 1)


def digests(text: Column) -> Column:
    """Distinct digests of the paragraphs of a text; together they cover all of it."""
    parts = F.regexp_extract_all(text, F.lit(rf"([^\n]{{1,{PART_CHARS}}}\n?|\n)"), F.lit(1))
    return F.array_distinct(F.transform(F.coalesce(parts, F.array().cast("array<string>")), lambda p: F.xxhash64(p)))


def check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(-1)).bitwiseAND(F.lit(0xFFFFFFFF))


def placed(key: Column, n: Column | int = 1) -> Column:
    """A digest, how often it counts, its check and its cell in each region."""
    cells = [F.pmod(F.xxhash64(key, F.lit(r)), F.lit(CELLS)).cast("int").alias(f"cell{r}") for r in range(REGIONS)]
    return F.struct(key.alias("k"), (F.lit(n) if isinstance(n, int) else n).cast("long").alias("n"), check(key).alias("c"), *cells)


def entry(n: Column, k: Column, c: Column) -> Column:
    return F.struct(n.cast("long").alias("n"), k.alias("k"), c.alias("c"))


def without(cell: Column, gone: Column) -> Column:
    return F.aggregate(gone, cell, lambda s, g: entry(s["n"] - g["n"], s["k"].bitwiseXOR(g["k"]), s["c"].bitwiseXOR(g["c"])))


def less(cells: Column, gone: Column) -> Column:
    """All cells without the placed digests in ``gone``."""

    def region(r: int) -> Column:
        part = F.slice(cells, r * CELLS + 1, CELLS)
        return F.transform(part, lambda cell, i: without(cell, F.filter(gone, lambda g: g[f"cell{r}"] == i)))

    return F.concat(*[region(r) for r in range(REGIONS)])


def table(keys: Column) -> Column:
    """The cells of a set of digests."""
    zero = entry(F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long"))
    return let(F.transform(keys, lambda k: placed(k, -1)), lambda every: less(F.array_repeat(zero, REGIONS * CELLS), every))


def subtract(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: entry(a["n"] - b["n"], a["k"].bitwiseXOR(b["k"]), a["c"].bitwiseXOR(b["c"])))


def is_empty(cell: Column) -> Column:
    return (cell["n"] == 0) & (cell["k"] == 0) & (cell["c"] == 0)


def peel(cells: Column) -> Column:
    """The number of differing digests of a subtracted table, or null where peeling gets stuck.

    A round takes the digests of all cells that show one, once each, out of all their cells.
    """

    def step(state: Column, _: Column) -> Column:
        def shows(n: int) -> Column:
            pure = F.filter(state["cells"], lambda c: (c["n"] == n) & (check(c["k"]) == c["c"]))
            return F.transform(F.array_distinct(F.transform(pure, lambda c: c["k"])), lambda k: placed(k, n))

        def after(shown: Column) -> Column:
            return F.struct(
                F.when(F.size(shown) == 0, state["cells"]).otherwise(less(state["cells"], shown)).alias("cells"),
                (state["found"] + F.size(shown)).cast("long").alias("found"),
                (F.size(shown) > 0).alias("going"),
            )

        return F.when(state["going"], let(F.concat(shows(1), shows(-1)), after)).otherwise(state)

    start = F.struct(cells.alias("cells"), F.lit(0).cast("long").alias("found"), F.lit(True).alias("going"))
    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, start, step, lambda s: F.when(F.forall(s["cells"], is_empty), s["found"]))


def differing(own: Column, other: Column, difference: Column) -> Column:
    """The number of digests on one side alone, from the subtracted table of the whole sets, or larger ones.

    A table that even all bits of the hash leave stuck is counted from its few digests themselves.
    """

    def children(t: Column, level: Column) -> Column:
        def child(branch: Column) -> Column:
            def inside(keys: Column) -> Column:
                return F.filter(keys, lambda k: F.pmod(F.xxhash64(k, level, F.lit(77)), F.lit(4)) == branch)

            return F.struct(inside(t["own"]).alias("own"), inside(t["other"]).alias("other"))

        return F.transform(F.sequence(F.lit(0), F.lit(3)), child)

    def step(state: Column, level: Column) -> Column:
        def tried(results: Column) -> Column:
            stuck = F.filter(results, lambda r: r["found"].isNull())
            last = level == LEVELS
            exact = F.aggregate(
                stuck, F.lit(0).cast("long"),
                lambda s, r: (s + F.size(F.array_except(r["own"], r["other"])) + F.size(F.array_except(r["other"], r["own"]))).cast("long"),
            )
            total = F.aggregate(results, state["found"], lambda s, r: (s + F.coalesce(r["found"], F.lit(0))).cast("long"))
            return F.struct(
                F.when(last, F.filter(stuck, lambda r: F.lit(False)))
                .otherwise(stuck).alias("open"),
                F.when(last, (total + exact).cast("long")).otherwise(total).alias("found"),
            )

        def result(t: Column) -> Column:
            return F.struct(
                t["own"].alias("own"), t["other"].alias("other"), peel(subtract(table(t["own"]), table(t["other"]))).alias("found")
            )

        parts = F.flatten(F.transform(state["open"], lambda t: children(t, level)))
        return F.when(F.size(state["open"]) == 0, state).otherwise(let(F.transform(parts, result), tried))

    whole = F.struct(own.alias("own"), other.alias("other"), F.lit(None).cast("long").alias("found"))
    start = F.struct(F.array(whole).alias("open"), F.lit(0).cast("long").alias("found"))
    larger = F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS)), start, step, lambda s: s["found"])
    return F.coalesce(peel(difference), larger)


def likeness(own: Column, other: Column, difference: Column) -> Column:
    """Shared digests to all digests of two texts, from the differing ones; 1 for two empty sets."""

    def share(d: Column) -> Column:
        total = F.size(own) + F.size(other)
        return F.when(total == 0, F.lit(1.0)).otherwise((total - d) / (total + d))

    return let(differing(own, other, difference), share)


def written(cells: Column) -> Column:
    """A table as text: counts, digests and checks in hexadecimal."""
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(".", F.hex(c["n"]), F.hex(c["k"]), F.hex(c["c"]))), "-")


def listed(values: list, kind: str) -> Column:
    """A constant array; as one text it stays a single literal, however long."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def id_blocks(docs: DataFrame, docs_in_block: int, most_blocks: int) -> Column:
    """The block of a row with columns ``doc_id`` and ``hash``, numbered in the order of falling ids, rows without id last.

    Blocks are ranges between quantiles of the ids, so they hold about as many rows each, wherever ids cluster. An id
    that fills several ranges, and the rows without an id, are cut by ranges of their texts' hashes instead.
    """
    seen = docs.agg(F.count(F.lit(1)).alias("all"), F.count("doc_id").alias("known")).first()
    ranges = max(1, min(most_blocks, seen["known"] // docs_in_block))
    fractions = listed([k / ranges for k in range(ranges)], "double")
    bounds = docs.agg(F.percentile_approx("doc_id", fractions, F.lit(4 * ranges + 100)).alias("b")).first()["b"] or [0]
    often = Counter(bounds)
    # A hot id has a range of its own; the range after it begins with the next number.
    edges = sorted(set(bounds) | {b + 1 for b, m in often.items() if m > 1 and b < 2**63 - 1})
    cuts = [often[e] if often[e] > 1 else 1 for e in edges]
    first = list(accumulate(reversed(cuts), initial=0))
    without = max(1, min(most_blocks, (seen["all"] - seen["known"]) // docs_in_block))
    at, starts, shares = listed(edges, "long"), listed(first[-2::-1], "long"), listed(cuts, "long")

    def cut(share: Column) -> Column:
        """Which of ``share`` equal ranges holds the hash, by its upper 31 bits."""
        return F.shiftright((F.shiftright("hash", 33) + F.lit(1 << 30)) * share, 31)

    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(edges).bit_length()))])
    # Ids below the smallest bound, which quantiles may miss, belong to the first range.
    found = F.aggregate(steps, F.lit(-1), lambda k, step: F.when(F.get(at, k + step) <= F.col("doc_id"), k + step).otherwise(k))
    range_ = let(F.greatest(found, F.lit(0)), lambda k: F.get(starts, k) + cut(F.get(shares, k)))
    return F.when(F.col("doc_id").isNull(), F.lit(first[-1]) + cut(F.lit(without).cast("long"))).otherwise(range_)


def with_next(docs: DataFrame, docs_in_block: int = 4096, most_blocks: int = 1 << 16) -> DataFrame:
    """``docs(doc_id, text)`` in blocks, each with the first row of the next block that has any (``extra``).

    There are at most three times ``most_blocks`` blocks, so the table of their heads is small enough to broadcast. The
    last block gets the very first row. Rows of one id and one text stay in one block.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    rows = rows.withColumn("block", id_blocks(docs, docs_in_block, most_blocks))
    place = F.struct(F.col("doc_id").isNull().alias("without"), F.bitwise_not("doc_id").alias("falling"), "hash", "doc_id")
    heads = rows.groupBy("block").agg(F.min(place).alias("head"))
    order = Window.orderBy("block")
    last = F.max("block").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    to = heads.select("block", "head.doc_id", "head.hash", F.coalesce(F.lag("block").over(order), last).alias("to"))
    to = F.broadcast(to.toDF("from", "head_id", "head_hash", "to"))  # a row a block at most
    extra = rows.join(to, (F.col("block") == F.col("from")) & (F.col("hash") == F.col("head_hash")) & F.col("doc_id").eqNullSafe(F.col("head_id")))
    extra = extra.dropDuplicates(["from"]).select("doc_id", "text", "hash", F.col("to").alias("block"), F.lit(True).alias("extra"))
    return rows.select("doc_id", "text", "hash", "block", F.lit(False).alias("extra")).unionByName(extra)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text of ``docs(doc_id, text)`` and of its edited text, with two likenesses.

    The edited text has the last third of its characters replaced by the first as many of the next document, by falling
    id; the first document follows the last one. Null texts are empty; two empty texts are alike (1). Rows of one id
    follow each other in the order of their texts' hashes; rows without an id come last.
    """
    rows = with_next(docs.select("doc_id", "text")).repartition("block")
    order = Window.partitionBy("block").orderBy("extra", F.col("doc_id").desc_nulls_last(), "hash")
    rows = rows.select("*", digests(F.col("text")).alias("own")).select("*", table(F.col("own")).alias("own_table"))
    rows = rows.select(
        "*", *[F.lead(c).over(order).alias(f"next_{c}") for c in ("text", "own", "own_table")]
    ).filter("not extra")
    n = F.char_length("text").cast("long")
    rows = rows.select("*", n.alias("n_chars"), F.floor(n / 3).cast("int").alias("tail"))
    edited = F.concat(
        F.substr("text", F.lit(1), (F.col("n_chars") - F.col("tail")).cast("int")), F.substr("next_text", F.lit(1), F.col("tail"))
    )
    rows = rows.select("*", edited.alias("edited"))
    rows = rows.select("*", digests(F.col("edited")).alias("changed"))
    rows = rows.select("*", table(F.col("changed")).alias("changed_table"))
    own, own_table = F.col("own"), F.col("own_table")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        written(own_table).alias("fingerprint"), written(F.col("changed_table")).alias("edited_fingerprint"),
        likeness(own, F.col("changed"), subtract(own_table, F.col("changed_table"))).alias("near_edited"),
        likeness(own, F.col("next_own"), subtract(own_table, F.col("next_own_table"))).alias("near_next"),
    )

"""Quality rules: a decision list learned from labelled statistics, in Spark expressions alone.

Sequential covering: a rule is a conjunction of thresholds on a document's statistics, grown condition by condition to
cover bad documents and no good ones, then pruned on rows that growing hasn't seen; the rows that it covers go, and the
next rule is grown on the rest. The list becomes one ordered conditional expression. Every step is a count by statistic
and interval over the labelled sample, so what reaches the driver has a fixed size. Cuts lie midway between neighbouring
quantiles. Bad are documents labelled as of low quality and those labelled as toxic; one statistic counts the words that
toxic documents of the sample have and others, nearly always, don't.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billweave.llm.common import stored

SPACES = r"[\x20\x09-\x0D]+"
WINDOW = 5
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def count_of(characters: str) -> Column:
    """How many characters of the text are in a class."""
    return F.length(F.regexp_replace("text", f"[^{characters}]+", "")).cast("long")


def bare_words(text: Column) -> Column:
    """The different words of a text in lower case, letters alone."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != ""))


def statistics(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), marked: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """``carry`` columns (in a struct ``carried``) and counts for each row of ``docs(doc_id, text)`` from its whole text; null and empty texts count nothing.

    Words in repeated windows: windows are compared by hash. Only texts in which two are equal sort them by hash, mark
    those with an equal neighbour and add up the words that these cover. Of ``marked`` words each counts once.
    """
    rows = docs.select(F.struct(*carry).alias("carried"), F.coalesce("text", F.lit("")).alias("text"))
    words = F.filter(F.split("text", SPACES), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.regexp_replace(x, SPACES, "")) > 0)
    rows = rows.select("*", words.alias("words"), lines.alias("lines"))
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    rows = rows.select("*", hashes.alias("hashes"))
    starts = F.when(F.size("hashes") >= WINDOW, F.sequence(F.lit(0), F.size("hashes") - WINDOW)).otherwise(
        F.array().cast("array<int>")
    )
    windows = F.transform(starts, lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)]))
    rows = rows.select("*", windows.alias("windows"))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    by_hash = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.select("*", F.when(repeats, by_hash).alias("by_hash"))

    def repeated(at: Column, k: Column) -> Column:
        return (at["h"] == F.get("by_hash", k - 1)["h"]) | (at["h"] == F.get("by_hash", k + 1)["h"])

    shown = F.filter("by_hash", lambda at, k: F.coalesce(repeated(at, k), F.get("by_hash", k - 1)["h"] == at["h"], F.lit(False)))
    places = F.sort_array(F.transform(shown, lambda at: at["i"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        places, start,
        lambda s, p: F.struct((s["n"] + WINDOW - F.greatest(F.lit(0), s["end"] - p)).alias("n"), (p + WINDOW).alias("end")),
        lambda s: s["n"],
    )
    return rows.select(
        "carried",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        count_of(r"#*$%&|<>").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.length("text").cast("long").alias("n_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        count_of("A-ZÀ-ÖØ-Þ").alias("n_upper"),
        count_of("0-9").alias("n_digits"),
        count_of("!?").alias("n_marks"),
        count_of(".").alias("n_stops"),
        (F.size(F.array_intersect(bare_words(F.col("text")), F.array(*map(F.lit, marked)))) if marked else F.lit(0)).alias("n_marked"),
    )


def features() -> dict[str, Column]:
    """What rules are made of: shares and means, 0 where there is nothing to divide by."""

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0))

    return {
        "symbols_per_word": share("n_symbols", "n_words"),
        "marks_per_word": share("n_marks", "n_words"),
        "stops_per_word": share("n_stops", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "digit_share": share("n_digits", "word_chars"),
        "distinct_share": share("n_distinct", "n_words"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "word_length": share("word_chars", "n_words"),
        "words": F.col("n_words").cast("double"),
        "marked_words": F.col("n_marked").cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def draw_labels(labels: DataFrame, most: int) -> DataFrame:
    """(doc_id, bad, toxic, prune) of about ``most`` documents whose quality is labelled, drawn by hash; one row an id."""
    toxic = F.coalesce(F.col("toxic") == 1, F.lit(False)) if "toxic" in labels.columns else F.lit(False)
    known = labels.filter("doc_id is not null and quality is not null")
    known = known.select("doc_id", ((F.col("quality") == 0) | toxic).alias("bad"), toxic.alias("toxic"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(31)), F.lit(1 << 30)) < int(min(1.0, most / max(known.count(), 1)) * (1 << 30))
    # An id with unlike labels counts as bad.
    taken = known.filter(draw).groupBy("doc_id").agg(F.max("bad").alias("bad"), F.max("toxic").alias("toxic"))
    return taken.withColumn("prune", F.pmod(F.xxhash64("doc_id", F.lit(37)), F.lit(3)) == 0)


def marked_words(
    docs: DataFrame, labels: DataFrame, most: int = 20_000, words: int = 200, least: int = 8, precise: float = 0.97
) -> list[str]:
    """At most ``words`` words that at least ``least`` toxic documents hold, and of all that hold them ``precise`` are toxic.

    Counted on the part of the labelled sample that rules are grown on; rules with them still have to hold on the other.
    """
    taken = draw_labels(labels, most).filter("not prune")  # bounded, so it may be broadcast
    found = docs.select("doc_id", "text").join(F.broadcast(taken.select("doc_id", "toxic")), "doc_id")
    counts = found.select("toxic", F.explode(bare_words(F.col("text"))).alias("word")).groupBy("word").agg(
        F.count_if("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")
    )
    good = counts.filter((F.col("toxic") >= least) & (F.col("toxic") >= precise * F.col("n")))
    return [r["word"] for r in good.orderBy(F.desc("toxic"), "word").limit(words).collect()]


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = 20_000, marked: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Statistics of a bounded sample of about ``most`` labelled documents, drawn by hash, with ``bad`` and ``prune``."""
    taken = draw_labels(labels, most).select("doc_id", "bad", "prune")  # bounded, so it may be broadcast
    found = docs.select("doc_id", "text").join(F.broadcast(taken.select("doc_id")), "doc_id", "left_semi")
    rows = statistics(found, marked=marked)
    rows = rows.withColumn("doc_id", F.col("carried.doc_id")).drop("carried")
    # Stored before it is filtered: a filter on counts would be pushed below them, with all that they are made of.
    return stored(rows.join(F.broadcast(taken), "doc_id"), "labelled").filter(~base_failed())


def learn(
    sample: DataFrame, intervals: int = 24, rules: int = 8, conditions: int = 4, precise: float = 0.97, least: int = 8,
    slack: float = 0.1, failures: int = 8,
) -> list[Rule]:
    """Rules that cover bad rows of ``sample``, in order; none if it has no bad rows.

    A rule must be right for ``precise`` of the rows that it covers, on the part for pruning and on that for growing, and
    cover at least ``least`` bad ones. One that isn't is given up, and another is grown without its first condition; after
    ``failures`` of them the list ends. Of rules with equal gain the first by feature, side and cut is taken.
    """
    names = list(features())
    rows = sample.select("bad", "prune", *[c.alias(n) for n, c in features().items()])
    steps = [k / (intervals + 1) for k in range(1, intervals + 1)]
    quantiles = rows.filter("bad").agg(*[F.percentile_approx(n, steps, 10_000).alias(n) for n in names])
    more = rows.filter("not bad").agg(*[F.percentile_approx(n, steps, 10_000).alias(n) for n in names])
    found = [quantiles.first(), more.first()]
    if found[0][names[0]] is None:
        return []
    values = {n: sorted({x for row in found for x in row[n] or []}) for n in names}
    cuts = {n: [(a + b) / 2 for a, b in zip(v, v[1:])] for n, v in values.items()}

    def interval(name: str) -> Column:
        """The number of cuts below the value: above cut k is an interval greater than k."""
        return F.size(F.filter(F.array(*[F.lit(float(x)) for x in cuts[name]]).cast("array<double>"), lambda c: c < F.col(name)))

    binned = stored(rows.select("bad", "prune", F.array(*[interval(n) for n in names]).alias("at")), "binned")

    def holds(parts: list[tuple[int, bool, int]]) -> Column:
        out = F.lit(True)
        for feature, above, cut in parts:
            at = F.col("at")[feature]
            out = out & ((at > cut) if above else (at <= cut))
        return out

    def counts(covered: Column) -> dict[tuple[int, int], list[int]]:
        """Bad and good rows for growing, then for pruning, by feature and interval."""
        table: dict[tuple[int, int], list[int]] = {}
        every = binned.filter(covered).select("bad", "prune", F.posexplode("at").alias("feature", "interval"))
        for r in every.groupBy("feature", "interval", "bad", "prune").count().collect():
            table.setdefault((r["feature"], r["interval"]), [0] * 4)[2 * r["prune"] + (not r["bad"])] += r["count"]
        return table

    def add(a: list[int], b: list[int]) -> list[int]:
        return [x + y for x, y in zip(a, b, strict=True)]

    done, out = F.lit(True), []
    barred: set[tuple[int, bool, int]] = set()
    while len(out) < rules and len(barred) < failures:
        parts: list[tuple[int, bool, int]] = []
        totals: list[list[int]] = []
        while len(parts) < conditions:
            table = counts(done & holds(parts))
            total = [0] * 4
            for (feature, _), row in table.items():
                total = add(total, row) if feature == 0 else total
            p, n = total[0], total[1]
            if not p or (parts and not n):
                break
            choices = []
            for feature, name in enumerate(names):
                below = [0] * 4
                for cut in range(len(cuts[name])):
                    below = add(below, table.get((feature, cut), [0] * 4))
                    above = [x - y for x, y in zip(total, below, strict=True)]
                    for is_above, side in ((False, below), (True, above)):
                        if side[0] >= least and (parts or (feature, is_above, cut) not in barred):
                            gain = side[0] * (log2(side[0] / (side[0] + side[1])) - log2(p / (p + n)))
                            choices.append((gain, (feature, is_above, cut), side))
            top = max(choices, key=lambda c: c[0], default=None)
            if top is None or top[0] <= 1e-9:
                break
            # Of the cuts that are nearly as good, the one that covers least: it leaves most room for good documents.
            alike = [c for c in choices if c[1][:2] == top[1][:2] and c[0] >= (1 - slack) * top[0]]
            best = min(alike, key=lambda c: c[2][0] + c[2][1])
            parts.append(best[1])
            totals.append(best[2])
        if not parts:
            break

        def worth(t: list[int]) -> float:
            return (t[2] - t[3]) / (t[2] + t[3]) if t[2] + t[3] else -1.0

        keep = max(range(len(parts)), key=lambda k: (worth(totals[k]), -k)) + 1
        bad, good = totals[keep - 1][0] + totals[keep - 1][2], totals[keep - 1][1] + totals[keep - 1][3]
        seen = totals[keep - 1]
        if bad < precise * (bad + good) or seen[2] < precise * (seen[2] + seen[3]):
            barred.add(parts[0])
            continue
        out.append(tuple(Condition(names[f], above, cuts[names[f]][cut]) for f, above, cut in parts[:keep]))
        done = done & ~holds(parts[:keep])
    return out


def fit(docs: DataFrame, labels: DataFrame, most: int = 20_000) -> tuple[list[Rule], list[str]]:
    """Rules, and the marked words that they may count, from at most about ``most`` labelled documents."""
    marked = marked_words(docs, labels, most)
    return learn(labelled_sample(docs, labels, most, marked)), marked


def verdict(rules: list[Rule]) -> Column:
    """The list as an ordered conditional expression: the first rule that holds rejects; true where none does."""
    out = None
    for rule in rules:
        holds = rule[0].column()
        for condition in rule[1:]:
            holds = holds & condition.column()
        out = F.when(holds, F.lit(False)) if out is None else out.when(holds, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judged(docs: DataFrame, rules: list[Rule], marked: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Base counts, ``base_failed`` and ``kept`` for each row of ``docs(doc_id, text)``."""
    rows = statistics(docs, marked=marked).select("*", base_failed().alias("base_failed"), verdict(rules).alias("verdict"))
    return rows.select("carried.doc_id", *BASE, "base_failed", (~F.col("base_failed") & F.col("verdict")).alias("kept"))


def accepted(docs: DataFrame, rules: list[Rule], marked: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    rows = statistics(docs, tuple(docs.columns), marked).select("carried", (~base_failed() & verdict(rules)).alias("kept"))
    # Stored before the filter, which would otherwise be pushed below the counts with all that they are made of.
    return stored(rows, "judged").filter("kept").select("carried.*")

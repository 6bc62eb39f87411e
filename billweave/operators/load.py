"""Load staged deliveries into a billing table."""

from __future__ import annotations

from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.functions.types import DEFAULT_TYPE
from billweave.operators.columns import column_defs, renamed_columns
from billweave.operators.completeness import delivery_completeness
from billweave.operators.ledger import EventLog, record_loads
from billweave.operators.state import DELIVERY, already_in, choose_deliveries
from billweave.operators.table import BillingTable, RenamedColumn, ReplaceCounts
from billweave.sources.csv_parts import delivery_faults, distinct_headers, map_headers, read_headers, scan_groups, scan_parts
from billweave.sources.manifests import manifest_files

# What a failed job raises, from the JVM or already converted.
JOB_ERRORS = (PySparkException, Py4JJavaError)

RESULT_SCHEMA = (
    "execution_id string, billing_period string, files_loaded bigint, rows_loaded bigint, rows_rejected bigint, "
    "status string, error string"
)


@dataclass
class LoadReport:
    """Results of one load. ``rejected_rows`` were kept out of the table and written to rejects."""

    results: DataFrame
    added_columns: list[str] = field(default_factory=list)
    rejected_rows: int = 0


@dataclass
class _Delivery:
    """Progress of one delivery; a run has one per month at most, so they are kept on the driver."""

    billing_period: str
    execution_id: str
    files: int = 0
    rows: int = 0
    rejected: int = 0
    status: str = "pending"
    error: str | None = None

    @property
    def key(self) -> tuple[str, str]:
        return self.billing_period, self.execution_id

    def fail(self, error: str) -> None:
        self.status, self.error = "failed", error

    def result(self) -> tuple:
        ok = self.status == "success"
        files, rows = (self.files, self.rows) if ok else (0, 0)
        return self.execution_id, self.billing_period, files, rows, self.rejected, self.status, self.error


def _decide(manifests: DataFrame, parts: DataFrame, loaded: DataFrame, overwrite: bool) -> list[_Delivery]:
    """One decision per delivery: superseded by a later one, skipped, incomplete or pending.

    The month's delivery is chosen before asking what is loaded, so an earlier delivery that is
    still listed never takes the place of a later one.
    Decisions are held as plain values: after the write the table would give another answer.
    """
    listed = manifests.groupBy(*DELIVERY).agg(F.max("manifest_path").alias("manifest_path"))
    chosen = choose_deliveries(listed, F.struct("manifest_path", "execution_id"))
    done = loaded.withColumn("done", F.lit(not overwrite))
    counts = delivery_completeness(manifest_files(manifests), parts)
    staged = parts.groupBy(*DELIVERY).agg(F.count("*").alias("staged_files"))
    state = chosen.join(done, DELIVERY, "left").join(counts, DELIVERY, "left").join(staged, DELIVERY, "left")
    decided = []
    for row in state.orderBy(F.desc("billing_period"), "execution_id").collect():
        delivery = _Delivery(row.billing_period, row.execution_id, row.staged_files or 0)
        if not row.keep:
            delivery.status = "superseded"
        elif row.done:
            delivery.status = "skipped"
        elif not row.complete:
            delivery.fail(f"{row.present_files or 0} of {row.expected_files or 0} listed files present")
        decided.append(delivery)
    return decided


def _as_frame(spark: SparkSession, deliveries: list[_Delivery]) -> DataFrame:
    return spark.createDataFrame([d.key for d in deliveries], "billing_period string, execution_id string")


def load_deliveries(
    spark: SparkSession,
    manifests: DataFrame,
    parts: DataFrame,
    table: BillingTable,
    *,
    overwrite: bool = False,
    on_unknown: str = "fail",
    on_renamed: str = "fail",
    cost_scale: int = 2,
    multi_line: bool = True,
    state: str = "rows",
) -> LoadReport:
    """Load every new, complete delivery; one per month, all months in one write job.

    A delivery that fails a check is left out before anything is written and its month stays as it
    was. If the common job fails, on a bad value for instance, one more job finds all deliveries at fault
    and a last one loads the others. ``state="ledger"`` asks the table's ledger what is loaded instead of
    its rows.
    """
    if on_unknown not in ("fail", "add"):
        raise ValueError(f"on_unknown must be 'fail' or 'add', got {on_unknown!r}")
    months = [row[0] for row in manifests.select("billing_period").distinct().collect()]
    decided = _decide(manifests, parts, table.deliveries(state, months), overwrite)
    report = LoadReport(results=None)
    log = EventLog(spark, table.events)
    pending = [d for d in decided if d.status == "pending"]
    for delivery in decided:
        if delivery.status != "skipped":
            log.note(delivery.key, "discovered")
    for delivery in pending:
        log.note(delivery.key, "staging")
    if pending:
        keys = _as_frame(spark, pending)
        defs = column_defs(already_in(manifests, keys), cost_scale)
        headers = distinct_headers(read_headers(already_in(parts, keys))).persist()
        mapped = map_headers(headers, defs).persist()
        unknown = _as_definitions(mapped.where(~F.col("declared")), defs)
        empty = headers.where("header IS NULL").select(*DELIVERY, F.explode("paths").alias("path"))
        headless = _problems(empty, "parts without a header", F.col("path"))
        if on_unknown == "fail":
            found = _problems(unknown, "columns not in the manifest", F.col("original_name"))
        else:
            taken = _clashes(defs, unknown)
            found = _problems(taken, "undeclared columns of a taken name", F.col("normalized_name"))
            defs = defs.unionByName(unknown.drop("ordinal"))
        pending = _fail_each(pending, headless.unionByName(found))
        if pending:
            defs = already_in(defs, _as_frame(spark, pending))
            try:
                report.added_columns = table.evolve(defs, on_renamed)
            except RenamedColumn:
                renamed = renamed_columns(defs, table.definitions())
                originals = F.concat_ws(" for ", "original_name", "official_name")
                pending = _fail_each(pending, _problems(renamed, "columns whose name changed its original", originals))
                if pending:
                    report.added_columns = table.evolve(already_in(defs, _as_frame(spark, pending)), on_renamed)
        if pending:
            record_loads(spark, [(*d.key, 0, "loading", None) for d in pending], table.ledger)
            for delivery in pending:
                log.note(delivery.key, "loading")
            log.write()
            _write(spark, table, headers, mapped, pending, multi_line, report)
        mapped.unpersist()
        headers.unpersist()
    report.results = spark.createDataFrame([d.result() for d in decided], RESULT_SCHEMA)
    done = [d for d in decided if d.status in ("success", "failed")]
    states = {"success": "loaded", "failed": "failed"}
    record_loads(spark, [(*d.key, d.rows, states[d.status], d.error) for d in done], table.ledger)
    for delivery in done:
        log.note(delivery.key, states[delivery.status])
    log.write()
    return report


def _problems(rows: DataFrame, what: str, name: Column) -> DataFrame:
    return rows.select(*DELIVERY, F.lit(what).alias("what"), name.alias("name"))


def _fail_each(pending: list[_Delivery], problems: DataFrame) -> list[_Delivery]:
    """Fail the deliveries that have problems, naming them in the error; returns the others."""
    names = F.concat_ws(", ", F.array_sort(F.collect_set("name")))
    rows = problems.groupBy(*DELIVERY, "what").agg(names.alias("names")).collect()
    errors = {(r.billing_period, r.execution_id): f"{r.what}: {r.names}" for r in rows}
    for delivery in pending:
        if delivery.key in errors:
            delivery.fail(errors[delivery.key])
    return [d for d in pending if d.status == "pending"]


def _clashes(defs: DataFrame, unknown: DataFrame) -> DataFrame:
    """Undeclared columns that share their name with a declared one or with each other."""
    keys = [*DELIVERY, "normalized_name"]
    declared = unknown.join(defs, keys, "left_semi").select(*keys)
    repeated = unknown.groupBy(*keys).agg(F.countDistinct("original_name", "ordinal").alias("n")).where("n > 1")
    return declared.unionByName(repeated.select(*keys))


def _as_definitions(unknown: DataFrame, defs: DataFrame) -> DataFrame:
    """Undeclared header columns as text definitions, after the declared ones of their delivery."""
    category = F.substring_index("original_name", "/", 1)
    declared = defs.groupBy(*DELIVERY).agg((F.max("pos") + 1).alias("declared_columns"))
    return unknown.join(declared, DELIVERY, "left").select(
        *DELIVERY,
        (F.col("pos") + F.coalesce("declared_columns", F.lit(0))).alias("pos"),
        "original_name",
        "normalized_name",
        category.alias("category"),
        F.lit("String").alias("source_type"),
        F.lit(DEFAULT_TYPE).alias("table_type"),
        "ordinal",
    ).distinct()


def _replace(spark, table, headers, mapped, deliveries, multi_line) -> ReplaceCounts:
    keys = _as_frame(spark, deliveries)
    groups = scan_groups(already_in(headers, keys), already_in(mapped, keys))
    return table.replace(scan_parts(spark, groups, table.schema(), multi_line))


def _write(spark, table, headers, mapped, pending, multi_line, report) -> None:
    """Replace the months of the pending deliveries in one job.

    If that fails, a second job looks through all their parts and names the deliveries at fault, whatever their number,
    and a third one loads the others. An error that no delivery is at fault for is raised.
    """
    try:
        counts = _replace(spark, table, headers, mapped, pending, multi_line)
    except JOB_ERRORS:
        keys = _as_frame(spark, pending)
        own = already_in(headers, keys)
        faults = delivery_faults(spark, own, scan_groups(own, already_in(mapped, keys)), table.schema(), multi_line).collect()
        if not faults:
            raise
        found = {(f.billing_period, f.execution_id): f"{f.faults} rows or files at fault, such as: {f.fault}" for f in faults}
        for delivery in pending:
            if delivery.key in found:
                delivery.fail(found[delivery.key])
        pending = [d for d in pending if d.status == "pending"]
        counts = _replace(spark, table, headers, mapped, pending, multi_line) if pending else ReplaceCounts(0, 0, 0)
    report.rejected_rows += counts.rejected
    for delivery in pending:
        delivery.rejected = counts.by_delivery.get(delivery.key, 0)
    # A month for which no row was accepted keeps its files; their rows are not this load's.
    for delivery in pending:
        delivery.rows = counts.loaded.get(delivery.key, 0)
        withheld = f"{delivery.rejected} rows of no or another month withheld" if delivery.rejected else None
        if delivery.rows:
            delivery.status, delivery.error = "success", withheld
        else:
            delivery.fail("; ".join(filter(None, ["no rows of its month", withheld])))

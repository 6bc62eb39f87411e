"""A whole run: discover, load, export, publish."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.functions.keys import VENDOR
from billweave.functions.periods import in_range
from billweave.operators.export import export_deliveries, export_periods, export_root
from billweave.operators.load import LoadReport, load_deliveries
from billweave.operators.publish import publish_deliveries, publish_periods
from billweave.operators.state import DELIVERY, already_in, choose_deliveries, loaded_map, not_in, periods, run_plan
from billweave.operators.table import BillingTable
from billweave.sources.listing import available_periods, exported_files, staged_parts
from billweave.sources.manifests import scan_manifests


@dataclass(frozen=True)
class Places:
    """Where a run reads and writes. ``warehouse`` may be left out."""

    store: str
    prefix: str
    export: str
    version: str
    staging: str
    table: str
    exports: str
    warehouse: str | None = None
    vendor: str = VENDOR


@dataclass
class RunReport:
    """What a run did. In a dry run only ``plan`` and ``rejects`` are set."""

    plan: DataFrame
    rejects: DataFrame
    load: LoadReport | None = None
    exported: DataFrame | None = None
    published: DataFrame | None = None


def pending_manifests(
    spark: SparkSession,
    places: Places,
    start: str | None = None,
    end: str | None = None,
    state: str = "rows",
) -> tuple[DataFrame, DataFrame]:
    """Manifests in a month range whose delivery is not yet live at the end of the run, and rejects.

    The end is the warehouse if there is one, else the table; each later step then asks its own
    target, so an interrupted run goes on where it stopped.
    """
    manifests, rejects = scan_manifests(spark, places.store, places.prefix, places.export, places.version)
    listed = manifests.where(in_range(F.col("billing_period"), start, end))
    live = choose_deliveries(listed.select(*DELIVERY, "manifest_path"), F.struct("manifest_path", "execution_id"))
    end_table = BillingTable(spark, places.warehouse or places.table)
    months = [row[0] for row in listed.select("billing_period").distinct().collect()]
    pending = not_in(live.where("keep"), loaded_map(end_table.deliveries(state, months)))
    # Held as values: once the run has written, the same question has another answer.
    keys = spark.createDataFrame(
        [tuple(row) for row in pending.select(*DELIVERY).collect()], "billing_period string, execution_id string"
    )
    return already_in(listed, keys), rejects


def run(
    spark: SparkSession,
    places: Places,
    *,
    start: str | None = None,
    end: str | None = None,
    dry_run: bool = False,
    overwrite: bool = False,
    compression: str = "snappy",
    state: str = "rows",
    **load_options,
) -> RunReport:
    """Load new deliveries, export them, and publish them if a warehouse is named.

    ``state="ledger"`` asks the ledgers of table and warehouse what is loaded, not their rows.
    """
    pending, rejects = pending_manifests(spark, places, start, end, state)
    # Manifests and listings are small, and each step asks them again; the store is listed once.
    pending = pending.persist()
    parts = staged_parts(spark, places.staging).persist()
    try:
        report = RunReport(run_plan(pending), rejects)
        if dry_run or pending.isEmpty():
            return report
        table = BillingTable(spark, places.table)
        report.load = load_deliveries(spark, pending, parts, table, state=state, **load_options)
        in_table = report.load.results.where(F.col("status").isin("success", "skipped")).select(*DELIVERY)
        report.exported = export_deliveries(
            spark, table, in_table, places.exports, vendor=places.vendor, overwrite=overwrite, compression=compression
        )
        if places.warehouse:
            ready = report.exported.where("status != 'failed'")
            warehouse = BillingTable(spark, places.warehouse)
            report.published = publish_deliveries(
                spark, ready, places.exports, warehouse, vendor=places.vendor, overwrite=overwrite, state=state
            )
        return report
    finally:
        pending.unpersist()
        parts.unpersist()


def load_months(
    spark: SparkSession, places: Places, start: str | None = None, end: str | None = None, **load_options
) -> LoadReport:
    """Load the staged deliveries of a month range into the table; its own state decides what is new."""
    manifests, _ = scan_manifests(spark, places.store, places.prefix, places.export, places.version)
    listed = manifests.where(in_range(F.col("billing_period"), start, end))
    parts = staged_parts(spark, places.staging)
    return load_deliveries(spark, listed, parts, BillingTable(spark, places.table), **load_options)


def export_months(
    spark: SparkSession, places: Places, start: str | None = None, end: str | None = None, **export_options
) -> DataFrame:
    """Export the table's months in a range; a status row each."""
    table = BillingTable(spark, places.table)
    if not table.has_rows():
        raise ValueError(f"no billing table at {places.table}: load data first")
    months = periods(table.statistics()).where(in_range(F.col("billing_period"), start, end))
    return export_periods(spark, table, months, places.exports, vendor=places.vendor, **export_options)


def publish_months(
    spark: SparkSession, places: Places, start: str | None = None, end: str | None = None, **publish_options
) -> DataFrame:
    """Publish the months in a range that have an export; a status row each.

    Where the billing table exists, a month is taken from exports of the delivery that holds it there.
    """
    roots = [export_root(places.exports, by, places.vendor) for by in ("period", "execution")]
    files = [exported_files(spark, root).select("billing_period") for root in roots]
    months = available_periods(files[0].unionByName(files[1]))
    chosen = months.where(in_range(F.col("billing_period"), start, end))
    warehouse, table = BillingTable(spark, places.warehouse), BillingTable(spark, places.table)
    live = loaded_map(table.deliveries("rows")) if table.exists() else None
    return publish_periods(spark, chosen, places.exports, warehouse, vendor=places.vendor, live=live, **publish_options)

"""Publish exports to the warehouse dataset: month-partitioned and clustered on usage start."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billweave.functions.keys import VENDOR, delivery_key
from billweave.functions.types import table_type_name
from billweave.operators.columns import conform
from billweave.operators.export import export_root
from billweave.operators.ledger import record_loads
from billweave.operators.state import DELIVERY, choose_deliveries, loaded_map
from billweave.operators.table import PARTITION, USAGE_START, BillingTable
from billweave.sources.listing import exported_files, list_files

def first_file_schema(spark: SparkSession, root: str) -> T.StructType:
    """Schema of the first Parquet file by name; only its footer is read."""
    first = list_files(spark, root, "*.parquet").agg(F.min("path").alias("path")).first().path
    if first is None:
        raise ValueError(f"no Parquet file below {root} to take a schema from")
    return spark.read.parquet(first).schema


def schema_definitions(spark: SparkSession, schema: T.StructType, period: str = "") -> DataFrame:
    """Column definitions of an existing schema, with originals where its metadata has them."""
    rows = [
        (
            period,
            "",
            pos,
            f.metadata.get("original_name", f.name),
            f.name,
            f.metadata.get("category", ""),
            f.metadata.get("source_type", ""),
            table_type_name(f.dataType),
        )
        for pos, f in enumerate(schema.fields)
        if f.name not in (PARTITION, "execution_id")
    ]
    return spark.createDataFrame(
        rows,
        "billing_period string, execution_id string, pos int, original_name string, normalized_name string, "
        "category string, source_type string, table_type string",
    )


def _entry(key: tuple, state: str, error: str | None = None) -> tuple:
    """Ledger entry of a month, or of a month's delivery."""
    period, execution = key if len(key) == 2 else (*key, None)
    return period, execution, 0, state, error


def _append_months(spark: SparkSession, warehouse: BillingTable, path: str, wanted: list[tuple]) -> set[str]:
    """Replace the wanted exports' months in the warehouse, adding columns it lacks; returns months left as they were.

    ``wanted`` holds months, or months with their delivery. The ledger gets an entry before the
    write and one after it with the rows that the warehouse then holds.
    """
    if len({key[0] for key in wanted}) < len(wanted):
        raise ValueError("a month can be replaced by one delivery only")
    keys = DELIVERY[: len(wanted[0])]
    pairs = spark.createDataFrame(wanted, ", ".join(f"{key} string" for key in keys))
    exported = exported_files(spark, path)
    # The files of one export share a schema: one footer for each is enough.
    firsts = exported.join(pairs, keys, "left_semi").groupBy(*keys).agg(F.min("path").alias("path")).collect()
    stored = spark.read.option("mergeSchema", "true").parquet(*[f.path for f in firsts]).schema
    fields = [f for f in stored.fields if f.name not in keys] + [T.StructField(k, T.StringType()) for k in keys]
    schema = T.StructType(fields)
    warehouse.evolve(schema_definitions(spark, schema), on_renamed="keep")
    months = [key[0] for key in wanted]
    # A condition on folder names, so only the wanted folders are read.
    chosen = F.concat_ws("/", *keys).isin(["/".join(key) for key in wanted])
    rows = spark.read.schema(schema).parquet(path).where(F.col(PARTITION).isin(months) & chosen)
    record_loads(spark, [_entry(key, "loading") for key in wanted], warehouse.ledger)
    # A task takes whole export files, whose ranges cover few days, and sorts them: nothing is shuffled, and files and row
    # groups of the warehouse cover few days as well, so that a filter on usage start skips most.
    counts = warehouse.replace(conform(rows, warehouse.schema(), PARTITION), order=[USAGE_START])
    # A month for which no row was accepted keeps its files.
    untouched = set(months) - {month for month, _ in counts.loaded}
    loaded = [(*key, n, "loaded", None) for key, n in counts.loaded.items() if key[0] in months]
    empty = [_entry(key, "failed", "no rows of its month in the export") for key in wanted if key[0] in untouched]
    record_loads(spark, loaded + empty, warehouse.ledger)
    return untouched


def _held(warehouse: BillingTable, months: list[str], state: str) -> DataFrame:
    """The warehouse's live delivery of some months; of its rows only those months are read."""
    return loaded_map(warehouse.deliveries(state, months))


def _current(spark: SparkSession, path: str, exported: DataFrame, months: list[str], live: DataFrame) -> DataFrame:
    """Exported months that hold rows of the live delivery and of no other; of the rows one column is read."""
    if exported.isEmpty():
        return exported
    rows = spark.read.parquet(path).where(F.col(PARTITION).cast("string").isin(months))
    pairs = rows.select(F.col(PARTITION).cast("string").alias(PARTITION), "execution_id").distinct()
    known = pairs.join(live.select(*DELIVERY, F.lit(True).alias("is_live")), DELIVERY, "left")
    only = known.groupBy(PARTITION).agg(F.every(F.coalesce("is_live", F.lit(False))).alias("only"))
    return exported.join(only.where("only"), PARTITION, "left_semi")


def publish_periods(
    spark: SparkSession,
    periods: DataFrame,
    out: str,
    warehouse: BillingTable,
    *,
    vendor: str = VENDOR,
    overwrite: bool = True,
    state: str = "rows",
    live: DataFrame | None = None,
) -> DataFrame:
    """Load months from their exports; a status row each: loaded, skipped or failed (no export).

    A month is taken from its month export, or else from the export of its greatest delivery. ``live`` (month and
    delivery) says which delivery holds each month in the billing table: then only exports of that one are taken,
    so that superseded data never comes back. With ``overwrite=False`` months the warehouse already holds are skipped.
    """
    months = [row[0] for row in periods.select(PARTITION).distinct().collect()]
    by_period = exported_files(spark, export_root(out, "period", vendor)).select(PARTITION).distinct()
    by_execution = exported_files(spark, export_root(out, "execution", vendor)).select(*DELIVERY).distinct()
    if live is not None:
        by_period = _current(spark, export_root(out, "period", vendor), by_period, months, live)
        by_execution = by_execution.join(live.select(*DELIVERY), DELIVERY, "left_semi")
    by_execution = loaded_map(by_execution)
    held = _held(warehouse, months, state).select(PARTITION, F.lit(not overwrite).alias("held"))
    checked = (
        spark.createDataFrame([(m,) for m in months], "billing_period string")
        .join(by_period.withColumn("whole", F.lit(True)), PARTITION, "left")
        .join(by_execution, PARTITION, "left")
        .join(held, PARTITION, "left")
    )
    status = (
        F.when(F.coalesce("held", F.lit(False)), "skipped")
        .when(F.col("whole") | F.col("execution_id").isNotNull(), "loaded")
        .otherwise("failed")
    )
    decided = checked.select(PARTITION, "execution_id", "whole", status.alias("status")).collect()
    whole = [(d.billing_period,) for d in decided if d.status == "loaded" and d.whole]
    single = [(d.billing_period, d.execution_id) for d in decided if d.status == "loaded" and not d.whole]
    untouched = _append_months(spark, warehouse, export_root(out, "period", vendor), whole) if whole else set()
    if single:
        untouched |= _append_months(spark, warehouse, export_root(out, "execution", vendor), single)
    missing = [_entry((d.billing_period,), "failed", "no export") for d in decided if d.status == "failed"]
    record_loads(spark, missing, warehouse.ledger)
    return spark.createDataFrame(
        [(d.billing_period, "failed" if d.billing_period in untouched else d.status) for d in decided],
        "billing_period string, status string",
    )


def publish_deliveries(
    spark: SparkSession,
    deliveries: DataFrame,
    out: str,
    warehouse: BillingTable,
    *,
    vendor: str = VENDOR,
    overwrite: bool = False,
    state: str = "rows",
    order: Column | None = None,
) -> DataFrame:
    """Load deliveries from their exports unless the warehouse already holds them for their month.

    Of several deliveries of a month that could be loaded, the last in ``order`` (by default the greatest id) is; the
    others are ``superseded``. So a month never holds two.
    """
    path = export_root(out, "execution", vendor)
    listed = [tuple(row) for row in deliveries.select(*DELIVERY).distinct().collect()]
    exports = exported_files(spark, path).select(*DELIVERY).distinct().withColumn("present", F.lit(True))
    held = _held(warehouse, [month for month, _ in listed], state).withColumn("held", F.lit(not overwrite))
    status = (
        F.when(F.coalesce("held", F.lit(False)), "skipped").when(F.col("present"), "loaded").otherwise("failed")
    )
    wanted = spark.createDataFrame(listed, "billing_period string, execution_id string")
    checked = wanted.join(exports, DELIVERY, "left").join(held, DELIVERY, "left")
    checked = checked.select(*DELIVERY, status.alias("status"))
    able = choose_deliveries(checked.where("status = 'loaded'"), F.col("execution_id") if order is None else order)
    checked = checked.join(able.select(*DELIVERY, "keep"), DELIVERY, "left")
    decided = checked.withColumn("status", F.when(~F.col("keep"), "superseded").otherwise(F.col("status"))).collect()
    loaded = [(d.billing_period, d.execution_id) for d in decided if d.status == "loaded"]
    untouched = _append_months(spark, warehouse, path, loaded) if loaded else set()
    missing = [
        _entry((d.billing_period, d.execution_id), "failed", "no export") for d in decided if d.status == "failed"
    ]
    record_loads(spark, missing, warehouse.ledger)
    frame = spark.createDataFrame(
        [
            (d.billing_period, d.execution_id, "failed" if d.status == "loaded" and d.billing_period in untouched else d.status)
            for d in decided
        ],
        "billing_period string, execution_id string, status string",
    )
    key = delivery_key(F.col("billing_period"), F.col("execution_id"))
    return frame.select("billing_period", "execution_id", key.alias("delivery_key"), "status")

"""Sorted Parquet exports of months or deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billweave.functions.keys import VENDOR, delivery_key
from billweave.operators.state import DELIVERY, has_data
from billweave.operators.table import PARTITION, SORT_KEYS, USAGE_START, BillingTable
from billweave.sources.listing import exported_files, partition_count

# Codecs an export may use.
CODECS = ("snappy", "gzip", "lz4", "zstd")


def export_root(out: str, by: str, vendor: str = VENDOR) -> str:
    """Months and deliveries are exported side by side, as their folders differ in depth."""
    return f"{out.rstrip('/')}/{vendor}/by_{by}"


def sorted_rows(rows: DataFrame, partitions: int | None, total_order: bool = True) -> DataFrame:
    """Rows sorted inside each file, and with ``total_order`` over all files of a month too.

    Total order takes ranges of the sort keys. The last range key is the row's place in its source
    file: with it a month, an account or a run of equal rows that holds a large share of the data is
    still split over many tasks. The range bounds are sampled, so the wanted months are read twice.
    Without ``partitions`` adaptive execution joins small ranges.

    Without it rows are gathered by month and usage day and read once; adaptive execution splits
    large days by measured size.
    """
    keys = [PARTITION, *SORT_KEYS, "_place"]
    if total_order:
        gathered = rows.repartitionByRange(*([partitions] if partitions else []), *keys)
    else:
        gathered = gather_days(rows, partitions)
    return gathered.sortWithinPartitions(*keys).drop("_place")


def gather_days(rows: DataFrame, partitions: int | None) -> DataFrame:
    """Rows brought together by month and usage day for a write.

    The rebalance hint lets adaptive execution split a day or month that holds a large share of the
    rows and join small ones, from sizes it has measured; nothing is sampled or read twice.
    """
    day = "_usage_day"
    sliced = rows.withColumn(day, F.col(USAGE_START).cast("date"))
    width = [partitions] if partitions else []
    return sliced.hint("rebalance", *width, F.col(PARTITION), F.col(day)).drop(day)


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` of a Parquet table with each row's place in its file, taken at the scan."""
    return rows.withColumn("_place", F.col("_metadata.row_index"))


def write_sorted(
    rows: DataFrame,
    path: str,
    partition_by: list[str],
    partitions: int | None = None,
    compression: str = "snappy",
    total_order: bool = True,
    max_records_per_file: int = 0,
) -> None:
    """Sort placed rows and write them; partitions in ``rows`` replace existing ones, others stay."""
    if compression not in CODECS:
        raise ValueError(f"compression must be one of {', '.join(CODECS)}, got {compression!r}")
    (
        sorted_rows(rows, partitions, total_order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def _decide(
    spark: SparkSession, wanted: DataFrame, table: BillingTable, path: str, keys: list[str], overwrite: bool
) -> list:
    """Wanted exports with their status before the write, held as values: months or deliveries. No row is read."""
    listed = [tuple(row) for row in wanted.select(*keys).distinct().collect()]
    wanted = spark.createDataFrame(listed, ", ".join(f"{key} string" for key in keys))
    stored = table.statistics([row[0] for row in listed])
    present = exported_files(spark, path).select(*keys).distinct().withColumn("present", F.lit(not overwrite))
    status = (
        F.when(F.coalesce("present", F.lit(False)), "skipped").when(F.col("has_data"), "exported").otherwise("failed")
    )
    checked = has_data(wanted, stored, keys).join(present, keys, "left")
    return checked.select(*keys, status.alias("status")).collect()


def _statuses(spark: SparkSession, decided: list) -> DataFrame:
    rows = [(d.billing_period, d.asDict().get("execution_id"), d.status) for d in decided]
    frame = spark.createDataFrame(rows, "billing_period string, execution_id string, status string")
    key = delivery_key(F.col("billing_period"), F.col("execution_id"))
    return frame.select("billing_period", "execution_id", key.alias("export_key"), "status")


def export_periods(
    spark: SparkSession,
    table: BillingTable,
    periods: DataFrame,
    out: str,
    *,
    vendor: str = VENDOR,
    overwrite: bool = False,
    compression: str = "snappy",
    partitions: int | None = None,
    total_order: bool = True,
) -> DataFrame:
    """Export months; one status row each: exported, skipped (exists) or failed (no data)."""
    path = export_root(out, "period", vendor)
    rows = table.rows()
    decided = _decide(spark, periods, table, path, [PARTITION], overwrite)
    wanted = [d.billing_period for d in decided if d.status == "exported"]
    if wanted:
        chosen = placed(rows.where(F.col(PARTITION).isin(wanted)))
        partitions = partitions or partition_count(exported_files(spark, table.data), wanted)
        write_sorted(chosen, path, [PARTITION], partitions, compression, total_order)
    return _statuses(spark, decided)


def export_deliveries(
    spark: SparkSession,
    table: BillingTable,
    deliveries: DataFrame,
    out: str,
    *,
    vendor: str = VENDOR,
    overwrite: bool = False,
    compression: str = "snappy",
    partitions: int | None = None,
    total_order: bool = True,
) -> DataFrame:
    """Export deliveries; status as in :func:`export_periods`, one row per delivery."""
    path = export_root(out, "execution", vendor)
    rows = table.rows()
    decided = _decide(spark, deliveries, table, path, DELIVERY, overwrite)
    wanted = [(d.billing_period, d.execution_id) for d in decided if d.status == "exported"]
    if wanted:
        # The months prune partitions, the pairs then choose deliveries inside them.
        months = [p for p, _ in wanted]
        pruned = placed(rows.where(F.col(PARTITION).isin(months)))
        pairs = spark.createDataFrame(wanted, "billing_period string, execution_id string")
        chosen = pruned.join(pairs, DELIVERY, "left_semi")
        partitions = partitions or partition_count(exported_files(spark, table.data), months)
        write_sorted(chosen, path, DELIVERY, partitions, compression, total_order)
    return _statuses(spark, decided)


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An export under the table schema: partition values stay text, never guessed."""
    fields = schema.fields + ([] if PARTITION in schema.names else [T.StructField(PARTITION, T.StringType())])
    return spark.read.schema(T.StructType(fields)).parquet(path)

"""What is loaded, asked of the data itself, and what is still to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELIVERY = ["billing_period", "execution_id"]


def loaded_pairs(rows: DataFrame) -> DataFrame:
    """Distinct (month, delivery) of a billing table; rows without a delivery do not count."""
    return rows.where("execution_id IS NOT NULL").select(*DELIVERY).distinct()


def loaded_map(rows: DataFrame) -> DataFrame:
    """The live delivery of each month; of several, the greatest id.

    Rows are counted per pair first, a hash aggregate on each mapper; the greatest of text values
    would sort all rows. The count is used, always true, or the optimizer drops that step again.
    """
    pairs = rows.where("execution_id IS NOT NULL").groupBy(*DELIVERY).agg(F.count("*").alias("rows"))
    greatest = F.max(F.when(F.col("rows") > 0, F.col("execution_id")))
    return pairs.groupBy("billing_period").agg(greatest.alias("execution_id"))


def periods(rows: DataFrame) -> DataFrame:
    """Months that have rows, newest first."""
    return rows.select("billing_period").distinct().orderBy(F.desc("billing_period"))


def not_in(deliveries: DataFrame, done: DataFrame, overwrite: bool = False, keys: list[str] | None = None) -> DataFrame:
    """Deliveries absent from ``done``; with ``overwrite`` all of them."""
    return deliveries if overwrite else deliveries.join(done, keys or DELIVERY, "left_anti")


def already_in(deliveries: DataFrame, done: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Deliveries present in ``done``."""
    return deliveries.join(done, keys or DELIVERY, "left_semi")


def has_data(wanted: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``wanted`` with a flag whether the table has any row under ``keys``."""
    present = rows.select(*keys).distinct().withColumn("present", F.lit(True))
    return wanted.join(present, keys, "left").select(
        *wanted.columns, F.coalesce("present", F.lit(False)).alias("has_data")
    )


def choose_deliveries(deliveries: DataFrame, order: Column) -> DataFrame:
    """Deliveries with ``keep``: true for the last in ``order`` of each month, false if superseded.

    One partial aggregate finds the kept ones, so no month is gathered in a window.
    """
    kept = deliveries.groupBy("billing_period").agg(F.max_by("execution_id", order).alias("kept_id"))
    keep = F.col("execution_id") == F.col("kept_id")
    return deliveries.join(kept, "billing_period").withColumn("keep", keep).drop("kept_id")


def status_rollup(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("deliveries"))


def load_stats(results: DataFrame) -> DataFrame:
    """One row of totals over load results; skipped deliveries count in the total only."""
    loaded = F.col("status") == "success"
    return results.agg(
        F.count("*").alias("total_executions"),
        F.count_if(loaded).alias("loaded_executions"),
        F.count_if(F.col("status") == "failed").alias("failed_executions"),
        F.coalesce(F.sum(F.when(loaded, F.col("rows_loaded"))), F.lit(0)).cast("bigint").alias("total_rows"),
    )


def run_plan(pending: DataFrame) -> DataFrame:
    """Months a run would cover, oldest first, with their deliveries. Nothing is written."""
    return pending.groupBy("billing_period").agg(F.count("*").alias("deliveries")).orderBy("billing_period")

"""Listed files against files present."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billweave.operators.state import DELIVERY


def delivery_completeness(files: DataFrame, parts: DataFrame) -> DataFrame:
    """Expected and present files per delivery; complete only if every listed file is there.

    The join runs on the file, so a delivery with very many files is spread over tasks; the counts
    are partial aggregates.
    """
    present = parts.select(*DELIVERY, "file_name").distinct().withColumn("present", F.lit(1))
    listed = files.join(present, [*DELIVERY, "file_name"], "left")
    return (
        listed.groupBy(*DELIVERY)
        .agg(F.count("file_name").alias("expected_files"), F.count("present").alias("present_files"))
        .withColumn("complete", (F.col("expected_files") > 0) & (F.col("expected_files") == F.col("present_files")))
    )


def extract_stats(completeness: DataFrame) -> DataFrame:
    """Intake totals. Each missing file is an error, and so is each partial delivery."""
    missing = F.col("expected_files") - F.col("present_files")
    partial = F.count_if(F.col("expected_files") != F.col("present_files"))
    total = lambda column: F.coalesce(F.sum(column), F.lit(0)).cast("bigint")
    return completeness.agg(
        F.count("*").alias("manifests_processed"),
        total(F.col("present_files")).alias("files_present"),
        (total(missing) + partial).alias("errors"),
    )


def export_status(deliveries: DataFrame, exports: DataFrame, keys: list[str]) -> DataFrame:
    """Deliveries or months with ``exported``: whether an export of them exists."""
    present = exports.select(*keys).distinct().withColumn("present", F.lit(True))
    return deliveries.join(present, keys, "left").select(
        *deliveries.columns, F.coalesce("present", F.lit(False)).alias("exported")
    )

"""File listings as DataFrames: the folder layout is the state of staging and exports."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.functions.keys import VENDOR, parse_export_name
from billweave.session import read_if_present

# The file source's own columns; ``content`` is never selected, so no file is opened.
FILE_COLUMNS = "path string, modificationTime timestamp, length bigint, content binary"

# Staged parts lie at ``{period}/{execution}/{name}.csv[.gz]``; ``col=value`` folder
# names, as a partitioned Spark write gives, are read alike.
STAGED_PART = r"/(?:[^/=]+=)?([^/=]+)/(?:[^/=]+=)?([^/=]+)/([^/]+\.csv(?:\.gz)?)$"
EXPORTED_PART = r"/billing_period=([^/]+)/(?:execution_id=([^/]+)/)?[^/]+\.parquet$"


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """``path, length`` of all files below ``root``; listed by Spark, contents unread."""
    options = {"recursiveFileLookup": "true"} | ({"pathGlobFilter": glob} if glob else {})
    return read_if_present(spark, root, FILE_COLUMNS, "binaryFile", **options).select("path", "length")


def unescaped(path: Column) -> Column:
    """A path without percent escapes. Most have none and stay as they are, since each row of a scan asks for its own."""
    # A plus sign is itself in a path, but a space to url_decode.
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(path, F.lit("%")), decoded).otherwise(path)


def path_group(path: Column, pattern: str, group: int) -> Column:
    """A part of a path; a partitioned Spark write escapes characters such as a colon in it."""
    return unescaped(F.regexp_extract(path, pattern, group))


def delivery_columns(files: DataFrame) -> DataFrame:
    """Month, delivery and file name of those paths that are staged parts."""
    part = F.col("path")
    return files.where(part.rlike(STAGED_PART)).select(
        path_group(part, STAGED_PART, 1).alias("billing_period"),
        path_group(part, STAGED_PART, 2).alias("execution_id"),
        F.regexp_extract(part, STAGED_PART, 3).alias("file_name"),
        "path",
    )


def staged_parts(spark: SparkSession, staging: str) -> DataFrame:
    """One row per staged CSV part; other files are left out."""
    return delivery_columns(list_files(spark, staging))


def staged_deliveries(parts: DataFrame) -> DataFrame:
    """Deliveries that have at least one staged part."""
    return parts.select("billing_period", "execution_id").distinct()


def exported_files(spark: SparkSession, root: str) -> DataFrame:
    """Exported Parquet files below a partitioned export, with their month and delivery."""
    part = F.col("path")
    execution = F.nullif(path_group(part, EXPORTED_PART, 2), F.lit(""))
    return list_files(spark, root, "*.parquet").where(part.rlike(EXPORTED_PART)).select(
        path_group(part, EXPORTED_PART, 1).alias("billing_period"),
        execution.alias("execution_id"),
        "path",
        "length",
    )


def partition_count(files: DataFrame, periods: list[str]) -> int | None:
    """How many partitions of the session's advisory size the stored bytes of the listed months make.

    None if they make no more than the session's shuffle partitions: adaptive execution, which then joins small ones,
    keeps all cores at work, where data of one advisory size would go to a single task.
    """
    size = files.where(F.col("billing_period").isin(periods)).agg(F.sum("length").alias("bytes")).first().bytes or 0
    advised = files.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", advised.strip().lower()).groups()
    count = -(-size // (int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]))
    return count if count > int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def flat_exports(files: DataFrame, vendor: str = VENDOR) -> DataFrame:
    """Exports named in the flat form ``{period}[_{execution}]_{vendor}_billing.parquet``."""
    parsed = parse_export_name(F.element_at(F.split("path", "/"), -1), vendor)
    return files.withColumn("name", parsed).where("name IS NOT NULL").select("name.*", "path")


def available_periods(exports: DataFrame) -> DataFrame:
    """Months that have an export, newest first."""
    return exports.select("billing_period").distinct().orderBy(F.desc("billing_period"))

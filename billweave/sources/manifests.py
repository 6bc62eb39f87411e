"""Delivery manifests: scan of both folder layouts, parse, and their files and columns."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.functions.names import original_name
from billweave.functions.periods import is_valid_period, manifest_period
from billweave.session import read_if_present

# Manifest JSON fields, default compression, and where manifests lie below
# ``{prefix}/{export}`` in each layout version.
MANIFEST_JSON = """
    assemblyId string, executionId string,
    billingPeriod struct<start: string, end: string>,
    reportKeys array<string>,
    columns array<struct<category: string, name: string, type: string>>,
    compression string
"""
DEFAULT_COMPRESSION = "GZIP"
LAYOUTS = {
    "v1": r"/\d{8}-\d{8}/",
    "v2": r"/metadata/BILLING_PERIOD=\d{4}-\d{2}/",
}
CORRUPT = "_corrupt_record"
NO_COLUMNS = "array<struct<category: string, name: string, type: string>>"


def manifest_pattern(root: str, prefix: str, export: str, version: str) -> str:
    """Anchored pattern of one layout's manifest paths; names are taken literally."""
    if version not in LAYOUTS:
        raise ValueError(f"unknown manifest version: {version}")
    bare_root = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/")
    folder = re.escape("/".join([bare_root, prefix.strip("/"), export]))
    scheme = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?"
    return scheme + folder + LAYOUTS[version] + re.escape(export) + r"-Manifest\.json$"


def scan_manifests(
    spark: SparkSession, root: str, prefix: str, export: str, version: str
) -> tuple[DataFrame, DataFrame]:
    """Manifests of one export, and the files that were no usable manifest with the reason.

    Files are listed and read whole by the text source and parsed in one pass; a bad file becomes a
    reject and does not stop the others. The JSON source would parse only the fields a query asks
    for, so that the same file could be good in one query and bad in another.
    """
    pattern = manifest_pattern(root, prefix, export, version)
    texts = read_if_present(
        spark,
        f"{root.rstrip('/')}/{prefix.strip('/')}/{export}",
        "value string",
        "text",
        "manifest_path",
        wholetext="true",
        recursiveFileLookup="true",
        pathGlobFilter="*-Manifest.json",
    ).where(F.col("manifest_path").rlike(pattern))
    parsed = texts.select("manifest_path", parse_manifest_text(F.col("value")).alias("manifest"))
    return split_manifests(parse_manifests(parsed.select("manifest_path", "manifest.*"), version))


def parse_manifest_text(text: Column) -> Column:
    """Struct of a manifest held as JSON text; a bad text has its corrupt field set."""
    return F.from_json(
        text,
        f"{MANIFEST_JSON}, {CORRUPT} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )


def manifest_id(version: str) -> Column:
    """``assemblyId`` names a delivery in v1, ``executionId`` in v2."""
    return F.col("assemblyId") if version == "v1" else F.col("executionId")


def parse_manifests(raw: DataFrame, version: str) -> DataFrame:
    """Manifest records from raw JSON fields, ``manifest_path`` and the corrupt field."""
    return raw.select(
        manifest_id(version).alias("execution_id"),
        F.lit(version).alias("version"),
        manifest_period(F.col("billingPeriod.start")).alias("billing_period"),
        F.col("billingPeriod.start").alias("billing_period_start"),
        F.col("billingPeriod.end").alias("billing_period_end"),
        "manifest_path",
        F.coalesce("reportKeys", F.array().cast("array<string>")).alias("files"),
        F.coalesce("columns", F.array().cast(NO_COLUMNS)).alias("columns"),
        F.coalesce("compression", F.lit(DEFAULT_COMPRESSION)).alias("compression"),
        CORRUPT,
    )


def split_manifests(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable manifests and rejects. Without an id or a month nothing can be loaded."""
    reason = (
        F.when(F.col(CORRUPT).isNotNull(), F.lit("bad JSON"))
        .when(F.col("execution_id").isNull(), F.lit("no delivery id"))
        .when(~is_valid_period(F.col("billing_period")), F.lit("no billing month"))
    )
    flagged = parsed.withColumn("reason", reason)
    good = flagged.where("reason IS NULL").drop(CORRUPT, "reason")
    return good, flagged.where("reason IS NOT NULL").select("manifest_path", "reason")


def manifest_files(manifests: DataFrame) -> DataFrame:
    """One row per listed data file; a delivery that lists none keeps one row with NULL."""
    return manifests.select(
        "billing_period", "execution_id", "compression", F.explode_outer("files").alias("file_key")
    ).withColumn("file_name", F.element_at(F.split("file_key", "/"), -1))


def manifest_columns(manifests: DataFrame) -> DataFrame:
    """One row per declared column; ``pos`` keeps the manifest's order."""
    return manifests.select(
        "billing_period", "execution_id", F.posexplode("columns").alias("pos", "column")
    ).select(
        "billing_period",
        "execution_id",
        "pos",
        "column.category",
        "column.name",
        F.col("column.type").alias("source_type"),
        original_name(F.col("column.category"), F.col("column.name")).alias("original_name"),
    )


def manifest_summary(manifests: DataFrame) -> DataFrame:
    """One line per manifest, newest month first; the path breaks ties."""
    return manifests.select(
        "billing_period",
        "version",
        F.size("files").alias("file_count"),
        "execution_id",
        "manifest_path",
    ).orderBy(F.desc("billing_period"), "manifest_path")

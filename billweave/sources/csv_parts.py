"""CSV parts of deliveries: headers, their mapping to table columns, and the typed scan."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billweave.functions.names import normalize_name
from billweave.functions.periods import utc_wall_time
from billweave.functions.types import DEFAULT_TYPE, misfit, spark_type
from billweave.operators.columns import conform
from billweave.sources.files import damage_finder, record_reader
from billweave.sources.listing import STAGED_PART, path_group, unescaped

FAULT = "_fault"
OWN = ("billing_period", "execution_id", FAULT)  # columns of a scan that are not in its files
FAULTS_SCHEMA = "billing_period string, execution_id string, fault string"
HEADER_SCHEMA = "billing_period string, execution_id string, path string, header array<string>"


def read_headers(parts: DataFrame) -> DataFrame:
    """Header of every part, read where the part's task runs.

    Spark's own ``header`` option renames repeated names, and scanning a part for its first row
    would read it whole, so the task opens the file and takes one record.
    """

    first_record = record_reader()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from concurrent.futures import ThreadPoolExecutor

        # Opening a stored file is mostly waiting, so a task opens some at a time.
        with ThreadPoolExecutor(16) as opening:
            for batch in batches:
                yield batch.assign(header=list(opening.map(first_record, batch["path"])))

    return parts.select("billing_period", "execution_id", "path").mapInPandas(read, HEADER_SCHEMA)


def distinct_headers(headers: DataFrame) -> DataFrame:
    """Different headers per delivery with the parts that have them (paths only, no data)."""
    header_id = F.sha2(F.to_json("header"), 256)
    return (
        headers.withColumn("header_id", header_id)
        .groupBy("billing_period", "execution_id", "header_id", "header")
        .agg(F.collect_list("path").alias("paths"))
    )


def map_headers(headers: DataFrame, defs: DataFrame) -> DataFrame:
    """Each header column's table name and type, by original name.

    A repeated original is matched by its ordinal, so two equal headers reach two table columns.
    A column that the manifest does not declare has ``declared = false`` and is text under its
    normalized name.
    """
    keys = ["billing_period", "execution_id", "original_name"]

    def counted(name: Column, pos: Column) -> Column:
        earlier = F.filter(F.slice("header", F.lit(1), pos), lambda h: h == name)
        return F.struct(name.alias("original_name"), F.size(earlier).alias("ordinal"))

    columns = headers.select(
        "billing_period", "execution_id", "header_id", F.posexplode(F.transform("header", counted)).alias("pos", "c")
    ).select("billing_period", "execution_id", "header_id", "pos", "c.*")
    declared = (
        defs.groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("pos", "normalized_name", "table_type"))).alias("same"))
        .select(*keys, F.posexplode("same").alias("ordinal", "definition"))
    )
    return columns.join(declared, [*keys, "ordinal"], "left").select(
        "billing_period",
        "execution_id",
        "header_id",
        "pos",
        "original_name",
        "ordinal",
        F.col("definition").isNotNull().alias("declared"),
        F.coalesce("definition.normalized_name", normalize_name(F.col("original_name"))).alias("normalized_name"),
        F.coalesce("definition.table_type", F.lit(DEFAULT_TYPE)).alias("table_type"),
    )


def scan_groups(headers: DataFrame, mapped: DataFrame) -> DataFrame:
    """Parts that can be read together: same column names and types in the same places."""
    keys = ["billing_period", "execution_id", "header_id"]
    columns = mapped.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("pos", "normalized_name", "table_type"))).alias("columns")
    )
    names = F.transform("columns", lambda c: c["normalized_name"])
    types = F.transform("columns", lambda c: c["table_type"])
    return (
        headers.join(columns, keys)
        .select(names.alias("names"), types.alias("types"), "paths")
        .groupBy("names", "types")
        .agg(F.flatten(F.collect_list("paths")).alias("paths"))
    )


def _reader_type(data_type: T.DataType) -> T.DataType:
    # The reader takes a trailing Z only for zoned timestamps.
    return T.TimestampType() if isinstance(data_type, T.TimestampNTZType) else data_type


def glob_literal(path: str) -> str:
    """``path`` with the characters escaped that the reader would take for a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def typed_scan(
    spark: SparkSession,
    names: list[str],
    types: list[str],
    paths: list[str],
    multi_line: bool = True,
    keep_faults: bool = False,
) -> DataFrame:
    """Rows of parts that share one header, typed, with the delivery taken from the path.

    A value that does not fit its type, or a record of another width, fails the read. With ``keep_faults`` it is kept
    instead, its text in ``_fault``, and a damaged file ends where the damage begins. With ``multi_line=False`` large
    plain parts are split over tasks, but values must hold no line breaks.
    """
    fields = [T.StructField(n, spark_type(t)) for n, t in zip(names, types)]
    read_fields = [T.StructField(f.name, _reader_type(f.dataType)) for f in fields]
    options = {"mode": "FAILFAST"}
    if keep_faults:
        read_fields.append(T.StructField(FAULT, T.StringType()))
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": FAULT, "ignoreCorruptFiles": "true"}
    read = (
        spark.read.schema(T.StructType(read_fields))
        .options(header=True, sep=",", quote='"', escape='"', multiLine=multi_line, timeZone="UTC", **options)
        .csv([glob_literal(path) for path in paths])
    )
    # Every row has its file's path: only the last three names, which the pattern asks for, are decoded and matched.
    path = unescaped(F.concat(F.lit("/"), F.substring_index(F.col("_metadata.file_path"), "/", -3)))
    values = [
        (utc_wall_time(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f"`{f.name}`"))
        .alias(f.name)
        for f in fields
    ]
    return read.select(
        path_group(path, STAGED_PART, 1).alias("billing_period"),
        path_group(path, STAGED_PART, 2).alias("execution_id"),
        *values,
        *([FAULT] if keep_faults else []),
    )


def scan_parts(
    spark: SparkSession, groups: DataFrame, schema: T.StructType, multi_line: bool = True
) -> DataFrame | None:
    """All parts as one DataFrame under the table schema: one typed scan per distinct header.

    The driver holds only names, types and paths, as the file source itself does. The number of
    scans is the number of different headers, not of deliveries or parts.
    """
    scans = [
        conform(typed_scan(spark, g.names, g.types, g.paths, multi_line), schema, "billing_period")
        for g in groups.toLocalIterator()
    ]
    return reduce(DataFrame.unionByName, scans) if scans else None


def row_faults(rows: DataFrame, schema: T.StructType) -> Column:
    """What keeps a row scanned with its faults out of a table of that schema, or NULL; the counterpart of ``conform``."""
    present = {f.name: f.dataType for f in rows.schema.fields}
    unlike = [f for f in schema.fields if f.name in present and present[f.name] != f.dataType]
    # The reader checks only columns that a query takes; a condition that always holds takes all of them.
    reads = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in rows.columns if name not in OWN]), F.lit(2)) < 2
    malformed = F.when(reads, F.concat(F.lit("malformed record: "), F.left(F.col(FAULT), F.lit(200))))
    return F.coalesce(malformed, *[misfit(F.col(f"`{f.name}`"), f.dataType) for f in unlike])


def damaged_parts(parts: DataFrame) -> DataFrame:
    """Parts that can't be read to their end, each with its fault; files are read where their tasks run."""

    damage = damage_finder()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [damage(path) for path in batch["path"]]
            faults = [error and f"damaged file {path}: {error}" for path, error in zip(batch["path"], found)]
            yield batch.assign(fault=faults).drop(columns="path").dropna(subset=["fault"])

    return parts.select("billing_period", "execution_id", "path").repartition("path").mapInPandas(read, FAULTS_SCHEMA)


def delivery_faults(
    spark: SparkSession, headers: DataFrame, groups: DataFrame, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """Deliveries with rows or files at fault: how many, and one of the faults. All parts are looked through in one job."""
    parts = headers.select("billing_period", "execution_id", F.explode("paths").alias("path"))
    found = damaged_parts(parts)
    for g in groups.toLocalIterator():
        rows = typed_scan(spark, g.names, g.types, g.paths, multi_line, keep_faults=True)
        found = found.unionByName(rows.select("billing_period", "execution_id", row_faults(rows, schema).alias("fault")))
    faulty = found.where("fault IS NOT NULL").groupBy("billing_period", "execution_id")
    return faulty.agg(F.count("*").alias("faults"), F.min("fault").alias("fault"))

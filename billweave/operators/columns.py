"""Column definitions: manifest columns with clean, unique names and table types."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billweave.functions.names import normalize_names, original_name, suffixed
from billweave.functions.types import checked_cast, spark_type, table_type

DEFINITION_FIELDS = ["original_name", "normalized_name", "category", "source_type", "table_type"]
EXECUTION_COLUMN = "execution_id"


def unique_names(bases: Column) -> Column:
    """Names of an array of base names, made unique in order: ``a``, ``a_1``, ``a_2``, …

    The n-th repeat of a base takes suffix n. Where a literal column already holds that name, the
    next free number is taken. One manifest's columns are one array, so nothing is shuffled.
    """
    empty = F.array().cast("array<string>")
    start = F.struct(empty.alias("bases"), empty.alias("names"))

    def add(done: Column, base: Column) -> Column:
        repeats = F.size(F.filter(done["bases"], lambda b: b == base))
        plain = suffixed(base, repeats)
        later = F.transform(
            F.sequence(repeats + 1, repeats + 1 + F.size(done["names"])), lambda n: suffixed(base, n)
        )
        free = F.element_at(F.array_except(later, done["names"]), 1)
        name = F.when(F.array_contains(done["names"], plain), free).otherwise(plain)
        return F.struct(
            F.array_append(done["bases"], base).alias("bases"),
            F.array_append(done["names"], name).alias("names"),
        )

    return F.aggregate(bases, start, add, lambda done: done["names"])


def column_defs(manifests: DataFrame, cost_scale: int = 2, text_categories: Iterable[str] = ()) -> DataFrame:
    """Definitions of every manifest's columns, one row each, with no shuffle."""
    named = manifests.select(
        "billing_period",
        "execution_id",
        "columns",
        normalize_names(F.transform("columns", lambda c: original_name(c["category"], c["name"]))).alias("bases"),
    )
    rows = named.select(
        "billing_period",
        "execution_id",
        F.posexplode(F.arrays_zip("columns", unique_names(F.col("bases")).alias("names"))).alias("pos", "item"),
    )
    column = F.col("item.columns")
    return rows.select(
        "billing_period",
        "execution_id",
        "pos",
        original_name(column["category"], column["name"]).alias("original_name"),
        F.col("item.names").alias("normalized_name"),
        column["category"].alias("category"),
        column["type"].alias("source_type"),
        table_type(column["category"], column["type"], cost_scale, text_categories).alias("table_type"),
    )


def merged_definitions(defs: DataFrame) -> DataFrame:
    """One definition per name over all manifests: the newest month's, then the first by position.

    ``rank_period, rank_pos`` give the table order; ``other_originals`` are further originals that
    other manifests gave the same name. Partial aggregation leaves one row per name on each mapper
    before the shuffle.
    """
    newest_first = F.struct("billing_period", "execution_id", -F.col("pos"))
    picked = F.max_by(F.struct(*DEFINITION_FIELDS, "billing_period", "pos"), newest_first)
    merged = defs.groupBy("normalized_name").agg(
        picked.alias("d"), F.collect_set("original_name").alias("originals")
    )
    return merged.select(
        *[F.col(f"d.{field}") for field in DEFINITION_FIELDS],
        F.col("d.billing_period").alias("rank_period"),
        F.col("d.pos").alias("rank_pos"),
        F.array_except("originals", F.array("d.original_name")).alias("other_originals"),
    )


def unified_schema(defs: DataFrame) -> DataFrame:
    """The schema over all manifests, one row per column."""
    return merged_definitions(defs).drop("other_originals")


def new_columns(defs: DataFrame, existing: DataFrame) -> DataFrame:
    """Definitions whose name the table lacks."""
    return defs.join(existing.select("normalized_name").distinct(), "normalized_name", "left_anti")


def renamed_columns(defs: DataFrame, existing: DataFrame) -> DataFrame:
    """Columns whose name stands for another original, so that loading them would mix data.

    The original that the table recorded counts, or else that of the newest delivery.
    """
    recorded = existing.select("normalized_name", F.col("original_name").alias("recorded_name"))
    newest = merged_definitions(defs).select("normalized_name", F.col("original_name").alias("newest_name"))
    official = newest.join(recorded, "normalized_name", "left").select(
        "normalized_name", F.coalesce("recorded_name", "newest_name").alias("official_name")
    )
    return defs.join(official, "normalized_name").where(F.col("original_name") != F.col("official_name"))


def schema_summary(defs: DataFrame) -> DataFrame:
    """Column counts in total, by category and by type, in one pass."""
    level = F.grouping_id()
    return (
        defs.groupingSets([("category",), ("table_type",), ()], "category", "table_type")
        .agg(F.count("*").alias("columns"), level.alias("level"))
        .select(
            F.when(F.col("level") == 3, "total").when(F.col("level") == 1, "category").otherwise("type").alias("kind"),
            F.when(F.col("level") == 3, F.lit("")).otherwise(F.coalesce("category", "table_type")).alias("key"),
            "columns",
        )
        .orderBy("kind", "key")
    )


def table_schema(definitions: list) -> T.StructType:
    """Table schema from ordered definition rows: the delivery tag, then one field each."""
    fields = [T.StructField(EXECUTION_COLUMN, T.StringType())]
    for d in definitions:
        source = {"original_name": d.original_name, "category": d.category or "", "source_type": d.source_type or ""}
        fields.append(T.StructField(d.normalized_name, spark_type(d.table_type), metadata=source))
    return T.StructType(fields)


def conform(rows: DataFrame, schema: T.StructType, *others: str) -> DataFrame:
    """``rows`` under the table schema: absent columns NULL, existing types kept, by name.

    A value that an existing column cannot hold fails the job. ``others`` are kept as they are.
    """
    present = {f.name: f.dataType for f in rows.schema.fields}

    def field(f: T.StructField) -> Column:
        if f.name not in present:
            value = F.lit(None).cast(f.dataType)
        elif present[f.name] == f.dataType:
            value = F.col(f.name)
        else:
            value = checked_cast(F.col(f.name), f.dataType)
        return value.alias(f.name)

    return rows.select(*[field(f) for f in schema.fields], *others)

"""Billing data derived by Spark from the given tables: rows, manifests and staged CSV parts.

The given tables hold no billing files, so line items with their order and part stand for billing
rows: the order month is the billing month and a third of the orders make up each delivery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.functions.periods import month_floor, period_of
from billweave.operators.columns import column_defs
from billweave.operators.state import DELIVERY
from billweave.operators.table import BillingTable
from billweave.session import work_folder
from billweave.sources.files import text_writer

PREFIX, EXPORT = "billing/reports", "daily.usage"

# Header names of the billing columns, in the order of a part: category, name, type.
BILLING_COLUMNS = [
    ("bill", "BillingPeriodStartDate", "DateTime"),
    ("bill", "BillingPeriodEndDate", "DateTime"),
    ("lineItem", "UsageStartDate", "DateTime"),
    ("lineItem", "UsageAccountId", "String"),
    ("lineItem", "ProductCode", "String"),
    ("lineItem", "UnblendedCost", "BigDecimal"),
    ("resourceTags", "user:PartType", "OptionalBigDecimal"),
]
BILLING_NAMES = [
    "bill_billing_period_start_date",
    "bill_billing_period_end_date",
    "line_item_usage_start_date",
    "line_item_usage_account_id",
    "line_item_product_code",
    "line_item_unblended_cost",
    "resource_tags_user_part_type",
]
TAG_NAME = BILLING_NAMES[-1]

BILLING_SQL = """
billing AS (
    SELECT 'exec-' || (o_orderkey % 3) AS execution_id,
           CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS bill_billing_period_start_date,
           CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS TIMESTAMP) AS bill_billing_period_end_date,
           l_shipdate AS line_item_usage_start_date,
           CAST(o_custkey AS VARCHAR) AS line_item_usage_account_id,
           p_brand AS line_item_product_code,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS line_item_unblended_cost,
           p_type AS resource_tags_user_part_type,
           strftime(o_orderdate, '%Y-%m') AS billing_period,
           l_linenumber, p_name, p_size, l_linestatus
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_delivery() -> tuple[Column, Column]:
    """Month and delivery of an order."""
    execution = F.concat(F.lit("exec-"), (F.col("o_orderkey") % 3).cast("string"))
    return period_of(F.col("o_orderdate")).alias("billing_period"), execution.alias("execution_id")


def billing_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing rows with the item columns that deliveries are derived from."""
    items, orders, parts = (given(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    start = month_floor(F.col("o_orderdate"))
    # Dates become text once an order, before the join, not once an item.
    billed = orders.select(
        "o_orderkey",
        *order_delivery(),
        start.alias("bill_billing_period_start_date"),
        F.add_months(start.cast("date"), 1).cast("timestamp_ntz").alias("bill_billing_period_end_date"),
        F.col("o_custkey").cast("string").alias("line_item_usage_account_id"),
    )
    joined = items.join(billed, items.l_orderkey == billed.o_orderkey).join(parts, items.l_partkey == parts.p_partkey)
    return joined.select(
        "execution_id",
        "bill_billing_period_start_date",
        "bill_billing_period_end_date",
        F.col("l_shipdate").alias("line_item_usage_start_date"),
        "line_item_usage_account_id",
        F.col("p_brand").alias("line_item_product_code"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("line_item_unblended_cost"),
        F.col("p_type").alias("resource_tags_user_part_type"),
        "billing_period",
        "l_linenumber",
        "p_name",
        "p_size",
        "l_linestatus",
    )


def billing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The billing view: delivery tag, billing columns, month."""
    return billing_items(spark, sf_dir).select("execution_id", *BILLING_NAMES, "billing_period")


def billed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month and delivery of every order that has a billing row, without the rows themselves."""
    items, orders, parts = (given(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    billed = items.join(parts, items.l_partkey == parts.p_partkey, "left_semi")
    return orders.join(billed, orders.o_orderkey == billed.l_orderkey, "left_semi").select(*order_delivery())


def base_columns() -> Column:
    """The billing columns as manifest column structs."""
    return F.array(
        *[
            F.struct(F.lit(c).alias("category"), F.lit(n).alias("name"), F.lit(t).alias("type"))
            for c, n, t in BILLING_COLUMNS
        ]
    )


# A delivery also declares one tag per part name it bills, in upper case for large parts, so that
# tags of one delivery may differ in case only.
TAG_SQL = "'user:' || CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END"

BASE_SQL = "base(pos, category, name, source_type) AS (VALUES " + ", ".join(
    f"({i}, '{c}', '{n}', '{t}')" for i, (c, n, t) in enumerate(BILLING_COLUMNS)
) + ")"
COLUMNS_SQL = f"""{BILLING_SQL},
{BASE_SQL},
declared AS (
    SELECT billing_period, execution_id, pos, category, name, source_type
    FROM (SELECT DISTINCT billing_period, execution_id FROM billing) CROSS JOIN base
    UNION ALL
    SELECT billing_period, execution_id,
           {len(BILLING_COLUMNS)} - 1 + row_number() OVER (PARTITION BY billing_period, execution_id ORDER BY tag),
           'resourceTags', tag, 'BigDecimal'
    FROM (SELECT DISTINCT billing_period, execution_id, {TAG_SQL} AS tag FROM billing)
)"""


def delivery_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest per delivery: its line numbers are its files, its part names its tags.

    Both sets are small and fixed by the source's vocabulary. Rows are first made distinct on each
    mapper, so a delivery's row count does not matter.
    """
    name = F.concat(F.lit("user:"), F.when(F.col("p_size") > 25, F.upper("p_name")).otherwise(F.col("p_name")))
    tag = F.struct(
        F.lit("resourceTags").alias("category"), F.col("tag_name").alias("name"), F.lit("BigDecimal").alias("type")
    )
    file_name = F.concat(F.lit("part-"), F.col("l_linenumber").cast("string"), F.lit(".csv.gz"))
    key = F.concat_ws("/", "billing_period", "execution_id", file_name)
    return (
        billing_items(spark, sf_dir)
        .select(*DELIVERY, "l_linenumber", name.alias("tag_name"))
        .distinct()
        .groupBy(*DELIVERY)
        .agg(F.array_sort(F.collect_set(key)).alias("files"), F.array_sort(F.collect_set(tag)).alias("tags"))
        .select(
            *DELIVERY,
            F.concat(F.lit("manifests/"), "billing_period", F.lit("/"), "execution_id").alias("manifest_path"),
            "files",
            F.concat(base_columns(), "tags").alias("columns"),
            F.lit("v2").alias("version"),
            F.lit("GZIP").alias("compression"),
        )
    )


def part_manifests(parts: DataFrame) -> DataFrame:
    """Manifests that list exactly the staged parts and declare the billing columns."""
    key = F.concat_ws("/", "billing_period", "execution_id", "file_name")
    return parts.groupBy(*DELIVERY).agg(F.array_sort(F.collect_list(key)).alias("files")).select(
        *DELIVERY,
        F.concat(F.lit("manifests/"), "billing_period", F.lit("/"), "execution_id").alias("manifest_path"),
        "files",
        base_columns().alias("columns"),
        F.lit("v2").alias("version"),
        F.lit("GZIP").alias("compression"),
    )


def manifest_json(manifests: DataFrame) -> DataFrame:
    """``billing_period, execution_id, text``: the manifests as JSON."""
    start = F.concat(F.replace("billing_period", F.lit("-"), F.lit("")), F.lit("01T000000.000Z"))
    text = F.to_json(
        F.struct(
            F.col("execution_id").alias("assemblyId"),
            F.col("execution_id").alias("executionId"),
            F.struct(start.alias("start")).alias("billingPeriod"),
            F.col("files").alias("reportKeys"),
            "columns",
        )
    )
    return manifests.select(*DELIVERY, text.alias("text"))


def write_manifests(texts: DataFrame, store: str, version: str) -> None:
    """Write manifest files from tasks: a month's greatest delivery where the layout has it, the
    others in an archive folder, which is no part of the layout."""
    texts = texts.persist()
    live = texts.groupBy("billing_period").agg(F.max("execution_id").alias("live"))
    first = F.to_date(F.concat("billing_period", F.lit("-01")))
    months = F.concat_ws("-", F.date_format(first, "yyyyMMdd"), F.date_format(F.add_months(first, 1), "yyyyMMdd"))
    folder = months if version == "v1" else F.concat(F.lit("metadata/BILLING_PERIOD="), F.col("billing_period"))
    archive = F.concat_ws("/", F.lit("archive"), "billing_period", "execution_id")
    place = F.when(F.col("execution_id") == F.col("live"), folder).otherwise(archive)
    path = F.concat(F.lit(f"{store}/{PREFIX}/{EXPORT}/"), place, F.lit(f"/{EXPORT}-Manifest.json"))

    write_text = text_writer()

    def write(rows) -> None:
        for row in rows:
            write_text(row.path, row.text)

    texts.join(live, "billing_period").select(path.alias("path"), "text").foreachPartition(write)
    texts.unpersist()


def write_parts(rows: DataFrame, names: list[str], staging: str) -> None:
    """Add billing rows to a staging folder as gzip CSV parts that have some of the columns, under original headers."""
    original = {n: f"{c}/{name}" for n, (c, name, _) in zip(BILLING_NAMES, BILLING_COLUMNS)}
    (
        rows.select(*DELIVERY, *[F.col(n).alias(original[n]) for n in names])
        .hint("rebalance", *[F.col(k) for k in DELIVERY])
        .write.mode("append")
        .partitionBy(*DELIVERY)
        .options(header=True, compression="gzip", escape='"', timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss'Z'")
        .csv(staging)
    )


def stage_csv(spark: SparkSession, sf_dir: str, staging: str) -> None:
    """Stage all billing rows as gzip CSV parts with original headers.

    The deliveries differ: ``exec-1`` has its columns in reverse order, ``exec-2`` has no tag column.
    """
    orders = {"exec-0": BILLING_NAMES, "exec-1": BILLING_NAMES[::-1], "exec-2": BILLING_NAMES[:-1]}
    rows = billing_rows(spark, sf_dir)
    for execution, names in orders.items():
        write_parts(rows.where(F.col("execution_id") == execution), names, staging)


def base_definitions(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """Definitions of the billing columns, of all or of some."""
    one = spark.range(1).select(
        F.lit("0000-00").alias("billing_period"), F.lit("").alias("execution_id"), base_columns().alias("columns")
    )
    defs = column_defs(one)
    return defs.where(F.col("normalized_name").isin(names)) if names else defs


def given_table(spark: SparkSession, sf_dir: str) -> BillingTable:
    """A billing table that holds the whole billing view."""
    table = BillingTable(spark, work_folder(spark, "table"))
    table.evolve(base_definitions(spark))
    table.replace(billing_rows(spark, sf_dir), gather=True)
    return table

"""Queries on names, types, periods, keys and column definitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.functions.keys import delivery_key, export_name, parse_export_name
from billweave.functions.names import RESERVED_WORDS, normalize_name
from billweave.functions.periods import (
    in_month,
    in_range,
    is_valid_period,
    manifest_period,
    month_floor,
    period_end,
    period_of,
    period_start,
    period_text,
)
from billweave.functions.types import table_type
from billweave.operators.columns import column_defs, new_columns, schema_summary, unified_schema
from billweave.plans.given import (
    BILLING_SQL,
    COLUMNS_SQL,
    billing_rows,
    delivery_manifests,
    given,
    given_table,
)
from billweave.plans.registry import checked

# Fixed values, stated once more so that the SQL does not follow a mistake in the library.
RESERVED_SQL = ", ".join(f"'{w}'" for w in """
group order select from where join inner outer left right on as and or not in exists between like is
null true false case when then else end union intersect except all distinct limit offset having by
asc desc create table insert update delete alter drop index view database schema column primary key
foreign references constraint unique check default grant revoke user role commit rollback begin
transaction start
""".split())


def normalized_sql(text: str) -> str:
    bare = (
        f"trim(regexp_replace(lower(regexp_replace({text}, '([a-z0-9])([A-Z])', '\\1_\\2', 'g')), "
        "'[^a-z0-9]+', '_', 'g'), '_')"
    )
    safe = (
        f"CASE WHEN {bare} = '' THEN 'unknown_column' WHEN regexp_matches({bare}, '^[0-9]') "
        f"THEN 'col_' || {bare} ELSE {bare} END"
    )
    return f"CASE WHEN {safe} IN ({RESERVED_SQL}) THEN ({safe}) || '_col' ELSE {safe} END"


def type_sql(category: str, source_type: str) -> str:
    return f"""CASE WHEN {category} = 'resourceTags' THEN 'VARCHAR'
        WHEN {source_type} IN ('BigDecimal', 'OptionalBigDecimal') THEN 'DECIMAL(18,2)'
        WHEN {source_type} = 'DateTime' THEN 'TIMESTAMP' ELSE 'VARCHAR' END"""


DEFS_SQL = f"""{COLUMNS_SQL},
based AS (
    SELECT *, category || '/' || name AS original_name, {normalized_sql("category || '/' || name")} AS base_name
    FROM declared
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY billing_period, execution_id, base_name ORDER BY pos) - 1 AS k FROM based
),
defs AS (
    SELECT billing_period, execution_id, CAST(pos AS BIGINT) AS pos, original_name, category, source_type,
           CASE WHEN k = 0 THEN base_name ELSE base_name || '_' || k END AS normalized_name,
           {type_sql("category", "source_type")} AS table_type
    FROM numbered
)"""


def _defs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_defs(delivery_manifests(spark, sf_dir))


@checked(
    f"""SELECT raw AS original_name, {normalized_sql("raw")} AS normalized_name, count(*) AS parts
    FROM (SELECT 'resourceTags/user:' || p_name || '/IPv4Address.' || p_type AS raw FROM part) GROUP BY ALL"""
)
def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("resourceTags/user:"), "p_name", F.lit("/IPv4Address."), "p_type")
    counted = given(spark, sf_dir, "part").groupBy(raw.alias("original_name")).agg(F.count("*").alias("parts"))
    return counted.withColumn("normalized_name", normalize_name(F.col("original_name")))


_EDGE_SQL = f"""CASE p_size % 5 WHEN 0 THEN '' WHEN 1 THEN '/' WHEN 2 THEN CAST(p_size AS VARCHAR) || p_name
    WHEN 3 THEN '__' || upper(substr(p_name, 1, 1)) || 'x__Y' || p_type || '??'
    ELSE list_extract([{RESERVED_SQL}], CAST(p_size AS BIGINT)) END"""


@checked(
    f"""SELECT raw AS original_name, {normalized_sql("raw")} AS normalized_name, count(*) AS parts
    FROM (SELECT {_EDGE_SQL} AS raw FROM part) GROUP BY ALL"""
)
def normalize_edge_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty names, names of digits, of separators only, and reserved words, one kind by part size."""
    kind = F.col("p_size") % 5
    odd = F.concat(F.lit("__"), F.upper(F.substring("p_name", 1, 1)), F.lit("x__Y"), "p_type", F.lit("??"))
    word = F.element_at(F.array(*[F.lit(w) for w in RESERVED_WORDS]), F.greatest("p_size", F.lit(1)))
    raw = (
        F.when(kind == 0, "")
        .when(kind == 1, "/")
        .when(kind == 2, F.concat(F.col("p_size").cast("string"), "p_name"))
        .when(kind == 3, odd)
        .otherwise(word)
    )
    counted = given(spark, sf_dir, "part").groupBy(raw.alias("original_name")).agg(F.count("*").alias("parts"))
    return counted.withColumn("normalized_name", normalize_name(F.col("original_name")))


@checked(
    f"""SELECT {normalized_sql("word")} AS normalized_name, count(*) AS words, count(DISTINCT word) AS spellings
    FROM (SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\v\\f\\r]+')) AS word FROM documents) WHERE word <> '' GROUP BY 1"""
)
def normalize_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names made from every word of every document."""
    words = given(spark, sf_dir, "documents").select(
        F.explode(F.split("text", r"[ \t\n\x0B\f\r]+")).alias("word")
    ).filter("word <> ''")
    spelled = words.groupBy("word").agg(F.count("*").alias("n"))
    named = spelled.withColumn("normalized_name", normalize_name(F.col("word")))
    return named.groupBy("normalized_name").agg(
        F.sum("n").cast("bigint").alias("words"), F.count("*").alias("spellings")
    )


@checked(f"WITH {DEFS_SQL} SELECT billing_period, execution_id, pos, original_name, normalized_name FROM defs")
def dup_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags that differ in case only get numbered names, in manifest order."""
    return _defs(spark, sf_dir).select(
        "billing_period", "execution_id", F.col("pos").cast("bigint").alias("pos"), "original_name", "normalized_name"
    )


@checked(
    f"""WITH named AS (
        SELECT p_partkey, p_size % 2 = 0 AS literal_first, {normalized_sql("'resourceTags/user:' || lower(p_name)")} AS base FROM part),
    placed AS (
        SELECT p_partkey, 0 AS pos, base AS normalized_name FROM named
        UNION ALL SELECT p_partkey, 1, base || '_1' FROM named
        UNION ALL SELECT p_partkey, 2, CASE WHEN literal_first THEN base || '_2' ELSE base || '_1_1' END FROM named
        UNION ALL SELECT p_partkey, 3, CASE WHEN literal_first THEN base || '_3' ELSE base || '_2' END FROM named)
    SELECT CAST(p_partkey AS VARCHAR) AS execution_id, CAST(pos AS BIGINT) AS pos, normalized_name FROM placed"""
)
def dup_suffix_clash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated tags next to a tag that literally has a numbered name, before or after the first repeat.

    A literal that comes first keeps its name and the repeats count on; one that comes later is numbered itself.
    """
    low = F.concat(F.lit("user:"), F.lower("p_name"))
    tag = lambda name: F.struct(F.lit("resourceTags").alias("category"), name.alias("name"), F.lit("String").alias("type"))
    plain, literal = tag(low), tag(F.concat(low, F.lit("/1")))
    again, third = tag(F.concat(low, F.lit("?"))), tag(F.concat(low, F.lit("??")))
    order = F.when(F.col("p_size") % 2 == 0, F.array(plain, literal, again, third)).otherwise(F.array(plain, again, literal, third))
    manifests = given(spark, sf_dir, "part").select(
        F.lit("2024-01").alias("billing_period"), F.col("p_partkey").cast("string").alias("execution_id"), order.alias("columns")
    )
    return column_defs(manifests).select("execution_id", F.col("pos").cast("bigint").alias("pos"), "normalized_name")


_TYPED_SQL = """SELECT CASE WHEN p_type = 'PROMO' THEN 'resourceTags' ELSE 'product' END AS category,
    list_extract(['String', 'OptionalString', 'BigDecimal', 'OptionalBigDecimal', 'DateTime', 'Interval', 'Mystery'],
                 CAST(p_size % 7 + 1 AS BIGINT)) AS source_type FROM part"""


@checked(
    f"""SELECT category, source_type, {type_sql("category", "source_type")} AS table_type, count(*) AS parts
    FROM ({_TYPED_SQL}) GROUP BY ALL"""
)
def type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["String", "OptionalString", "BigDecimal", "OptionalBigDecimal", "DateTime", "Interval", "Mystery"]
    category = F.when(F.col("p_type") == "PROMO", "resourceTags").otherwise("product")
    source_type = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("p_size") % 7 + 1)
    counted = (
        given(spark, sf_dir, "part")
        .groupBy(category.alias("category"), source_type.alias("source_type"))
        .agg(F.count("*").alias("parts"))
    )
    return counted.withColumn("table_type", table_type(F.col("category"), F.col("source_type")))


@checked(
    f"""WITH {DEFS_SQL} SELECT billing_period, execution_id, pos, original_name, normalized_name, category,
    source_type, table_type FROM defs""",
    name="column_defs",
)
def column_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _defs(spark, sf_dir).withColumn("pos", F.col("pos").cast("bigint"))


_UNIFIED_SQL = f"""{DEFS_SQL},
unified AS (
    SELECT * FROM defs
    QUALIFY row_number() OVER (PARTITION BY normalized_name ORDER BY billing_period DESC, execution_id DESC, pos) = 1
)"""


@checked(
    f"""WITH {_UNIFIED_SQL} SELECT normalized_name, original_name, category, source_type, table_type,
    billing_period AS rank_period, pos AS rank_pos FROM unified""",
    name="unified_schema",
)
def unified_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unified_schema(_defs(spark, sf_dir)).withColumn("rank_pos", F.col("rank_pos").cast("bigint"))


@checked(
    f"""WITH {DEFS_SQL} SELECT billing_period, execution_id, normalized_name, table_type FROM defs
    WHERE normalized_name NOT IN (SELECT normalized_name FROM defs WHERE source_type <> 'BigDecimal' OR pos < 7)""",
    name="new_columns",
)
def columns_to_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of all deliveries that a table holding only the billing columns lacks."""
    defs = _defs(spark, sf_dir)
    known = defs.where("source_type <> 'BigDecimal' OR pos < 7")
    return new_columns(defs, known).select("billing_period", "execution_id", "normalized_name", "table_type")


@checked(
    f"""WITH {DEFS_SQL}
    SELECT 'total' AS kind, '' AS key, count(*) AS columns FROM defs
    UNION ALL SELECT 'category', category, count(*) FROM defs GROUP BY category
    UNION ALL SELECT 'type', table_type, count(*) FROM defs GROUP BY table_type""",
    name="schema_summary",
)
def schema_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_summary(_defs(spark, sf_dir))


@checked(
    """SELECT start, CASE WHEN start IS NULL OR start = '' THEN 'unknown'
        WHEN regexp_matches(start, '^[0-9]{6}') THEN substr(start, 1, 4) || '-' || substr(start, 5, 2)
        ELSE substr(start, 1, 7) END AS billing_period, count(*) AS manifests
    FROM (SELECT CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN strftime(o_orderdate, '%Y%m%dT000000.000Z')
        WHEN '2' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN '3' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
        WHEN '4' THEN '' END AS start FROM orders) GROUP BY ALL""",
    name="manifest_period",
)
def manifest_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of compact, dashed, empty and missing manifest starts, one form by order priority."""
    form, day = F.substring("o_orderpriority", 1, 1), F.col("o_orderdate")
    start = (
        F.when(form == "1", F.concat(F.date_format(day, "yyyyMMdd"), F.lit("T000000.000Z")))
        .when(form == "2", F.date_format(day, "yyyy-MM-dd"))
        .when(form == "3", F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(form == "4", "")
    )
    counted = given(spark, sf_dir, "orders").groupBy(start.alias("start")).agg(F.count("*").alias("manifests"))
    return counted.withColumn("billing_period", manifest_period(F.col("start")))


@checked("SELECT strftime(o_orderdate, '%Y-%m') AS billing_period, count(*) AS orders FROM orders GROUP BY 1")
def period_printf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month text from year and month numbers."""
    day = F.col("o_orderdate")
    return (
        given(spark, sf_dir, "orders")
        .groupBy(F.year(day).alias("year"), F.month(day).alias("month"))
        .agg(F.count("*").alias("orders"))
        .select(period_text(F.col("year"), F.col("month")).alias("billing_period"), "orders")
    )


@checked(
    """SELECT strftime(ts, '%Y-%m') AS billing_period, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month_start,
        CAST(date_trunc('month', ts) + INTERVAL 1 MONTH AS TIMESTAMP) AS month_end,
        CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month,
        CAST(date_trunc('month', ts) AS TIMESTAMP) AS month_floor, count(*) AS items
    FROM (SELECT l_shipdate AS ts FROM lineitem) GROUP BY ALL"""
)
def period_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, period = F.col("l_shipdate"), F.col("billing_period")
    counted = (
        given(spark, sf_dir, "lineitem")
        .groupBy(
            period_of(ts).alias("billing_period"),
            F.year(ts).cast("bigint").alias("year"),
            F.month(ts).cast("bigint").alias("month"),
            month_floor(ts).alias("month_floor"),
        )
        .agg(F.count("*").alias("items"))
    )
    return counted.withColumn("month_start", period_start(period)).withColumn("month_end", period_end(period))


@checked(
    """SELECT billing_period, regexp_matches(billing_period, '^\\d{4}-(0[1-9]|1[0-2])$') AS valid, count(*) AS orders
    FROM (SELECT CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN strftime(o_orderdate, '%Y-%m')
        WHEN '2' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN '3' THEN strftime(o_orderdate, '%Y-%d')
        ELSE 'unknown' END AS billing_period FROM orders) GROUP BY ALL"""
)
def period_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid and invalid month texts, among them a day in the month's place."""
    form, day = F.substring("o_orderpriority", 1, 1), F.col("o_orderdate")
    text = (
        F.when(form == "1", period_of(day))
        .when(form == "2", F.date_format(day, "yyyy-MM-dd"))
        .when(form == "3", F.date_format(day, "yyyy-dd"))
        .otherwise("unknown")
    )
    counted = given(spark, sf_dir, "orders").groupBy(text.alias("billing_period")).agg(F.count("*").alias("orders"))
    return counted.withColumn("valid", is_valid_period(F.col("billing_period")))


@checked(
    f"""WITH {BILLING_SQL} SELECT billing_period, count(*) AS rows FROM billing
    WHERE billing_period BETWEEN '1996-01' AND '1997-06' GROUP BY 1"""
)
def period_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months from 1996-01 to 1997-06 of a stored table; the range prunes partitions."""
    rows = given_table(spark, sf_dir).rows()
    chosen = rows.where(in_range(F.col("billing_period"), "1996-01", "1997-06"))
    return chosen.groupBy("billing_period").agg(F.count("*").alias("rows"))


@checked(
    """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderdate FROM orders
    WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = 3"""
)
def month_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month of a table that is not partitioned; both bounds reach the scan."""
    orders = given(spark, sf_dir, "orders")
    return orders.where(in_month(F.col("o_orderdate"), "1996-03")).select("o_orderkey", "o_orderdate")


@checked(
    f"""WITH {BILLING_SQL} SELECT billing_period || ':' || execution_id AS delivery_key, count(*) AS rows
    FROM billing GROUP BY 1"""
)
def delivery_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = billing_rows(spark, sf_dir).groupBy("billing_period", "execution_id").agg(F.count("*").alias("rows"))
    return counted.select(delivery_key(F.col("billing_period"), F.col("execution_id")).alias("delivery_key"), "rows")


@checked(
    f"""WITH {BILLING_SQL}, pairs AS (SELECT DISTINCT billing_period, execution_id FROM billing)
    SELECT billing_period || '_' || execution_id || '_aws_billing.parquet' AS name, billing_period, execution_id FROM pairs
    UNION ALL SELECT DISTINCT billing_period || '_aws_billing.parquet', billing_period, NULL FROM pairs"""
)
def export_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat export names of months and deliveries, built and read back."""
    pairs = billing_rows(spark, sf_dir).select("billing_period", "execution_id").distinct()
    period, execution = F.col("billing_period"), F.col("execution_id")
    names = pairs.select(
        F.explode(F.array(export_name(period), export_name(period, execution=execution))).alias("name")
    ).distinct()
    return names.withColumn("parsed", parse_export_name(F.col("name"))).select("name", "parsed.*")

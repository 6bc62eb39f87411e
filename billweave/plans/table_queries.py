"""Queries on the billing table, its loads, exports, the warehouse and the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from billweave.operators.completeness import export_status
from billweave.operators.export import CODECS, export_deliveries, export_periods, export_root, read_export
from billweave.operators.ledger import append_ledger, current_loads, delivery_states, loaded_periods, read_events, read_ledger
from billweave.operators.load import load_deliveries
from billweave.operators.publish import first_file_schema, publish_deliveries, publish_periods
from billweave.operators.state import DELIVERY, has_data, loaded_pairs, periods
from billweave.operators.table import BillingTable, SORT_KEYS, delete_counts
from billweave.functions.types import table_type_name
from billweave.plans.given import (
    BILLING_NAMES,
    BILLING_SQL,
    EXPORT,
    PREFIX,
    TAG_NAME,
    base_definitions,
    billed_orders,
    billing_items,
    billing_rows,
    given,
    given_table,
    manifest_json,
    part_manifests,
    stage_csv,
    write_parts,
    write_manifests,
)
from billweave.plans.registry import checked
from billweave.plans.run import Places, run
from billweave.session import work_folder
from billweave.sources.listing import available_periods, exported_files, staged_parts

ROW_NAMES = ", ".join(["execution_id", *BILLING_NAMES, "billing_period"])
ROWS_SQL = f"SELECT {ROW_NAMES} FROM billing"
SUMS_SQL = "count(*) AS rows, CAST(sum(line_item_unblended_cost) AS DECIMAL(38,2)) AS cost"


def _sums(rows: DataFrame, *keys: str) -> DataFrame:
    cost = F.sum("line_item_unblended_cost").cast("decimal(38,2)")
    return rows.groupBy(*keys).agg(F.count("*").alias("rows"), cost.alias("cost"))


@checked(f"WITH {BILLING_SQL} {ROWS_SQL}")
def billing_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of a stored billing table, under its schema."""
    return given_table(spark, sf_dir).rows()


@checked(f"WITH {BILLING_SQL} SELECT DISTINCT billing_period FROM billing", name="periods")
def billing_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months with rows, newest first."""
    return periods(billed_orders(spark, sf_dir))


@checked(
    f"""WITH {BILLING_SQL} SELECT 'aws_billing_data' AS table_name, 8 AS column_count, count(*) AS row_count,
        min(bill_billing_period_start_date) AS min_date, max(bill_billing_period_end_date) AS max_date FROM billing""",
    name="table_info",
)
def table_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns, rows and date range of a stored table, from the statistics of its files."""
    return given_table(spark, sf_dir).info("aws_billing_data")


@checked(f"WITH {BILLING_SQL} SELECT billing_period, count(*) AS deleted_rows FROM billing GROUP BY 1")
def delete_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delete_counts(given_table(spark, sf_dir).rows())


@checked(
    f"""WITH {BILLING_SQL}, wanted AS (SELECT DISTINCT billing_period, execution_id FROM billing
        UNION ALL SELECT DISTINCT billing_period, 'exec-none' FROM billing)
    SELECT billing_period, execution_id, execution_id <> 'exec-none' AS has_data FROM wanted""",
    name="has_data",
)
def data_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the table has rows for deliveries, half of which it never got."""
    rows = billing_rows(spark, sf_dir)
    known = loaded_pairs(rows)
    wanted = known.unionByName(rows.select("billing_period", F.lit("exec-none").alias("execution_id")).distinct())
    return has_data(wanted, rows, DELIVERY)


@checked(
    f"""WITH {BILLING_SQL}, names(normalized_name, table_type) AS (VALUES
        ('bill_billing_period_start_date', 'TIMESTAMP'), ('bill_billing_period_end_date', 'TIMESTAMP'),
        ('line_item_usage_start_date', 'TIMESTAMP'), ('line_item_usage_account_id', 'VARCHAR'),
        ('line_item_product_code', 'VARCHAR'), ('line_item_unblended_cost', 'DECIMAL(18,2)'),
        ('resource_tags_user_part_type', 'VARCHAR'), ('execution_id', 'VARCHAR'))
    SELECT normalized_name, table_type, (SELECT count(*) FROM billing) AS filled FROM names"""
)
def schema_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and types of a table created from its definitions, with their filled rows."""
    rows = given_table(spark, sf_dir).rows().drop("billing_period")
    return _filled(rows)


def _filled(rows: DataFrame) -> DataFrame:
    """Type and number of filled rows per column, counted in one pass."""
    counts = rows.agg(*[F.count(c).alias(c) for c in rows.columns])
    pairs = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("normalized_name"),
                F.lit(table_type_name(f.dataType)).alias("table_type"),
                F.col(f.name).alias("filled"),
            )
            for f in rows.schema.fields
        ]
    )
    return counts.select(F.inline(pairs))


@checked(
    f"""WITH {BILLING_SQL} SELECT {ROW_NAMES.replace(TAG_NAME, f"CASE WHEN billing_period > '1998-06' THEN {TAG_NAME} END AS {TAG_NAME}")}
    FROM billing"""
)
def schema_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months up to 1998-06 written before the tag column came, later ones after it."""
    table = BillingTable(spark, work_folder(spark, "table"))
    rows = billing_rows(spark, sf_dir)
    early = F.col("billing_period") <= "1998-06"
    table.evolve(base_definitions(spark, BILLING_NAMES[:-1]))
    table.replace(rows.where(early).drop(TAG_NAME), gather=True)
    table.evolve(base_definitions(spark))
    table.replace(rows.where(~early), gather=True)
    return table.rows()


@checked(
    f"""WITH {BILLING_SQL} {ROWS_SQL} WHERE billing_period <> '1996-03' OR execution_id = 'exec-2'"""
)
def replace_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month replaced by one delivery; all other months stay."""
    table = given_table(spark, sf_dir)
    new = billing_rows(spark, sf_dir).where("billing_period = '1996-03' AND execution_id = 'exec-2'")
    table.replace(new, gather=True)
    return table.rows()


def _staged_load(spark: SparkSession, sf_dir: str):
    staging = work_folder(spark, "staging")
    stage_csv(spark, sf_dir, staging)
    parts = staged_parts(spark, staging)
    table = BillingTable(spark, work_folder(spark, "table"))
    return staging, parts, table


_LIVE_SQL = f"""{BILLING_SQL}, live AS (SELECT billing_period, max(execution_id) AS execution_id FROM billing GROUP BY 1)"""


@checked(
    f"""WITH {_LIVE_SQL}, counted AS (SELECT billing_period, execution_id, count(*) AS n FROM billing GROUP BY ALL),
    first AS (SELECT c.billing_period, c.execution_id, c.n, c.execution_id = l.execution_id AS keep
        FROM counted c JOIN live l USING (billing_period))
    SELECT 1 AS attempt, billing_period, execution_id, CASE WHEN keep THEN n ELSE 0 END AS rows_loaded,
        CASE WHEN keep THEN 'success' ELSE 'superseded' END AS status FROM first
    UNION ALL SELECT 2, billing_period, execution_id, 0, CASE WHEN keep THEN 'skipped' ELSE 'superseded' END FROM first""",
    name="load_deliveries",
)
def delivery_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All staged deliveries loaded twice; the second time there is nothing to do."""
    _, parts, table = _staged_load(spark, sf_dir)
    manifests = part_manifests(parts)
    attempts = []
    for attempt in (1, 2):
        results = load_deliveries(spark, manifests, parts, table).results
        attempts.append(
            results.select(F.lit(attempt).alias("attempt"), *DELIVERY, "rows_loaded", "status")
        )
    return attempts[0].unionByName(attempts[1])


@checked(
    f"""WITH {_LIVE_SQL} SELECT billing_period, execution_id,
        CASE WHEN bool_or(l_linenumber = 1 AND billing_period LIKE '%-03') THEN 'failed' ELSE 'success' END AS status,
        CASE WHEN bool_or(l_linenumber = 1 AND billing_period LIKE '%-03') THEN 0 ELSE count(*) END AS rows_loaded,
        CASE WHEN bool_or(l_linenumber = 1 AND billing_period LIKE '%-03')
            THEN CAST(count(*) FILTER (l_linenumber = 1) AS VARCHAR) END AS faulty_rows
    FROM billing JOIN live USING (billing_period, execution_id) GROUP BY ALL"""
)
def load_bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third month of a year has costs that are no numbers: only those deliveries fail, with their faulty rows."""
    staging = work_folder(spark, "staging")
    bad = (F.col("l_linenumber") == 1) & F.col("billing_period").endswith("-03")
    cost = F.when(bad, "n/a").otherwise(F.col("line_item_unblended_cost").cast("string"))
    write_parts(billing_items(spark, sf_dir).withColumn("line_item_unblended_cost", cost), BILLING_NAMES, staging)
    parts = staged_parts(spark, staging)
    table = BillingTable(spark, work_folder(spark, "table"))
    results = load_deliveries(spark, part_manifests(parts), parts, table).results.where("status <> 'superseded'")
    faulty = F.nullif(F.regexp_extract("error", r"^(\d+) rows or files at fault", 1), F.lit(""))
    return results.select(*DELIVERY, "status", "rows_loaded", faulty.alias("faulty_rows"))


@checked(
    f"""WITH {_LIVE_SQL}, given AS (SELECT DISTINCT billing_period, execution_id FROM billing)
    SELECT attempt, g.billing_period || ':' || g.execution_id AS delivery,
        CASE WHEN g.execution_id = l.execution_id THEN 'loaded' ELSE 'discovered' END AS state,
        CAST(CASE WHEN g.execution_id = l.execution_id THEN 4 ELSE 1 END AS BIGINT) AS events, CAST(0 AS BIGINT) AS illegal_steps
    FROM given g JOIN live l USING (billing_period) CROSS JOIN (VALUES (1), (2)) AS attempts(attempt)"""
)
def ledger_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of all deliveries from the events that two loads of them wrote, the second one with overwrite."""
    _, parts, table = _staged_load(spark, sf_dir)
    manifests = part_manifests(parts)
    for overwrite in (False, True):
        load_deliveries(spark, manifests, parts, table, overwrite=overwrite)
    states = delivery_states(read_events(spark, table.events))
    first = Window.partitionBy(F.substring_index("delivery", ":", 2)).orderBy("began", "delivery")
    began = read_events(spark, table.events).groupBy("delivery").agg(F.min("event_time").alias("began"))
    return states.join(began, "delivery").select(
        F.row_number().over(first).alias("attempt"),
        F.substring_index("delivery", ":", 2).alias("delivery"),
        "state",
        "events",
        "illegal_steps",
    )


@checked(
    f"""WITH {_LIVE_SQL} SELECT {ROW_NAMES.replace(TAG_NAME, f"CASE WHEN execution_id <> 'exec-2' THEN {TAG_NAME} END AS {TAG_NAME}")}
    FROM billing JOIN live USING (billing_period, execution_id)"""
)
def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all loaded parts with their delivery's tag; columns a part lacks are NULL."""
    _, parts, table = _staged_load(spark, sf_dir)
    load_deliveries(spark, part_manifests(parts), parts, table)
    return table.rows()


@checked(f"WITH {BILLING_SQL} {ROWS_SQL}")
def export_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months exported and read back."""
    table, out = given_table(spark, sf_dir), work_folder(spark, "exports")
    export_periods(spark, table, periods(table.rows()), out)
    return read_export(spark, export_root(out, "period"), table.schema())


@checked(f"WITH {BILLING_SQL} {ROWS_SQL} WHERE billing_period = '1996-03' AND execution_id = 'exec-1'")
def export_execution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery exported and read back."""
    table, out = given_table(spark, sf_dir), work_folder(spark, "exports")
    wanted = loaded_pairs(table.rows()).where("billing_period = '1996-03' AND execution_id = 'exec-1'")
    export_deliveries(spark, table, wanted, out)
    return read_export(spark, export_root(out, "execution"), table.schema())


@checked(f"WITH {BILLING_SQL} {ROWS_SQL}")
def export_all_executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivery exported and read back."""
    table, out = given_table(spark, sf_dir), work_folder(spark, "exports")
    export_deliveries(spark, table, loaded_pairs(table.rows()), out)
    return read_export(spark, export_root(out, "execution"), table.schema())


def _disorder(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of each file and those that come before their predecessor in key order."""
    # Names are unique inside a month's folder, and each row carries its own through the shuffle: the path is far longer.
    read = rows.withColumn("file", F.col("_metadata.file_name")).withColumn("place", F.col("_metadata.row_index"))
    key = F.struct(*keys)
    in_file = Window.partitionBy("billing_period", "file").orderBy("place")
    steps = read.withColumn("back", F.coalesce(F.lag(key).over(in_file) > key, F.lit(False)))
    return steps.groupBy("billing_period").agg(
        F.count("*").alias("rows"), F.count_if("back").alias("out_of_order")
    )


@checked(f"WITH {BILLING_SQL} SELECT billing_period, count(*) AS rows, CAST(0 AS BIGINT) AS out_of_order FROM billing GROUP BY 1")
def export_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported rows follow the sort keys inside every file."""
    table, out = given_table(spark, sf_dir), work_folder(spark, "exports")
    export_periods(spark, table, periods(table.rows()), out)
    return _disorder(read_export(spark, export_root(out, "period"), table.schema()), SORT_KEYS)


@checked(
    f"""WITH {BILLING_SQL} SELECT codec, billing_period, {SUMS_SQL} FROM billing
    CROSS JOIN (VALUES ('snappy'), ('gzip'), ('lz4'), ('zstd')) AS codecs(codec) GROUP BY ALL"""
)
def export_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months exported with each codec and summed from the files."""
    table = given_table(spark, sf_dir)
    months = periods(table.rows())
    read = None
    for codec in CODECS:
        out = work_folder(spark, f"exports-{codec}")
        export_periods(spark, table, months, out, compression=codec)
        rows = read_export(spark, export_root(out, "period"), table.schema()).withColumn("codec", F.lit(codec))
        read = rows if read is None else read.unionByName(rows)
    return _sums(read, "codec", "billing_period")


@checked(
    f"""WITH {BILLING_SQL}, months AS (SELECT DISTINCT billing_period FROM billing)
    SELECT 1 AS attempt, billing_period, 'exported' AS status FROM months WHERE billing_period <= '1998-06'
    UNION ALL SELECT 2, billing_period, CASE WHEN billing_period <= '1998-06' THEN 'skipped' ELSE 'exported' END FROM months
    UNION ALL SELECT 3, billing_period, 'exported' FROM months
    UNION ALL SELECT 4, '2099-01', 'failed'"""
)
def export_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some months, then all, then all with overwrite, then one that has no data."""
    table, out = given_table(spark, sf_dir), work_folder(spark, "exports")
    months = periods(table.rows())
    missing = months.limit(1).select(F.lit("2099-01").alias("billing_period"))
    wanted = [(months.where("billing_period <= '1998-06'"), False), (months, False), (months, True), (missing, False)]
    attempts = None
    for attempt, (chosen, overwrite) in enumerate(wanted, 1):
        done = export_periods(spark, table, chosen, out, overwrite=overwrite)
        rows = done.select(F.lit(attempt).alias("attempt"), "billing_period", "status")
        attempts = rows if attempts is None else attempts.unionByName(rows)
    return attempts


@checked(
    f"""WITH {BILLING_SQL} SELECT DISTINCT billing_period, execution_id, billing_period <= '1998-06' AS exported FROM billing"""
)
def export_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries that have an export and those that have none."""
    table, out = given_table(spark, sf_dir), work_folder(spark, "exports")
    pairs = loaded_pairs(table.rows())
    export_deliveries(spark, table, pairs.where("billing_period <= '1998-06'"), out)
    return export_status(pairs, exported_files(spark, export_root(out, "execution")), DELIVERY)


@checked(f"WITH {BILLING_SQL} SELECT DISTINCT billing_period FROM billing", name="export_periods")
def exported_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months found in the export folders."""
    table, out = given_table(spark, sf_dir), work_folder(spark, "exports")
    export_deliveries(spark, table, loaded_pairs(table.rows()), out)
    return available_periods(exported_files(spark, export_root(out, "execution")))


@checked(
    f"""WITH {BILLING_SQL}, names(normalized_name, table_type) AS (VALUES
        ('bill_billing_period_start_date', 'TIMESTAMP'), ('bill_billing_period_end_date', 'TIMESTAMP'),
        ('line_item_usage_start_date', 'TIMESTAMP'), ('line_item_usage_account_id', 'VARCHAR'),
        ('line_item_product_code', 'VARCHAR'), ('line_item_unblended_cost', 'DECIMAL(18,2)'),
        ('resource_tags_user_part_type', 'VARCHAR'), ('execution_id', 'VARCHAR'))
    SELECT normalized_name, table_type, (SELECT count(*) FROM billing) AS filled FROM names"""
)
def parquet_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export read under the schema of its first file."""
    table, out = given_table(spark, sf_dir), work_folder(spark, "exports")
    export_periods(spark, table, periods(table.rows()), out)
    root = export_root(out, "period")
    rows = spark.read.schema(first_file_schema(spark, root)).parquet(root)
    return _filled(rows.drop("billing_period"))


@checked(f"WITH {BILLING_SQL} {ROWS_SQL} WHERE billing_period <> '1996-03' OR execution_id = 'exec-2'")
def publish_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months published, then one month replaced by a later export of it."""
    table, out = given_table(spark, sf_dir), work_folder(spark, "exports")
    warehouse = BillingTable(spark, work_folder(spark, "warehouse"))
    months = periods(billed_orders(spark, sf_dir))
    export_periods(spark, table, months, out)
    publish_periods(spark, months, out, warehouse)
    table.replace(billing_rows(spark, sf_dir).where("billing_period = '1996-03' AND execution_id = 'exec-2'"))
    march = months.where("billing_period = '1996-03'")
    export_periods(spark, table, march, out, overwrite=True)
    publish_periods(spark, march, out, warehouse)
    return warehouse.rows()


@checked(
    f"""WITH {_LIVE_SQL}
    SELECT 1 AS attempt, billing_period, execution_id, 'loaded' AS status FROM live
    UNION ALL SELECT 2, billing_period, execution_id, 'skipped' FROM live
    UNION ALL SELECT 3, billing_period, execution_id, 'loaded' FROM live"""
)
def publish_execution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live deliveries published, skipped as they are there, and published again on demand."""
    table, out = given_table(spark, sf_dir), work_folder(spark, "exports")
    warehouse = BillingTable(spark, work_folder(spark, "warehouse"))
    live = table.rows().groupBy("billing_period").agg(F.max("execution_id").alias("execution_id"))
    export_deliveries(spark, table, live, out)
    attempts = None
    for attempt, overwrite in enumerate((False, False, True), 1):
        done = publish_deliveries(spark, live, out, warehouse, overwrite=overwrite)
        rows = done.select(F.lit(attempt).alias("attempt"), *DELIVERY, "status")
        attempts = rows if attempts is None else attempts.unionByName(rows)
    return attempts


@checked(f"WITH {BILLING_SQL} SELECT billing_period, count(*) AS rows, CAST(0 AS BIGINT) AS out_of_order FROM billing GROUP BY 1")
def publish_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse is partitioned by month and clustered on usage start inside every file."""
    table, out = given_table(spark, sf_dir), work_folder(spark, "exports")
    warehouse = BillingTable(spark, work_folder(spark, "warehouse"))
    months = periods(table.rows())
    export_periods(spark, table, months, out)
    publish_periods(spark, months, out, warehouse)
    return _disorder(warehouse.rows(), ["line_item_usage_start_date"])


_LEDGER_SQL = """SELECT strftime(o_orderdate, '%Y-%m') AS billing_period, 'exec-' || o_orderkey AS execution_id,
    o_orderdate + to_seconds(o_orderkey) AS load_timestamp, o_orderkey AS row_count,
    CASE o_orderstatus WHEN 'F' THEN 'loaded' WHEN 'O' THEN 'loading' ELSE 'failed' END AS state,
    CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS error_message FROM orders"""


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger entry per order, appended in one write per order status."""
    state = F.col("o_orderstatus")
    entries = given(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("billing_period"),
        F.concat(F.lit("exec-"), F.col("o_orderkey").cast("string")).alias("execution_id"),
        F.timestamp_add("SECOND", F.col("o_orderkey"), F.col("o_orderdate")).alias("load_timestamp"),
        F.col("o_orderkey").alias("row_count"),
        F.when(state == "F", "loaded").when(state == "O", "loading").otherwise("failed").alias("state"),
        F.when(state == "P", F.col("o_orderpriority")).alias("error_message"),
    )
    path = work_folder(spark, "ledger")
    for name in ("loading", "loaded", "failed"):
        append_ledger(entries.where(F.col("state") == name), path)
    return read_ledger(spark, path)


_CURRENT_SQL = f"""SELECT * FROM ({_LEDGER_SQL})
    QUALIFY row_number() OVER (PARTITION BY billing_period ORDER BY load_timestamp DESC, execution_id DESC) = 1"""


@checked(_CURRENT_SQL)
def loads_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current load of each month after all entries."""
    return current_loads(_ledger(spark, sf_dir))


@checked(f"SELECT * FROM ({_CURRENT_SQL}) WHERE state = 'loaded'")
def ledger_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months whose current load is complete."""
    return loaded_periods(_ledger(spark, sf_dir))


@checked(
    """WITH states AS (SELECT user_id AS delivery, ts, event_id, CASE event_type WHEN 'view' THEN 'discovered'
        WHEN 'click' THEN 'staging' WHEN 'signup' THEN 'loading' WHEN 'purchase' THEN 'loaded' ELSE 'failed' END AS state
        FROM events),
    steps AS (SELECT *, coalesce(lag(state) OVER (PARTITION BY delivery ORDER BY ts, event_id), '') AS prior,
        row_number() OVER (PARTITION BY delivery ORDER BY ts DESC, event_id DESC) AS back FROM states)
    SELECT delivery, max(state) FILTER (back = 1) AS state, count(*) AS events,
        count(*) FILTER (prior || '>' || state NOT IN ('>discovered', 'discovered>staging', 'staging>loading',
            'loading>loaded', 'discovered>failed', 'staging>failed', 'loading>failed')) AS illegal_steps
    FROM steps GROUP BY delivery"""
)
def delivery_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest state and illegal steps of each user's events taken as one delivery."""
    states = {"view": "discovered", "click": "staging", "signup": "loading", "purchase": "loaded", "error": "failed"}
    named = F.create_map(*[F.lit(x) for pair in states.items() for x in pair])
    events = given(spark, sf_dir, "events").select(
        F.col("user_id").alias("delivery"),
        F.col("ts").alias("event_time"),
        "event_id",
        F.element_at(named, F.col("event_type")).alias("state"),
    )
    return delivery_states(events)


@checked(
    f"""WITH {_LIVE_SQL} SELECT billing_period, execution_id, {SUMS_SQL},
        count(CASE WHEN execution_id <> 'exec-2' THEN {TAG_NAME} END) AS tagged
    FROM billing JOIN live USING (billing_period, execution_id) GROUP BY ALL"""
)
def whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discover, load, export and publish everything; sums of the warehouse's deliveries."""
    staging, parts, _ = _staged_load(spark, sf_dir)
    store = work_folder(spark, "store")
    write_manifests(manifest_json(part_manifests(parts)), store, "v2")
    folders = [work_folder(spark, name) for name in ("table", "exports", "warehouse")]
    places = Places(store, PREFIX, EXPORT, "v2", staging, *folders)
    run(spark, places)
    rows = BillingTable(spark, places.warehouse).rows()
    cost = F.sum("line_item_unblended_cost").cast("decimal(38,2)")
    return rows.groupBy(*DELIVERY).agg(
        F.count("*").alias("rows"), cost.alias("cost"), F.count(TAG_NAME).alias("tagged")
    )

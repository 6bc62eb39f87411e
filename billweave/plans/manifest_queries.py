"""Queries on manifests, staged parts and their completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.operators.columns import column_defs
from billweave.operators.completeness import delivery_completeness, extract_stats
from billweave.operators.state import (
    DELIVERY,
    already_in,
    choose_deliveries,
    load_stats,
    loaded_map,
    loaded_pairs,
    not_in,
    run_plan,
    status_rollup,
)
from billweave.functions.periods import in_range
from billweave.plans.given import (
    BILLING_NAMES,
    BILLING_SQL,
    COLUMNS_SQL,
    EXPORT,
    PREFIX,
    base_columns,
    billing_items,
    billed_orders,
    delivery_manifests,
    given,
    manifest_json,
    stage_csv,
    write_manifests,
)
from billweave.plans.registry import checked
from billweave.session import work_folder
from billweave.sources import manifests as M
from billweave.sources.csv_parts import distinct_headers, map_headers, read_headers, scan_groups, scan_parts
from billweave.sources.listing import staged_deliveries, staged_parts
from billweave.operators.columns import table_schema

FILES_SQL = f"""{BILLING_SQL},
files AS (
    SELECT DISTINCT billing_period, execution_id, 'part-' || l_linenumber || '.csv.gz' AS file_name FROM billing
),
counted AS (SELECT billing_period, execution_id, count(*) AS file_count FROM files GROUP BY ALL)"""


@checked(
    f"""WITH {COLUMNS_SQL},
    files AS (SELECT billing_period, execution_id, count(DISTINCT l_linenumber) AS file_count FROM billing GROUP BY ALL),
    live AS (SELECT billing_period, max(execution_id) AS execution_id FROM files GROUP BY 1),
    wide AS (SELECT billing_period, execution_id, count(*) AS column_count FROM declared GROUP BY ALL)
    SELECT version, billing_period, execution_id, file_count, column_count, 'GZIP' AS compression
    FROM live JOIN files USING (billing_period, execution_id) JOIN wide USING (billing_period, execution_id)
    CROSS JOIN (VALUES ('v1'), ('v2')) AS versions(version)"""
)
def manifest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest files of both layouts, written and found again; archived ones do not match."""
    texts = manifest_json(delivery_manifests(spark, sf_dir))
    found = []
    for version in ("v1", "v2"):
        store = work_folder(spark, "store")
        write_manifests(texts, store, version)
        good, _ = M.scan_manifests(spark, store, PREFIX, EXPORT, version)
        found.append(good)
    return found[0].unionByName(found[1]).select(
        "version",
        "billing_period",
        "execution_id",
        F.size("files").cast("bigint").alias("file_count"),
        F.size("columns").cast("bigint").alias("column_count"),
        "compression",
    )


@checked(
    f"""WITH {FILES_SQL}, live AS (SELECT billing_period, max(execution_id) AS execution_id FROM counted GROUP BY 1)
    SELECT billing_period, 'v1' AS version, file_count, execution_id
    FROM live JOIN counted USING (billing_period, execution_id)"""
)
def manifest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of the manifests found in the v1 layout, newest month first."""
    store = work_folder(spark, "store")
    write_manifests(manifest_json(delivery_manifests(spark, sf_dir)), store, "v1")
    good, _ = M.scan_manifests(spark, store, PREFIX, EXPORT, "v1")
    summary = M.manifest_summary(good).withColumn("file_count", F.col("file_count").cast("bigint"))
    return summary.drop("manifest_path")


@checked(
    """SELECT CAST(event_id AS BIGINT) AS event_id,
        CASE WHEN event_type <> 'error' THEN 'run-' || user_id END AS execution_id,
        CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m') END AS billing_period,
        CASE WHEN event_type IN ('error', 'signup') THEN 0 ELSE 2 END AS file_count,
        CASE WHEN event_type IN ('view', 'click') THEN 'ZIP' ELSE 'GZIP' END AS compression,
        CASE WHEN event_type = 'error' THEN 'bad JSON' ELSE 'manifest' END AS outcome
    FROM events""",
    name="manifest_json",
)
def manifest_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest text per event, parsed: broken ones, ones without files and without compression."""
    kind = F.col("event_type")
    period = F.struct(F.date_format("ts", "yyyyMMdd'T'HHmmss.SSS'Z'").alias("start"))
    keys = F.array(F.concat_ws("/", kind, F.lit("a.csv.gz")), F.concat_ws("/", kind, F.lit("b.csv.gz")))
    record = F.struct(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("executionId"),
        period.alias("billingPeriod"),
        F.when(kind != "signup", keys).alias("reportKeys"),
        F.when(kind.isin("view", "click"), "ZIP").alias("compression"),
        F.col("props").alias("note"),
    )
    text = F.when(kind == "error", F.concat(F.lit('{"executionId": "run-'), "props")).otherwise(F.to_json(record))
    parsed = given(spark, sf_dir, "events").select("event_id", M.parse_manifest_text(text).alias("m"))
    raw = parsed.select("m.*", F.col("event_id").cast("string").alias("manifest_path"))
    good, rejects = M.split_manifests(M.parse_manifests(raw, "v2"))
    found = good.select(
        F.col("manifest_path").cast("bigint").alias("event_id"),
        "execution_id",
        "billing_period",
        F.size("files").alias("file_count"),
        "compression",
        F.lit("manifest").alias("outcome"),
    )
    bad = rejects.select(
        F.col("manifest_path").cast("bigint").alias("event_id"),
        F.lit(None).cast("string").alias("execution_id"),
        F.lit(None).cast("string").alias("billing_period"),
        F.lit(0).alias("file_count"),
        F.lit(M.DEFAULT_COMPRESSION).alias("compression"),
        F.col("reason").alias("outcome"),
    )
    return found.unionByName(bad)


@checked(
    """SELECT 'v1' AS version, 'assembly-' || user_id AS execution_id, count(*) AS manifests FROM events GROUP BY 2
    UNION ALL SELECT 'v2', 'execution-' || event_type, count(*) FROM events GROUP BY 2""",
    name="manifest_id",
)
def manifest_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The field that names a delivery in each version."""
    raw = given(spark, sf_dir, "events").select(
        F.concat(F.lit("assembly-"), F.col("user_id").cast("string")).alias("assemblyId"),
        F.concat(F.lit("execution-"), "event_type").alias("executionId"),
    )
    named = [
        raw.select(F.lit(version).alias("version"), M.manifest_id(version).alias("execution_id"))
        for version in ("v1", "v2")
    ]
    return named[0].unionByName(named[1]).groupBy("version", "execution_id").agg(F.count("*").alias("manifests"))


@checked(
    f"""WITH {FILES_SQL} SELECT billing_period, execution_id, 'GZIP' AS compression,
        billing_period || '/' || execution_id || '/' || file_name AS file_key, file_name FROM files"""
)
def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.manifest_files(delivery_manifests(spark, sf_dir))


@checked(
    f"""WITH {COLUMNS_SQL} SELECT billing_period, execution_id, CAST(pos AS BIGINT) AS pos, category, name, source_type,
        category || '/' || name AS original_name FROM declared"""
)
def manifest_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = M.manifest_columns(delivery_manifests(spark, sf_dir))
    return columns.withColumn("pos", F.col("pos").cast("bigint"))


_PRESENT_SQL = f"""{FILES_SQL},
present AS (
    SELECT DISTINCT billing_period, execution_id, 'part-' || l_linenumber || '.csv.gz' AS file_name, 1 AS here
    FROM billing WHERE l_linestatus = 'F'
),
complete AS (
    SELECT billing_period, execution_id, count(*) AS expected_files, count(here) AS present_files,
           count(*) = count(here) AS complete
    FROM files LEFT JOIN present USING (billing_period, execution_id, file_name) GROUP BY ALL
)"""


def _completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries whose files are present where they hold a finished line item."""
    items = billing_items(spark, sf_dir)
    name = F.concat(F.lit("part-"), F.col("l_linenumber").cast("string"), F.lit(".csv.gz")).alias("file_name")
    files = items.select(*DELIVERY, name).distinct()
    parts = items.where("l_linestatus = 'F'").select(*DELIVERY, name)
    return delivery_completeness(files, parts)


@checked(f"WITH {_PRESENT_SQL} SELECT * FROM complete", name="delivery_completeness")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _completeness(spark, sf_dir)


@checked(
    f"""WITH {_PRESENT_SQL} SELECT count(*) AS manifests_processed, CAST(sum(present_files) AS BIGINT) AS files_present,
        CAST(sum(expected_files - present_files) + count(*) FILTER (expected_files <> present_files) AS BIGINT) AS errors
    FROM complete""",
    name="extract_stats",
)
def extract_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_stats(_completeness(spark, sf_dir))


@checked(f"WITH {BILLING_SQL} SELECT DISTINCT billing_period, execution_id FROM billing")
def staged_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries found in the staging folder after staging all rows."""
    staging = work_folder(spark, "staging")
    stage_csv(spark, sf_dir, staging)
    return staged_deliveries(staged_parts(spark, staging))


@checked(
    f"""WITH {BILLING_SQL}, pairs AS (SELECT DISTINCT billing_period, execution_id FROM billing),
    staged AS (SELECT DISTINCT billing_period, execution_id FROM billing WHERE p_name LIKE 'red%')
    SELECT pairs.*, CASE WHEN staged.execution_id IS NULL THEN 'take' ELSE 'skip' END AS action
    FROM pairs LEFT JOIN staged USING (billing_period, execution_id)"""
)
def staged_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries to take and to skip, where those that bill a red part are staged."""
    items = billing_items(spark, sf_dir)
    listed = items.select(*DELIVERY).distinct()
    staged = items.where(F.col("p_name").startswith("red")).select(*DELIVERY).distinct()
    take = not_in(listed, staged).withColumn("action", F.lit("take"))
    return take.unionByName(already_in(listed, staged).withColumn("action", F.lit("skip")))


@checked(
    f"""WITH {BILLING_SQL}, heads AS (
        SELECT DISTINCT billing_period, execution_id FROM billing
    ), names(i, original_name, normalized_name, table_type) AS (VALUES
        (0, 'bill/BillingPeriodStartDate', 'bill_billing_period_start_date', 'TIMESTAMP'),
        (1, 'bill/BillingPeriodEndDate', 'bill_billing_period_end_date', 'TIMESTAMP'),
        (2, 'lineItem/UsageStartDate', 'line_item_usage_start_date', 'TIMESTAMP'),
        (3, 'lineItem/UsageAccountId', 'line_item_usage_account_id', 'VARCHAR'),
        (4, 'lineItem/ProductCode', 'line_item_product_code', 'VARCHAR'),
        (5, 'lineItem/UnblendedCost', 'line_item_unblended_cost', 'DECIMAL(18,2)'),
        (6, 'resourceTags/user:PartType', 'resource_tags_user_part_type', 'VARCHAR'))
    SELECT billing_period, execution_id, CAST(CASE WHEN execution_id = 'exec-1' THEN 6 - i ELSE i END AS BIGINT) AS pos,
        original_name, normalized_name, table_type, true AS declared
    FROM heads CROSS JOIN names WHERE NOT (execution_id = 'exec-2' AND i = 6)"""
)
def csv_header_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of all staged parts, mapped to table columns by original name."""
    staging = work_folder(spark, "staging")
    stage_csv(spark, sf_dir, staging)
    parts = staged_parts(spark, staging)
    manifests = parts.select(*DELIVERY).distinct().withColumn("columns", base_columns())
    mapped = map_headers(distinct_headers(read_headers(parts)), column_defs(manifests))
    return mapped.select(
        *DELIVERY, F.col("pos").cast("bigint").alias("pos"), "original_name", "normalized_name", "table_type", "declared"
    )


@checked(
    f"""WITH {BILLING_SQL} SELECT billing_period, execution_id, bill_billing_period_start_date,
        bill_billing_period_end_date, line_item_usage_start_date, line_item_usage_account_id, line_item_product_code,
        line_item_unblended_cost,
        CASE WHEN execution_id <> 'exec-2' THEN resource_tags_user_part_type END AS resource_tags_user_part_type
    FROM billing"""
)
def typed_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All billing rows written as CSV parts with three kinds of header, and scanned again typed."""
    staging = work_folder(spark, "staging")
    stage_csv(spark, sf_dir, staging)
    parts = staged_parts(spark, staging)
    defs = column_defs(parts.select(*DELIVERY).distinct().withColumn("columns", base_columns()))
    headers = distinct_headers(read_headers(parts))
    first = defs.dropDuplicates(["normalized_name"]).orderBy("pos").collect()
    rows = scan_parts(spark, scan_groups(headers, map_headers(headers, defs)), table_schema(first))
    return rows.select(*DELIVERY, *BILLING_NAMES)


_LOADED_SQL = f"""{BILLING_SQL},
pairs AS (SELECT DISTINCT billing_period, execution_id FROM billing),
live AS (SELECT billing_period, max(execution_id) AS execution_id FROM pairs GROUP BY 1)"""


@checked(f"WITH {BILLING_SQL} SELECT DISTINCT billing_period, execution_id FROM billing", name="loaded_pairs")
def loaded_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_pairs(billed_orders(spark, sf_dir))


@checked(f"WITH {_LOADED_SQL} SELECT * FROM live", name="loaded_map")
def loaded_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live delivery of each month."""
    return loaded_map(billed_orders(spark, sf_dir))


@checked(
    f"""WITH {_LOADED_SQL} SELECT billing_period, execution_id FROM pairs
    WHERE billing_period BETWEEN '1996-01' AND '1997-06' AND (billing_period, execution_id) NOT IN (SELECT * FROM live)"""
)
def new_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries in a month range that are not the live one of their month."""
    rows = billed_orders(spark, sf_dir)
    listed = loaded_pairs(rows).where(in_range(F.col("billing_period"), "1996-01", "1997-06"))
    return not_in(listed, loaded_map(rows))


@checked(
    f"""WITH {BILLING_SQL}, pairs AS (SELECT DISTINCT billing_period, execution_id FROM billing),
    loaded AS (SELECT DISTINCT billing_period, execution_id FROM billing WHERE l_linestatus = 'F' AND p_size = 50)
    SELECT pairs.* FROM pairs LEFT JOIN loaded l USING (billing_period, execution_id) WHERE l.execution_id IS NULL"""
)
def new_deliveries_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries of which the table holds no row at all."""
    items = billing_items(spark, sf_dir)
    loaded = items.where("l_linestatus = 'F' AND p_size = 50")
    return not_in(items.select(*DELIVERY).distinct(), loaded_pairs(loaded))


@checked(
    f"""WITH {_LOADED_SQL} SELECT pairs.billing_period, pairs.execution_id,
        pairs.execution_id = live.execution_id AS keep
    FROM pairs JOIN live USING (billing_period)"""
)
def superseded_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention plan: which delivery of each month to keep."""
    return choose_deliveries(loaded_pairs(billed_orders(spark, sf_dir)), F.col("execution_id"))


@checked(
    f"""WITH {_LOADED_SQL} SELECT billing_period, count(*) AS deliveries FROM pairs
    WHERE (billing_period, execution_id) NOT IN (SELECT * FROM live) AND billing_period >= '1998-01' GROUP BY 1""",
    name="run_plan",
)
def dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run from 1998-01 on would process."""
    rows = billed_orders(spark, sf_dir)
    pending = not_in(loaded_pairs(rows).where(in_range(F.col("billing_period"), "1998-01")), loaded_map(rows))
    return run_plan(pending)


_STATUS_SQL = """SELECT CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'skipped' ELSE 'failed' END AS status,
    o_orderkey FROM orders"""


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load result per order: its status from the order's, its row count from the order's key."""
    state = F.col("o_orderstatus")
    status = F.when(state == "F", "success").when(state == "O", "skipped").otherwise("failed")
    return given(spark, sf_dir, "orders").select(status.alias("status"), F.col("o_orderkey").alias("rows_loaded"))


@checked(f"SELECT status, count(*) AS deliveries FROM ({_STATUS_SQL}) GROUP BY 1", name="status_rollup")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_rollup(_results(spark, sf_dir))


@checked(
    f"""SELECT count(*) AS total_executions, count(*) FILTER (status = 'success') AS loaded_executions,
        count(*) FILTER (status = 'failed') AS failed_executions,
        CAST(sum(o_orderkey) FILTER (status = 'success') AS BIGINT) AS total_rows FROM ({_STATUS_SQL})""",
    name="load_stats",
)
def load_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_stats(_results(spark, sf_dir))

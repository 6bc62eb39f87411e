"""Steps whose work a row or a task once grew with paths, dates or single tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from billweave.operators.export import export_periods, export_root, read_export
from billweave.plans import given, table_queries
from billweave.sources import listing
from billweave.sources.csv_parts import typed_scan
from billweave.sources.listing import exported_files, partition_count
from test_export_publish import frame, loaded  # noqa: F401

SF_DIR = "/root/testdata/sf0.001"


def plan(rows) -> str:
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_scan_decodes_only_the_end_of_a_path(spark, tmp_path):
    folder = tmp_path / "50%+ done" / "billing_period=2024-01" / "execution_id=e%3A1+%25"
    folder.mkdir(parents=True)
    (folder / "part-1.csv").write_text("a\nx\n")
    read = typed_scan(spark, ["a"], ["VARCHAR"], [str(folder / "part-1.csv")])
    assert [tuple(r) for r in read.collect()] == [("2024-01", "e:1+%", "x")]
    assert "substring_index(" in plan(read)


def test_only_escaped_paths_are_decoded(spark):
    paths = spark.createDataFrame([("/a+b/c d",), ("/a%2Bb+c%25",), (None,)], "path string")
    found = paths.select(listing.unescaped(F.col("path"))).collect()
    assert [r[0] for r in found] == ["/a+b/c d", "/a+b+c%", None]


def test_months_are_derived_before_the_join(spark):
    lines = plan(given.billing_rows(spark, SF_DIR)).splitlines()
    joined = next(k for k, line in enumerate(lines) if "Join Inner" in line)
    assert not any("date_format" in line or "gettimestamp" in line for line in lines[:joined])
    assert any("date_format" in line for line in lines[joined:])


def test_an_export_below_the_advisory_size_keeps_several_tasks_at_work(spark, loaded):  # noqa: F811
    start = F.to_timestamp_ntz(F.lit("2024-01-01"))
    loaded.table.replace(
        spark.range(20_000).select(
            F.lit("e1").alias("execution_id"),
            F.sha2(F.col("id").cast("string"), 256).alias("identity_line_item_id"),
            start.alias("bill_billing_period_start_date"),
            start.alias("line_item_usage_start_date"),
            F.lit("2024-01").alias("billing_period"),
        )
    )
    out, least = loaded.folder("exports"), "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(least, "64k")
    try:
        export_periods(spark, loaded.table, frame(spark, ("2024-01",)), out)
    finally:
        spark.conf.unset(least)
    assert exported_files(spark, export_root(out, "period")).count() >= 3
    back = read_export(spark, export_root(out, "period"), loaded.table.schema())
    assert back.select("identity_line_item_id").distinct().count() == 20_000


def test_a_large_export_has_as_many_ranges_as_its_bytes_ask_for(spark):
    files = spark.createDataFrame([("2024-01", 40 << 20), ("2024-02", 1 << 40)], "billing_period string, length long")
    assert partition_count(files, ["2024-01"]) == 10
    assert partition_count(files.withColumn("length", F.lit(5)), ["2024-01"]) is None


def test_order_check_moves_no_paths(spark, loaded):  # noqa: F811
    rows = table_queries._disorder(loaded.table.rows(), ["line_item_usage_start_date"])
    assert "file_path" not in plan(rows)
    assert {tuple(r) for r in rows.collect()} == {("2024-01", 2, 0), ("2024-02", 1, 0)}

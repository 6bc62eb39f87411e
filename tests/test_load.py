from __future__ import annotations

import datetime
import shutil
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from billweave.operators.columns import column_defs
from billweave.operators.ledger import current_loads, read_ledger, record_loads
from billweave.operators import load as load_module
from billweave.operators.load import load_deliveries
from billweave.operators.table import BillingTable
from billweave.sources.csv_parts import distinct_headers, map_headers, read_headers, scan_groups
from billweave.sources.listing import staged_parts
from billweave.sources.manifests import scan_manifests
from cloud_store import BASE, csv_text, rows

TAG = ("resourceTags", "user:Team", "String")


def load(cloud, **options):
    manifests, _ = scan_manifests(cloud.spark, cloud.folder("store"), cloud.prefix, cloud.export, cloud.version)
    return load_deliveries(cloud.spark, manifests, staged_parts(cloud.spark, cloud.folder("staging")), cloud.table, **options)


def outcome(report):
    return {r.billing_period: (r.status, r.rows_loaded) for r in report.results.collect()}


def ids(cloud):
    return rows(cloud.table.rows(), "billing_period", "execution_id", "identity_line_item_id")


def test_plain_and_gzip_parts_with_hard_values(cloud):
    head = ",".join(f"{c}/{n}" for c, n, _ in BASE)
    first = head + "\n" + '"say ""hi"", you",2024-01-01T00:00:00Z,,2024-01-05 06:07:08,"",two,1.005\n'
    second = head + "\n" + '"two\nlines",2024-01-01T00:00:00Z,,,,"",-1.005\nlast,2024-01-01T00:00:00Z,,,,,1E-7\n'
    cloud.part("2024-01", "e", "a.csv", first)
    cloud.part("2024-01", "e", "b.csv.gz", second)
    cloud.manifest("2024-01", "e", ["a.csv", "b.csv.gz"])
    assert outcome(load(cloud)) == {"2024-01": ("success", 3)}
    got = {r.identity_line_item_id: r for r in cloud.table.rows().collect()}
    assert set(got) == {'say "hi", you', "two\nlines", "last"}
    assert [got[k].line_item_unblended_cost for k in ('say "hi", you', "two\nlines", "last")] == [
        Decimal("1.01"), Decimal("-1.01"), Decimal("0.00")
    ]
    row = got['say "hi", you']
    assert row.line_item_usage_start_date == datetime.datetime(2024, 1, 5, 6, 7, 8)
    assert row.bill_billing_period_end_date is None and row.line_item_usage_account_id is None
    assert row.execution_id == "e"


def test_times_do_not_depend_on_the_session_zone(cloud):
    cloud.delivery("2024-01", "e", ["a"])
    cloud.spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert outcome(load(cloud)) == {"2024-01": ("success", 1)}
        text = cloud.table.rows().select(F.col("bill_billing_period_start_date").cast("string")).first()[0]
        assert text == "2024-01-01 00:00:00"
    finally:
        cloud.spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parts_may_differ_in_column_order_and_set(cloud):
    cloud.part("2024-01", "e", "a.csv", csv_text("2024-01", ["a"], columns=[*BASE, TAG], extra={"user:Team": "blue"}.items()))
    cloud.part("2024-01", "e", "b.csv", csv_text("2024-01", ["b"], columns=BASE[::-1]))
    cloud.manifest("2024-01", "e", ["a.csv", "b.csv"], [*BASE, TAG])
    load(cloud)
    assert rows(cloud.table.rows(), "identity_line_item_id", "line_item_product_code", "resource_tags_user_team") == [
        ("a", "Store", "blue"), ("b", "Store", None)
    ]


def test_equal_headers_share_one_scan(spark, cloud):
    for period in ("2024-01", "2024-02", "2024-03"):
        cloud.delivery(period, "e", ["a"])
    cloud.part("2024-03", "e", "part-1.csv", csv_text("2024-03", ["b"], columns=BASE[::-1]))
    manifests, _ = scan_manifests(spark, cloud.folder("store"), cloud.prefix, cloud.export, "v2")
    headers = distinct_headers(read_headers(staged_parts(spark, cloud.folder("staging"))))
    groups = scan_groups(headers, map_headers(headers, column_defs(manifests))).collect()
    assert sorted(len(g.paths) for g in groups) == [1, 3]


def test_repeated_header_reaches_two_columns(cloud):
    columns = [*BASE, TAG, TAG]
    text = csv_text("2024-01", ["a"], columns=columns, extra={"user:Team": "x"}.items())
    cloud.part("2024-01", "e", "a.csv", text.replace("x,x", "x,y"))
    cloud.manifest("2024-01", "e", ["a.csv"], columns)
    load(cloud)
    assert rows(cloud.table.rows(), "resource_tags_user_team", "resource_tags_user_team_1") == [("x", "y")]


def test_second_load_skips_and_changes_nothing(cloud):
    cloud.delivery("2024-01", "e1", ["a", "b"])
    cloud.delivery("2024-02", "e2", ["c"])
    assert outcome(load(cloud)) == {"2024-01": ("success", 2), "2024-02": ("success", 1)}
    before = ids(cloud)
    assert outcome(load(cloud)) == {"2024-01": ("skipped", 0), "2024-02": ("skipped", 0)}
    assert ids(cloud) == before
    assert outcome(load(cloud, overwrite=True)) == {"2024-01": ("success", 2), "2024-02": ("success", 1)}
    assert ids(cloud) == before


def test_new_delivery_replaces_its_month_only(cloud):
    cloud.delivery("2024-01", "e1", ["a", "b"])
    cloud.delivery("2024-02", "e1", ["c"])
    load(cloud)
    cloud.delivery("2024-01", "e0", ["d"])
    assert outcome(load(cloud)) == {"2024-01": ("success", 1), "2024-02": ("skipped", 0)}
    assert ids(cloud) == [("2024-01", "e0", "d"), ("2024-02", "e1", "c")]


def test_two_deliveries_of_a_month(spark, tmp_path, cloud):
    cloud.delivery("2024-01", "e1", ["a"])
    cloud.delivery("2024-01", "e2", ["b"], folder="metadata/BILLING_PERIOD=2024-02")
    results = {r.execution_id: r.status for r in load(cloud).results.collect()}
    assert results == {"e1": "superseded", "e2": "success"}
    assert ids(cloud) == [("2024-01", "e2", "b")]
    results = {r.execution_id: r.status for r in load(cloud).results.collect()}
    assert results == {"e1": "superseded", "e2": "skipped"}


def test_incomplete_delivery_leaves_its_month(cloud):
    cloud.delivery("2024-01", "e1", ["a"])
    load(cloud)
    cloud.delivery("2024-01", "e2", ["b"])
    cloud.manifest("2024-01", "e2", ["part-0.csv.gz", "part-1.csv.gz"])
    report = load(cloud)
    assert outcome(report) == {"2024-01": ("failed", 0)}
    assert report.results.first().error == "1 of 2 listed files present"
    assert ids(cloud) == [("2024-01", "e1", "a")]
    cloud.part("2024-01", "e2", "part-1.csv.gz", csv_text("2024-01", ["c"]))
    assert outcome(load(cloud)) == {"2024-01": ("success", 2)}


def test_delivery_without_rows_is_refused(cloud):
    cloud.delivery("2024-01", "e1", ["a"])
    load(cloud)
    cloud.delivery("2024-01", "e2", [])
    assert outcome(load(cloud)) == {"2024-01": ("failed", 0)}
    assert ids(cloud) == [("2024-01", "e1", "a")]


@pytest.mark.parametrize(
    "bad", ["x", "12345678901234567890", "1,2"], ids=["no number", "overflow", "extra field"]
)
def test_bad_value_fails_only_its_delivery(cloud, bad):
    cloud.delivery("2024-01", "e1", ["a"])
    load(cloud)
    cloud.delivery("2024-01", "e2", ["b"], cost=bad)
    cloud.delivery("2024-02", "e2", ["c"])
    assert outcome(load(cloud)) == {"2024-01": ("failed", 0), "2024-02": ("success", 1)}
    assert ids(cloud) == [("2024-01", "e1", "a"), ("2024-02", "e2", "c")]


def test_rows_of_no_or_another_month_go_to_rejects(cloud):
    cloud.delivery("2024-02", "e", ["keep"])
    load(cloud)
    text = csv_text("2024-01", ["a"]) + csv_text("2024-02", ["stray"]).split("\n", 1)[1]
    text += "none,,,2024-01-05T00:00:00Z,111,Store,1\n"
    cloud.part("2024-01", "e", "a.csv", text)
    cloud.manifest("2024-01", "e", ["a.csv"])
    report = load(cloud)
    assert report.rejected_rows == 2
    assert ids(cloud) == [("2024-01", "e", "a"), ("2024-02", "e", "keep")]
    rejects = cloud.spark.read.parquet(cloud.table.rejects)
    assert rows(rejects, "identity_line_item_id") == [("none",), ("stray",)]


def test_loading_again_repeats_no_rejects(cloud):
    text = csv_text("2024-01", ["a"]) + csv_text("2024-02", ["stray"]).split("\n", 1)[1]
    cloud.part("2024-01", "e", "a.csv", text)
    cloud.manifest("2024-01", "e", ["a.csv"])
    for _ in range(2):
        result = load(cloud, overwrite=True).results.first()
        assert (result.status, result.rows_loaded, result.rows_rejected) == ("success", 1, 1)
        assert result.error == "1 rows of no or another month withheld"
    assert rows(cloud.table.rejected_rows(), "billing_period", "execution_id", "identity_line_item_id") == [("2024-01", "e", "stray")]


def test_overwrite_without_accepted_rows_fails(cloud):
    """The table's own rows of the delivery, from an earlier load, are not counted as loaded."""
    cloud.delivery("2024-01", "e", ["a", "b"])
    cloud.delivery("2024-02", "f", ["c"])
    load(cloud)
    cloud.part("2024-01", "e", "part-0.csv.gz", csv_text("2024-03", ["x", "y", "z"]))
    report = load(cloud, overwrite=True)
    assert outcome(report) == {"2024-01": ("failed", 0), "2024-02": ("success", 1)}
    failed = report.results.where("status = 'failed'").first()
    assert (failed.rows_rejected, failed.error) == (3, "no rows of its month; 3 rows of no or another month withheld")
    assert ids(cloud) == [("2024-01", "e", "a"), ("2024-01", "e", "b"), ("2024-02", "f", "c")]


def test_files_loaded_counts_parts_that_no_manifest_lists(cloud):
    cloud.delivery("2024-01", "e", ["a"])
    cloud.part("2024-01", "e", "more.csv", csv_text("2024-01", ["b"]))
    result = load(cloud).results.first()
    assert (result.files_loaded, result.rows_loaded) == (2, 2)


def test_interrupted_load_is_made_again(cloud):
    cloud.delivery("2024-01", "e", ["a"])
    load(cloud)
    record_loads(cloud.spark, [("2024-01", "e", 0, "loading", None)], cloud.table.ledger)
    assert cloud.table.deliveries().isEmpty() and cloud.table.deliveries("ledger").isEmpty()
    assert outcome(load(cloud)) == {"2024-01": ("success", 1)}
    assert outcome(load(cloud)) == {"2024-01": ("skipped", 0)}


def test_error_that_is_no_deliverys_fault_is_raised(cloud, monkeypatch):
    def lost(*_, **__):
        raise PySparkException("executors lost")

    cloud.delivery("2024-01", "e", ["a"])
    monkeypatch.setattr(BillingTable, "replace", lost)
    with pytest.raises(PySparkException, match="executors lost"):
        load(cloud)


def test_state_reads_the_wanted_months_only(cloud):
    cloud.delivery("2024-01", "e", ["a"])
    cloud.delivery("2024-02", "e", ["b"])
    load(cloud)
    pairs = cloud.table.deliveries("rows", ["2024-02"])
    assert rows(pairs, "billing_period") == [("2024-02",)]
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    filters = [part.split("]")[0] for part in plan.split("PushedFilters: [")[1:]]
    assert any("billing_period,2024-02" in f for f in filters)
    assert "FileScan parquet [kind" in plan  # statistics, no row of the table


def test_statistics_are_those_of_the_files_that_are_there(cloud):
    """After a write that was lost before it recorded them, a replaced month and a removed folder of statistics."""
    cloud.delivery("2024-01", "e1", ["a", "b"])
    cloud.delivery("2024-02", "e1", ["c"])
    load(cloud)
    summary = lambda: rows(cloud.table.statistics(), "billing_period", "execution_id", "rows")
    assert summary() == [("2024-01", "e1", 2), ("2024-02", "e1", 1)]
    half = cloud.table.rows().withColumn("execution_id", F.lit("e2")).where("billing_period = '2024-02'")
    half = cloud.spark.createDataFrame(half.unionByName(half).drop("billing_period").toArrow())
    half.coalesce(1).write.mode("overwrite").parquet(f"{cloud.table.data}/billing_period=2024-02")
    assert summary() == [("2024-01", "e1", 2), ("2024-02", "e2", 2)] == summary()
    assert rows(cloud.table.row_counts(["2024-02"]), "execution_id", "rows") == [("e2", 2)]
    info = cloud.table.info("t").first()
    assert (info.row_count, info.column_count) == (4, 8) and str(info.min_date) == "2024-01-01 00:00:00"
    shutil.rmtree(cloud.table.recorded)
    assert summary() == [("2024-01", "e1", 2), ("2024-02", "e2", 2)]
    assert cloud.table.has_rows()


def test_undeclared_column(cloud):
    extra = [*BASE, ("lineItem", "Surprise", "String")]
    cloud.part("2024-01", "e", "a.csv", csv_text("2024-01", ["a"], columns=extra, extra={"Surprise": "s"}.items()))
    cloud.manifest("2024-01", "e", ["a.csv"])
    cloud.delivery("2024-02", "f", ["b"])
    report = load(cloud)
    assert outcome(report) == {"2024-01": ("failed", 0), "2024-02": ("success", 1)}
    assert "lineItem/Surprise" in [r.error for r in report.results.collect() if r.error][0]
    assert outcome(load(cloud, on_unknown="add"))["2024-01"] == ("success", 1)
    assert rows(cloud.table.rows(), "identity_line_item_id", "line_item_surprise") == [("a", "s"), ("b", None)]


def test_undeclared_column_of_a_taken_name(cloud):
    extra = [*BASE, ("lineItem", "unblendedCost", "String")]
    text = csv_text("2024-01", ["a"], columns=extra, extra={"unblendedCost": "9"}.items())
    cloud.part("2024-01", "e", "a.csv", text)
    cloud.manifest("2024-01", "e", ["a.csv"])
    report = load(cloud, on_unknown="add")
    assert outcome(report) == {"2024-01": ("failed", 0)}
    assert report.results.first().error == "undeclared columns of a taken name: line_item_unblended_cost"


def test_part_without_a_header_fails_its_delivery(cloud):
    cloud.delivery("2024-01", "e", ["a"])
    cloud.part("2024-01", "e", "empty.csv.gz", "")
    assert outcome(load(cloud)) == {"2024-01": ("failed", 0)}
    assert not cloud.table.exists()


def test_schema_grows_and_keeps_types(cloud):
    cloud.delivery("2024-01", "e", ["a"])
    load(cloud)
    changed = [("lineItem", n, "String") if n == "UnblendedCost" else (c, n, t) for c, n, t in BASE]
    cloud.delivery("2024-02", "e", ["b"], columns=[TAG, *changed], cost="2.5", extra={"user:Team": "red"}.items())
    report = load(cloud)
    assert report.added_columns == ["resource_tags_user_team"]
    assert cloud.table.schema().names[-1] == "resource_tags_user_team"
    assert rows(cloud.table.rows(), "identity_line_item_id", "line_item_unblended_cost", "resource_tags_user_team") == [
        ("a", Decimal("1.25"), None), ("b", Decimal("2.50"), "red")
    ]
    cloud.delivery("2024-03", "e", ["c"], columns=changed, cost="much")
    assert outcome(load(cloud))["2024-03"] == ("failed", 0)


def test_name_must_keep_its_original(cloud):
    cloud.delivery("2024-01", "e", ["a"], columns=[*BASE, TAG], extra={"user:Team": "x"}.items())
    load(cloud)
    other = ("resourceTags", "user:team", "String")
    cloud.delivery("2024-02", "e", ["b"], columns=[*BASE, other], extra={"user:team": "y"}.items())
    cloud.delivery("2024-03", "e", ["c"])
    report = load(cloud)
    assert outcome(report) == {"2024-01": ("skipped", 0), "2024-02": ("failed", 0), "2024-03": ("success", 1)}
    error = [r.error for r in report.results.collect() if r.error][0]
    assert error.endswith("resourceTags/user:team for resourceTags/user:Team")
    with pytest.raises(ValueError, match="resource_tags_user_team"):
        cloud.table.evolve(column_defs(scan_manifests(cloud.spark, *cloud.scan)[0]))
    assert outcome(load(cloud, on_renamed="keep"))["2024-02"] == ("success", 1)


def test_wide_deliveries(cloud):
    wide = [*BASE, *[("resourceTags", f"user:tag{i}", "String") for i in range(300)]]
    values = {f"user:tag{i}": str(i) for i in range(300)}
    cloud.delivery("2024-01", "e", ["a", "b"], columns=wide, extra=values.items())
    assert outcome(load(cloud)) == {"2024-01": ("success", 2)}
    row = cloud.table.rows().first()
    assert (len(row), row.resource_tags_user_tag299) == (309, "299")


def test_ledger_holds_loads_and_failures(cloud):
    cloud.delivery("2024-01", "e1", ["a"])
    load(cloud)
    cloud.delivery("2024-01", "e2", ["b"], cost="x")
    load(cloud)
    ledger = read_ledger(cloud.spark, cloud.table.ledger)
    assert rows(ledger, "execution_id", "state", "row_count") == [
        ("e1", "loaded", 1), ("e1", "loading", 0), ("e2", "failed", 0), ("e2", "loading", 0)
    ]
    assert current_loads(ledger).first().state == "failed"
    assert rows(cloud.table.deliveries("ledger"), "execution_id") == rows(cloud.table.deliveries(), "execution_id") == [("e1",)]


def test_table_object_of_an_absent_table(spark, tmp_path):
    table = BillingTable(spark, str(tmp_path / "none"))
    assert not table.exists() and table.rows().count() == 0


def test_three_jobs_whatever_the_number_of_bad_deliveries(cloud, monkeypatch):
    """A value that its existing column can't hold, a record of another width, a cut and a damaged file, and two good ones."""
    cloud.delivery("2024-01", "e", ["a"])
    load(cloud)
    changed = [("lineItem", n, "String") if n == "UnblendedCost" else (c, n, t) for c, n, t in BASE]
    cloud.delivery("2024-02", "e", ["b", "b2"], columns=changed, cost="much")
    cloud.delivery("2024-03", "e", ["c"], cost="1,2")
    for month in ("2024-04", "2024-05"):
        cloud.delivery(month, "e", [str(hash(k * 7919 + 13) * 48271 % 2147483647) for k in range(40_000)])
        path = cloud.root / "staging" / month / "e" / "part-0.csv.gz"
        data = path.read_bytes()
        path.write_bytes(data[:-400] if month == "2024-04" else data[:150_000] + b"\xff" * 60 + data[150_060:])
    cloud.delivery("2024-06", "e", ["f"], columns=changed, cost="2.5")
    calls = []
    for name in ("_replace", "delivery_faults"):
        monkeypatch.setattr(load_module, name, lambda *a, f=getattr(load_module, name), n=name: (calls.append(n), f(*a))[1])
    report = load(cloud)
    assert calls == ["_replace", "delivery_faults", "_replace"]
    states = {m: "failed" for m in ("2024-02", "2024-03", "2024-04", "2024-05")} | {"2024-01": "skipped", "2024-06": "success"}
    assert {m: s for m, (s, _) in outcome(report).items()} == states
    errors = {r.billing_period: r.error for r in report.results.collect()}
    assert errors["2024-02"] == "2 rows or files at fault, such as: not a decimal(18,2): much"
    assert "malformed record: c," in errors["2024-03"] and "damaged file" in errors["2024-04"] and "damaged file" in errors["2024-05"]
    assert ids(cloud) == [("2024-01", "e", "a"), ("2024-06", "e", "f")]

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from billweave.operators.export import export_deliveries, export_periods, export_root, read_export
from billweave.operators.ledger import record_loads
from billweave.operators.publish import first_file_schema, publish_deliveries, publish_periods
from billweave.operators.state import DELIVERY
from billweave.sources.listing import exported_files
from cloud_store import BASE, rows
from test_load import TAG, load


def frame(spark, *values):
    names = ["billing_period", "execution_id"][: len(values[0])]
    return spark.createDataFrame(list(values), ", ".join(f"{n} string" for n in names))


def statuses(frame):
    return {r.billing_period: r.status for r in frame.collect()}


@pytest.fixture
def loaded(cloud):
    cloud.delivery("2024-01", "e1", ["a", "b"])
    cloud.delivery("2024-02", "e2", ["c"])
    load(cloud)
    return cloud


def test_export_periods_skip_overwrite_fail(spark, loaded):
    out, months = loaded.folder("exports"), frame(spark, ("2024-01",), ("2024-02",), ("2024-09",))
    first = export_periods(spark, loaded.table, months, out, compression="zstd")
    assert statuses(first) == {"2024-01": "exported", "2024-02": "exported", "2024-09": "failed"}
    assert statuses(export_periods(spark, loaded.table, months, out))["2024-01"] == "skipped"
    again = export_periods(spark, loaded.table, frame(spark, ("2024-01",)), out, overwrite=True)
    assert statuses(again) == {"2024-01": "exported"}
    back = read_export(spark, export_root(out, "period"), loaded.table.schema())
    assert rows(back, "billing_period", "execution_id", "identity_line_item_id") == [
        ("2024-01", "e1", "a"), ("2024-01", "e1", "b"), ("2024-02", "e2", "c")
    ]
    assert rows(exported_files(spark, export_root(out, "period")).select("billing_period").distinct(), "billing_period") == [
        ("2024-01",), ("2024-02",)
    ]


def test_export_rejects_unknown_codec(spark, loaded):
    with pytest.raises(ValueError, match="lzma"):
        export_periods(spark, loaded.table, frame(spark, ("2024-01",)), loaded.folder("exports"), compression="lzma")


def test_export_orders_a_hot_key_over_several_files(spark, tmp_path, loaded):
    """Equal sort keys everywhere: ranges still split, and nothing is lost."""
    start = F.to_timestamp_ntz(F.lit("2024-01-01"))
    hot = spark.range(20_000).select(
        F.lit("e1").alias("execution_id"),
        F.col("id").cast("string").alias("identity_line_item_id"),
        start.alias("bill_billing_period_start_date"),
        start.alias("line_item_usage_start_date"),
        F.lit("2024-01").alias("billing_period"),
    )
    loaded.table.replace(hot)
    out = loaded.folder("exports")
    export_periods(spark, loaded.table, frame(spark, ("2024-01",)), out, partitions=6)
    files = exported_files(spark, export_root(out, "period"))
    back = read_export(spark, export_root(out, "period"), loaded.table.schema())
    assert files.count() >= 4
    assert back.select("identity_line_item_id").distinct().count() == 20_000
    sizes = back.groupBy(F.col("_metadata.file_path")).count().agg(F.max("count")).first()[0]
    assert sizes < 10_000


def test_export_without_total_order(spark, loaded):
    out, months = loaded.folder("exports"), frame(spark, ("2024-01",), ("2024-02",))
    done = export_periods(spark, loaded.table, months, out, total_order=False)
    assert set(statuses(done).values()) == {"exported"}
    back = read_export(spark, export_root(out, "period"), loaded.table.schema())
    assert rows(back, *back.columns) == rows(loaded.table.rows(), *back.columns)


def test_export_deliveries_keys_and_text_ids(spark, cloud):
    cloud.delivery("2024-01", "20240105", ["a"])
    load(cloud)
    out = cloud.folder("exports")
    done = export_deliveries(spark, cloud.table, frame(spark, ("2024-01", "20240105"), ("2024-01", "x")), out)
    assert {r.export_key: r.status for r in done.collect()} == {"2024-01:20240105": "exported", "2024-01:x": "failed"}
    back = read_export(spark, export_root(out, "execution"), cloud.table.schema())
    assert rows(back, "execution_id", "identity_line_item_id") == [("20240105", "a")]


def test_publish_periods(spark, loaded):
    out, months = loaded.folder("exports"), frame(spark, ("2024-01",), ("2024-02",), ("2024-09",))
    export_periods(spark, loaded.table, months, out)
    done = publish_periods(spark, months, out, loaded.warehouse)
    assert statuses(done) == {"2024-01": "loaded", "2024-02": "loaded", "2024-09": "failed"}
    assert rows(loaded.warehouse.rows(), "billing_period", "identity_line_item_id", "line_item_unblended_cost") == [
        ("2024-01", "a", Decimal("1.25")), ("2024-01", "b", Decimal("1.25")), ("2024-02", "c", Decimal("1.25"))
    ]
    assert statuses(publish_periods(spark, months, out, loaded.warehouse, overwrite=False))["2024-01"] == "skipped"
    assert loaded.warehouse.rows().count() == 3


def test_publish_shuffles_no_rows(spark, loaded, monkeypatch):
    """The rows go from export files to warehouse files in their tasks; months and files stay apart."""
    out, months = loaded.folder("exports"), frame(spark, ("2024-01",), ("2024-02",))
    export_periods(spark, loaded.table, months, out)
    plans = []
    replace = type(loaded.warehouse).replace
    monkeypatch.setattr(
        type(loaded.warehouse), "replace",
        lambda table, rows, **how: (plans.append(rows._jdf.queryExecution().executedPlan().toString()), replace(table, rows, **how))[1],
    )
    publish_periods(spark, months, out, loaded.warehouse)
    assert len(plans) == 1 and "FileScan parquet" in plans[0]
    assert "Exchange" not in plans[0].replace("BroadcastExchange", "") and "Sort" not in plans[0]


def test_interrupted_month_is_published_again(spark, loaded):
    out, months = loaded.folder("exports"), frame(spark, ("2024-01",))
    export_periods(spark, loaded.table, months, out)
    publish_periods(spark, months, out, loaded.warehouse)
    record_loads(spark, [("2024-01", None, 0, "loading", None)], loaded.warehouse.ledger)
    assert statuses(publish_periods(spark, months, out, loaded.warehouse, overwrite=False)) == {"2024-01": "loaded"}
    assert statuses(publish_periods(spark, months, out, loaded.warehouse, overwrite=False)) == {"2024-01": "skipped"}


def test_publish_period_from_delivery_exports(spark, loaded):
    out = loaded.folder("exports")
    export_deliveries(spark, loaded.table, frame(spark, ("2024-01", "e1")), out)
    done = publish_periods(spark, frame(spark, ("2024-01",), ("2024-02",)), out, loaded.warehouse)
    assert statuses(done) == {"2024-01": "loaded", "2024-02": "failed"}
    assert rows(loaded.warehouse.rows(), *DELIVERY) == [("2024-01", "e1"), ("2024-01", "e1")]


def test_publish_deliveries_adds_columns_and_replaces_months(spark, loaded):
    out, warehouse = loaded.folder("exports"), loaded.warehouse
    pairs = frame(spark, ("2024-01", "e1"), ("2024-02", "e2"))
    export_deliveries(spark, loaded.table, pairs, out)
    assert set(statuses(publish_deliveries(spark, pairs, out, warehouse)).values()) == {"loaded"}
    assert set(statuses(publish_deliveries(spark, pairs, out, warehouse)).values()) == {"skipped"}
    loaded.delivery("2024-02", "e3", ["d"], columns=[*BASE, TAG], extra={"user:Team": "red"}.items())
    load(loaded)
    newer = frame(spark, ("2024-02", "e3"), ("2024-02", "none"))
    export_deliveries(spark, loaded.table, newer, out)
    done = {r.execution_id: r.status for r in publish_deliveries(spark, newer, out, warehouse).collect()}
    assert done == {"e3": "loaded", "none": "failed"}
    fresh = loaded.warehouse.rows()
    assert rows(fresh, "execution_id", "identity_line_item_id", "resource_tags_user_team") == [
        ("e1", "a", None), ("e1", "b", None), ("e3", "d", "red")
    ]


def test_a_month_is_published_from_one_delivery_the_live_one(spark, loaded):
    out, warehouse = loaded.folder("exports"), loaded.warehouse
    export_deliveries(spark, loaded.table, frame(spark, ("2024-01", "e1")), out)
    loaded.delivery("2024-01", "e0", ["new"])
    load(loaded, overwrite=True)
    live = loaded.table.deliveries("rows")
    if ("2024-01", "e0") in rows(live, *DELIVERY):
        stale = publish_periods(spark, frame(spark, ("2024-01",)), out, warehouse, live=live)
        assert statuses(stale) == {"2024-01": "failed"}
    export_deliveries(spark, loaded.table, frame(spark, ("2024-01", "e0")), out)
    both = frame(spark, ("2024-01", "e0"), ("2024-01", "e1"))
    done = {r.execution_id: r.status for r in publish_deliveries(spark, both, out, warehouse).collect()}
    assert sorted(done.values()) in (["loaded", "superseded"], ["failed", "loaded"])
    assert warehouse.rows().select("execution_id").distinct().count() == 1


def test_first_file_schema(spark, loaded):
    out = loaded.folder("exports")
    with pytest.raises(ValueError, match="no Parquet file"):
        first_file_schema(spark, export_root(out, "period"))
    export_periods(spark, loaded.table, frame(spark, ("2024-01",)), out)
    assert first_file_schema(spark, export_root(out, "period")).names == loaded.table.schema().names

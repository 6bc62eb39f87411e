from __future__ import annotations

import random

import pytest

from billweave.operators.ledger import LEGAL_STEPS, EventLog, IllegalStep, delivery_states, read_events, read_ledger, state_steps
from billweave.operators.state import choose_deliveries, load_stats, loaded_map, not_in
from billweave.plans.run import export_months, load_months, publish_months, run
from billweave.session import work_folder
from billweave.streaming.intake import load_arrivals
from cloud_store import csv_text, rows
from pyspark.sql import functions as F


def warehouse(cloud):
    return rows(cloud.warehouse.rows(), "billing_period", "execution_id", "identity_line_item_id")


def test_run_and_rerun(spark, cloud):
    cloud.delivery("2024-01", "e1", ["a", "b"])
    cloud.delivery("2024-02", "e1", ["c"])
    cloud.manifest("2024-03", "x", text="{")
    plan = run(spark, cloud.places, dry_run=True, start="2024-02")
    assert [tuple(r) for r in plan.plan.collect()] == [("2024-02", 1)] and plan.load is None
    assert not cloud.table.exists()
    report = run(spark, cloud.places)
    assert report.rejects.count() == 1
    assert tuple(load_stats(report.load.results).first()) == (2, 2, 0, 3)
    assert warehouse(cloud) == [("2024-01", "e1", "a"), ("2024-01", "e1", "b"), ("2024-02", "e1", "c")]
    again = run(spark, cloud.places)
    assert again.load is None and again.plan.count() == 0
    cloud.delivery("2024-01", "e0", ["d"])
    report = run(spark, cloud.places)
    assert {r.billing_period: r.status for r in report.published.collect()} == {"2024-01": "loaded"}
    assert warehouse(cloud) == [("2024-01", "e0", "d"), ("2024-02", "e1", "c")]


def test_run_goes_on_where_it_stopped(spark, cloud):
    """Loaded but not exported nor published, as after a failure between the steps."""
    cloud.delivery("2024-01", "e1", ["a"])
    places = cloud.places
    run(spark, type(places)(**{**places.__dict__, "warehouse": None}))
    assert not cloud.warehouse.exists()
    report = run(spark, places)
    assert rows(report.load.results, "status") == rows(report.exported, "status") == [("skipped",)]
    assert warehouse(cloud) == [("2024-01", "e1", "a")]


def test_run_by_ledger(spark, cloud):
    cloud.delivery("2024-01", "e1", ["a"])
    run(spark, cloud.places, state="ledger")
    assert run(spark, cloud.places, state="ledger").load is None
    ledger = read_ledger(spark, cloud.warehouse.ledger)
    assert rows(ledger, "execution_id", "state", "row_count") == [("e1", "loaded", 1), ("e1", "loading", 0)]
    cloud.delivery("2024-01", "e2", ["b", "c"])
    assert run(spark, cloud.places, state="ledger").published.first().status == "loaded"
    assert warehouse(cloud) == [("2024-01", "e2", "b"), ("2024-01", "e2", "c")]


def test_single_steps(spark, cloud):
    cloud.delivery("2024-01", "e1", ["a"])
    cloud.delivery("2024-02", "e1", ["b"], name="part[0]{1}.csv")
    with pytest.raises(ValueError, match="load data first"):
        export_months(spark, cloud.places)
    load = load_months(spark, cloud.places, start="2024-01")
    assert rows(load.results, "billing_period", "status") == [("2024-01", "success"), ("2024-02", "success")]
    assert rows(export_months(spark, cloud.places, end="2024-02"), "status") == [("exported",), ("exported",)]
    assert rows(publish_months(spark, cloud.places, start="2024-02"), "billing_period", "status") == [("2024-02", "loaded")]
    assert warehouse(cloud) == [("2024-02", "e1", "b")]


def test_run_checks_months(spark, cloud):
    with pytest.raises(ValueError, match="YYYY-MM"):
        run(spark, cloud.places, start="2024-13")


def test_arrivals_load_once_complete(spark, cloud):
    cloud.part("2024-01", "e1", "a.csv", csv_text("2024-01", ["a"]))
    cloud.manifest("2024-01", "e1", ["a.csv", "b.csv"])
    cloud.delivery("2024-02", "e2", ["c"])
    seen = []
    arrive = lambda: load_arrivals(
        spark, cloud.places, cloud.folder("checkpoint"), lambda r: seen.append({tuple(x) for x in r.results.select("billing_period", "status").collect()})
    )
    arrive()
    assert seen == [{("2024-01", "failed"), ("2024-02", "success")}]
    arrive()
    assert len(seen) == 1
    cloud.part("2024-01", "e1", "b.csv", csv_text("2024-01", ["b"]))
    arrive()
    assert seen[1:] == [{("2024-01", "success")}]
    assert rows(cloud.table.rows(), "identity_line_item_id") == [("a",), ("b",), ("c",)]


def test_arrivals_whose_manifest_comes_last(spark, cloud):
    """Three waves: parts alone, the manifest alone, then a later delivery of the month in the same order."""
    arrive = lambda: load_arrivals(spark, cloud.places, cloud.folder("checkpoint"))
    cloud.part("2024-01", "e1", "a.csv", csv_text("2024-01", ["a"]))
    arrive()
    assert not cloud.table.exists()
    cloud.manifest("2024-01", "e1", ["a.csv"])
    arrive()
    assert rows(cloud.table.rows(), "execution_id", "identity_line_item_id") == [("e1", "a")]
    cloud.part("2024-01", "e0", "a.csv", csv_text("2024-01", ["b"]))
    arrive()
    assert rows(cloud.table.rows(), "execution_id", "identity_line_item_id") == [("e1", "a")]
    cloud.manifest("2024-01", "e0", ["a.csv"])
    arrive()
    assert rows(cloud.table.rows(), "execution_id", "identity_line_item_id") == [("e0", "b")]


def test_state_operators(spark):
    pairs = spark.createDataFrame([("2024-01", "e1"), ("2024-01", "e2"), ("2024-02", None)], "billing_period string, execution_id string")
    assert rows(loaded_map(pairs), "billing_period", "execution_id") == [("2024-01", "e2")]
    kept = choose_deliveries(pairs.na.drop(), F.col("execution_id"))
    assert rows(kept, "execution_id", "keep") == [("e1", False), ("e2", True)]
    assert not_in(pairs, pairs, overwrite=True).count() == 3
    assert not_in(pairs.na.drop(), pairs).count() == 0


def test_steps_across_slices_match_brute_force(spark):
    """One delivery holds most events; equal times are ordered by id."""
    rng = random.Random(7)
    states = ["discovered", "staging", "loading", "loaded", "failed"]
    events = [
        ("hot" if rng.random() < 0.7 else f"d{rng.randrange(5)}", f"2024-01-0{rng.randrange(1, 4)} {rng.randrange(24):02}:{rng.choice((0, 30)):02}:00", i, rng.choice(states))
        for i in range(400)
    ]
    frame = spark.createDataFrame(events, "delivery string, t string, event_id long, state string")
    frame = frame.withColumn("event_time", F.to_timestamp_ntz("t"))
    expected, last = {}, {}
    for delivery, _, event, state in sorted(events, key=lambda e: (e[1], e[2])):
        expected[event] = (last.get(delivery), (last.get(delivery), state) in LEGAL_STEPS)
        last[delivery] = state
    found = {r.event_id: (r.prior_state, r.legal) for r in state_steps(frame).collect()}
    assert found == expected


def test_events_of_loads_are_checked_as_they_are_noted(spark, cloud):
    cloud.delivery("2024-01", "e1", ["a"])
    cloud.manifest("2024-02", "e1", ["absent.csv"])
    for _ in range(2):
        run(spark, cloud.places)
    states = delivery_states(read_events(spark, cloud.table.events)).withColumn("delivery", F.substring_index("delivery", ":", 2))
    assert rows(states, "delivery", "state", "events", "illegal_steps") == [
        ("2024-01:e1", "loaded", 4, 0), ("2024-02:e1", "failed", 2, 0), ("2024-02:e1", "failed", 2, 0)
    ]
    log = EventLog(spark, cloud.folder("events"))
    log.note(("2024-01", "e"), "discovered")
    with pytest.raises(IllegalStep, match="2024-01:e can't go from discovered to loaded"):
        log.note(("2024-01", "e"), "loaded")
    assert log.state(("2024-01", "e")) == "discovered"


def test_work_folder_uses_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    folder = work_folder(spark, "x")
    assert folder.startswith(base or "/") and folder != work_folder(spark, "x")

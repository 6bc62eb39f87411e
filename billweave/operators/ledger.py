"""Loads ledger and the states of a delivery."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from billweave.functions.periods import utc_wall_time
from billweave.session import read_if_present

LEDGER_SCHEMA = (
    "billing_period string, execution_id string, load_timestamp timestamp_ntz, row_count bigint, "
    "state string, error_message string"
)

# Legal steps of a delivery. A first event must be ``discovered``.
LEGAL_STEPS = [
    (None, "discovered"),
    ("discovered", "staging"),
    ("staging", "loading"),
    ("loading", "loaded"),
    ("discovered", "failed"),
    ("staging", "failed"),
    ("loading", "failed"),
]


EVENTS_SCHEMA = "delivery string, event_time timestamp_ntz, event_id bigint, state string"


class IllegalStep(ValueError):
    """A delivery can't go from its state to the one that was asked for."""


class EventLog:
    """Events of the deliveries of one attempt to load them, checked as they are noted and appended in batches.

    Each attempt gives its deliveries a life of their own, from ``discovered`` on: a later attempt after a failure starts
    anew. Their key is month, delivery and attempt. At most a few events of a run's deliveries are held.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.attempt = spark, path, uuid.uuid4().hex[:12]
        self._states: dict[tuple, tuple[str | None, int]] = {}
        self._noted: list[tuple] = []

    def note(self, delivery: tuple[str, str], state: str) -> None:
        before, number = self._states.get(delivery, (None, 0))
        if (before, state) not in LEGAL_STEPS:
            raise IllegalStep(f"{':'.join(delivery)} can't go from {before or 'nothing'} to {state}")
        self._states[delivery] = state, number + 1
        self._noted.append((":".join([*delivery, self.attempt]), number + 1, state))

    def state(self, delivery: tuple[str, str]) -> str | None:
        return self._states.get(delivery, (None, 0))[0]

    def write(self) -> None:
        """Append what was noted since the last time."""
        if self._noted:
            events = self.spark.createDataFrame(self._noted, "delivery string, event_id bigint, state string")
            timed = events.withColumn("event_time", utc_wall_time(F.current_timestamp()))
            append_ledger(timed.select(*[f.split()[0] for f in EVENTS_SCHEMA.split(", ")]).coalesce(1), self.path)
            self._noted = []


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return read_if_present(spark, path, EVENTS_SCHEMA)


def append_ledger(entries: DataFrame, path: str) -> None:
    """Add entries; earlier ones are never rewritten."""
    entries.write.mode("append").parquet(path)


def record_loads(spark: SparkSession, loads: list[tuple], path: str) -> None:
    """Add an entry, timed now, for each ``(period, execution, row_count, state, error)`` of a run."""
    if loads:
        fields = [f for f in LEDGER_SCHEMA.split(", ") if not f.startswith("load_timestamp")]
        now = utc_wall_time(F.current_timestamp())
        entries = spark.createDataFrame(loads, ", ".join(fields)).withColumn("load_timestamp", now)
        names = [f.split()[0] for f in LEDGER_SCHEMA.split(", ")]
        append_ledger(entries.select(*names).coalesce(1), path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_if_present(spark, path, LEDGER_SCHEMA)


def current_loads(ledger: DataFrame) -> DataFrame:
    """Latest entry of each month; equal times are decided by delivery and state."""
    entry = F.struct("load_timestamp", "execution_id", "row_count", "state", "error_message")
    return ledger.groupBy("billing_period").agg(F.max(entry).alias("last")).select("billing_period", "last.*")


def live_deliveries(ledger: DataFrame) -> DataFrame:
    """The delivery last loaded for each month. A failure after it left it in place."""
    loaded = current_loads(ledger.where("state = 'loaded'"))
    return loaded.select("billing_period", "execution_id")


def interrupted_loads(ledger: DataFrame) -> DataFrame:
    """Deliveries whose last entry says that a load of them began: it never came to an end."""
    last = F.max_by("state", F.struct("load_timestamp", F.col("state") != "loading"))
    entries = ledger.where("execution_id IS NOT NULL").groupBy("billing_period", "execution_id")
    return entries.agg(last.alias("state")).where("state = 'loading'").select("billing_period", "execution_id")


def interrupted_months(ledger: DataFrame) -> DataFrame:
    """Months whose last entry says that a write of the month as a whole began: it never came to an end."""
    last = F.max_by(F.struct("state", "execution_id"), F.struct("load_timestamp", F.col("state") != "loading"))
    months = ledger.groupBy("billing_period").agg(last.alias("last"))
    return months.where("last.state = 'loading' AND last.execution_id IS NULL").select("billing_period")


def loaded_periods(ledger: DataFrame) -> DataFrame:
    return current_loads(ledger).where("state = 'loaded'")


def state_steps(events: DataFrame, slice_unit: str = "hour") -> DataFrame:
    """Each event of a delivery with the state before it and whether the step is legal.

    ``events`` has ``delivery, event_time, event_id, state``. The earlier event is looked up inside
    time slices, and across slices through the last event of each slice, so a delivery with very
    many events is spread over tasks. Both branches use one shuffle.
    """
    inside = Window.partitionBy("delivery", "slice").orderBy("event_time", "event_id")
    sliced = (
        events.withColumn("slice", F.date_trunc(slice_unit, "event_time"))
        .withColumn("prior", F.lag("state").over(inside))
        .withColumn("begins", F.row_number().over(inside) == 1)
        .withColumn("ends", F.lead("event_id").over(inside).isNull())
    )
    across = Window.partitionBy("delivery").orderBy("slice")
    before = sliced.where("ends").select("delivery", "slice", F.lag("state").over(across).alias("last_before"))
    prior = F.when(F.col("begins"), F.col("last_before")).otherwise(F.col("prior"))
    steps = sliced.join(before, ["delivery", "slice"]).withColumn("prior_state", prior)
    legal = F.concat_ws(">", F.coalesce("prior_state", F.lit("")), "state").isin(
        [f"{a or ''}>{b}" for a, b in LEGAL_STEPS]
    )
    return steps.select("delivery", "event_id", "event_time", "prior_state", "state", legal.alias("legal"))


def delivery_states(events: DataFrame) -> DataFrame:
    """Latest state of each delivery, its events, and how many of its steps were not legal."""
    steps = state_steps(events)
    return steps.groupBy("delivery").agg(
        F.max_by("state", F.struct("event_time", "event_id")).alias("state"),
        F.count("*").alias("events"),
        F.count_if(~F.col("legal")).alias("illegal_steps"),
    )

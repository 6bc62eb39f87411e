"""Load deliveries as their parts arrive in staging."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.operators.completeness import delivery_completeness
from billweave.operators.load import LoadReport, load_deliveries
from billweave.operators.state import DELIVERY, already_in, choose_deliveries, not_in
from billweave.operators.table import BillingTable
from billweave.plans.run import Places
from billweave.session import read_if_present
from billweave.sources.listing import FILE_COLUMNS, delivery_columns, staged_parts
from billweave.sources.manifests import manifest_files, scan_manifests

KEYS = "billing_period string, execution_id string"


def load_arrivals(
    spark: SparkSession,
    places: Places,
    checkpoint: str,
    on_load: Callable[[LoadReport], None] | None = None,
    **load_options,
) -> None:
    """Take all parts that arrived since the last call and load the deliveries they complete.

    The stream is over part files, whose names are never used twice, and only notes which deliveries they
    belong to, below the checkpoint. Then staging and manifests are listed once, however many batches there
    were. A noted delivery waits until it is loaded: it is tried when parts of it are new and when it is
    complete, so a manifest may come after its parts, in a call that has no new part. An interrupted call
    leaves its notes to the next one, which skips what is loaded.
    """
    arrivals, finished = (f"{checkpoint.rstrip('/')}/{name}" for name in ("arrivals", "finished"))
    new_batches: list[int] = []

    def note(batch: DataFrame, number: int) -> None:
        touched = delivery_columns(batch).select(*DELIVERY).distinct()
        # A batch that is repeated after a failure overwrites its notes.
        touched.write.mode("overwrite").parquet(f"{arrivals}/batch={number}")
        new_batches.append(number)

    arrived = (
        spark.readStream.format("binaryFile")
        .schema(FILE_COLUMNS)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv*")
        .load(places.staging)
        .select("path")
    )
    query = (
        arrived.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(note)
        .start()
    )
    query.awaitTermination()

    noted = read_if_present(spark, arrivals, f"{KEYS}, batch bigint")
    touched = noted.where(F.col("batch").isin(new_batches)).select(*DELIVERY).distinct()
    waiting = not_in(noted.select(*DELIVERY), read_if_present(spark, finished, KEYS)).unionByName(touched).distinct()
    manifests, _rejects = scan_manifests(spark, places.store, places.prefix, places.export, places.version)
    # Other deliveries of a month have a say in which one is live.
    listed = already_in(manifests, waiting.select("billing_period").distinct(), ["billing_period"]).persist()
    parts = staged_parts(spark, places.staging).persist()
    try:
        order = F.struct("manifest_path", "execution_id")
        live = choose_deliveries(listed.select(*DELIVERY, "manifest_path"), order).where("keep")
        complete = delivery_completeness(manifest_files(listed), parts).where("complete")
        due = already_in(already_in(live, waiting), complete.select(*DELIVERY).unionByName(touched)).select(*DELIVERY)
        # Held as values: one delivery a month at most.
        due = [tuple(row) for row in due.distinct().collect()]
        if not due:
            return
        table = BillingTable(spark, places.table)
        report = load_deliveries(spark, already_in(listed, spark.createDataFrame(due, KEYS)), parts, table, **load_options)
        done = report.results.where(F.col("status").isin("success", "skipped")).select(*DELIVERY)
        done.coalesce(1).write.mode("append").parquet(finished)
        if on_load:
            on_load(report)
    finally:
        listed.unpersist()
        parts.unpersist()

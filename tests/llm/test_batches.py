"""Arrow batches between executors and Python workers have a bounded size in bytes."""

from __future__ import annotations

from pyspark.sql import functions as F

from billweave.llm import near_dedup
from billweave.llm.common import ARROW_BYTES, BATCH_BYTES, map_batches


def test_batches_are_bounded_in_bytes(spark):
    session = spark.newSession()
    rows = session.range(0, 8_000, 1, 1).select("id", F.repeat(F.lit("x"), 3_000).alias("text"))
    assert map_batches(rows, lambda: lambda batch: [batch], "id long, text string", BATCH_BYTES).count() == 8_000

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    found = [r["size"] for r in rows.mapInArrow(sizes, "size long").collect()]
    assert max(found) < 2 * BATCH_BYTES and sum(found) > 8_000 * 3_000


def test_a_bound_of_the_session_stays(spark):
    session = spark.newSession()
    session.conf.set(ARROW_BYTES, "1000000")
    map_batches(session.range(1), lambda: lambda batch: [batch], "id long", BATCH_BYTES)
    assert session.conf.get(ARROW_BYTES) == "1000000"


def test_members_meet_their_forms_once_a_document(spark):
    members = spark.createDataFrame(
        [(t, 100 * t + r % 3, r, r) for r in range(5) for t in range(4)] + [(0, 7, 2, 2), (0, 7, None, 1), (1, 8, 99, 99)],
        "tree int, node long, rep long, component long",
    )
    classes = spark.createDataFrame(
        [(r, n, bytes([r]), bytes([n]), r) for r, n in [(0, 1), (1, 2), (2, 3), (2, 4), (3, 5), (4, 6)]],
        "rep long, n long, sketch binary, firsts binary, small long",
    )
    ddl = "n long, sketch binary, firsts binary, small long"
    found, plain = near_dedup.with_forms(members, classes, ddl), members.join(classes, "rep")
    columns = sorted(plain.columns)
    key = lambda r: tuple(map(repr, r))
    assert sorted(map(key, found.select(columns).collect())) == sorted(map(key, plain.select(columns).collect()))
    lines = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joined = next(k for k, line in enumerate(lines) if "Join Inner" in line)
    assert any("collect_list" in line for line in lines[joined:])

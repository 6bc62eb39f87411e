"""What the operators share: reading, stored intermediate tables, ranks without a global sort, Arrow mapping."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from billweave.session import work_folder


#: Bytes of Arrow data that a task turns into Python objects at once, which take several times the room.
BATCH_BYTES = 4 << 20
#: The session's bound on the bytes of an Arrow batch; without one a batch has 10,000 rows of any size.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` written to the shared work folder and read again: computed once, and safe when executors are lost."""
    path = work_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def runs(batch: pa.RecordBatch, most: int | None) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about ``most`` bytes; a longer row is a run of its own. None: all at once."""
    rows = batch.num_rows if most is None else max(1, batch.num_rows * most // max(batch.nbytes, 1))
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, max(rows, 1)))


def bound_batches(spark: SparkSession, most: int | None) -> None:
    """From here on the session's Arrow batches have about ``most`` bytes, unless it has a bound of its own.

    A batch is held by the executor and by the Python worker, on the way in and out, for each task at work.
    """
    if most is not None and spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, str(most))


def map_batches(
    frame: DataFrame, make: Callable[[], Callable[[dict], Iterable[dict]]], ddl: str, most: int | None = None
) -> DataFrame:
    """Map Arrow batches: ``make()`` runs once a task and gives a function from a batch's columns to dicts of columns.

    A batch arrives as lists by column name; each dict that comes back is one output batch. ``most`` bounds the bytes
    of a batch.
    """
    schema = schema_of(ddl)
    bound_batches(frame.sparkSession, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, arrow = make(), to_arrow_schema(schema)
        for batch in (part for whole in batches for part in runs(whole, most)):
            for out in step(batch.to_pydict()):
                arrays = [pa.array(out[f.name], type=f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)
        # The worker waits for its next task without the room of this one.
        pa.default_memory_pool().release_unused()

    return frame.mapInArrow(run, schema)


def ranked(rows: DataFrame, keys: list[str], order: list[str], cells: int = 1024, name: str = "rank") -> DataFrame:
    """Number the rows of each key from 0, in any but a fixed order, without gathering a key in one task.

    A key's rows are dealt to ``cells`` by a hash of ``order``; the counts of the cells, a small table, give each cell
    its first number, and rows are numbered inside their cell only. So a key with a third of all rows is split.
    """
    dealt = rows.withColumn("_cell", F.pmod(F.xxhash64(*order), F.lit(cells)))
    counts = dealt.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*keys, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy(*keys, "_cell").orderBy(*order)
    number = F.col("_first") + F.row_number().over(inside) - 1
    return dealt.join(first, [*keys, "_cell"]).withColumn(name, number.cast("long")).drop("_cell", "_first")


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def map_groups(frame: DataFrame, keys: list[str], step: Callable[[dict], dict | None], ddl: str) -> DataFrame:
    """Map each group of rows with equal keys, by sorted runs inside partitions; groups must have a bounded size.

    ``step`` takes a group's columns (lists) and gives columns for the output, or None. Results of a batch go out together.
    """
    schema, columns = schema_of(ddl), frame.columns
    bound_batches(frame.sparkSession, BATCH_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        open_key, held = None, {c: [] for c in columns}
        out: dict[str, list] = {f.name: [] for f in arrow}

        def close() -> None:
            if held[columns[0]] and (made := step(held)):
                for name, values in made.items():
                    out[name].extend(values)

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)
            for values in out.values():
                values.clear()
            return batch

        for batch in (part for whole in batches for part in runs(whole, BATCH_BYTES)):
            data = batch.to_pydict()
            row_keys = list(zip(*(data[k] for k in keys), strict=True))
            at = 0
            while at < len(row_keys):
                end = at + 1
                while end < len(row_keys) and row_keys[end] == row_keys[at]:
                    end += 1
                if row_keys[at] != open_key:
                    close()
                    open_key, held = row_keys[at], {c: [] for c in columns}
                for c in columns:
                    held[c] += data[c][at:end]
                at = end
            if out[arrow.names[0]]:
                yield flush()
        close()
        if out[arrow.names[0]]:
            yield flush()
        pa.default_memory_pool().release_unused()

    return frame.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)

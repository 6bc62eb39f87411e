"""Longest-processing-time sharding: groups of equal texts, by falling size, go to the least-loaded shard.

A heap holds the loads. Groups of at least one part in ``shards * fine`` of all bytes go through it one by one; as sizes
add up to the total, there are at most ``shards * fine`` of them, so that table has a fixed bound. Smaller ones come after
them in the order anyway. They are counted in size classes, each about 1/64 wide: the heap deals a class's groups by
their mean size, and Spark gives each group its shard by its rank in the class. So the driver's work doesn't grow with
the number of documents, and loads differ by what the widths of the classes leave.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billweave.llm.common import ranked, stored, utf8_bytes

WIDTH = 64


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the group's key. Null texts stand with empty ones."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (utf8_bytes(F.col("text")) + 8).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("group_key"),
    )


def deal_class(heap: list[tuple[float, int]], count: int, size: float) -> list[tuple[int, int]]:
    """Put ``count`` groups of one size on the least-loaded shards; how many go to each (shard, groups).

    All but the last few are dealt at once: as many to each shard as keep it below the level that they fill together.
    """
    loads, shards = np.array([x for x, _ in heap]), [s for _, s in heap]
    dealt = np.zeros(len(heap), dtype=np.int64)
    if count > 2 * len(heap):
        order = np.sort(loads)
        filled = np.arange(1, len(order) + 1) * order - np.cumsum(order)  # bytes that lift the first k loads to load k
        k = int(np.searchsorted(filled, count * size, side="right"))
        level = (count * size + order[:k].sum()) / k
        dealt = np.maximum(0, np.floor((level - loads) / size) - 1).astype(np.int64)
    heap[:] = [(float(x + n * size), s) for x, n, s in zip(loads, dealt, shards, strict=True)]
    heapq.heapify(heap)
    total = dict(zip(shards, dealt.tolist(), strict=True))
    for _ in range(count - int(dealt.sum())):
        load, shard = heapq.heappop(heap)
        total[shard] += 1
        heapq.heappush(heap, (load + size, shard))
    return [(s, n) for s, n in sorted(total.items()) if n]


def shards_of_groups(groups: DataFrame, shards: int = 24, fine: int = 1024) -> DataFrame:
    """``groups(group_key, bytes)`` with their ``shard``."""
    spark = groups.sparkSession
    total = groups.agg(F.sum("bytes").alias("b")).first()["b"] or 0
    least = max(1, -(-total // (shards * fine)))
    heap: list[tuple[float, int]] = [(0.0, s) for s in range(shards)]
    single = []
    for row in sorted(groups.filter(F.col("bytes") >= least).collect(), key=lambda r: (-r["bytes"], bytes(r["group_key"]))):
        load, shard = heapq.heappop(heap)
        single.append((bytes(row["group_key"]), shard))
        heapq.heappush(heap, (load + row["bytes"], shard))
    small = groups.filter(F.col("bytes") < least).withColumn("size_class", F.floor(F.log("bytes") * WIDTH).cast("long"))
    classes = small.groupBy("size_class").agg(F.count(F.lit(1)).alias("n"), F.avg("bytes").alias("mean")).collect()
    runs = []
    for row in sorted(classes, key=lambda r: -r["size_class"]):
        first = 0
        for shard, n in deal_class(heap, row["n"], row["mean"]):
            runs.append((row["size_class"], first, first + n, shard))
            first += n
    # Bounded tables: at most shards * fine groups, and shards runs for each of at most 64 * ln(total) classes.
    large = spark.createDataFrame(single, "group_key binary, shard int")
    run_table = spark.createDataFrame(runs, "size_class long, first long, last long, shard int")
    placed = ranked(small, ["size_class"], ["group_key"]).join(F.broadcast(run_table), "size_class")
    placed = placed.filter((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    return placed.select("group_key", "shard").unionByName(large)


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of ``docs(doc_id, text)``; equal texts share a shard.

    A group larger than a fair share fills a shard by itself. Repeated rows get slots of their own.
    """
    rows = stored(sized(docs), "sized")
    groups = stored(rows.groupBy("group_key").agg(F.sum("size").alias("bytes")), "groups")
    placed = stored(shards_of_groups(groups, shards), "placed")
    # Both sides come from tables, so adaptive execution may split a group that holds many rows.
    dealt = rows.join(placed, "group_key").drop("group_key")
    return ranked(stored(dealt, "dealt"), ["shard"], ["doc_id"], name="slot")

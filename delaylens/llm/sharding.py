"""Shards of near-equal size by longest-processing-time scheduling of groups.

A group's rows stay together. Each task schedules the groups of its hash partition,
largest first, through a heap of bins (a fixed number per shard); the bins of all
tasks, again largest first, go to the least-loaded shard through a heap. No group or
row passes through the driver, only one load per task and bin.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import numbered, staged, text_bytes

BINS_PER_SHARD, BINS_OF_A_SHARD = 4, 256


def least_loaded(loads: list[int], bins: int) -> list[int]:
    """Bin of each load: the least loaded so far, the lowest number among equals."""
    heap = [(0, i) for i in range(bins)]
    places = []
    for load in loads:
        total, place = heap[0]
        places.append(place)
        heapq.heapreplace(heap, (total + load, place))
    return places


def _schedule_partition(bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        heap = [(0, i) for i in range(bins)]
        for batch in batches:
            places = []
            for load in batch.column("load").to_pylist():
                total, place = heap[0]
                places.append(place)
                heapq.heapreplace(heap, (total + load, place))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("group"),
                    batch.column("load"),
                    pa.array([task] * batch.num_rows, pa.int32()),
                    pa.array(places, pa.int32()),
                ],
                names=["group", "load", "task", "bin"],
            )

    return run


def assign(rows: DataFrame, shards: int, group: str = "group", size: str = "size") -> DataFrame:
    """Add ``shard``; rows with equal ``group`` share one. Groups and sizes must not be null.

    An empty table gives an empty result. Equal loads are ordered by group, so reruns
    agree; one group larger than a fair share fills its shard alone as far as possible.
    """
    spark = rows.sparkSession
    loads = rows.groupBy(F.col(group).alias("group")).agg(F.sum(size).cast("long").alias("load"))
    # a shard is made of this many bins, or of a few from each task, so that bins are small beside it
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bins_per_shard = max(BINS_PER_SHARD, -(-BINS_OF_A_SHARD // tasks))
    # by another hash than the aggregation's: Spark drops a like one, then may merge all groups into one task
    ordered = loads.repartition(tasks, F.xxhash64("group")).sortWithinPartitions(F.desc("load"), "group")
    kind = dict(rows.dtypes)[group]
    schedule = _schedule_partition(shards * bins_per_shard)
    placed = staged(ordered.mapInArrow(schedule, f"group {kind}, load long, task int, bin int"), "groups")
    bins = sorted(
        placed.groupBy("task", "bin").agg(F.sum("load").alias("load")).collect(),
        key=lambda b: (-b["load"], b["task"], b["bin"]),
    )
    chosen = least_loaded([b["load"] for b in bins], shards)
    homes = spark.createDataFrame(
        [(b["task"], b["bin"], s) for b, s in zip(bins, chosen)], "task int, bin int, shard int"
    )
    home_of = placed.join(F.broadcast(homes), ["task", "bin"]).select(F.col("group").alias(group), "shard")
    return rows.join(home_of, group)


def shard_texts(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Shard, slot and size of each row; equal texts stay together.

    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32, shard, slot (0, 1, ... in the
    shard). A null text has no bytes and goes with empty texts; null and repeated ids are
    kept row by row; other columns are ignored; an empty table gives no rows.
    """
    raw = text_bytes(F.col(text))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.unhex(F.sha2(raw, 256)).alias("group"),
    )
    placed = assign(staged(rows, "sizes"), shards)
    return numbered(placed, "shard", ["doc_id", "group"], "slot").drop("group")

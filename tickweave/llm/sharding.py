"""Groups that must stay together, dealt to shards of near-equal bytes.

Longest-processing-time scheduling: groups, largest first, each go to the least-loaded shard,
which a heap names. Groups of one size are alike to the heap, so it works on classes: the
sizes and how many groups have each. A class of many groups first fills, in one step, every
shard to the level below which all its starts come, and the heap deals the few that are
left; the counts are those that popping group by group would give. Only the classes reach the
driver. Distinct sizes are few: D of them need D * (D + 1) / 2 bytes at least, 14 million
at 100 TB, and texts of real corpora have far fewer.

Rows are placed by Spark: groups get their place inside their class from a range-partitioned
rank, rows their slot inside their shard from another. No group, class or shard is one task.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.operators.ranking import global_rank

from .common import materialise


def place(loads: list[int], size: int, n: int) -> list[int]:
    """How many of ``n`` groups of one size each shard takes, least-loaded first, ties to the smaller shard."""
    counts = [0] * len(loads)
    if n > 2 * len(loads):
        def below(level: int) -> list[int]:
            return [max(0, -(-(level - load) // size)) for load in loads]

        lo, hi = min(loads), max(loads) + size * (n // len(loads) + 2)
        while hi - lo > 1:  # the highest level with at most n starts below it
            level = (lo + hi) // 2
            lo, hi = (level, hi) if sum(below(level)) <= n else (lo, level)
        counts = below(lo)
    heap = [(load + c * size, j) for j, (load, c) in enumerate(zip(loads, counts, strict=True))]
    heapq.heapify(heap)
    for _ in range(n - sum(counts)):
        load, j = heap[0]
        counts[j] += 1
        heapq.heapreplace(heap, (load + size, j))
    return counts


def schedule(sizes: np.ndarray, groups: np.ndarray, shards: int) -> tuple[np.ndarray, list[int]]:
    """Per class (largest size first) the running counts of its groups by shard, and the loads."""
    loads = [0] * shards
    ends = np.zeros((len(sizes), shards), np.int64)
    for i, (size, n) in enumerate(zip(sizes.tolist(), groups.tolist(), strict=True)):
        counts = place(loads, size, n)
        loads = [load + size * c for load, c in zip(loads, counts, strict=True)]
        ends[i] = np.cumsum(counts)
    return ends, loads


def assign(rows: DataFrame, group: list[str], size: str, shards: int) -> DataFrame:
    """``rows`` with ``shard`` (int): rows equal in ``group`` stay together, sums of ``size`` are near equal.

    ``size`` is a positive long, the columns of ``group`` hold no nulls. Within a class, groups
    go to the shards in the order of their columns, so reruns agree.
    """
    spark = rows.sparkSession
    groups = materialise(rows.groupBy(*group).agg(F.sum(size).alias("load")))
    classes = groups.groupBy("load").agg(F.count("*").alias("n")).toPandas().sort_values("load", ascending=False)
    if not len(classes):
        return rows.withColumn("shard", F.lit(0))
    counts = classes["n"].to_numpy(np.int64)
    ends, _ = schedule(classes["load"].to_numpy(np.int64), counts, shards)
    ends = pa.ListArray.from_arrays(pa.array(np.arange(len(ends) + 1, dtype=np.int32) * shards), pa.array(ends.reshape(-1)))
    first = np.cumsum(counts) - counts + 1
    plan = spark.createDataFrame(pa.table({"load": classes["load"].to_numpy(np.int64), "first": first, "ends": ends}))
    placed = global_rank(groups, [F.col("load").desc(), *map(F.col, group)], "at")
    place_in_class = F.col("at") - F.col("first")
    shard = F.size(F.filter("ends", lambda e: e <= place_in_class)).cast("int")
    placed = placed.join(plan, "load").select(*group, shard.alias("shard"))
    return rows.join(placed, group)


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot): every document's shard, and its place there from 0.

    Size is the text's UTF-8 bytes plus one. Equal texts are a group; one that is larger than
    an even share has a shard of that size, as it stays together. Groups are told apart by a 64-bit
    hash, CRC and size, so two texts that agree in all three would share a shard, which
    breaks no promise. Slots follow the id.

    A null text is a group of its own (size 1, CRC 0), apart from the empty text. Null and repeated
    ids and repeated rows all get slots; an empty table gives no rows; other columns are not
    looked at. A text of any length is only hashed, never moved.
    """
    text = F.col(text_col)
    raw = F.coalesce(text.cast("binary"), F.lit(b""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.when(text.isNull(), F.lit(0)).otherwise(F.xxhash64(text)).alias("hash"),
        # Rows alike in all columns would be one key of the range partitioning below.
        F.monotonically_increasing_id().alias("row"),
    )
    placed = assign(materialise(rows), ["text_crc32", "size", "hash"], "size", shards)
    ranked = global_rank(placed, [F.col("shard"), F.col("id").asc_nulls_last(), F.col("hash"), F.col("row")], "at")
    starts = ranked.groupBy("shard").agg(F.min("at").alias("start"))
    return ranked.join(F.broadcast(starts), "shard").select("id", "size", "text_crc32", "shard", (F.col("at") - F.col("start")).alias("slot"))

"""Byte-balanced sharding by Karmarkar-Karp differencing of indivisible groups.

Rows with equal texts form a group that must stay together. Differencing works
at two levels, so that no task and not the driver sees all groups: each task
keeps its largest groups as they are and differences the others into bins of
evenly rising loads, and the bins of all tasks, whose number is bounded by a
parameter, are differenced into shards on the driver. A task's groups are not
cut into equal parts for the shards: a group that is large beside a task's
share of a shard, but not beside the shard, could not be evened out any more.
Rows are then joined to their group's bin and to the bin's shard.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendspark.llm.common import mapped, saved, spread, text_or_empty


def difference(loads: list[int], ways: int, start: np.ndarray | None = None) -> np.ndarray:
    """The part (0 to ``ways - 1``) of each item, by k-way largest differencing.

    Every item starts as a partial partition that has it in one part and
    nothing in the others; ``start`` is one more, what the parts hold before.
    The two partial partitions with the largest spread are combined again and
    again, the fullest part of one with the emptiest of the other. Ties go by
    the item's place, so the result is determined.
    """
    n = len(loads)
    out = np.zeros(n, np.int64)
    if n == 0 or ways == 1:
        return out
    held = np.zeros(ways, np.int64) if start is None else np.asarray(start, np.int64)
    names = np.argsort(held, kind="stable")
    # partial partitions by node: items, then what is held, then the joins; parts' loads in ascending order
    sums: dict[int, np.ndarray] = {n: held[names]}
    heap = [(-int(x), i) for i, x in enumerate(loads)] + [(-int(held.max() - held.min()), n)]
    heapq.heapify(heap)
    joins: list[tuple[int, int, np.ndarray]] = []  # of node n + 1 + j: its two nodes, and how the parts were reordered

    def parts(node: int) -> np.ndarray:
        if node < n:
            one = np.zeros(ways, np.int64)
            one[-1] = loads[node]
            return one
        return sums.pop(node)

    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = parts(a) + parts(b)[::-1]
        order = np.argsort(both, kind="stable")
        both = both[order]
        node = n + 1 + len(joins)
        joins.append((a, b, order.astype(np.int32)))
        sums[node] = both
        heapq.heappush(heap, (-int(both[-1] - both[0]), node))
    # downwards: which final part each node's parts belong to
    final = {n + len(joins): np.arange(ways)}
    for j in range(len(joins) - 1, -1, -1):
        a, b, order = joins[j]
        where = np.empty(ways, np.int64)
        where[order] = final.pop(n + 1 + j)
        for node, parts_of in ((a, where), (b, where[::-1])):
            if node < n:
                out[node] = parts_of[-1]
            else:
                final[node] = parts_of
    name = np.empty(ways, np.int64)
    name[final[n]] = names
    return name[out]


def binned_groups(loads: np.ndarray, singles: int, ways: int) -> np.ndarray:
    """The bin of each group of a task, of loads in descending order.

    The ``singles`` largest have a bin each. The others are differenced into
    ``ways`` bins whose loads rise evenly from almost nothing: shards that are
    made of bins of many sizes can be evened out, which equal bins cannot. No
    more groups than bins: each has its own. Differenced in runs, each from
    what the bins hold after the one before, so memory is bounded.
    """
    n = len(loads)
    if n <= singles + ways:
        return np.arange(n)
    out = np.arange(n)
    rest = loads[singles:]
    rising = np.arange(1, ways + 1) * (2 * float(rest.sum()) / (ways * (ways + 1)))
    held = np.round(rising[-1] - rising).astype(np.int64)
    step = max(ways, (1 << 22) // ways)
    for i in range(0, len(rest), step):
        run = rest[i:i + step]
        part = difference(run.tolist(), ways, held)
        np.add.at(held, part, run)
        out[singles + i:singles + i + len(run)] = singles + part
    return out


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16,
                    most_bins: int = 16_384) -> DataFrame:
    """Every row with its shard under the law ``bytes``: shard sizes as near equal as the groups allow.

    A row's size is its UTF-8 bytes (null text: none) plus ``overhead``. Null
    and empty texts are one group. A group larger than a shard's fair share
    gets a shard to itself. ``most_bins`` bounds what reaches the driver, one
    number for each bin, but each task has ``shards + 1`` bins at least. Returns ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard`` for every row (also those with a null or repeated id); slots
    count from 0 in each shard without gaps. An empty table gives no rows.
    """
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", (F.octet_length("text") + F.lit(overhead)).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"), F.unhex(F.md5("text")).alias("same"))
    rows = saved(rows, "shard-rows")
    groups = rows.groupBy("same", "size").agg(F.count("*").alias("n"))
    # a fixed number of tasks: were they coalesced, there would be too few bins (by other columns than the groups, or Spark leaves it out)
    tasks = spread(docs)
    singles = max(1, most_bins // (2 * tasks))
    ways = max(shards, min(1024, singles))

    def local(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        whole = pa.Table.from_batches(batches).sort_by([("n", "descending"), ("same", "ascending"), ("size", "ascending")])
        loads = np.asarray(whole.column("size")) * np.asarray(whole.column("n"))
        order = np.argsort(-loads, kind="stable")
        part = np.empty(len(loads), np.int64)
        part[order] = binned_groups(loads[order], singles, ways)
        task = TaskContext.get().partitionId()
        out = pa.table({"same": whole.column("same"), "size": whole.column("size"), "load": pa.array(loads, pa.int64()),
                        "task": pa.array(np.full(len(part), task), pa.int32()), "bin": pa.array(part, pa.int32())})
        yield from out.to_batches()

    binned = saved(mapped(groups.repartition(tasks, "same"), local, "same binary, size long, load long, task int, bin int"), "shard-bins")
    loads = binned.groupBy("task", "bin").agg(F.sum("load").alias("load")).toPandas().sort_values(["task", "bin"])
    loads["shard"] = difference(loads["load"].tolist(), shards)
    spark = docs.sparkSession
    places = spark.createDataFrame(loads[["task", "bin", "shard"]].astype({"shard": "int32"}), "task int, bin int, shard int")
    of_group = binned.join(F.broadcast(places), ["task", "bin"]).select("same", "size", "shard")

    def number(batches):
        task, seen = TaskContext.get().partitionId(), np.zeros(shards, np.int64)
        for batch in batches:
            shard = np.asarray(batch.column("shard"))
            order = np.argsort(shard, kind="stable")
            counts = np.bincount(shard, minlength=shards)
            begins = np.cumsum(counts) - counts
            place = np.empty(len(shard), np.int64)
            place[order] = np.arange(len(shard)) - np.repeat(begins - seen, counts)
            seen += counts
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(shard), task), pa.int32()), pa.array(place, pa.int64())],
                                             ["doc_id", "size", "text_crc32", "shard", "task", "place"])

    placed = rows.join(of_group, ["same", "size"]).select("doc_id", "size", "text_crc32", "shard")
    placed = saved(mapped(placed, number, "doc_id long, size long, text_crc32 long, shard int, task int, place long"), "shard-places")
    # one row for each task and shard: where the task's rows begin
    counted = placed.groupBy("shard", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = counted.select("shard", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    return placed.join(begins, ["shard", "task"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("begin") + F.col("place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))

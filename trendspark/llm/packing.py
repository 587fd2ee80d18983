"""Best-fit packing of token sequences by bulk-synchronous sweeps.

All pieces of one length are alike, and so are all sequences with one gap, so
a sweep works on runs of equal pieces and equal gaps. In each round the pieces
and the open gaps are sorted by size together and swept from the largest down:
a piece takes the smallest gap that holds it, which in that order is the gap
seen last (brackets that match). Pieces that want the same gap are resolved by
rank: the larger piece first, then the lower place among its equals; the others
go on to the next larger gap. Gaps are updated after the sweep and the rest of
the pieces is swept again in the next round, until nothing more fits; then the
largest pieces that are left open new sequences.

There are at most ``capacity`` lengths and ``capacity`` gaps, so the runs of a
sweep are bounded by the capacity and not by the data; what the data decide
(lengths, ranks among equals, places in the sequences) is computed by Spark
over all rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendspark.llm.bpe import encoder
from trendspark.llm.common import mapped, saved, text_or_empty

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, place long"
NAMES = [c.split()[0] for c in PIECES.split(", ")]


def cut_documents(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = 1024, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, task, place)``: every text's ids and ``end_id``, cut only if longer than ``capacity``.

    The first piece of a longer document takes what is over, all others are
    full. A null text is the empty text and gives one piece of length 1.
    ``place`` counts the pieces of one length in a task from 0.
    """
    tail = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        own = encoder(vocabulary, fast=True)
        task, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            out: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), own.encode(batch.column(1).to_pylist())):
                packed = ids.tobytes() + tail
                total = len(packed) // 4
                start, piece = 0, 0
                length = (total - 1) % capacity + 1
                while start < total:
                    out.append((doc, piece, start, length, zlib.crc32(packed[4 * start:4 * (start + length)]), task, seen[length]))
                    seen[length] += 1
                    start, piece, length = start + length, piece + 1, capacity
            columns = list(zip(*out)) or [()] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], NAMES)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return mapped(rows, cut, PIECES)


def match(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Packs ``counts[length]`` pieces of each length; ``(length, rank, n, sequence, offset)`` for runs of equals.

    The pieces of ``length`` with ranks ``rank`` to ``rank + n - 1`` go to the
    sequences ``sequence`` to ``sequence + n - 1``, all at ``offset``.
    """
    left = {s: n for s, n in counts.items() if n}
    rank = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, number)
    plan, opened = [], 0

    def place(size: int, n: int, sequence: int, gap: int, to: dict) -> None:
        plan.append((size, rank[size], n, sequence, capacity - gap))
        rank[size] += n
        left[size] -= n
        if gap > size:
            to.setdefault(gap - size, []).append((sequence, n))

    while any(left.values()):
        # one sweep: every gap takes at most one piece
        stack: list[tuple[int, int, int]] = []
        later: dict[int, list[tuple[int, int]]] = {}
        before = len(plan)
        for size in sorted({*gaps, *left}, reverse=True):
            stack += [(size, *run) for run in gaps.get(size, ())]
            while stack and left.get(size, 0):
                gap, sequence, n = stack.pop()
                used = min(n, left[size])
                if used < n:
                    stack.append((gap, sequence + used, n - used))
                place(size, used, sequence, gap, later)
        for gap, sequence, n in stack:
            later.setdefault(gap, []).append((sequence, n))
        gaps = later
        if len(plan) > before:
            continue
        # nothing fits: pieces over half the capacity need sequences of their own; else no more than the rest's volume asks for
        room = sum(n for s, n in left.items() if 2 * s > capacity) or -(-sum(s * n for s, n in left.items()) // capacity)
        for size in sorted(left, reverse=True):
            if n := min(room, left[size]):
                place(size, n, opened, capacity, gaps)
                opened, room = opened + n, room - n
    return plan


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = 1024, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Every piece of every document with its sequence and offset.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.
    Texts of null or repeated id are packed like any other; equal lengths are
    ranked by the place in their task. An empty table gives no rows.
    """
    pieces = saved(cut_documents(docs, vocabulary, end_id, capacity, id_col, text_col), "pieces")
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    plan = match(counts, capacity)
    spark = docs.sparkSession
    runs = spark.createDataFrame([(a, b, b + n, c, d) for a, b, n, c, d in plan],
                                 "length int, low long, high long, sequence long, offset long")
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = by_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    ranked = pieces.join(begins, ["length", "task"]).withColumn("rank", F.col("begin") + F.col("place"))
    # runs: a few for each length, whatever the size of the data
    return ranked.join(F.broadcast(runs), (ranked["length"] == runs["length"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))).select(
        "doc_id", "piece", "start", ranked["length"].cast("long").alias("length"), "ids_crc32",
        (F.col("sequence") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset")

"""MinHash fingerprints of documents, and near pairs by bands of signatures."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendspark.llm.common import mapped, saved, spread, text_or_empty
from trendspark.llm.shingles import shingle_hashes, word_hashes

#: Universal hash permutations of a signature: (a * x + b) mod 2**32 with odd a.
PERMUTATIONS = 128
_rng = np.random.default_rng(7919)
_A = (_rng.integers(0, 2**32, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _rng.integers(0, 2**32, PERMUTATIONS, dtype=np.uint64).astype(np.uint32)


def signature(shingles: np.ndarray, block: int = 1024) -> np.ndarray:
    """The upper 16 bits of each permutation's minimum over the shingles; all ones for no shingle."""
    low = np.full(PERMUTATIONS, 2**32 - 1, np.uint32)
    points = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(points), block):  # blocks that stay in the cache
        x = np.multiply.outer(_A, points[i:i + block])
        x += _B[:, None]
        np.minimum(low, x.min(axis=1), out=low)
    return (low >> np.uint32(16)).astype(">u2")


def fingerprint(text: str, width: int = 5) -> np.ndarray:
    """Signature of a text's shingles of ``width`` words. Equal texts have equal ones."""
    return signature(shingle_hashes(word_hashes(text.encode()), width))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal coordinates, an estimate of the Jaccard similarity of the shingle sets."""
    return float(np.count_nonzero(a == b)) / PERMUTATIONS


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """``(doc_id, fingerprint)`` of every whole text; null is the empty text. Nothing is shuffled."""
    def run(batches):
        for batch in batches:
            marks = [fingerprint(x, width).tobytes().hex() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.string())], ["doc_id", "fingerprint"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return mapped(rows, run, "doc_id long, fingerprint string")


def near_pairs(docs: DataFrame, threshold: float = 0.8, rows_per_band: int = 4, id_col: str = "doc_id", text_col: str = "text",
               width: int = 5) -> DataFrame:
    """``(doc_id, other_id, jaccard)``: verified near copies, ``other_id`` the smaller.

    One row for each pair of different texts that agree in a band and whose
    full shingle sets have the Jaccard similarity, under each text's smallest
    id, and one row that links each further copy of a text to that id. All
    texts of a group of equal bands are compared, so pairs grow with the square
    of the different texts in a group; copies add none. Rows with a null id and
    texts without words take no part.
    """
    digits = 4 * rows_per_band
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("same", F.unhex(F.md5("text")))
    texts = rows.groupBy("same").agg(F.min("doc_id").alias("doc_id"), F.any_value("text").alias("text"))
    texts = saved(texts.withColumn("node", F.monotonically_increasing_id()), "different-texts")
    marks = saved(fingerprints(texts, "node", "text", width).where(F.col("fingerprint") != "f" * (4 * PERMUTATIONS)), "fingerprints")
    bands = marks.select(F.col("doc_id").alias("node"), F.posexplode(F.expr(
        f"transform(sequence(0, {PERMUTATIONS // rows_per_band - 1}), i -> substr(fingerprint, i * {digits} + 1, {digits}))")).alias("band", "value"))
    pairs = bands.join(bands.withColumnRenamed("node", "other"), ["band", "value"]).where("node < other").select("node", "other").distinct()
    pairs = saved(pairs, "band-pairs")

    def sets(batches):
        for batch in batches:
            found = [np.unique(shingle_hashes(word_hashes(x.encode()), width)).view(np.int64) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["node", "shingles"])

    wanted = pairs.select("node").union(pairs.select("other")).distinct()
    full = mapped(texts.join(wanted, "node", "left_semi").select("node", "text"), sets, "node long, shingles array<long>")
    full = full.join(texts.select("node", "doc_id"), "node")
    both = pairs.join(full, "node").join(full.select(F.col("node").alias("other"), F.col("doc_id").alias("other_id"), F.col("shingles").alias("others")),
                                         "other")
    common = F.size(F.array_intersect("shingles", "others"))
    union = F.size("shingles") + F.size("others") - common
    near = both.where("doc_id != other_id").select(F.greatest("doc_id", "other_id").alias("doc_id"), F.least("doc_id", "other_id").alias("other_id"),
                                                   (common / union).alias("jaccard")).where(F.col("jaccard") >= threshold)
    worded = texts.join(marks.select(F.col("doc_id").alias("node")), "node", "left_semi").select("same", F.col("doc_id").alias("other_id"))
    copies = rows.select("doc_id", "same").join(worded, "same").where("doc_id != other_id").select("doc_id", "other_id", F.lit(1.0).alias("jaccard"))
    return near.union(copies.distinct())


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


RESULT = ("doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, "
          "part int, edge string, edge_text string")
NAMES = [c.split()[0] for c in RESULT.split(", ")]
KINDS = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]


def _compared(text: str, mark: np.ndarray, following: str, next_mark: np.ndarray, width: int) -> tuple:
    edited = _edited(text, following)
    edited_mark = fingerprint(edited, width)
    return (len(text), hashlib.sha256(edited.encode()).digest(), mark.tobytes(), edited_mark.tobytes(),
            likeness(mark, edited_mark), likeness(mark, next_mark))


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """Every document's fingerprint against its half-replaced text's and the next document's.

    The texts are shuffled once, into ranges of ids that are sorted. Within a
    range each row sees the next one; the first and last texts of the ranges
    (two for each partition) are matched afterwards. The order is by id, null
    first, and by text among equal ids; after the last row comes the first.
    Null texts are empty. One row alone follows itself; no rows give none.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    ordered = rows.repartitionByRange(spread(docs), "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        part, held = TaskContext.get().partitionId(), None
        blank = (None,) * 6
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                mark = fingerprint(text, width)
                if held is None:
                    out.append((doc, *blank, part, "first", text))
                else:
                    out.append((held[0], *_compared(held[1], held[2], text, mark, width), None, None, None))
                held = doc, text, mark
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), KINDS)], NAMES)
        if held is not None:
            out = [(held[0], *blank, part, "last", held[1])]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), KINDS)], NAMES)

    found = saved(mapped(ordered, run, RESULT), "fingerprint-rows")
    edges = found.where("edge is not null").select("doc_id", "part", "edge", F.col("edge_text").alias("text"))
    firsts = edges.where("edge = 'first'").select("part", F.col("text").alias("following"))
    # one row for each range that has rows; ids of ranges only
    in_turn = Window.orderBy("part")
    turn = firsts.select("part").select("part", F.coalesce(F.lead("part").over(in_turn), F.min("part").over(Window.partitionBy(F.lit(1)))).alias("next_part"))
    lasts = edges.where("edge = 'last'").join(turn, "part").join(firsts.withColumnRenamed("part", "next_part"), "next_part")

    def resolve(batches):
        for batch in batches:
            out = [(doc, *_compared(text, fingerprint(text, width), following, fingerprint(following, width), width))
                   for doc, text, following in zip(*(batch.column(i).to_pylist() for i in range(3)))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), KINDS)], NAMES[:7])

    resolved = mapped(lasts.select("doc_id", "text", "following"), resolve, ", ".join(RESULT.split(", ")[:7]))
    whole = found.where("edge is null").select(*NAMES[:7]).unionByName(resolved)
    return whole.withColumns({c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")})

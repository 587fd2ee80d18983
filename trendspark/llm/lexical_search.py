"""Ranked lexical search by range-maximum queries on posting lists.

Documents are cut into blocks (a few thousand consecutive ids of a task), so a
common term's postings are spread over all tasks. In a block each posting list
has a sparse table of range maxima. An interval of documents is bounded by the
sum of its terms' range maxima; of the best intervals each is split at a
document of maximum impact, which is scored exactly, and the two remaining
parts are bounded anew. An interval whose bound can't reach the item's present
last place is dropped, so the search ends with the exact ranking of the block.
The best of each block meet in Spark, pre-ranked in salted groups.

Weights need the corpus's counts, which a pass over all documents gathers first.
Items are taken in blocks of bounded size; a block's terms go to all tasks.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendspark.llm.common import mapped, saved, text_or_empty

#: Bytes of terms: letters (A-Z folded), digits, and all bytes of characters beyond ASCII; others separate.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_POSTINGS = "doc_id long, n long, terms binary, counts binary"
_RANKED = "item int, doc_id long, score long"
#: Documents of a block: a posting's impact (below 2**20) and its place (12 bits) fit 32 bits.
_BLOCK = 1 << 12


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def _item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """Lists of ``(item_id, Counter of terms)`` with at most ``block_bytes`` bytes of text (or one item)."""
    block, size = [], 0
    for r in items.select(F.col(id_col).alias("item"), text_or_empty(text_col).cast("binary").alias("text")).toLocalIterator():
        if block and size + len(r["text"]) > block_bytes:
            yield block
            block, size = [], 0
        block.append((r["item"], Counter(terms(bytes(r["text"])))))
        size += len(r["text"])
    if block:
        yield block


def _postings(docs: DataFrame, vocabulary, id_col: str, text_col: str) -> DataFrame:
    """One row for each document: its number of terms, and the numbers and counts of those in the vocabulary."""
    def run(batches):
        index = vocabulary.value
        for batch in batches:
            n, found, counts = [], [], []
            for text in batch.column(1).to_pylist():
                words = terms(text)
                tf = Counter(words)
                own = sorted((index[w], tf[w]) for w in tf.keys() & index.keys())
                n.append(len(words))
                found.append(np.array([t for t, _ in own], "<i4").tobytes())
                counts.append(np.array([c for _, c in own], "<i8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(found, pa.binary()), pa.array(counts, pa.binary())],
                                             ["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("text"))
    return mapped(rows, run, _POSTINGS)


def _statistics(postings: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms, and each vocabulary term's documents."""
    def run(batches):
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            df += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4"), minlength=n_terms)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at])], ["term", "df"])

    total = postings.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    out = np.zeros(n_terms, np.int64)
    for r in mapped(postings.select("terms"), run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return total["docs"], total["terms"], out


class _Block:
    """Posting lists of up to 4096 documents, in order of their ids, with a sparse table of maxima for each list."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, found: list[bytes], counts: list[bytes], documents: int, length_sum: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.n = ids[order], len(ids)
        sizes = np.array([len(found[i]) // 4 for i in order])
        term = np.frombuffer(b"".join([found[i] for i in order]), "<i4")
        tf = np.frombuffer(b"".join([counts[i] for i in order]), "<i8")
        place = np.repeat(np.arange(self.n), sizes)
        n, length_sum = lengths[order], max(length_sum, 1)
        if 25 * int(n.max(initial=0)) * documents < 2**62:
            m = 100 - 25 + (25 * n * documents) // length_sum
        else:  # the product needs more than 64 bits, the quotient does not
            m = np.array([100 - 25 + 25 * x * documents // length_sum for x in n.tolist()], np.int64)
        impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[place])
        at = np.argsort(term, kind="stable")
        term, place = term[at], place[at]
        # a posting: its impact above, its place in the low 12 bits; a maximum tells where it is
        self.tables = [(impact[at].astype(np.uint32) << 12) | place.astype(np.uint32)]
        self.terms, first, size = np.unique(term, return_index=True, return_counts=True)
        self.row = {t: i for i, t in enumerate(self.terms.tolist())}
        step = 1
        while 2 * step <= (size.max() if len(size) else 0):
            # maxima of 2 * step postings from each on; those that cross into the next list are never asked for
            last = self.tables[-1]
            wider = last.copy()
            np.maximum(last[:-step], last[step:], out=wider[:-step])
            self.tables.append(wider)
            step *= 2
        # postings of each list before each document
        self.before = np.zeros((len(self.terms), self.n + 1), np.int32)
        np.add.at(self.before, (np.repeat(np.arange(len(self.terms)), size), place + 1), 1)
        np.cumsum(self.before, axis=1, out=self.before)
        self.before += first[:, None].astype(np.int32)
        self.levels = np.zeros(self.n + 2, np.int8)
        for i in range(2, self.n + 2):
            self.levels[i] = self.levels[i // 2] + 1
        self.tables = np.stack(self.tables) if len(term) else np.zeros((1, 1), np.uint32)

    def maxima(self, rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """``[row, interval]``: the largest posting of each list among documents lo to hi, 0 for none."""
        start, end = self.before[rows[:, None], lo], self.before[rows[:, None], hi]
        some = end > start
        level = self.levels[end - start]
        first = np.where(some, start, 0)
        second = np.where(some, end - (1 << level.astype(np.int32)), 0)
        return np.where(some, np.maximum(self.tables[level, first], self.tables[level, second]), 0)

    def search(self, rows: np.ndarray, weights: np.ndarray, top: "_Top") -> None:
        """Best-first over intervals of documents; what is found goes to ``top``."""
        def bounded(lo, hi):
            best = self.maxima(rows, lo, hi)
            impacts = (best >> 12).astype(np.int64) * weights[:, None]
            # split at the document of the largest weighted impact
            at = best[impacts.argmax(axis=0), np.arange(len(lo))] & 0xFFF
            return np.stack([impacts.sum(axis=0), lo, hi, at.astype(np.int64)])

        open_ = bounded(np.zeros(1, np.int64), np.full(1, self.n))
        chunk = 16
        while True:
            bound = open_[0]
            # an interval that only ties the last place must begin with a smaller id
            alive = (bound > 0) & ((bound > top.score) | ((bound == top.score) & (self.ids[open_[1]] < top.last_id)))
            open_ = open_[:, alive]
            if not open_.shape[1]:
                return
            if open_.shape[1] > chunk:
                order = np.argpartition(-open_[0], chunk - 1)
                now, open_ = open_[:, order[:chunk]], open_[:, order[chunk:]]
            else:
                now, open_ = open_, open_[:, :0]
            _, lo, hi, at = now
            # a single document's bound is its score: maxima over one document each
            scores = ((self.maxima(rows, at, at + 1) >> 12).astype(np.int64) * weights[:, None]).sum(axis=0)
            top.add(self.ids[at], scores)
            lo, hi = np.concatenate([lo, at + 1]), np.concatenate([at, hi])
            rest = hi > lo
            if rest.any():
                open_ = np.concatenate([open_, bounded(lo[rest], hi[rest])], axis=1)
            chunk = min(2 * chunk, 1024)


class _Top:
    """The best ``k`` of the documents seen: by score, then by smaller id."""

    def __init__(self, k: int):
        self.k, self.score, self.last_id = k, 0, -2**63
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        good = (scores > 0) & (scores >= self.score)
        ids, scores = np.append(self.ids, ids[good]), np.append(self.scores, scores[good])
        order = np.lexsort((ids, -scores))[:self.k]
        self.ids, self.scores = ids[order], scores[order]
        if len(order) == self.k:
            self.score, self.last_id = int(self.scores[-1]), int(self.ids[-1])


def _weights(items: list, index: dict, documents: int, df: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each item's terms that occur in documents, with their weights times the item's repeats."""
    out = []
    for _, counts in items:
        own = sorted((index[t], c) for t, c in counts.items() if df[index[t]])
        w = [c * math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df[t]) + 1))) for t, c in own]
        pairs = [(t, x) for (t, _), x in zip(own, w) if x > 0]
        out.append((np.array([t for t, _ in pairs], np.int64), np.array([x for _, x in pairs], np.int64)))
    return out


def _ranked(postings: DataFrame, queries, k: int, documents: int, length_sum: int) -> DataFrame:
    """``(item, doc_id, score)``: each task's ``k`` best documents of each item."""
    def run(batches):
        tops = [_Top(k) for _ in queries.value]
        parts: list = []

        def searched(ids, n, found, counts):
            block = _Block(ids, n, found, counts, documents, length_sum)
            for top, (own, weights) in zip(tops, queries.value):
                here = [i for i, t in enumerate(own.tolist()) if t in block.row]
                if here:
                    block.search(np.array([block.row[t] for t in own[here].tolist()]), weights[here], top)

        for batch in batches:
            for i in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(i, _BLOCK)
                # a null id ranks behind all others
                searched(part.column(0).fill_null(2**63 - 1).to_numpy(), part.column(1).to_numpy(), part.column(2).to_pylist(), part.column(3).to_pylist())
        item = np.repeat(np.arange(len(tops)), [len(t.ids) for t in tops])
        ids = np.concatenate([t.ids for t in tops]) if tops else np.zeros(0, np.int64)
        scores = np.concatenate([t.scores for t in tops]) if tops else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, mask=ids == 2**63 - 1), pa.array(scores)], ["item", "doc_id", "score"])

    return mapped(postings, run, _RANKED)


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
           item_text_col: str = "text", block_bytes: int = 4 << 20) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents with a score above nought of each item row.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z folded. A
    null text has none. Equal scores rank by ascending document id, a null id
    last; ranks are unique. Repeated document rows are documents each, repeated
    item rows are ranked each. Items without a term that occurs in a document
    have no row, as has an empty table. Items are searched in blocks of at most
    ``block_bytes`` of text, the bound of what is sent to all tasks.
    """
    spark = docs.sparkSession
    schema = f"item_id {items.schema[item_id_col].dataType.simpleString()}, rank int, doc_id long, score long"
    out = []
    for block in _item_blocks(items, item_id_col, item_text_col, block_bytes):
        index = {t: i for i, t in enumerate(sorted(set().union(*(c for _, c in block))))}
        postings = saved(_postings(docs, spark.sparkContext.broadcast(index), id_col, text_col), "term-postings")
        documents, length_sum, df = _statistics(postings, len(index))
        queries = spark.sparkContext.broadcast(_weights(block, index, documents, df))
        best = _ranked(postings, queries, k, documents, length_sum)
        # first among salted groups, so that one item's rows of very many tasks aren't one group
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        best = best.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(16)))
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], f"item int, {schema.split(',')[0]}")
        out.append(best.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.union, out) if out else spark.createDataFrame([], schema)

"""Benchmark decontamination: a prefix-filtered set join of documents with the windows of benchmark items.

An item's windows are its runs of ``window`` words. A window occurs in a
document only if all its word shingles do, so with shingles ordered by rarity a
prefix of one, the window's rarest, is all that must be joined. Counting the
shingles and posting the rare ones read the documents once each; only
occurrences of the items' rarest shingles are shuffled. A joined pair whose
window would begin before the document or end after it is dropped (position and
length bounds); the others are compared word by word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import mapped, saved, text_or_empty
from trendspark.llm.shingles import shingle_hashes, word_hashes

#: Bytes of words: letters (A-Z folded), digits, and all bytes of characters beyond ASCII; others separate.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WINDOWS = "item_id string, words string, tokens array<long>"
_POSTINGS = "doc_id long, n_words long, posts array<struct<token: long, at: int, left: int, context: string>>"


def _hashes(text: bytes) -> np.ndarray:
    return word_hashes(text.translate(_WORD_BYTES))


def _tokens(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of exactly ``width`` words."""
    return shingle_hashes(words, width).view(np.int64) if len(words) >= width else np.zeros(0, np.int64)


def item_windows(items: DataFrame, window: int = 10, width: int = 4, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, words, tokens)``: each run of ``window`` words of each item and its shingles' hashes.

    An item of fewer words is one window, and a window of fewer than ``width``
    words one shingle. Items without words, or of null text, have no window.
    """
    def run(batches):
        for batch in batches:
            ids, words, tokens = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = text.translate(_WORD_BYTES).split()
                hashes = _hashes(text)
                for i in range(max(1, len(found) - window + 1) if found else 0):
                    ids.append(item)
                    words.append(b" ".join(found[i:i + window]).decode())
                    own = hashes[i:i + window]
                    tokens.append(_tokens(own, min(width, len(own))))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(words, pa.string()), pa.array(tokens, pa.list_(pa.int64()))],
                                             ["item_id", "words", "tokens"])

    return mapped(items.select(F.col(id_col).cast("string").alias("item_id"), text_or_empty(text_col).cast("binary").alias("text")), run, _WINDOWS)


class _Bitmap:
    """A bitmap of hashes, of 2**20 to 2**29 bits: what it lets through in error is dropped by the exact join that follows."""

    def __init__(self, tokens: DataFrame):
        """``tokens``: distinct hashes in a column ``token``."""
        n = tokens.count()
        self.mask = (1 << min(29, max(20, (64 * n).bit_length()))) - 1
        bit = F.col("token").bitwiseAND(F.lit(self.mask))
        words = tokens.select(F.shiftright(bit, 6).alias("word"), F.expr("shiftleft(1L, cast(token & 63 as int))").alias("bits"))
        found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
        bitmap = np.zeros((self.mask + 1) // 64, np.int64)
        bitmap[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
        self.shared = tokens.sparkSession.sparkContext.broadcast(bitmap.view(np.uint64))

    def has(self, tokens: np.ndarray) -> np.ndarray:
        at = tokens & self.mask
        return ((self.shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def _document_counts(rows: DataFrame, tokens: DataFrame, widths: list[int]) -> DataFrame:
    """``(token, n)``: in how many documents each of ``tokens`` occurs; summed in each task first."""
    bitmap = _Bitmap(tokens)

    def run(batches):
        for batch in batches:
            found = []
            for text in batch.column(0).to_pylist():
                words = _hashes(text)
                for width in widths:
                    own = _tokens(words, width)
                    found.append(np.unique(own[bitmap.has(own)]))
            values, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n, pa.int64())], ["token", "n"])

    return mapped(rows.select("text"), run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).join(tokens, "token", "left_semi")


def _posted(rows: DataFrame, prefix: DataFrame, widths: list[int], window: int) -> DataFrame:
    """One row for each document with its occurrences of prefix tokens: place, and the words around it that a window can reach."""
    bitmap = _Bitmap(prefix.select("token").distinct())

    def run(batches):
        for batch in batches:
            counts, posts, ends = [], [[], [], [], []], [0]
            for text in batch.column(1).to_pylist():
                words, split = _hashes(text), None
                for width in widths:
                    own = _tokens(words, width)
                    for at in np.flatnonzero(bitmap.has(own)).tolist():
                        split = split or text.translate(_WORD_BYTES).split()
                        first = max(0, at - window + width)
                        for column, v in zip(posts, (own[at], at, at - first, b" ".join(split[first:at + window]).decode())):
                            column.append(v)
                counts.append(len(words))
                ends.append(len(posts[0]))
            fields = [pa.array(posts[0], pa.int64()), pa.array(posts[1], pa.int32()), pa.array(posts[2], pa.int32()), pa.array(posts[3], pa.string())]
            column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, ["token", "at", "left", "context"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), column], ["doc_id", "n_words", "posts"])

    return mapped(rows, run, _POSTINGS)


def _dealt_join(rows: DataFrame, windows: DataFrame, on: str, salts: int = 16) -> DataFrame:
    """``rows`` joined with the (far smaller) ``windows``; the rows of one key, however many, are dealt over ``salts`` tasks."""
    salted = windows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int")).join(salted, [on, "salt"]).drop("salt")


def _covered(spans: Column) -> Column:
    """Words in the union of ``(start, length)`` spans."""
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(F.array_sort(spans), zero, lambda s, x: F.struct(
        F.greatest(s["end"], x["start"] + x["length"]).cast("long").alias("end"),
        (s["n"] + F.greatest(F.lit(0), x["start"] + x["length"] - F.greatest(s["end"], x["start"]))).cast("long").alias("n")), lambda s: s["n"])


def occurrences(docs: DataFrame, items: DataFrame, window: int = 10, width: int = 4, id_col: str = "doc_id", text_col: str = "text",
                item_id_col: str = "item_id", item_text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(documents, matches, windows)``: all documents as ``(row, doc_id, n_words)``, all occurrences as
    ``(row, start, length, words)``, and the items' windows as ``(words, item_id)``."""
    windows = saved(item_windows(items, window, width, item_id_col, item_text_col), "windows")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("text"))
    shape = F.least(F.lit(width), F.size(F.split("words", " ")))
    widths = [r["width"] for r in windows.select(shape.alias("width")).distinct().orderBy("width").collect()]  # 1 to width
    distinct = windows.select("words", "tokens").distinct()
    counts = _document_counts(rows, windows.select(F.explode("tokens").alias("token")).distinct(), widths)
    ranked = distinct.select("words", F.posexplode("tokens").alias("offset", "token")).join(counts, "token")
    # every window whose shingles all occur somewhere has a rarest one; a window with an unseen shingle occurs nowhere
    rarest = ranked.groupBy("words").agg(F.min(F.struct("n", "token", "offset")).alias("first"), F.count("*").alias("seen"))
    prefix = rarest.join(distinct.select("words", F.size("tokens").alias("all")), "words").where("seen = all").select(
        "words", F.col("first.token").alias("token"), F.col("first.offset").alias("offset"), F.size(F.split("words", " ")).alias("length"))
    prefix = saved(prefix, "prefixes")
    posted = saved(_posted(rows, prefix, widths, window).withColumn("row", F.monotonically_increasing_id()), "postings")
    occurring = _dealt_join(posted.select("row", "n_words", F.inline("posts")), prefix, "token")
    inside = (F.col("at") >= F.col("offset")) & (F.col("at") - F.col("offset") + F.col("length") <= F.col("n_words"))
    same = F.array_join(F.slice(F.split("context", " "), F.col("left") - F.col("offset") + 1, F.col("length")), " ") == F.col("words")
    # the place is in the context only within the bounds, so they are checked first
    matches = occurring.where(F.when(inside & (F.col("left") >= F.col("offset")), same).otherwise(False)).select(
        "row", (F.col("at") - F.col("offset")).cast("long").alias("start"), F.col("length").cast("long").alias("length"), "words")
    return posted.select("row", "doc_id", "n_words"), saved(matches, "matches"), windows.select("words", "item_id").distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, width: int = 4, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``: one row for each document row.

    Words are runs of letters, digits and characters beyond ASCII, A-Z folded.
    ``n_hit`` counts words inside any occurrence of an item's window, ``n_items``
    the different ids of items with an occurring window, and ``items_sha256``
    digests those ids, sorted as strings and joined by commas (no items: the
    empty string). Null texts have no words; null doc ids and repeated rows are
    rows like others. An item with a null id marks words but is no counted id;
    items of equal ids count once. Empty tables give no hits or no rows.
    """
    documents, matches, windows = occurrences(docs, items, window, width, id_col, text_col, item_id_col, item_text_col)
    hits = matches.groupBy("row").agg(_covered(F.collect_set(F.struct("start", "length"))).alias("n_hit"))
    # a document's windows are many more than its items: each is looked up once
    ids = _dealt_join(matches.select("row", "words").distinct(), windows.where(F.col("item_id").isNotNull()), "words").groupBy("row").agg(
        F.array_sort(F.collect_set("item_id")).alias("ids"))
    ids = ids.select("row", F.size("ids").cast("long").alias("n_items"), F.array_join("ids", ",").alias("joined"))
    out = documents.join(hits.join(ids, "row", "left"), "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                      F.sha2(F.coalesce("joined", F.lit("")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, items: DataFrame, window: int = 10, width: int = 4, id_col: str = "doc_id") -> DataFrame:
    """The documents, with all their columns, whose id has no contaminated row. A null id's rows are kept or dropped together."""
    dirty = contamination(docs, items, window, width, id_col).where("contaminated").select("doc_id").distinct()
    return docs.join(dirty, docs[id_col].cast("long").eqNullSafe(dirty["doc_id"]), "left_anti")

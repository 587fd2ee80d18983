"""Removal of repeated passages by grouping sampled windows by hash, in three passes.

A passage is removed where a string of ``length`` bytes starts at more than
one place of the corpus. Ranking every byte position would move many times the
corpus, so ranks are kept for a sample that loses nothing: position p stands
for all starts i whose first ``WINDOW`` k-mers have their smallest hash at p
(the leftmost of equals). That choice depends on the string alone, so equal
strings choose the same place in them.

This is not prefix doubling: no rank is made from an earlier round's ranks and
nothing repeats until all are unique, as the question is only which strings of
a fixed length repeat. Each round sorts positions by hashes of text slices, in
Spark; neighbours in that order that are equal are repeats:

1. the prefix that all strings of a sampled position have in common, hashed in
   halves. Unique ones have no repeated string and drop out.
2. past the threshold: the whole run from a position's first string to the end
   of its last. Runs that aren't unique are repeated as a whole.
3. the rest, at the edges of repeats: each string by itself, hashed in halves,
   together with the strings of one of each group of equal runs
   that have the same common prefix.

Hashes are 64-bit fingerprints (of both halves in round 1, where a clash only
costs a later look; of each half in rounds 2 and 3).

Before each sort, a task keeps back rows whose like it has seen in the same
batch: one of them is sent to where the pair is sorted, the others are known to
be repeated and go anywhere. So a passage that a third of all documents share
puts one row for each batch into one place and not all its rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import aliased, mapped, saved, ship_package, spread

#: Bytes of a k-mer, and k-mers among which the smallest is sampled (powers of two).
KMER, WINDOW = 32, 128
_rng = np.random.default_rng(104729)
_OF_BYTE = _rng.integers(0, 2**32, 256, dtype=np.uint64).astype(np.uint32)
_FACTORS = _rng.integers(0, 2**32, 8, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_ROUND_1 = "key long, tag int, low int, more short, core long, first long, second long, seen byte"
_ROUND_2 = "key long, tag int, low int, more short, core long, first long, second long, seen byte"
_BLOCKS = "key long, tag int, span long, core long, state byte"
UNSURE, WITNESS, SURE = 0, 1, 2
_STRINGS = "key long, tag int, low int, first long, second long, seen byte"
_SPANS = "key long, tag int, span long"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def sampled(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(p, low, high)``: sampled positions, and the first and last string start that each stands for."""
    n = len(data)
    if n < length:
        return (np.zeros(0, np.int64),) * 3
    h, span = _OF_BYTE[data], 1
    for factor in _FACTORS:
        if span == KMER:
            break
        h = h[:-span] * factor + h[span:]
        span *= 2
    h ^= h >> np.uint32(15)
    h *= _FACTORS[7]
    h ^= h >> np.uint32(13)
    least = (h.astype(np.uint64) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while span < WINDOW:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    at = (least[:n - length + 1] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    low = np.flatnonzero(np.diff(at, prepend=-1))
    return at[low], low, np.append(low[1:], len(at)) - 1


def _once(order_keys: tuple[np.ndarray, ...]) -> np.ndarray:
    """By row of a batch: 0 if its keys occur once, 1 for the first of several, 2 for the others."""
    n = len(order_keys[0])
    out = np.zeros(n, np.int8)
    if n > 1:
        order = np.lexsort(order_keys)
        same = np.ones(n - 1, bool)
        for k in order_keys:
            s = k[order]
            same &= s[1:] == s[:-1]
        out[order[1:][same]] = 2
        heads = np.zeros(n, bool)
        heads[:-1] = same
        heads[1:] &= ~same
        out[order[heads]] = 1
    return out


def _repeated(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Sorted batches with two marks by row: a neighbour has the same keys or its like was seen before; no row before it has them."""
    held, held_mark, held_head = None, False, True
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        n = batch.num_rows
        same = np.ones(n - 1, bool)
        for k in keys:
            c = np.asarray(batch.column(k))
            same &= c[1:] == c[:-1]
        mark = np.asarray(batch.column("seen")) > 0
        head = np.append(held_head, ~same)
        mark[1:] |= same
        mark[:-1] |= same
        mark[0] |= held_mark
        if n > 1:
            yield batch.slice(0, n - 1), mark[:-1], head[:-1]
        held, held_mark, held_head = batch.slice(n - 1), bool(mark[-1]), bool(head[-1])
    if held is not None:
        yield held, np.array([held_mark]), np.array([held_head])


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _dealt(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows sorted by ``keys`` in tasks that have all unseen rows of a key; rows known to be repeated go anywhere.

    Of equal keys a row that was dealt by them comes first, also where others have strayed into its task.
    """
    to = F.when(F.col("seen") == 2, F.xxhash64("key", "low")).otherwise(F.col(keys[0]))
    return rows.repartition(spread(rows), to).sortWithinPartitions(*keys, "seen")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with ``_key`` and ``_tag``, which tell rows apart unless both id and text are equal."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.withColumns({"_key": F.coalesce(F.col(id_col).cast("long"), F.lit(-1)), "_tag": F.hash(text)})


def with_spans(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``_spans``: the byte ranges covered by repeated strings, each as ``start * 2**32 + stop``, unordered.

    Null texts and texts of less than ``length`` bytes have none. Rows that are
    equal in id and text are copies of each other like any other copies. Names
    that begin with an underscore are taken; all other columns pass.
    """
    if length < KMER + WINDOW - 1:
        raise ValueError(f"length must be {KMER + WINDOW - 1} at least")
    common, half, middle = length - WINDOW + 1, (length - WINDOW + 1) // 2, length // 2
    digest = xxhash.xxh3_64_intdigest
    docs = keyed(docs, id_col, text_col)
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    low_word = 0xFFFFFFFF

    def positions(batches):
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            for key, tag, text in zip(*(c.to_pylist() for c in batch.columns)):
                p, low, high = sampled(np.frombuffer(text, np.uint8), length)
                if not len(p):
                    continue
                at, begin, end = p.tolist(), low.tolist(), (high + length).tolist()
                columns[0].append(np.full(len(at), key))
                columns[1].append(np.full(len(at), tag, np.int32))
                columns[2].append(low)
                columns[3].append(high - low)
                columns[4] += [(digest(text[a:a + half]) & low_word) << 32 | digest(text[a + half:a + common]) & low_word for a in at]
                columns[5] += [digest(text[a:a + middle]) for a in begin]
                columns[6] += [digest(text[a + middle:b]) for a, b in zip(begin, end)]
            if columns[0]:
                core, first, second = map(_signed, columns[4:])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(columns[0]), pa.int64()), pa.array(np.concatenate(columns[1]), pa.int32()),
                     pa.array(np.concatenate(columns[2]).astype(np.int32)), pa.array(np.concatenate(columns[3]).astype(np.int16)),
                     pa.array(core), pa.array(first), pa.array(second), pa.array(_once((core,)))], _names(_ROUND_1))

    def reranked(batches):
        for batch, mark, _ in _repeated(batches, ["core"]):
            batch = batch.filter(pa.array(mark))
            first, second = np.asarray(batch.column("first")), np.asarray(batch.column("second"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "tag", "low", "more", "core")), pa.array(first), pa.array(second),
                                              pa.array(_once((second, first)))], _names(_ROUND_2))

    def judged(batches):
        for batch, mark, head in _repeated(batches, ["first", "second"]):
            low = np.asarray(batch.column("low")).astype(np.int64)
            span = low << 32 | (low + np.asarray(batch.column("more")) + length)
            # of equal runs one that was dealt by its keys is the witness
            state = np.where(mark, SURE, UNSURE).astype(np.int8)
            state[mark & head & (np.asarray(batch.column("seen")) < 2)] = WITNESS
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("tag"), pa.array(span), batch.column("core"), pa.array(state)],
                                             _names(_BLOCKS))

    def strings(batches):
        for batch in batches:
            keys, tags, lows, firsts, seconds = [], [], [], [], []
            for key, tag, text, spans in zip(*(batch.column(i).to_pylist() for i in range(4))):
                for span in set(spans):
                    begin, end = span >> 32, (span & low_word) - length + 1
                    lows += range(begin, end)
                    keys.append(np.full(end - begin, key))
                    tags.append(np.full(end - begin, tag, np.int32))
                    firsts += [digest(text[i:i + middle]) for i in range(begin, end)]
                    seconds += [digest(text[i + middle:i + length]) for i in range(begin, end)]
            if keys:
                first, second = _signed(firsts), _signed(seconds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys), pa.int64()), pa.array(np.concatenate(tags), pa.int32()), pa.array(lows, pa.int32()),
                     pa.array(first), pa.array(second), pa.array(_once((second, first)))], _names(_STRINGS))

    def found(batches):
        for batch, mark, _ in _repeated(batches, ["first", "second"]):
            batch = batch.filter(pa.array(mark))
            low = np.asarray(batch.column("low")).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("tag"), pa.array(low << 32 | (low + length))], _names(_SPANS))

    texts = docs.select("_key", "_tag", raw.alias("raw"))
    round_1 = _dealt(mapped(texts, positions, _ROUND_1), ["core"])
    round_2 = _dealt(mapped(round_1, reranked, _ROUND_2), ["first", "second"])
    blocks = saved(mapped(round_2, judged, _BLOCKS), "repeated-blocks")
    # strings at the edge of a repeat may have their like within a sure run of the same common prefix: its witness is looked at too
    unsure = blocks.where(F.col("state") == UNSURE)
    near = blocks.where(F.col("state") == WITNESS).join(unsure.select("core").distinct(), "core", "left_semi")
    # at most a document's own positions in each list
    unsure = unsure.select("key", "tag", "span").union(near.select("key", "tag", "span")).groupBy("key", "tag").agg(
        F.collect_list("span").alias("_list")).withColumnsRenamed({"key": "_of", "tag": "_of_tag"})
    edges = docs.join(unsure, (F.col("_key") == F.col("_of")) & (F.col("_tag") == F.col("_of_tag")))
    edges = edges.select("_key", "_tag", raw.alias("_raw"), "_list", *(c for c in docs.columns if c not in ("_key", "_tag")))
    round_3 = _dealt(mapped(edges, strings, _STRINGS), ["first", "second"])
    spans = blocks.where(F.col("state") != UNSURE).select("key", "tag", "span").union(mapped(round_3, found, _SPANS))
    per_doc = spans.groupBy("key", "tag").agg(F.collect_list("span").alias("_spans")).withColumnsRenamed({"key": "_of", "tag": "_of_tag"})
    return docs.join(per_doc, (F.col("_key") == F.col("_of")) & (F.col("_tag") == F.col("_of_tag")), "left").drop("_of", "_of_tag")


def merged(spans: list[int] | None) -> list[tuple[int, int]]:
    """Maximal runs ``(start, stop)`` of the bytes that packed ranges cover, in order."""
    out: list[list[int]] = []
    for span in sorted(set(spans or ())):
        start, stop = span >> 32, span & 0xFFFFFFFF
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [tuple(x) for x in out]


def without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    """``data`` less the runs."""
    if not runs:
        return data
    begins = [0, *(stop for _, stop in runs)]
    return b"".join(data[a:b] for a, b in zip(begins, [*(start for start, _ in runs), len(data)]))


def on_characters(data: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs shrunk to whole UTF-8 characters."""
    out = []
    for start, stop in runs:
        while start < stop and data[start] & 0xC0 == 0x80:
            start += 1
        while stop > start and stop < len(data) and data[stop] & 0xC0 == 0x80:
            stop -= 1
        if start < stop:
            out.append((start, stop))
    return out


def removal_digests(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for every document."""
    def digests(batches):
        for batch in batches:
            rows = []
            for doc, data, spans in zip(*(c.to_pylist() for c in batch.columns)):
                runs = merged(spans)
                kept = without(data, runs)
                rows.append((doc, len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ranged = with_spans(rows, length)
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return mapped(ranged.select("doc_id", raw.alias("raw"), "_spans"), digests,
                  "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut out of the text, at whole characters. All other columns, of any names, and all rows stay."""
    rows, the_id, the_text = aliased(docs, id_col, text_col)
    ship_package(docs.sparkSession)

    @F.arrow_udf("string")
    def cut(raw: pa.Array, spans: pa.Array) -> pa.Array:
        texts = [None if data is None else without(data, on_characters(data, merged(found))).decode()
                 for data, found in zip(raw.to_pylist(), spans.to_pylist())]
        return pa.array(texts, pa.string())

    # only texts with repeats go to Python
    ranged = with_spans(rows, length, the_id, the_text)
    text = F.col(the_text).cast("string")
    clean = F.when(F.col("_spans").isNull(), text).otherwise(cut(text.cast("binary"), "_spans"))
    return ranged.select(*(clean.alias(c) if c == the_text else F.col(c) for c in rows.columns)).toDF(*docs.columns)

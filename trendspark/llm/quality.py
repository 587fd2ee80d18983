"""Quality scores by a byte-level convolutional network in numpy.

Bytes are embedded, and filters of ``WIDTH`` bytes slide over the whole
document; beside the embedded bytes they see whether their window repeats the
bytes a short lag before (stuttering text). Each filter's responses are max-pooled over overlapping chunks. Mean and
maximum of the pooled chunks are combined into one probability. Filters,
embedding and the last layer are learned by gradient descent on a bounded
sample of labelled documents; scoring reads every byte of every document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import mapped, saved, ship_package, text_or_empty

WIDTH, STRIDE, DEPTH, FILTERS = 8, 4, 8, 48
#: Bytes of a chunk; the next one begins half a chunk later.
CHUNK = 1024
HALF = CHUNK // 2 // STRIDE  # windows
#: Lags at which a window can repeat earlier bytes.
LAGS = range(2, 33)


def repeats(data: np.ndarray) -> np.ndarray:
    """For each window along the last axis (every ``STRIDE`` bytes): 1 if its bytes came just before, at one of ``LAGS``."""
    n = (data.shape[-1] - WIDTH) // STRIDE + 1
    size, front = (n - 1) * STRIDE + WIDTH, max(LAGS)
    padded = np.zeros((*data.shape[:-1], front + size), np.uint8)
    padded[..., front:] = data[..., :size]
    here, found = np.ascontiguousarray(padded[..., front:]), np.zeros((*data.shape[:-1], n), bool)
    for lag in LAGS:
        four = (here == padded[..., front - lag:front - lag + size]).view("<u4") == 0x01010101  # STRIDE bytes at once
        found |= four[..., :-1] & four[..., 1:]
    return found.astype(np.float32)


class Network:
    """The weights, and the forward pass over one document."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights

    @classmethod
    def fresh(cls, seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return cls({"embedding": normal(256, DEPTH, scale=0.5), "filters": normal(WIDTH * DEPTH, FILTERS, scale=1 / math.sqrt(WIDTH * DEPTH)),
                    "bias": np.zeros(FILTERS, np.float32), "repeat": normal(FILTERS, scale=0.5), "last": normal(2 * FILTERS, scale=0.1), "shift": np.zeros(1, np.float32)})

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Filter responses at every ``STRIDE`` bytes of ``data``."""
        w = self.weights
        embedded = w["embedding"][data].ravel()
        n = (len(data) - WIDTH) // STRIDE + 1
        step = embedded.itemsize
        windows = np.lib.stride_tricks.as_strided(embedded, (n, WIDTH * DEPTH), (STRIDE * DEPTH * step, step), writeable=False)
        return windows @ w["filters"] + (w["bias"] + repeats(data)[:, None] * w["repeat"])

    def features(self, text: bytes, piece: int = 1 << 18) -> np.ndarray:
        """Mean and maximum over the chunks of a whole document; memory is bounded by ``piece`` bytes."""
        short = -max(len(text) - WIDTH, 0) % STRIDE if len(text) >= WIDTH else WIDTH - len(text)
        data = np.frombuffer(text + bytes(short), np.uint8)
        halves = []
        for i in range(0, max(len(data) - WIDTH, 0) + 1, piece):
            found = self.responses(data[i:i + piece + WIDTH - STRIDE])
            halves.append(np.maximum.reduceat(found, np.arange(0, len(found), HALF)))
        halves = np.concatenate(halves)
        chunks = np.maximum(halves[:-1], halves[1:]) if len(halves) > 1 else halves
        chunks = np.maximum(chunks, 0)
        return np.concatenate([chunks.mean(0), chunks.max(0)])

    def score(self, text: bytes) -> float:
        w = self.weights
        logit = float(self.features(text) @ w["last"] + w["shift"][0])
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, logit))))


def train(chunks: list[list[bytes]], labels: list[int], steps: int = 600, batch: int = 32, rate: float = 4e-3, seed: int = 5) -> Network:
    """Fits a network to documents given as lists of chunks, by Adam on the logistic loss with both classes weighted alike."""
    net = Network.fresh()
    w = net.weights
    if len(set(labels)) < 2:
        return net
    y_all = np.array(labels, np.float32)
    weight_all = np.where(y_all == 1, 0.5 / y_all.mean(), 0.5 / (1 - y_all.mean())).astype(np.float32)
    rng = np.random.default_rng(seed)
    first, second, t = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    epochs = -(-steps // -(-len(labels) // batch))
    steps = epochs * -(-len(labels) // batch)
    starts = np.arange(0, CHUNK - WIDTH + 1, STRIDE)

    def shortened(pieces: list[bytes]) -> list[bytes]:
        """A short slice, so that the length of a text isn't taken for its quality."""
        piece = pieces[rng.integers(len(pieces))]
        size = int(rng.integers(16, 200))
        at = int(rng.integers(max(1, len(piece) - size + 1)))
        return [piece[at:at + size]]

    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for i in range(0, len(order), batch):
            docs = order[i:i + batch]
            views = [shortened(chunks[d]) if rng.random() < 0.3 else chunks[d] for d in docs]
            counts = np.array([len(v) for v in views])
            doc_of = np.repeat(np.arange(len(docs)), counts)
            flat = [c for v in views for c in v]
            sizes = np.array([max(len(c), WIDTH) for c in flat])
            data = np.frombuffer(b"".join(c.ljust(CHUNK, b"\0") for c in flat), np.uint8).reshape(len(flat), CHUNK)
            embedded = np.ascontiguousarray(w["embedding"][data])
            s0, s1, s2 = embedded.strides
            windows = np.lib.stride_tricks.as_strided(embedded, (len(flat), len(starts), WIDTH * DEPTH), (s0, STRIDE * s1, s2))
            stutter = repeats(data)
            found = windows @ w["filters"] + (w["bias"] + stutter[:, :, None] * w["repeat"])
            found[starts[None, :] > (sizes - WIDTH)[:, None] + STRIDE - 1] = -np.inf
            best = found.argmax(1)
            pooled = np.take_along_axis(found, best[:, None], 1)[:, 0]
            active = np.maximum(pooled, 0)
            begins = np.cumsum(counts) - counts
            mean = np.add.reduceat(active, begins) / counts[:, None]
            top = np.maximum.reduceat(active, begins)
            features = np.concatenate([mean, top], 1)
            logit = features @ w["last"] + w["shift"]
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            d_logit = ((p - y_all[docs]) * weight_all[docs] / len(docs)).astype(np.float32)
            d_features = d_logit[:, None] * w["last"]
            is_top = active == top[doc_of]
            d_active = (d_features[:, :FILTERS] / counts[:, None])[doc_of] + d_features[:, FILTERS:][doc_of] * is_top
            d_pooled = np.where(pooled > 0, d_active, 0).astype(np.float32)
            # only the window that each chunk's maximum came from has a gradient
            chosen = windows[np.arange(len(flat))[:, None], best]  # chunk, filter, window
            d_filters = np.einsum("cfw,cf->wf", chosen, d_pooled, optimize=True)
            d_windows = d_pooled[:, :, None] * w["filters"].T[None]
            at = (best * STRIDE)[:, :, None] + np.arange(WIDTH)
            byte = data[np.arange(len(flat))[:, None, None], at].ravel()
            d_embedding = np.stack([np.bincount(byte, d_windows.reshape(len(byte), DEPTH)[:, k], 256) for k in range(DEPTH)], 1)
            gradients = {"embedding": d_embedding, "filters": d_filters, "bias": d_pooled.sum(0),
                         "repeat": (np.take_along_axis(stutter, best, 1) * d_pooled).sum(0),
                         "last": features.T @ d_logit + 1e-4 * w["last"], "shift": d_logit.sum(keepdims=True)}
            t += 1
            now = rate * (1 - 0.9 * t / steps)
            for k, g in gradients.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] -= (now * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return net


def held_out(id_col: str = "doc_id"):
    """Rows that labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", rows_per_class: int = 1000, chunks_per_doc: int = 4,
        id_col: str = "doc_id", text_col: str = "text") -> Network:
    """Learns from at most ``rows_per_class`` labelled rows of each class and ``chunks_per_doc`` chunks of each document.

    The rows come first in the order of a hash of their id, so the sample is
    the same in any partitioning; the chunks lie evenly over the whole text.
    The class shares of all labels then move the threshold. Without labels of
    both classes the scores are those of an untrained network. Of conflicting
    labels of one id the smallest counts.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(
        F.col(id_col).cast("long").alias("_id")).agg(F.min(label_col).cast("int").alias("_label"))
    known = saved(known, "labels")
    order = F.xxhash64("_id")
    picked = [known.where(F.col("_label") == c).orderBy(order, "_id").limit(rows_per_class) for c in (0, 1)]
    sample = F.broadcast(picked[0].union(picked[1]))  # 2 * rows_per_class rows at most
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text_or_empty(text_col).cast("binary").alias("_text")).join(sample, "_id")

    def cut(batches):
        for batch in batches:
            out = []
            for data in batch.column(2).to_pylist():
                n = max(1, -(-len(data) // CHUNK))
                at = sorted({round(x) for x in np.linspace(0, n - 1, min(n, chunks_per_doc))})
                out.append([data[i * CHUNK:(i + 1) * CHUNK] for i in at])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.binary()))], ["id", "label", "chunks"])

    found = mapped(rows.select("_id", "_label", "_text"), cut, "id long, label int, chunks array<binary>").toPandas()
    found = found.drop_duplicates("id").sort_values("id")
    net = train([[bytes(c) for c in x] for x in found["chunks"]], found["label"].tolist())
    shares = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    if len(shares) == 2:
        net.weights["shift"] = net.weights["shift"] + np.float32(math.log(shares[1] / shares[0]))
    return net


def score(docs: DataFrame, net: Network, text_col: str = "text") -> Column:
    """The probability of label 1 of each row of ``docs``, from the whole text, as a column. A null text scores as an empty one.

    Python gets the texts alone, once; the other columns stay where they are.
    """
    ship_package(docs.sparkSession)
    weights = docs.sparkSession.sparkContext.broadcast(net.weights)  # 6,000 numbers

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Network(weights.value)
        for texts in batches:
            yield pa.array([own.score(x or b"") for x in texts.to_pylist()], pa.float64())

    return run(text_or_empty(text_col).cast("binary"))


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document, by a network learned from the rows that aren't held out."""
    net = fit(docs, labels, id_col=id_col, text_col=text_col)

    def run(batches):
        own = Network(weights.value)
        for batch in batches:
            found = np.array([own.score(x) for x in batch.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64()),
                                              pa.array((found >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    weights = docs.sparkSession.sparkContext.broadcast(net.weights)  # 6,000 numbers
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), text_or_empty(text_col).cast("binary").alias("raw"))
    return mapped(rows, run, "doc_id long, held_out boolean, score double, predicted int")


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, unchanged; columns may have any names."""
    net = fit(docs, labels, id_col=id_col, text_col=text_col)
    return docs.where(score(docs, net, text_col) >= 0.5)

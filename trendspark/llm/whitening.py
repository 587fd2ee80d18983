"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance matrix is never formed. A pass over the centred rows multiplies
it with a block of columns (``X'(XQ)``, summed over tasks by Spark); polynomials
of it, by the three-term recurrence of Chebyshev, damp the unwanted part of the
spectrum. QR and a Rayleigh-Ritz step follow, until the residuals of all wanted
eigenpairs certify them. The driver holds blocks of (dimension x block) numbers
only, whatever the number of rows.

Entries are whole numbers ``floor(scale * c) + shift``, so sums and means are
exact; rows are centred by the exact mean before anything is multiplied.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import mapped, saved

_ROWS = "vec_id long, dim int, entries binary"
_DIGESTS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
#: Larger entries aren't exact as doubles; a row that holds one is left out like one with an infinite entry.
_LARGEST = float(2**52)


@dataclass
class Whitening:
    """A fitted whitening: mean ``base + rest / n``, unit eigenvectors as columns, their eigenvalues, the covariance's trace, the last residual."""
    n: int
    dim: int
    base: np.ndarray
    rest: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base) - self.rest / max(self.n, 1)

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Rows of entries to whitened components."""
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


def whole_entries(vectors: DataFrame, scale: float = 1024.0, shift: int = 100_000, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, dim, entries)``: the usable rows' whole-number entries as little-endian 64-bit bytes.

    Left out: null and empty vectors, those with a null or non-finite entry, and
    those with an entry beyond 2**52 after scaling. Null ids and repeated rows stay.
    """
    def run(batches):
        for batch in batches:
            column = batch.column(1)
            values = column.values.to_numpy(zero_copy_only=False)  # a null entry reads as not a number
            offsets, valid = np.asarray(column.offsets).tolist(), np.asarray(column.is_valid())
            with np.errstate(over="ignore", invalid="ignore"):
                whole = np.floor(values * scale)
                good = np.abs(whole) <= _LARGEST
                whole = np.where(good, whole, 0).astype("<i8") + shift
            bad = np.concatenate([[0], np.cumsum(~good)])
            keep = [i for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])) if valid[i] and b > a and bad[b] == bad[a]]
            data = [whole[offsets[i]:offsets[i + 1]].tobytes() for i in keep]
            dims = [offsets[i + 1] - offsets[i] for i in keep]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(dims, pa.int32()), pa.array(data, pa.binary())],
                                             ["vec_id", "dim", "entries"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return mapped(rows, run, _ROWS)


def _matrix(batch, dim: int) -> np.ndarray:
    """The entries of a batch, one row each."""
    return np.frombuffer(b"".join(batch.column(batch.schema.get_field_index("entries")).to_pylist()), "<i8").reshape(-1, dim)


def _sums(entries: DataFrame, dim: int) -> list[int]:
    """Exact sums of each dimension; a task sends one row for each."""
    def run(batches):
        total = [0] * dim
        for batch in batches:
            x = _matrix(batch, dim)
            for i in range(0, len(x), 1024):  # 1024 entries of at most 2**53: no overflow
                total = [a + b for a, b in zip(total, x[i:i + 1024].sum(axis=0).tolist())]
        # in two halves, as a task's sum may exceed 64 bits
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([t >> 40 for t in total], pa.int64()),
                                          pa.array([t & (2**40 - 1) for t in total], pa.int64())], ["at", "high", "low"])

    halves = mapped(entries.select("entries"), run, "at int, high long, low long").groupBy("at").agg(
        F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    found = {r["at"]: (int(r["high"]) << 40) + int(r["low"]) for r in halves.collect()}
    return [found.get(i, 0) for i in range(dim)]


def _pass(entries: DataFrame, centre: Whitening, block: np.ndarray) -> tuple[np.ndarray, float]:
    """One pass over the rows: covariance times ``block``, and the covariance's trace."""
    dim, width = block.shape
    shared = entries.sparkSession.sparkContext.broadcast((centre, block))  # dimension x block numbers

    def run(batches):
        model, q = shared.value
        product, squares = np.zeros((dim, width)), np.zeros(dim)
        for batch in batches:
            y = model.centred(_matrix(batch, dim))
            product += y.T @ (y @ q)
            squares += (y * y).sum(axis=0)
        cells = np.append(product.ravel(), squares.sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)], ["at", "v"])

    out = np.zeros(dim * width + 1)
    for r in mapped(entries.select("entries"), run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r["v"]
    shared.unpersist()
    out /= centre.n
    return out[:-1].reshape(dim, width), float(out[-1])


def fit(entries: DataFrame, dim: int, components: int = 8, degree: int = 16, turns: int = 100) -> Whitening:
    """The leading eigenpairs of the covariance of ``entries``, all of dimension ``dim``.

    Subspaces have four columns for each wanted component (all dimensions, if
    there are no more: then one pass is exact). Eigenvalues of (relatively)
    nought give no component. A fit that isn't certified after ``turns`` is an error.
    """
    n = entries.count()
    sums = _sums(entries, dim)
    base = np.array([s // n for s in sums], np.int64) if n else np.zeros(dim, np.int64)
    rest = np.array([s % n for s in sums], np.float64) if n else np.zeros(dim)
    model = Whitening(n, dim, base, rest, np.zeros((dim, 0)), np.zeros(0), 0.0, 0.0)
    if not n:
        return model
    wanted, width = min(components, dim), min(dim, 4 * components)
    q = np.linalg.qr(np.random.default_rng(11).standard_normal((dim, width)))[0]
    best = math.inf
    for turn in range(turns):
        product, trace = _pass(entries, model, q)
        # Rayleigh-Ritz: eigenpairs of the covariance within the subspace
        values, rotation = np.linalg.eigh((q.T @ product + product.T @ q) / 2)
        values, rotation = values[::-1], rotation[:, ::-1]
        q, product = q @ rotation, product @ rotation
        residuals = np.sqrt(((product - q * values) ** 2).sum(axis=0))
        residual = float(residuals[:wanted].max())
        floor = 2e-15 * dim * max(values[0], 0.0)
        if width == dim or residual <= floor or (residual <= 1e-10 * values[0] and residual > best / 2):
            break
        best = min(best, residual)
        # damp what lies between a lower bound and the smallest Ritz value of the block: the other eigenvalues add up to
        # what the trace leaves, so none of them is smaller than that less the others at their largest (while the block is
        # unconverged that may be too much: the interval is at least as wide as the wanted values lie above it)
        top = values[-1]
        low = max(0.0, min(trace - values.sum() - residuals.sum() - (dim - width - 1) * top, 2 * top - values[wanted - 1]))
        middle, half = (top + low) / 2, (top - low) / 2
        if half <= 1e-14 * values[0]:  # nothing is left outside the block: one more step on it is exact
            q = np.linalg.qr(product)[0]
            continue
        # of the wanted columns none may outgrow another beyond what doubles resolve
        growth = lambda v: max((v - middle) / half, 1.0) + math.sqrt(max(((v - middle) / half) ** 2 - 1, 0.0))
        apart = growth(values[0]) / growth(values[wanted - 1])
        m = max(2, min(degree, int(math.log(1e8) / math.log(apart)))) if apart > 1 + 1e-9 else degree
        before, now = q, (product - middle * q) / half
        for _ in range(m - 1):
            step, _ = _pass(entries, model, now)
            before, now = now, 2 * (step - middle * now) / half - before
        q = np.linalg.qr(now / np.sqrt((now ** 2).sum(axis=0)))[0]
    else:
        raise ArithmeticError(f"no certified eigenpairs after {turns} turns: residual {residual}")
    real = int((values[:wanted] > 1e-13 * trace).sum()) if trace > 0 else 0
    return Whitening(n, dim, base, rest, np.ascontiguousarray(q[:, :real]), values[:real].copy(), trace, residual)


def _one_dimension(entries: DataFrame) -> tuple[DataFrame, int]:
    """The rows of the most frequent dimension (of equally frequent ones the largest)."""
    top = entries.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    dim = top["dim"] if top else 0
    return entries.where(F.col("dim") == dim), dim


def identity_error(entries: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity (rows are centred exactly)."""
    k = len(model.values)
    if not k:
        return 0.0
    shared = entries.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        total = np.zeros((k, k))
        for batch in batches:
            w = shared.value.apply(_matrix(batch, shared.value.dim))
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(k * k), pa.int32()), pa.array(total.ravel())], ["at", "v"])

    found = mapped(entries.select("entries"), run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    cov = np.zeros(k * k)
    for r in found:
        cov[r["at"]] = r["v"] / model.n
    return float(np.abs(cov.reshape(k, k) - np.eye(k)).max())


def whitened(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, whitened array<double>)`` of every usable row, by a whitening that is fitted on all of them."""
    entries, dim = _one_dimension(saved(whole_entries(vectors, id_col=id_col, vector_col=vector_col), "entries"))
    model = fit(entries, dim, components)
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            w = shared.value.apply(_matrix(batch, shared.value.dim))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(w), pa.list_(pa.float64()))], ["vec_id", "whitened"])

    return mapped(entries.select("vec_id", "entries"), run, "vec_id long, whitened array<double>")


def _deviations(x: np.ndarray, model: Whitening) -> pa.Array:
    """Exact sums of ``(n*x - S)**2`` of each row; null where one exceeds 64 bits."""
    z, n = x - model.base, model.n
    rest = model.rest.astype(np.int64)
    rough = (n * (np.abs(z) + 1.0)).astype(float)
    small = (rough ** 2).sum(axis=1) < 2.0**62
    out = np.zeros(len(x), object)
    if small.any():
        out[small] = ((n * z[small] - rest) ** 2).sum(axis=1).tolist()
    for i in np.flatnonzero(~small):
        exact = sum((n * int(a) - int(r)) ** 2 for a, r in zip(z[i], rest))
        out[i] = exact if exact < 2**63 else None
    return pa.array(out.tolist(), pa.int64())


def whitening_digests(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``: one row for each usable vector and component.

    Vectors that are null, empty, hold a null or non-finite entry or one beyond
    2**52 after scaling, or have another dimension than most (of equally
    frequent dimensions the largest counts) are left out. Null ids and repeated
    rows stay, each counted. Components without variance are left out, so a
    table of equal vectors, one row or none gives no rows. ``deviation`` is null
    where it exceeds 64 bits.
    """
    entries, dim = _one_dimension(saved(whole_entries(vectors, id_col=id_col, vector_col=vector_col), "entries"))
    model = fit(entries, dim, components)
    error = identity_error(entries, model)
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        k = len(model.values)
        for batch in batches:
            for i in range(0, batch.num_rows if k else 0, 4096):
                part = batch.slice(i, 4096)
                x = _matrix(part, model.dim)
                rows = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                     pa.array(np.full(len(rows), model.n, np.int64)), _deviations(x, model).take(pa.array(rows)), pa.array(model.apply(x).ravel()),
                     pa.array(np.tile(model.values / model.trace, len(x))), pa.array(np.full(len(rows), error))],
                    [c.split()[0] for c in _DIGESTS.split(", ")])

    return mapped(entries.select("vec_id", "entries"), run, _DIGESTS)

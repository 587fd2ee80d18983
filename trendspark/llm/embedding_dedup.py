"""Near-duplicate embeddings by product quantisation.

Unit vectors are put into coarse inverted lists (nearest centroid), and what
is left of them is coded by subspaces. A vector is compared with the codes of
all lists that can hold a vector within the wanted distance: those whose
bisector with its own list's centroid is not farther away. Table lookups give
the distance from a vector to a coded one; as the error of each code is kept,
the triangle inequality tells which pairs may reach the threshold, and those
are ranked again by the exact cosine. Both steps leave out only pairs that
cannot be linked, so the recall is that of brute force.

Centroids and codebooks are fitted on a sample bounded by ``sample_rows``;
every vector is indexed. Lists are cut into blocks of bounded size, and blocks
are compared block by block, so a list that holds a third of all vectors is
many small tasks. Equal vectors are one node with a count. No pairs are
written: a block pair gives each vector's number of links and one link to the
component that it has within the pair.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import mapped, saved, spread
from trendspark.llm.components import components

_ROWS = "vec_id long, label string, dim int, vector binary"
_INDEXED = "node long, label string, dim int, vector binary, n long, list int, codes binary, error double, probes array<int>"
_FOUND = "node long, links long, other long"


def _centroids(points: np.ndarray, k: int, turns: int = 8) -> np.ndarray:
    """k-means from evenly spaced first centroids; an empty cell keeps its centroid."""
    k = min(k, len(points))
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(turns):
        cell = _nearest(points, centres)[0]
        counts = np.bincount(cell, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, points)
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
    return centres


def _squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((points ** 2).sum(1)[:, None] - 2 * points @ centres.T + (centres ** 2).sum(1), 0)


def _nearest(points: np.ndarray, centres: np.ndarray, step: int = 8192) -> tuple[np.ndarray, np.ndarray]:
    cells = [_squared(points[i:i + step], centres).argmin(1) for i in range(0, len(points), step)]
    cell = np.concatenate(cells) if cells else np.zeros(0, int)
    return cell, points - centres[cell]


class Quantiser:
    """Coarse centroids and, for each subspace of the residuals, a codebook."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int = 8, codes: int = 64):
        self.centres = _centroids(sample, lists)
        _, rest = _nearest(sample, self.centres)
        self.parts = [p for p in np.array_split(np.arange(sample.shape[1]), subspaces) if len(p)]
        self.books = [_centroids(rest[:, p], codes) for p in self.parts]

    def encode(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(list, codes, error)`` of each point."""
        cell, rest = _nearest(points, self.centres)
        codes = np.stack([_nearest(rest[:, p], b)[0] for p, b in zip(self.parts, self.books)], axis=1).astype(np.uint8)
        decoded = np.empty_like(rest)
        for i, (p, b) in enumerate(zip(self.parts, self.books)):
            decoded[:, p] = b[codes[:, i]]
        return cell, codes, np.sqrt(((rest - decoded) ** 2).sum(1))

    def probes(self, points: np.ndarray, cell: np.ndarray, radius: float) -> list[np.ndarray]:
        """The lists that can hold a point within ``radius`` of each point, its own included."""
        to = _squared(points, self.centres)
        apart = np.sqrt(_squared(self.centres[cell], self.centres))
        gap = (to - to[np.arange(len(points)), cell][:, None]) / np.maximum(2 * apart, 1e-12)
        near = (gap <= radius + 1e-6) | (apart < 1e-9)
        return [np.flatnonzero(x) for x in near]

    def distances(self, points: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances from points to the coded members of one list, by table lookup."""
        rest = points - self.centres[cell]
        out = np.zeros((len(points), len(codes)))
        for i, (p, b) in enumerate(zip(self.parts, self.books)):
            out += _squared(rest[:, p], b)[:, codes[:, i]]
        return np.sqrt(out)


def _usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    def rows(batches):
        for batch in batches:
            column = batch.column(2)
            values = column.values.to_numpy(zero_copy_only=False)
            offsets, valid = np.asarray(column.offsets), np.asarray(column.is_valid())
            keep, dims, data = [], [], []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                x = values[a:b] if valid[i] else values[:0]
                if len(x) and np.isfinite(x).all() and x.any():
                    keep.append(i)
                    dims.append(len(x))
                    data.append(x.astype("<f8").tobytes())
            if keep:
                taken = batch.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays([taken.column(0), taken.column(1), pa.array(dims, pa.int32()), pa.array(data, pa.binary())],
                                                 ["vec_id", "label", "dim", "vector"])

    rows_in = vectors.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"))
    return mapped(rows_in, rows, _ROWS)


def _units(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(vectors, unit vectors)``; scaled first, so that no square over- or underflows."""
    raw = np.stack([np.frombuffer(x, "<f8") for x in data])
    scaled = raw / np.abs(raw).max(1, keepdims=True)
    return raw, scaled / np.sqrt((scaled ** 2).sum(1))[:, None]


def linked(a: np.ndarray, b: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float, step: int = 1 << 15) -> np.ndarray:
    """Marks the index pairs whose exact cosine is at least ``threshold``."""
    out = np.zeros(len(left), bool)
    norm_a, norm_b = np.sqrt((a ** 2).sum(1)), np.sqrt((b ** 2).sum(1))
    for i in range(0, len(left), step):
        x, y = left[i:i + step], right[i:i + step]
        out[i:i + step] = (a[x] * b[y]).sum(1) / (norm_a[x] * norm_b[y]) >= threshold
    return out


def _least_linked(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` indices reaches by the links."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            return label


def near_vectors(vectors: DataFrame, threshold: float = 0.93, sample_rows: int = 20_000, block_rows: int = 1024, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``: one row for each vector.

    Vectors are linked if their labels are equal and their cosine in double
    precision is ``threshold`` or more. Vectors that are null, empty, zero, or
    hold a null or non-finite component, and those with a null label, are
    linked with nothing, as are vectors of different dimensions. A row with a
    null id is linked with nothing and has a null ``component_id``. Equal
    vectors of one label are linked with each other, repeated rows included.
    """
    spark = vectors.sparkSession
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))
    rows = saved(_usable(vectors, id_col, vector_col, label_col), "vectors")
    node = F.xxhash64("label", "vector")
    nodes = saved(rows.groupBy("label", "dim", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("n")).withColumn("node", node),
                  "vector-nodes")
    n_nodes = nodes.count()
    lists = int(min(4096, max(4, 2 ** round(math.log2(max(1.0, math.sqrt(n_nodes) / 16))))))
    sample = nodes.select("dim", "vector").orderBy(F.xxhash64("vector"), "vector").limit(sample_rows).toPandas()
    fitted = {int(dim): Quantiser(_units(list(group.vector))[1], lists) for dim, group in sample.groupby("dim")}
    shared = spark.sparkContext.broadcast(fitted)  # bounded by the sample: lists x dim and subspaces x codes x dim numbers

    def quantiser(dim: int) -> Quantiser:
        return shared.value.get(dim) or Quantiser(np.zeros((1, dim)), 1)

    def index(batches):
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                q, (_, units) = quantiser(dim), _units(own.column("vector").to_pylist())
                cell, codes, error = q.encode(units)
                yield pa.RecordBatch.from_arrays(
                    [*(own.column(c) for c in ("node", "label", "dim", "vector", "n")), pa.array(cell, pa.int32()),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                     pa.array([p.astype(np.int32) for p in q.probes(units, cell, radius)], pa.list_(pa.int32()))],
                    [c.split()[0] for c in _INDEXED.split(", ")])

    indexed = saved(mapped(nodes.select("node", "label", "dim", "vector", "n"), index, _INDEXED), "vector-index")
    key = ["label", "dim", "list"]
    sizes = indexed.groupBy(key).agg(F.ceil(F.count("*") / F.lit(block_rows)).alias("blocks"))
    placed = indexed.join(sizes, key).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    members = F.struct("node", "vector", "n", "codes", "error")
    blocks = placed.groupBy(*key, "block").agg(F.collect_list(members).alias("members"),
                                               F.array_distinct(F.flatten(F.collect_set("probes"))).alias("probes"))
    blocks = saved(blocks.withColumn("id", F.xxhash64(*key, "block")), "vector-blocks")
    # block pairs by probed lists, each once
    names = blocks.select("label", "dim", "list", "block", "id")
    asked = blocks.select("label", "dim", F.col("id").alias("left"), F.col("list").alias("own"), F.explode("probes").alias("list"))
    pairs = asked.join(names, key).select(F.least("left", "id").alias("left"), F.greatest("left", "id").alias("right")).distinct()
    content = blocks.select("id", "dim", "list", "members")
    part = F.pmod(F.xxhash64("right"), F.lit(8)).cast("int")
    pairs = saved(pairs.select("left", "right", part.alias("part")), "block-pairs")
    # the left block of each group of pairs goes first, then the right blocks are streamed past it
    own = pairs.select("left", F.col("left").alias("id"), "part", F.lit(False).alias("is_right")).distinct()
    stream = pairs.select("left", F.col("right").alias("id"), "part", F.lit(True).alias("is_right")).union(own).join(content, "id")
    stream = stream.repartition(spread(vectors), "left", "part").sortWithinPartitions("left", "part", "is_right", "id")

    def unpack(block):
        ids = np.array([m["node"] for m in block], np.int64)
        raw, units = _units([m["vector"] for m in block])
        counts = np.array([m["n"] for m in block], np.int64)
        return ids, raw, units, counts, np.stack([np.frombuffer(m["codes"], np.uint8) for m in block]), np.array([m["error"] for m in block])

    def compare(batches):
        here = None
        for batch in batches:
            for i in range(batch.num_rows):
                left, block, is_right, dim, cell = (batch.column(c)[i].as_py() for c in ("left", "id", "is_right", "dim", "list"))
                content = unpack(batch.column("members")[i].as_py())
                if not is_right:
                    here = content
                    continue
                ids, raw, units, counts, _, _ = here
                ids_b, raw_b, _, counts_b, codes, error = content
                far = quantiser(dim).distances(units, cell, codes)
                a, b = np.nonzero(far <= radius + error + 1e-6)
                if left == block:
                    a, b = a[a < b], b[a < b]
                good = linked(raw, raw_b, a, b, threshold)
                a, b = a[good], b[good]
                if not len(a):
                    continue
                if left == block:
                    all_ids, all_counts, at_b = ids, counts, b
                else:
                    all_ids, all_counts, at_b = np.append(ids, ids_b), np.append(counts, counts_b), b + len(ids)
                links = np.bincount(a, all_counts[at_b], len(all_ids)) + np.bincount(at_b, all_counts[a], len(all_ids))
                has = np.flatnonzero(links)
                least = _least_linked(len(all_ids), a, at_b)
                yield pa.RecordBatch.from_arrays([pa.array(all_ids[has]), pa.array(links[has].astype(np.int64)), pa.array(all_ids[least[has]])],
                                                 ["node", "links", "other"])

    found = saved(mapped(stream.select("left", "id", "is_right", "dim", "list", "members"), compare, _FOUND), "vector-links")
    joined = components(found.where("node != other").select(F.col("node").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    whole = saved(nodes.select("node", "label", "vector", "first", "n").join(joined, "node", "left").join(links, "node", "left").select(
        "node", "first", F.coalesce("component", "node").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")),
        "vector-components")
    smallest = whole.groupBy("component").agg(F.min("first").alias("component_id"))
    of_node = whole.join(smallest, "component").select("node", "n_links", "component_id")
    found_rows = rows.withColumn("node", node).select("vec_id", "node").join(of_node, "node").select("vec_id", "n_links", "component_id")
    # the other rows: not usable, linked with nothing
    value = F.col(vector_col).cast("array<double>")
    usable = (F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & value.isNotNull() & (F.size(value) > 0)
              & F.coalesce(F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
              & F.coalesce(F.exists(value, lambda x: x != 0), F.lit(False)))
    alone = vectors.where(~F.coalesce(usable, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found_rows.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

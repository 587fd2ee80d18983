import numpy as np

from trendspark.llm import embedding_dedup as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold):
    links, parent = {}, {}
    usable = [(i, np.array(x, np.float32).astype(float), g) for i, x, g in rows
              if i is not None and g is not None and x is not None and len(x) and all(v is not None and np.isfinite(v) for v in x) and any(x)]
    for i, x, g in rows:
        links[i], parent[i] = 0, i

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, x, g) in enumerate(usable):
        for j, y, h in usable[:a]:
            if g == h and len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                links[i] += 1
                links[j] += 1
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    return {i: (links[i], find(i), find(i) == i) for i in links}


def vectors():
    rng = np.random.default_rng(2)
    base = rng.standard_normal((6, 16))
    rows = []
    for i in range(240):
        x = base[i % 6] + rng.standard_normal(16) * rng.uniform(0.05, 0.6)
        rows.append((i, x.astype(np.float32).tolist(), i % 3))
    rows += [(300 + i, rows[0][1], 0) for i in range(30)]
    nan, inf = float("nan"), float("inf")
    rows += [(400, None, 0), (401, [], 0), (402, [0.0] * 16, 0), (403, [None] + [1.0] * 15, 0), (404, [nan] * 16, 0), (405, [inf] + [1.0] * 15, 0),
             (406, rows[0][1], None), (407, [1.0, 2.0], 0), (408, [2.0, 4.0], 0), (409, (np.array(rows[1][1]) * 1e-20).tolist(), 1)]
    return rows


def test_equals_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as node", "'x' as list", "2 as block")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in V.near_vectors(df, 0.93, block_rows=32).collect()}
    assert got == brute(rows, 0.93)


def test_null_ids_and_empty_tables(spark):
    out = V.near_vectors(spark.createDataFrame([(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1)], SCHEMA)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in out), key=repr) == sorted(
        [(None, 0, None, True), (1, 1, 1, True), (2, 1, 1, False)], key=repr)
    assert V.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_probes_and_codes_lose_no_pair_within_the_radius():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((600, 24))
    x[300:] = x[:300] + rng.standard_normal((300, 24)) * 0.04
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = V.Quantiser(x[:200], 8)
    cell, codes, error = q.encode(x)
    radius = float(np.sqrt(2 - 2 * 0.93))
    probes = q.probes(x, cell, radius)
    near = np.argwhere(np.triu(x @ x.T >= 0.93, 1))
    assert len(near) > 100
    for a, b in near:
        assert cell[b] in probes[a] and cell[a] in probes[b]
        assert q.distances(x[a:a + 1], cell[b], codes[b:b + 1])[0, 0] <= radius + error[b] + 1e-6

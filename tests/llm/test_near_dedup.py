import random

from trendspark.llm import near_dedup as N
from trendspark.llm.components import components

from .helpers import CLASHING, DOCUMENTS, frame, near, odd_rows, words


def result(df, **kw):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in N.near_components(df, **kw).collect()}


def test_equals_all_pairs_on_a_group_around_the_threshold(spark):
    rng = random.Random(3)
    base = words(150, 41).split()
    rows = [(i, t) for i, t in odd_rows() if i is not None and i != 12]
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 16)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        rows.append((100 + i, " ".join(w).upper() if i % 7 == 0 else " ".join(w)))
    rows += [(300 + i, " ".join(base)) for i in range(20)]
    for width in (2, 5):
        expected = {i: (n, c, i == c) for i, (n, c) in near(rows, width).items()}
        assert result(frame(spark, rows, clash=True), percent=80, width=width) == expected


def test_null_ids_repeated_rows_and_empty_tables(spark):
    same = words(40, 42)
    out = N.near_components(frame(spark, [(None, same), (1, same), (1, same), (2, same), (3, None), (3, None)])).collect()
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in out), key=repr)
    assert got == sorted([(None, None, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True), (3, 3, True)], key=repr)
    assert N.near_components(frame(spark, [])).count() == 0


def test_one_of_each_keeps_columns_and_one_row_of_a_group(spark):
    same = words(60, 43)
    df = frame(spark, [(4, same), (2, same), (2, same), (9, words(60, 44)), (10, None), (11, "")], clash=True)
    out = N.one_of_each(df).collect()
    assert sorted(r["doc_id"] for r in out) == [2, 9, 10, 11] and list(out[0].asDict()) == df.columns
    assert all(r[c] == "x" for r in out for c in CLASHING)


def test_of_rows_equal_in_id_and_text_one_stays_by_value(spark):
    same = words(60, 43)
    rows = [(1, same, "de", "b", 3), (1, same, "de", "a", 9), (1, same, "en", "a", 1), (2, same, "aa", "a", 1), (None, None, None, "z", 1), (None, None, None, "y", 2)]
    for turn in (rows, rows[::-1]):
        out = N.one_of_each(spark.createDataFrame(turn, DOCUMENTS).repartition(3)).collect()
        assert sorted(((r.doc_id, r.lang, r.source, r.n_chars) for r in out), key=repr) == [(1, "de", "a", 9), (None, None, "y", 2)]
    only = N.one_of_each(spark.createDataFrame([(1, same), (1, same), (2, same)], "doc_id long, text string"))
    assert [r.doc_id for r in only.collect()] == [1]


def test_components_of_a_long_chain_a_star_and_loops(spark):
    chain = [(i, i + 1) for i in range(1, 40)]
    rng = random.Random(1)
    rng.shuffle(chain)
    links = chain + [(100, 100 + i) for i in range(1, 30)] + [(500, 500), (7, 6), (6, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 41)} == {1} and {got[i] for i in range(100, 130)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bitmap_filter_loses_no_wanted_row(spark):
    from trendspark.llm.common import likely_in
    rows = spark.range(5000).selectExpr("id as node", "cast(id as string) as text")
    ids = spark.range(0, 5000, 7).selectExpr("id as node")
    kept = {r.node for r in likely_in(rows, ids, "node", bits=1 << 16).collect()}
    assert kept >= set(range(0, 5000, 7)) and len(kept) < 1200
    assert likely_in(rows, ids.limit(0), "node").count() == 0


def test_lonely_shingles_and_the_bound(spark):
    from pyspark.sql import functions as F
    bodies = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d x y"), (3, "q r s t")], "node long, text string")
    assert {r.node: r.lonely for r in N.lonely_shingles(bodies, 2).collect()} == {1: 2, 2: 2, 3: 3}
    pairs = spark.createDataFrame([(100, 0, 100, 0), (100, 12, 100, 0), (100, 11, 100, 0), (100, 0, 80, 0), (100, 0, 79, 0)],
                                  "na int, la int, nb int, lb int")
    got = [r[0] for r in pairs.select(N.possible(F.col("na"), F.col("la"), F.col("nb"), F.col("lb"), 80)).collect()]
    assert got == [True, False, True, True, False]


def test_pivots_bound_the_last_pairs_and_refute_no_link(spark):
    from pyspark.sql import functions as F
    rng = random.Random(8)
    base = words(120, 45).split()
    texts = {1: " ".join(base)}
    for i in range(2, 40):
        w = list(base)
        for _ in range(rng.randint(2, 9)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(40)}"
        texts[i] = " ".join(w)
    sets = {i: set(N.shingle_set(t, 2).tolist()) for i, t in texts.items()}
    lonely = {i: len(s - set().union(*(o for j, o in sets.items() if j != i))) for i, s in sets.items()}
    bodies = spark.createDataFrame(list(texts.items()), "node long, text string")
    members = spark.createDataFrame([(i, i, len(s), lonely[i]) for i, s in sets.items()] + [(99, 99, 5, 0)], "node long, component long, n long, lonely long")
    tested = spark.createDataFrame([(i, 1) for i in range(2, 40)] + [(3, 2)], "a long, b long")
    out = N.with_pivots(members, tested, bodies, 2)
    got = {r.node: (r.pivot, r.common, r.other) for r in out.collect()}
    assert got.pop(99) == (None, None, None)
    assert got == {i: (1, len(s & sets[1]), max(0, len(s - sets[1]) - lonely[i]) if i != 1 else 0) for i, s in sets.items()}
    one, two = (out.select(*(F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "pivot", "common", "other"))) for x in "ab")
    kept = {(r.node_a, r.node_b) for r in one.join(two, (F.col("node_a") > F.col("node_b")) & N.within_pivot(80)).collect()}
    every = {(a, b) for a in got for b in got if a > b}
    links = {(a, b) for a, b in every if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert links and links <= kept and len(kept - {(99, b) for b in got}) < len(every)


def test_short_signatures_keep_every_agreement(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([([-2**31, -1, 0, 1, 255, 256, 2**31 - 1],)], "signature array<int>")
    assert list(df.select(N.short_signature("signature").alias("s")).first().s) == [-128, 127, -128, -127, 127, -128, 127]


def _edited_family(size, seed):
    """A text and copies of it, each with other words in places of its own: all are near the text, few near each other."""
    rng = random.Random(seed)
    base = words(150, seed + 1, vocabulary=4000).split()
    texts = {1: " ".join(base)}
    for i in range(2, size + 2):
        w = list(base)
        for at in rng.sample(range(len(w)), 14):
            w[at] = f"n{rng.randrange(12)}"
        texts[i] = " ".join(w)
    return texts, {i: set(N.shingle_set(t, 2).tolist()) for i, t in texts.items()}


def test_gaps_refute_copies_edited_in_different_places_and_no_link(spark):
    from pyspark.sql import functions as F
    texts, sets = _edited_family(60, 3)
    lonely = {i: len(s - set().union(*(o for j, o in sets.items() if j != i))) for i, s in sets.items()}
    bodies = spark.createDataFrame(list(texts.items()), "node long, text string")
    members = spark.createDataFrame([(i, i, len(s), lonely[i]) for i, s in sets.items()] + [(99, 99, 5, 0)], "node long, component long, n long, lonely long")
    out = N.with_pivots(members, spark.createDataFrame([(i, 1) for i in texts if i > 1], "a long, b long"), bodies, 2)
    one, two = (out.select(*(F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "pivot", "common", "other", "gaps"))) for x in "ab")
    pairs = one.join(two, F.col("node_a") > F.col("node_b"))
    without = {(r.node_a, r.node_b) for r in pairs.where(N.within_pivot(80)).collect()}
    kept = {(r.node_a, r.node_b) for r in pairs.where(N.within_pivot(80, gaps=True)).collect()}
    links = {(a, b) for a in texts for b in texts if a > b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert links <= kept <= without and all((99, b) in kept for b in texts)
    assert 10 * len(kept - {(99, b) for b in texts} - links) < len(without)


def test_gap_bits_are_folded_and_count_no_shingle_twice():
    import numpy as np
    rng = np.random.default_rng(2)
    for n in (1, 100, 256, 257, 1500):
        base = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        a, b = (base[rng.random(len(base)) < share] for share in (0.9, 0.7))
        gaps = [[x & (2**64 - 1) for x in N.gap_bits(base, s)] for s in (a, b)]
        only = sum((y & ~x).bit_count() for x, y in zip(*gaps))
        common = len(np.intersect1d(a, b))
        assert len(a) - only >= common and (n > 256 or len(a) - only == common)


def test_chance_agreement_posts_no_document(spark):
    """Each document has all of its values in common with some others, but only two documents have most in common with each other."""
    rng = random.Random(4)
    rows = [(i, [rng.randrange(40) for _ in range(N.COORDINATES)]) for i in range(150)]
    near = list(rows[0][1])
    near[::4] = [99] * 12
    nodes = spark.createDataFrame([*rows, (1000, near)], "node long, signature array<int>")
    posted = {r.node: set(r.tokens) for r in N.postings(nodes).collect()}
    assert {0, 1000} <= set(posted) and posted[0] & posted[1000] and len(posted) < 15


def test_pairs_at_the_similarity_share_bands():
    rng = random.Random(6)
    for _ in range(20_000):
        same = [rng.random() < 0.8 for _ in range(N.COORDINATES)]
        assert sum(same) < N.MATCHES or sum(all(same[x] for x in band) for band in N.BANDS) >= N.SHARED

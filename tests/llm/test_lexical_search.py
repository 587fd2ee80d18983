import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from trendspark.llm import lexical_search as S

from .helpers import frame, odd_rows, words

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def found_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=20):
    """Per item row, in order: ``[(doc_id, score)]``; a null document id ranks last among equals."""
    tf = [(i, Counter(found_terms(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in tf]
    n_docs, length_sum = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        scored = []
        for (doc, c), n in zip(tf, lengths):
            m = 100 - 25 + (25 * n * n_docs) // max(length_sum, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in found_terms(text) if c[t])
            if score > 0:
                scored.append((-score, doc is None, doc, score))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, doc, score) for r, (_, _, doc, score) in enumerate(scored[:k])]
    return out


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as item", "1 as term")


def result(spark, docs, items, k=20, **kw):
    out = S.search(frame(spark, docs, clash=True).repartition(5), items_frame(spark, items), k, **kw)
    return sorted(map(tuple, out.collect()), key=repr)


def corpus(n=700, seed=5):
    rng = random.Random(seed)
    return [(i, words(rng.randint(0, 90), rng.randrange(n // 2), vocabulary=60)) for i in range(n)]


@pytest.mark.parametrize("k", [1, 20])
def test_equals_scoring_every_document(spark, monkeypatch, k):
    monkeypatch.setattr(S, "_BLOCK", 64)  # several blocks in a task (read on the driver, sent with the function)
    docs = corpus() + odd_rows()
    items = [(1, words(30, 3, 60)), (2, "W1 w1 w1 w2"), (3, None), (4, ""), (5, "nowhere-else"), (None, "w5 w7 日本語"), (6, docs[10][1]), (6, "w9"),
             (7, "one"), (8, "x" * 3000)]
    assert result(spark, docs, items, k) == sorted(brute(docs, items, k), key=repr)


def test_items_in_several_blocks(spark):
    docs, items = corpus(60), [(i, words(12, i, 60)) for i in range(9)]
    assert result(spark, docs, items, block_bytes=100) == sorted(brute(docs, items), key=repr)


def test_ties_go_by_id_in_a_hot_group_of_copies(spark):
    docs = [(i, "alpha beta") for i in range(3000, 0, -1)] + [(5000, "alpha"), (6000, "gamma delta")] + [(7000 + i, "delta") for i in range(2000)]
    assert result(spark, docs, [(1, "beta gamma")]) == sorted(brute(docs, [(1, "beta gamma")]), key=repr)


def test_empty_tables(spark):
    assert result(spark, [], [(1, "w1")]) == [] and result(spark, corpus(5), []) == []
    assert result(spark, [(1, None), (2, " ")], [(1, "w1"), (2, None)]) == []


def test_maxima_of_ranges():
    rng = np.random.default_rng(0)
    n = 200
    dense = (rng.random((7, n)) < 0.3) * rng.integers(1, 50, (7, n))
    found = [np.flatnonzero(dense[:, d]).astype("<i4").tobytes() for d in range(n)]
    counts = [dense[dense[:, d] > 0, d].astype("<i8").tobytes() for d in range(n)]
    block = S._Block(np.arange(n), np.full(n, 100), found, counts, n, 100 * n)
    impact = (10**9 * dense) // (1000 * dense + 12 * 100)
    lo = rng.integers(0, n, 300)
    hi = np.minimum(n, lo + rng.integers(0, n, 300))
    got = block.maxima(np.arange(7), lo, hi)
    for i, (a, b) in enumerate(zip(lo, hi)):
        for t in range(7):
            best = impact[t, a:b].max(initial=0)
            assert got[t, i] >> 12 == best
            if best:
                assert impact[t, got[t, i] & 0xFFF] == best and a <= got[t, i] & 0xFFF < b


def test_products_beyond_64_bits():
    args = (np.array([3, 4]), np.array([2**40, 7]), [np.array([0], "<i4").tobytes()] * 2, [np.array([5], "<i8").tobytes()] * 2)
    block = S._Block(*args, 2**30, 2**45)
    m = [75 + 25 * x * 2**30 // 2**45 for x in (2**40, 7)]
    assert (block.tables[0] >> 12).tolist() == [5 * 10**9 // (5000 + 12 * x) for x in m]

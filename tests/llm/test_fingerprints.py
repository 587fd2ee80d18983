import hashlib
import random

import numpy as np

from trendspark.llm import fingerprints as P
from trendspark.llm.shingles import shingle_hashes, word_hashes

from .helpers import frame, odd_rows, shingle_set, words


def test_compare_with_next_equals_a_walk_over_the_rows(spark):
    rows = [r for r in odd_rows() if r[0] is not None]
    out = {}
    for r in P.compare_with_next(frame(spark, rows, clash=True)).collect():
        out.setdefault(r.doc_id, []).append(tuple(r)[1:])
    ordered = [(i, t or "") for i, t in sorted(rows, key=lambda r: (r[0], r[1] or ""))]
    for k, (doc, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        a, b, c = map(P.fingerprint, (text, edited, following))
        expected = (len(text), hashlib.sha256(edited.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(), P.likeness(a, b), P.likeness(a, c))
        assert expected in out[doc]
    assert sum(map(len, out.values())) == len(rows)


def test_one_row_follows_itself_and_no_rows_give_none(spark):
    one = P.compare_with_next(frame(spark, [(5, "a b c d e f g h")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert P.compare_with_next(frame(spark, [])).count() == 0
    assert P.compare_with_next(frame(spark, [(None, None), (None, None), (1, "")])).count() == 3


def test_likeness_estimates_the_jaccard_similarity():
    base = words(2000, 21, vocabulary=5000).split()
    for share in (0.05, 0.2, 0.5):
        other = base[:int(len(base) * (1 - share))] + words(int(len(base) * share), 22, vocabulary=5000).split()
        a, b = " ".join(base), " ".join(other)
        sets = shingle_set(a, 5), shingle_set(b, 5)
        exact = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        assert abs(P.likeness(P.fingerprint(a), P.fingerprint(b)) - exact) < 0.15


def test_word_and_shingle_hashes_tell_sets_apart():
    for text in ["", " ", "a", "a b", "a  b\tc\n", "x" * 700 + " y", "é 中 é 中 é"]:
        for width in (1, 2, 5):
            assert len(np.unique(shingle_hashes(word_hashes(text.encode(), lower=True), width))) == len(shingle_set(text, width))
    long = "q" * 1000
    assert len(np.unique(word_hashes(f"{long} {long}z {long[:-1]} z{long}".encode()))) == 4
    assert (word_hashes(b"AbC", lower=True) == word_hashes(b"abc")).all()


def test_near_pairs_are_verified(spark):
    base = words(400, 31)
    rows = [(1, base), (2, base + " tail"), (3, words(400, 32)), (4, base), (5, None), (6, "")]
    found = {(r.doc_id, r.other_id): r.jaccard for r in P.near_pairs(frame(spark, rows)).collect()}
    assert set(found) >= {(2, 1), (4, 1)} and all(v >= 0.8 for v in found.values()) and not any(3 in k for k in found)
    assert P.near_pairs(frame(spark, [])).count() == 0


def test_near_pairs_equal_all_pairs_in_a_family_around_the_threshold(spark):
    rng = random.Random(3)
    base = words(200, 41, vocabulary=5000).split()
    texts = []
    for i in range(40):
        changed = list(base)
        for k in rng.sample(range(200), rng.randint(1, 4) if i else 6):  # the smallest id is near few of the others
            changed[k] = f"new{i}x{k}"
        texts.append(" ".join(changed))
    sets = [shingle_set(t, 5) for t in texts]
    expected = {(b, a) for a in range(40) for b in range(a + 1, 40) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    assert 50 < len(expected) < 700
    rows = list(enumerate(texts)) + [(100, texts[7]), (101, texts[7]), (102, " "), (103, "")]
    found = [(r.doc_id, r.other_id) for r in P.near_pairs(frame(spark, rows)).collect()]
    assert sorted(found) == sorted(expected | {(100, 7), (101, 7)})

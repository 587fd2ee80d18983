import random

import numpy as np

from trendspark.llm import quality as Q

from .helpers import frame, odd_rows, words


def junk(n, seed):
    rng = random.Random(seed)
    kind = seed % 3
    if kind == 0:
        return " ".join(w + rng.choice(["&&&", "***", "%%%"]) for w in words(n, seed).split())
    if kind == 1:
        return " ".join([words(1, seed)] * n)
    return words(n, seed).upper().replace(" ", "!! ")


def corpus(n=300):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        size = rng.randint(20, 300)
        rows.append((i, words(size, 1000 + i) if good else junk(size, i // 4)))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_accuracy_and_whole_texts(spark):
    rows, labels = corpus()
    df = frame(spark, rows, clash=True)
    marks = spark.createDataFrame(labels + [(None, 1, 0), (5, None, 0), (999999, 0, 0)], "doc_id long, quality int, toxic int")
    out = Q.scored(df, marks).collect()
    truth = {i: q for i, q, _ in labels}
    assert len(out) == len(rows)
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    tested = [r for r in out if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in tested]) >= 0.9
    kept = Q.good_documents(df, marks)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {r.doc_id for r in out if r.predicted == 1}


def test_labels_of_held_out_rows_change_nothing(spark):
    rows, labels = corpus(120)
    import zlib
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in labels]
    a, b = (Q.fit(frame(spark, rows), spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flipped))
    assert all((a.weights[k] == b.weights[k]).all() for k in a.weights)


def test_odd_rows_and_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = Q.scored(frame(spark, odd_rows()), none).collect()
    assert len(out) == len(odd_rows()) and all(0 <= r.score <= 1 for r in out)
    assert Q.scored(frame(spark, []), none).count() == 0


def test_features_cover_the_whole_text_in_bounded_pieces():
    net = Q.Network.fresh()
    text = words(30000, 9).encode()
    whole, pieces = net.features(text), net.features(text, piece=8192)
    assert np.allclose(whole, pieces, atol=1e-5)
    marked = text[:-9] + b"&&&&&&&&&"
    assert not np.allclose(net.features(marked), whole)
    for n in range(0, 20):
        assert np.isfinite(net.features(b"a" * n)).all()


def test_training_lowers_the_loss():
    chunks, labels = [[words(40, i).encode()] for i in range(8)], [0, 1] * 4
    before = Q.train(chunks, labels, steps=1)
    after = Q.train(chunks, labels, steps=60)

    def loss(net):
        return float(np.mean([-np.log(max(1e-9, net.score(c[0]) if y else 1 - net.score(c[0]))) for c, y in zip(chunks, labels)]))

    assert loss(after) < loss(before)

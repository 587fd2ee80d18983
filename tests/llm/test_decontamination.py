import hashlib
import random
import re

from trendspark.llm import decontamination as D

from .helpers import frame, odd_rows, words

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def found_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = found_words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + window]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, ids = found_words(text), set(), set()
        for k in lengths:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit.update(range(i, i + k))
                    ids |= {str(x) for x in windows[tuple(w[i:i + k])] if x is not None}
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as words", "1 as tokens")


def result(spark, docs, items, **kw):
    return sorted(map(tuple, D.contamination(frame(spark, docs, clash=True), items_frame(spark, items), **kw).collect()), key=repr)


def planted():
    rng = random.Random(8)
    items = [(i, words(rng.randint(1, 40), 100 + i, vocabulary=25)) for i in range(40)]
    items += [(50, "one"), (51, "it's 3"), (52, None), (53, "  - "), (None, words(20, 900)), (54, words(30, 7)), (54, words(30, 8)), (10, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1")]
    docs = odd_rows()
    for i in range(150):
        text = words(rng.randint(0, 200), 300 + i, vocabulary=25)
        for _ in range(rng.randrange(3)):
            own = found_words(rng.choice(items)[1])
            if own:
                a = rng.randrange(len(own))
                part = rng.choice([" ", ", ", "\n"]).join(own[a:a + rng.randint(5, 25)])
                at = rng.randint(0, len(text))
                text = text[:at] + " " + part.upper() + " " + text[at:]
        docs.append((1000 + i, text))
    docs += [(2000, " ".join(["w1"] * 60)), (2001, "w1 " * 9), (2002, words(20, 900))]
    return docs, items


def test_equals_comparing_every_window(spark):
    docs, items = planted()
    got = result(spark, docs, items)
    assert got == brute(docs, items)
    assert sum(r[-1] for r in got) > 30 and any(r[2] and not r[3] for r in got)


def test_other_widths_and_windows(spark):
    docs, items = planted()
    for window, width in ((3, 4), (8, 1), (13, 6)):
        assert result(spark, docs, items, window=window, width=width) == brute(docs, items, window)


def test_a_hot_passage_and_a_hot_window(spark):
    passage = words(40, 77)
    docs = [(i, f"start {i} {passage} end {i % 7}") for i in range(600)] + [(5000 + i, words(30, i)) for i in range(50)]
    items = [(i, f"a{i} {passage}") for i in range(30)]
    assert result(spark, docs, items) == brute(docs, items)


def test_windows_over_the_edges_of_documents(spark):
    item = "a b c d e f g h i j k"
    docs = [(1, "a b c d e f g h i"), (2, "b c d e f g h i j k"), (3, "x a b c d e f g h i j"), (4, "c d e f g h i j k l"), (5, item)]
    assert result(spark, docs, [(1, item)]) == brute(docs, [(1, item)])


def test_empty_tables(spark):
    assert result(spark, [], [(1, "a b")]) == []
    docs = [(1, "a b c"), (2, None), (None, "a b")]
    assert result(spark, docs, []) == brute(docs, [])
    assert result(spark, docs, [(1, None)]) == brute(docs, [])


def test_clean_documents_keep_their_columns(spark):
    docs, items = planted()
    df = frame(spark, docs, clash=True)
    dirty = {r[0] for r in brute(docs, items) if r[-1]}
    out = D.clean_documents(df, items_frame(spark, items))
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(((i, t) for i, t in docs if i not in dirty), key=repr)

"""Small documents tables with odd rows, and brute-force versions of the operators."""

import hashlib
import random
import re

from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                          T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Columns whose names the operators use inside.
CLASHING = ["key", "tag", "spans", "node", "component", "task", "bin", "shard", "slot", "size", "load", "length", "rank", "token", "part", "same", "low",
            "_found", "_between", "_score", "_raw", "_kept", "_key", "_tag", "_spans", "_list", "_of", "_of_tag", "_text", "_id", "_label", "_hash",
            "_rest", "c0", "c1", "row", "raw", "matches", "lonely", "place"]


def words(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgéßñ中") for _ in range(rng.randint(1, 8))) if rng.random() < 0.2
                    else f"w{rng.randrange(vocabulary)}" for _ in range(n))


def frame(spark, texts, clash=False):
    """A documents table of ``(doc_id, text)`` pairs, with clashing extra columns if asked for."""
    rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in texts]
    df = spark.createDataFrame(rows, DOCUMENTS)
    if clash:
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit("x") for c in CLASHING})
    return df


def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, short and very long texts."""
    long_text = words(9000, 1)
    shared = words(120, 2)
    rows = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one"), (6, long_text), (7, long_text + " tail"), (None, "no id at all"),
            (8, words(60, 3) + " " + shared + " " + words(50, 4)), (9, shared + " " + words(70, 5)), (10, "x" * 3000), (11, "ab" * 2000),
            (12, words(300, 6)), (12, words(300, 6)), (13, "it's 3 o'clock'll we''re 'the  \n\n end 　  "), (14, "é" * 500), (15, "日本語" * 300)]
    rows += [(20 + i, words(200, 7) + (" extra" * (i % 3))) for i in range(12)]
    return rows


def removed(rows, length=400):
    """Per row ``(doc_id, bytes, removed, spans, sha256 of what is kept)`` of repeated strings, by looking at every start."""
    seen = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, b in data:
        for k in range(len(b) - length + 1):
            s = b[k:k + length]
            seen[s] = seen.get(s, 0) + 1
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingle_set(text, width):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return frozenset()
    return frozenset(zip(*[found[i:] for i in range(width)])) if len(found) >= width else frozenset([tuple(found)])


def near(rows, width, percent=80):
    """``doc_id -> (shingles, component)`` by comparing all pairs."""
    sets = {i: shingle_set(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def table_folder(spark, tmp_path, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)

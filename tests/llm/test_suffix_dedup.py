import random

import pytest

from trendspark.llm import suffix_dedup as S

from .helpers import frame, odd_rows, removed, words


def digests(df):
    return sorted((tuple(r) for r in S.removal_digests(df).collect()), key=repr)


def test_equals_brute_force_on_odd_rows(spark):
    rows = odd_rows()
    assert digests(frame(spark, rows, clash=True)) == sorted(removed(rows), key=repr)


def test_equals_brute_force_on_overlapping_copies(spark):
    rng = random.Random(5)
    base = words(500, 11)
    rows = []
    for i in range(40):
        a = rng.randrange(len(base) - 700)
        cut = base[a:a + rng.randint(380, 700)]
        rows.append((i, words(rng.randint(0, 60), 100 + i) + cut + words(rng.randint(0, 60), 200 + i) + (cut[:450] if i % 5 == 0 else "")))
    assert digests(frame(spark, rows)) == sorted(removed(rows), key=repr)


@pytest.mark.parametrize("partitions", [2, 8])
def test_parts_of_texts_that_have_many_copies(spark, partitions):
    rows = []
    for i in range(30):
        base = words(260, 300 + i)
        rows += [(100 * i + k, base) for k in range(20)]
        for k in range(3):
            a = random.Random(10 * i + k).randrange(40, 300)
            rows.append((100 * i + 50 + k, words(12, 5000 + 10 * i + k) + base[a:a + 470 + 25 * k] + words(12, 9000 + 10 * i + k)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert digests(frame(spark, rows)) == sorted(removed(rows), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_row_dealt_by_its_keys_is_the_first_of_its_equals(spark):
    """In whatever order rows arrive, as after a sort that spills."""
    rows = [(k, i, i % 7, i % 3, 2 - (k == 15)) for i in range(60) for k in range(16)]
    dealt = S._dealt(spark.createDataFrame(rows, "key long, low int, first long, second long, seen byte").coalesce(1), ["first", "second"])
    for part in dealt.rdd.glom().collect():
        first_of = {}
        for r in part:
            first_of.setdefault((r["first"], r["second"]), r["seen"])
        home = {(r["first"], r["second"]) for r in part if r["seen"] < 2}
        assert all(first_of[k] < 2 for k in home)


def test_strings_at_the_threshold(spark):
    s = words(200, 12)[:400]
    assert len(s.encode()) >= 400
    data = s.encode()[:400].decode(errors="ignore")
    data += "z" * (400 - len(data.encode()))
    rows = [(1, "A" + data + "B"), (2, "C" + data + "D"), (3, "E" + data[:-1] + "!")]
    assert digests(frame(spark, rows)) == sorted(removed(rows), key=repr)


def test_empty_table(spark):
    df = frame(spark, [])
    assert S.removal_digests(df).count() == 0
    assert S.remove_repeats(df).columns == df.columns


def test_remove_repeats_keeps_rows_columns_and_characters(spark):
    rows = odd_rows()
    df = frame(spark, rows, clash=True)
    out = S.remove_repeats(df).collect()
    assert len(out) == len(rows) and set(out[0].asDict()) == set(df.columns)
    by_id = {r["doc_id"]: r["text"] for r in out}
    assert by_id[1] is None and by_id[2] == "" and by_id[10] == "" and by_id[14] == ""
    assert by_id[12] == ""  # a repeated row is a copy


def test_too_short_a_length_is_refused(spark):
    with pytest.raises(ValueError):
        S.with_spans(frame(spark, [(1, "a")]), 100)


def test_characters_are_not_cut():
    data = "aéb".encode()
    assert S.on_characters(data, [(2, 4)]) == [(3, 4)] and S.on_characters(data, [(0, 2)]) == [(0, 1)]
    assert S.merged([5 << 32 | 9, 1 << 32 | 5, 20 << 32 | 30, 5 << 32 | 9]) == [(1, 9), (20, 30)]

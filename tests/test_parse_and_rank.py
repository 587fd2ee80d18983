"""Parsing with quarantine (P1, P2, P12), best row / top-1."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trendspark import schemas
from trendspark.operators import ranking
from trendspark.plans import hot
from trendspark.sources.topics import parse_topic


def test_malformed_and_overflow(spark):
    raw = spark.createDataFrame([
        ("garbage",),
        ('{"viewer_count": 3000000000, "user_name": "a"}',),
        ('{"viewer_count": 5, "user_name": "b"}',),
        ('{"viewer_count": 7}',),
    ], "value string")
    good, bad = parse_topic(raw, schemas.TWITCH_STREAMS, "user_name")
    g = sorted((r.user_name, r.viewer_count) for r in good.collect())
    assert g == [("a", None), ("b", 5)]          # overflow -> null, rest survives
    assert sorted(r.raw_value for r in bad.collect()) == ["garbage", '{"viewer_count": 7}']


def test_binary_value_is_decoded(spark):
    raw = spark.createDataFrame([(bytearray(b'{"subreddit": "x", "score": 3}'),)], "value binary")
    good, _ = parse_topic(raw, schemas.REDDIT, "subreddit")
    assert [(r.subreddit, r.score) for r in good.collect()] == [("x", 3)]


def test_score_tie_breaks_by_title_then_url(spark):
    posts = spark.createDataFrame([
        ("s", 10, "a", "u2"), ("s", 10, "b", "u1"), ("s", 10, "b", "u0"), ("s", 9, "z", "u9"),
    ], "subreddit string, score int, title string, url string")
    best = hot.reddit_best_posts(posts).collect()[0]
    assert (best.best_score, best.best_title, best.best_url) == (10, "b", "u1")
    assert best.json_value == '{"best_title":"b","best_score":10,"best_url":"u1"}'


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5), st.integers(0, 3)),
                min_size=1, max_size=30))
def test_top1_equals_python_max(spark, data):
    df = spark.createDataFrame(data, "k string, m int, t int")
    got = {r.k: (r.m, r.t) for r in ranking.top1_per_key(df, "k", "m", ["t"]).collect()}
    want = {}
    for k, m, t in data:
        want[k] = max(want.get(k, (m, t)), (m, t))
    assert got == want


def test_one_row_per_key_is_fixed(spark):
    rows = [("k", i % 3, f"v{i}") for i in range(20)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, a int, b string").repartition(5)
    out = ranking.one_row_per_key(df, "k").collect()
    assert [(r.k, r.a, r.b) for r in out] == [("k", 2, "v8")]


def test_ranked_read_orders_ties_by_member(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", 5.0), ("d", 1.0)], "member string, score double")
    assert [r.member for r in ranking.ranked_read(df, n=3).collect()] == ["c", "a", "b"]
    assert [r.member for r in ranking.ranked_read(df, n=2, ascending=True).collect()] == ["d", "a"]


def test_youtube_sum_drops_null_category(spark):
    v = spark.createDataFrame([("c1", 5), ("c1", 7), (None, 100)], "category string, views long")
    assert [(r.category, r.total_views) for r in hot.youtube_category_views(v).collect()] == [("c1", 12)]


def test_tiktok_member_is_whole_document(spark):
    s = spark.createDataFrame([
        ("#3", "song", "2,013,570", "+41,200", "EG", "u", "Not Found", "2025-01-01 10:00:00"),
        ("#x", "song", "2,013,570", "+41,200", "EG", "u", "Not Found", "2025-01-02 10:00:00"),
    ], schemas.TIKTOK)
    rows = sorted((r.member, r.rank_score) for r in hot.tiktok_members(s).collect())
    assert len(rows) == 2 and rows[0][1] == 3 and rows[1][1] == 999   # re-fetch = new member
    assert '"fetched_at":"2025-01-01 10:00:00"' in rows[0][0]

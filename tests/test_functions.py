"""Scalar functions on the hand-made edge rows (FIXTURES §4) and against
small Python models of the published cleaning rules."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trendspark.functions import keys, text, times


def _one(spark, col, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(col(F.col("x")).alias("y")).collect()]


def test_rank_text(spark):
    # '#12' -> 12, '#1,2' -> 999, null -> 999, '# 7 ' -> 7
    assert _one(spark, text.rank_score, ["#12", "#1,2", None, "# 7 "]) == [12, 999, 999, 7]


def test_count_text(spark):
    # last token; empty -> '0'; surrounding newlines ignored
    vals = ["2M\n 2,013,570", "", "\n2M\n 2,013,570 \n", None, "\t5\t"]
    assert _one(spark, text.last_token, vals) == ["2,013,570", "0", "2,013,570", "0", "5"]


def test_growth_text(spark):
    # first token
    assert _one(spark, text.first_token, ["+41,200\n +3.7 %", ""]) == ["+41,200", "0"]


def test_percent_text(spark):
    # F16: split '%' joined to the token before it; else the first token with '%'
    vals = ["+95\n +12.4\n %", "+41,200 +3.7%", "12", "", None]
    assert _one(spark, text.percent_token, vals) == ["+12.4%", "+3.7%", "12", "0%", "0%"]


def _py_last(s):
    parts = s.split()
    return parts[-1] if parts else "0"


def _py_first(s):
    parts = s.split()
    return parts[0] if parts else "0"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=" \t\nab1,+%K", max_size=12), min_size=1, max_size=8))
def test_tokens_match_python_split(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = df.select(text.last_token("x").alias("l"), text.first_token("x").alias("f")).collect()
    assert [(r.l, r.f) for r in got] == [(_py_last(v), _py_first(v)) for v in values]


def test_rank_matches_python_int(spark):
    vals = ["#1", "#42", "# 7 ", "#x", "#1,2", "#-3", "#+4", "##5", "#"]

    def model(v):
        try:
            return int(v.replace("#", ""))
        except ValueError:
            return 999
    assert _one(spark, text.rank_score, vals) == [model(v) for v in vals]


def test_template_and_sentinel(spark):
    assert _one(spark, lambda c: text.fill_size_template(c, "320x180"),
                ["a-{width}x{height}.jpg", None]) == ["a-320x180.jpg", None]
    assert _one(spark, text.not_found, [None, "x"]) == ["Not Found", "x"]
    assert _one(spark, text.count_or_zero, ["12", None]) == [12, 0]


def test_absolute_url(spark):
    df = spark.createDataFrame([
        ("/sound/1", "https://charts.example.org"),
        ("sound/2", "https://charts.example.org/dash/list?page=2"),
        ("//cdn.example.org/x", "https://charts.example.org"),
        ("https://other.example/y", "https://charts.example.org"),
    ], "h string, b string")
    got = [r[0] for r in df.select(text.absolute_url("h", "b")).collect()]
    assert got == ["https://charts.example.org/sound/1", "https://charts.example.org/dash/sound/2",
                   "https://cdn.example.org/x", "https://other.example/y"]


def test_epoch_iso_is_utc(spark):
    # F8: the same text as datetime.fromtimestamp(x, tz=utc).isoformat()
    for secs in (0, 1764869484, 1704067207):
        want = dt.datetime.fromtimestamp(secs, tz=dt.timezone.utc).isoformat()
        assert _one(spark, times.epoch_to_iso_utc, [secs], "bigint") == [want]


def test_date_time_keys(spark):
    df = spark.createDataFrame([("2025-12-04T07:05:09.123456",), ("2025-01-31T23:59:00",)], "x string")
    got = df.select(keys.date_key("x").alias("d"), keys.time_key("x").alias("t")).collect()
    assert [(r.d, r.t) for r in got] == [(20251204, "0705"), (20250131, "2359")]


def test_normalized_key_is_one_key(spark):
    # J2: ' Funny ' and 'funny' -> one key; null -> null key
    df = spark.createDataFrame([(" Funny ",), ("funny",), (None,)], "x string")
    out = df.select(keys.surrogate_key("Reddit", keys.normalize_key("x")).alias("k")).collect()
    assert out[0].k == out[1].k and out[0].k is not None and out[2].k is None

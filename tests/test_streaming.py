"""Streaming forms equal the batch forms."""

import datetime as dt

from pyspark.sql import functions as F

from trendspark.functions.records import to_json_value
from trendspark.plans import hot, warehouse
from trendspark.sinks.serving import ServingStore
from trendspark.session import read_table
from trendspark.sources import standins
from trendspark.sources.topics import parse_topic, text_stream
from trendspark.streaming import archive, warehouse as wh_stream
from trendspark.streaming import hot as hot_stream
from trendspark import schemas

from conftest import SF_SMALL, rows


def _drop_files(spark, df, path, parts):
    to_json_value(df).repartition(parts).write.mode("overwrite").text(path)


def _posts(spark):
    return standins.reddit_posts(read_table(spark, SF_SMALL, "events"))


def _run(q):
    q.awaitTermination()
    assert q.exception() is None


def test_stream_update_best_equals_batch(spark, tmp_path):
    posts = _posts(spark)
    want = rows(hot.reddit_best_posts(posts), "subreddit", "json_value")
    for parts in (1, 3):
        src = str(tmp_path / f"in{parts}")
        _drop_files(spark, posts, src, parts)
        store = ServingStore(spark, str(tmp_path / f"views{parts}"))
        ckpt = str(tmp_path / f"ckpt{parts}")
        raw = text_stream(spark, src, max_files_per_trigger=1)
        _run(hot_stream.start_reddit_best(raw, store, ckpt, trigger={"availableNow": True}))
        got = rows(store.read("reddit_subreddits_details"), "member", "json_value")
        assert got == want
        # T5: a second run over the same files with the same checkpoint does nothing
        before = store.versions("reddit_subreddits_details")
        raw = text_stream(spark, src, max_files_per_trigger=1)
        _run(hot_stream.start_reddit_best(raw, store, ckpt, trigger={"availableNow": True}))
        assert store.versions("reddit_subreddits_details") == before


def test_stream_complete_sum_equals_batch(spark, tmp_path):
    posts = _posts(spark)
    src = str(tmp_path / "in")
    _drop_files(spark, posts, src, 3)
    store = ServingStore(spark, str(tmp_path / "views"))
    raw = text_stream(spark, src, max_files_per_trigger=1)
    _run(hot_stream.start_reddit_rank(raw, store, str(tmp_path / "ckpt"), trigger={"availableNow": True}))
    want = rows(hot.reddit_score_totals(posts).select("subreddit", F.col("total_score").cast("double")))
    assert rows(store.read("reddit_subreddits_rank"), "member", "score") == want


def test_stream_replace_view_keeps_last_batch(spark, tmp_path):
    streams = standins.twitch_streams(read_table(spark, SF_SMALL, "events"))
    src = str(tmp_path / "in")
    # three drops, one per trigger
    for i, cond in enumerate(["ts < '2024-01-10'", "ts >= '2024-01-10' and ts < '2024-01-20'", "ts >= '2024-01-20'"]):
        ev = read_table(spark, SF_SMALL, "events").where(cond)
        to_json_value(standins.twitch_streams(ev)).coalesce(1).write.text(f"{src}/d{i}")
    # garbage and keyless lines land in the first drop
    extra = spark.createDataFrame([("garbage",), ('{"viewer_count": 3}',)], "value string")
    extra.coalesce(1).write.mode("append").text(f"{src}/d0")
    store = ServingStore(spark, str(tmp_path / "views"))
    raw = text_stream(spark, f"{src}/*", max_files_per_trigger=1)
    q = hot_stream.start_view_query(raw, "twitch_streams", store, str(tmp_path / "ckpt"),
                                    quarantine=str(tmp_path / "bad"), trigger={"availableNow": True})
    _run(q)
    bad = spark.read.parquet(str(tmp_path / "bad"))
    assert sorted(r.raw_value for r in bad.collect()) == ["garbage", '{"viewer_count": 3}']
    last = standins.twitch_streams(read_table(spark, SF_SMALL, "events").where("ts >= '2024-01-20'"))
    want_rank = rows(hot.twitch_top_streams(last).select("user_name", F.col("viewer_count").cast("double")))
    assert rows(store.read("twitch_streamers_rank"), "member", "score") == want_rank
    # details are upserted: every user seen in any batch stays
    assert store.read("twitch_streamers_details").count() == streams.select("user_name").distinct().count()


def test_archive_then_incremental_load(spark, tmp_path):
    posts = _posts(spark)
    src = str(tmp_path / "in")
    _drop_files(spark, posts.drop("ingested_at"), src, 2)
    bad = spark.createDataFrame([("garbage",)], "value string")
    bad.write.mode("append").text(src)
    lake = str(tmp_path / "lake")
    when = F.lit(dt.datetime(2025, 1, 2, 3, 4, 5)).cast("timestamp_ntz")
    raw = text_stream(spark, src)
    q = archive.start_archive(raw, lake, "reddit_data", str(tmp_path / "ck_arch"), route_ts=when,
                              trigger={"availableNow": True}, rejects=str(tmp_path / "rejects"))
    _run(q)
    for s in spark.streams.active:
        s.awaitTermination()
    day = spark.read.text(f"{lake}/topic=reddit_data/year=2025/month=01/day=02")
    assert day.count() == posts.count()
    target = str(tmp_path / "wh")
    ckpt = str(tmp_path / "ck_wh")
    wh_stream.run_all(spark, lake, target, ckpt, topics=("reddit_data",), max_files_per_trigger=1)
    fact = spark.read.parquet(f"{target}/Fact_Redit_Activity")
    assert fact.count() == posts.count()
    assert fact.select("ingested_date_sk").distinct().collect()[0][0] == 20250102
    dims = spark.read.parquet(f"{target}/Dim_Subreddit")
    assert dims.count() == posts.select(F.lower(F.trim("subreddit"))).distinct().count()
    assert spark.read.parquet(f"{target}/Dim_Platform").count() == 4
    # second run: nothing new, nothing appended
    wh_stream.run_all(spark, lake, target, ckpt, topics=("reddit_data",), max_files_per_trigger=1)
    assert spark.read.parquet(f"{target}/Fact_Redit_Activity").count() == posts.count()
    # keys agree with the batch star over the same records
    lake_df = spark.read.schema(schemas.lake_schema("reddit_data")).json(f"{lake}/topic=reddit_data")
    batch = warehouse.reddit_star(lake_df)["Fact_Redit_Activity"]
    assert rows(batch, "post_sk", "subreddit_sk") == rows(fact, "post_sk", "subreddit_sk")


def test_ttl_views_through_streams_and_await_any(spark, tmp_path):
    """C2 + C5 as T1 queries in one session (T6), views expiring 24 h after
    their last non-empty batch (K7) with an injected clock."""
    li = read_table(spark, SF_SMALL, "lineitem")
    part = read_table(spark, SF_SMALL, "part")
    videos = standins.youtube_videos(li, part).drop("ingested_at")
    early, late = videos.where("ingestion_timestamp < '1998'"), videos.where("ingestion_timestamp >= '1998'")
    src = str(tmp_path / "yt")
    to_json_value(early).coalesce(1).write.text(f"{src}/a")
    to_json_value(late).coalesce(1).write.text(f"{src}/b")
    from trendspark.plans.landing import chart_records
    sounds = chart_records(standins.tiktok_chart_rows(li), "https://charts.example.org").drop("ingested_at")
    to_json_value(sounds).coalesce(1).write.text(str(tmp_path / "tt"))

    store = ServingStore(spark, str(tmp_path / "views"))
    clock_times = iter([dt.datetime(2025, 1, 1, 0), dt.datetime(2025, 1, 1, 10), dt.datetime(2025, 1, 1, 5)])
    clock = lambda: next(clock_times)
    q1 = hot_stream.start_view_query(text_stream(spark, f"{src}/*", max_files_per_trigger=1), "youtube_data",
                                     store, str(tmp_path / "ck1"), trigger={"availableNow": True}, clock=clock)
    q1.awaitTermination()
    q2 = hot_stream.start_view_query(text_stream(spark, str(tmp_path / "tt")), "tiktok_data",
                                     store, str(tmp_path / "ck2"), trigger={"availableNow": True}, clock=clock)
    hot_stream.await_any(spark)
    q2.awaitTermination()
    spark.streams.resetTerminated()

    # category sums: the last batch's sum per category it holds, older ones kept
    early_sums = dict((r.category, r.total_views) for r in hot.youtube_category_views(early).collect())
    late_sums = dict((r.category, r.total_views) for r in hot.youtube_category_views(late).collect())
    want = {**early_sums, **late_sums}
    got = {r.member: r.score for r in store.read("youtube_category_views", now=dt.datetime(2025, 1, 2, 9)).collect()}
    assert got == {k: float(v) for k, v in want.items()}
    # expiry: youtube views last written at 10:00, tiktok at 05:00
    assert store.read("youtube_category_views", now=dt.datetime(2025, 1, 2, 9)).count() == len(want)
    assert store.read("youtube_category_views", now=dt.datetime(2025, 1, 2, 11)).count() == 0
    assert store.read("tiktok_trends_eg", now=dt.datetime(2025, 1, 2, 4)).count() == \
        hot.tiktok_members(sounds).count()
    assert store.read("tiktok_trends_eg", now=dt.datetime(2025, 1, 2, 6)).count() == 0
    top = store.ranked("tiktok_trends_eg", n=3, ascending=True, now=dt.datetime(2025, 1, 2, 4)).collect()
    assert [r.score for r in top] == [1.0, 1.0, 1.0]


def test_a_held_batch_keeps_the_text_of_rejects_only(spark):
    from trendspark import schemas
    from trendspark.streaming import hot as streams
    texts = ['{"sound_name": "s", "rank": "#1"}', "garbage", '{"rank": "#2"}']
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    got = {(r.raw_value, r._good, r.sound_name) for r in streams._tagged(raw, schemas.TIKTOK, "sound_name").collect()}
    assert got == {(None, True, "s"), ("garbage", False, None), ('{"rank": "#2"}', False, None)}


def test_topics_that_wait_in_folders_are_compressed(spark, tmp_path, monkeypatch):
    from trendspark import catalog
    monkeypatch.setattr(catalog, "_run_dir", lambda _spark, _kind: str(tmp_path / "run"))
    catalog.QUERIES["stream_two_queries"](spark, SF_SMALL)
    texts = spark.read.text(str(tmp_path / "run" / "sounds"))
    assert texts.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    written = sum(f.stat().st_size for f in (tmp_path / "run" / "sounds").glob("part-*"))
    assert written < 0.5 * sum(len(r.value) for r in texts.collect())

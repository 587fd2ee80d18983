"""Table sinks (K1, K3, K13), lake scans (S4, S6) and loads over several drops."""

import datetime as dt

from pyspark.sql import functions as F

from trendspark import schemas
from trendspark.functions.records import to_json_value
from trendspark.plans import hot
from trendspark.session import read_table
from trendspark.sinks.tables import append_table, create_if_absent, read_snapshot, write_snapshot
from trendspark.sources import standins
from trendspark.sources.lake import infer_schema, read_lake
from trendspark.sources.topics import text_stream
from trendspark.streaming import archive
from trendspark.streaming import hot as hot_stream
from trendspark.streaming import warehouse as wh

from conftest import SF_SMALL, rows


def test_append_counts_in_one_pass(spark, tmp_path):
    df = spark.range(37)
    assert append_table(df, str(tmp_path / "t")) == 37
    assert append_table(df, str(tmp_path / "t")) == 37
    assert spark.read.parquet(str(tmp_path / "t")).count() == 74


def test_create_if_absent_is_noop_second_time(spark, tmp_path):
    create_if_absent(spark.range(3), str(tmp_path / "d"))
    create_if_absent(spark.range(10), str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "d")).count() == 3


def _archive_drop(spark, posts, src, lake, ckpt, when):
    to_json_value(posts.drop("ingested_at")).coalesce(1).write.mode("append").text(src)
    raw = text_stream(spark, src)
    q = archive.start_archive(raw, lake, "reddit_data", ckpt, route_ts=F.lit(when).cast("timestamp_ntz"),
                              trigger={"availableNow": True})
    q.awaitTermination()


def test_lake_pruning_and_two_drop_load(spark, tmp_path):
    ev = read_table(spark, SF_SMALL, "events")
    first = standins.reddit_posts(ev.where("ts < '2024-01-15'"))
    second = standins.reddit_posts(ev.where("ts >= '2024-01-15'"))
    src, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    _archive_drop(spark, first, src, lake, str(tmp_path / "ck_a"), dt.datetime(2025, 12, 31, 23, 0))
    target, ck = str(tmp_path / "wh"), str(tmp_path / "ck_w")
    wh.run_all(spark, lake, target, ck, topics=("reddit_data",))
    _archive_drop(spark, second, src, lake, str(tmp_path / "ck_a"), dt.datetime(2026, 1, 1, 1, 0))
    wh.run_all(spark, lake, target, ck, topics=("reddit_data",))

    # Partition columns prune by year; S4: inference sees the lake fields
    assert read_lake(spark, lake, "reddit_data", years=[2026]).count() == second.count()
    assert read_lake(spark, lake, "reddit_data").count() == first.count() + second.count()
    plan = read_lake(spark, lake, "reddit_data", years=[2026])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "ingested_at" in infer_schema(spark, f"{lake}/topic=reddit_data").fieldNames()

    fact = spark.read.parquet(f"{target}/Fact_Redit_Activity")
    assert fact.count() == first.count() + second.count()
    assert sorted(r[0] for r in fact.select("ingested_date_sk").distinct().collect()) == [20251231, 20260101]
    # entity dimension: one row per subreddit although both drops hold every subreddit
    dim = spark.read.parquet(f"{target}/Dim_Subreddit")
    assert dim.count() == dim.select("subreddit_sk").distinct().count() == 5
    assert fact.join(dim, "subreddit_sk", "left_anti").count() == 0


def test_summary_snapshot_complete_mode(spark, tmp_path):
    posts = standins.reddit_posts(read_table(spark, SF_SMALL, "events"))
    src = str(tmp_path / "in")
    to_json_value(posts).repartition(2).write.text(src)
    out = str(tmp_path / "summary")
    q = hot_stream.start_reddit_summary(text_stream(spark, src, max_files_per_trigger=1), out,
                                        str(tmp_path / "ck"), trigger={"availableNow": True})
    q.awaitTermination()
    assert rows(read_snapshot(spark, out)) == rows(hot.reddit_summary(posts))


def test_publish_then_parse_roundtrip(spark, tmp_path):
    from trendspark.sinks.publish import publish, publish_stream
    from trendspark.sources.topics import parse_topic
    streams = standins.twitch_streams(read_table(spark, SF_SMALL, "events"))
    publish(streams, "twitch_streams", path=str(tmp_path / "topics"))
    raw = spark.read.text(str(tmp_path / "topics/topic=twitch_streams"))
    good, bad = parse_topic(raw, schemas.TWITCH_STREAMS, "user_name")
    assert bad.count() == 0
    assert rows(good) == rows(streams.select(*schemas.TWITCH_STREAMS.fieldNames()))
    # streaming publish of the parsed stream, checkpointed
    q = publish_stream(text_stream(spark, str(tmp_path / "topics/topic=twitch_streams")), "copy",
                       str(tmp_path / "ck"), path=str(tmp_path / "out"), cols=["value"],
                       trigger={"availableNow": True})
    q.awaitTermination()
    assert spark.read.text(str(tmp_path / "out/topic=copy")).count() == streams.count()


def test_bad_lake_lines_and_dates_do_not_stop_a_load(spark, tmp_path):
    lake = tmp_path / "lake/topic=youtube_data/year=2025/month=01/day=01"
    lake.mkdir(parents=True)
    line = '{"video_id": "%s", "title": "%s", "channel": "c", "category": %s, "views": 1, "likes": 1, "ingested_at": "%s"}'
    (lake / "a.json").write_text("\n".join([line % ("v1", "old", '"A"', "2025-01-01T00:00:00.000000"), "garbage",
                                            line % ("v2", "t", "null", "not a time"), '{"title": "no id"}']))
    target, ck = str(tmp_path / "wh"), str(tmp_path / "ck")
    wh.run_all(spark, str(tmp_path / "lake"), target, ck, topics=("youtube_data",))
    sink = wh.warehouse_sink(spark, target)
    fact = sink.read("Fact_Youtube_Performance")
    assert fact.count() == 2 and fact.where("ingested_date_sk is null").count() == 1
    assert sink.read("Dim_Category").collect()[0].category_name_nk == "A" and sink.read("Dim_Category").count() == 1
    assert sorted(r.raw_value for r in spark.read.parquet(f"{ck}/youtube_data_quarantine").collect()) == ["garbage", '{"title":"no id"}']
    # a later drop renames v1: the newest title wins, keys stay unique in the table itself
    (lake / "b.json").write_text("\n".join([line % ("v1", "new", '"A"', "2025-01-02T00:00:00.000000"), line % ("v3", "t", '"A"', "2025-01-02T00:00:00.000000")]))
    wh.run_all(spark, str(tmp_path / "lake"), target, ck, topics=("youtube_data",))
    assert {r.video_id_nk: r.video_title for r in sink.read("Dim_Video").collect()} == {"v1": "new", "v2": "t", "v3": "t"}
    assert spark.read.parquet(f"{target}/Dim_Video").count() == 3


def test_a_broken_target_is_an_error(spark, tmp_path):
    import pytest
    from trendspark.sinks.tables import read_if_exists
    assert read_if_exists(spark, str(tmp_path / "none")) is None
    (tmp_path / "broken").mkdir()
    with pytest.raises(Exception):
        read_if_exists(spark, str(tmp_path / "broken")).count()


def test_row_keys_tell_parts_apart(spark):
    from trendspark.functions.keys import row_key
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a", None), ("a", "\\N")], "x string, y string")
    assert df.select(row_key("P", "x", "y").alias("k")).distinct().count() == 4

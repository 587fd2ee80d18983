"""Job entry points over landed JSON-lines folders."""

from trendspark import jobs
from trendspark.functions.records import to_json_value
from trendspark.sinks.tables import read_snapshot
from trendspark.plans import hot
from trendspark.session import read_table
from trendspark.sinks.serving import ServingStore
from trendspark.sources import standins

from conftest import SF_SMALL, rows


def test_hot_archive_and_warehouse_jobs(spark, tmp_path):
    ev = read_table(spark, SF_SMALL, "events")
    landing = str(tmp_path / "landing")
    posts = standins.reddit_posts(ev).drop("ingested_at")
    to_json_value(posts).coalesce(2).write.text(f"{landing}/topic=reddit_data")
    to_json_value(standins.twitch_streams(ev).drop("ingested_at", "type")).coalesce(2) \
        .write.text(f"{landing}/topic=twitch_streams")

    views = str(tmp_path / "views")
    jobs.main(["hot", "--topics", "reddit_data,twitch_streams", "--landing", landing, "--views", views,
               "--checkpoint", str(tmp_path / "ck_hot"), "--once"], spark=spark)
    store = ServingStore(spark, views)
    assert rows(store.read("reddit_subreddits_details"), "member", "json_value") == \
        rows(hot.reddit_best_posts(posts), "subreddit", "json_value")
    assert store.read("twitch_streamers_details").count() == ev.select("user_id").distinct().count()

    lake = str(tmp_path / "lake")
    jobs.main(["archive", "--topics", "reddit_data", "--landing", landing, "--lake", lake,
               "--checkpoint", str(tmp_path / "ck_arch"), "--once"], spark=spark)
    jobs.main(["warehouse", "--lake", lake, "--target", str(tmp_path / "wh"), "--topics", "reddit_data",
               "--checkpoint", str(tmp_path / "ck_wh")], spark=spark)
    assert spark.read.parquet(str(tmp_path / "wh/Fact_Redit_Activity")).count() == posts.count()


def test_poll_scope_over_all_topics(spark, tmp_path):
    ev, li, part = (read_table(spark, SF_SMALL, t) for t in ("events", "lineitem", "part"))
    landing = str(tmp_path / "landing")
    from trendspark.plans.landing import chart_records
    records = {"reddit_data": standins.reddit_posts(ev), "twitch_streams": standins.twitch_streams(ev).drop("type"),
               "twitch_games": standins.twitch_games(ev), "youtube_data": standins.youtube_videos(li, part),
               "tiktok_data": chart_records(standins.tiktok_chart_rows(li), "https://charts.example.org")}
    for topic, df in records.items():
        to_json_value(df.drop("ingested_at")).write.text(f"{landing}/topic={topic}")
    spark.createDataFrame([("garbage",)], "value string").write.mode("append").text(f"{landing}/topic=reddit_data")
    views, summary = str(tmp_path / "views"), str(tmp_path / "summary")
    jobs.main(["hot", "--landing", landing, "--views", views, "--checkpoint", str(tmp_path / "ck"), "--scope", "poll", "--once",
               "--rank", "--summary", summary], spark=spark)
    store = ServingStore(spark, views, policies=hot.POLL_POLICIES)
    newest = standins.twitch_streams(ev).agg({"fetched_at": "max"}).first()[0]
    rank = {r.member: r.score for r in store.read("twitch_streamers_rank").collect()}
    last = standins.twitch_streams(ev).where(f"fetched_at = '{newest}'")
    assert rank == {r.user_name: float(r.viewer_count) for r in hot.twitch_top_streams(last).collect()}
    assert store.read("youtube_category_views").count() > 0 and store.read("tiktok_trends_eg").count() > 0
    assert rows(store.read("reddit_subreddits_rank"), "member") == rows(records["reddit_data"].select("subreddit").distinct(), "subreddit")
    assert rows(read_snapshot(spark, summary)) == rows(hot.reddit_summary(records["reddit_data"]))
    # rejects are there when the job returns
    assert [r.raw_value for r in spark.read.json(str(tmp_path / "ck/reddit_data_quarantine")).collect()] == ["garbage"]


def test_landing_job(spark, tmp_path):
    import pytest
    rows_html = "".join(f'<tr><td>#{i}</td><td><a href="/sound/{i}">s{i}</a></td>' + "<td>1</td>" * 6 + "</tr>" for i in (1, 2))
    pages = spark.createDataFrame([("https://c.example.org/list", f"<table><tbody>{rows_html}</tbody></table>")], "url string, html string")
    pages.write.parquet(str(tmp_path / "pages"))
    details = spark.createDataFrame([("https://c.example.org/sound/1", "<a href='https://www.tiktok.com/music/x'>m</a>")], "url string, html string")
    details.write.parquet(str(tmp_path / "details"))
    args = ["landing", "--kind", "chart", "--input", str(tmp_path / "pages"), "--details", str(tmp_path / "details"), "--out", str(tmp_path / "out")]
    with pytest.raises(SystemExit):
        jobs.main(args, spark=spark)               # the base URL has no default
    jobs.main([*args, "--base", "https://c.example.org"], spark=spark)
    got = {r.sound_name: (r.tokchart_url, r.tiktok_direct_url) for r in spark.read.json(str(tmp_path / "out/topic=tiktok_data")).collect()}
    assert got == {"s1": ("https://c.example.org/sound/1", "https://www.tiktok.com/music/x"), "s2": ("https://c.example.org/sound/2", "Not Found")}
    replies = spark.createDataFrame([("youtube", 200, "t", '{"items": [{"id": "v", "snippet": {"categoryId": "1"}}]}'), ("youtube", 500, "t", "{}")],
                                    "source string, status int, fetched_at string, body string")
    replies.write.parquet(str(tmp_path / "replies"))
    spark.createDataFrame([("1", "Music")], "id string, name string").write.parquet(str(tmp_path / "cats"))
    jobs.main(["landing", "--kind", "youtube", "--input", str(tmp_path / "replies"), "--lookup", str(tmp_path / "cats"),
               "--out", str(tmp_path / "out")], spark=spark)
    assert [(r.video_id, r.category) for r in spark.read.json(str(tmp_path / "out/topic=youtube_data")).collect()] == [("v", "Music")]


def test_warehouse_in_another_format(spark, tmp_path):
    ev = read_table(spark, SF_SMALL, "events")
    landing, lake, target = (str(tmp_path / x) for x in ("landing", "lake", "wh"))
    for topic, df in (("reddit_data", standins.reddit_posts(ev)), ("twitch_streams", standins.twitch_streams(ev))):
        to_json_value(df.drop("ingested_at")).coalesce(2).write.text(f"{landing}/topic={topic}")
    jobs.main(["archive", "--topics", "reddit_data,twitch_streams", "--landing", landing, "--lake", lake,
               "--checkpoint", str(tmp_path / "ck_a"), "--once"], spark=spark)
    jobs.main(["warehouse", "--lake", lake, "--target", target, "--topics", "reddit_data,twitch_streams", "--checkpoint",
               str(tmp_path / "ck_w"), "--format", "orc", "--option", "compression=zlib"], spark=spark)
    assert spark.read.orc(f"{target}/Fact_Redit_Activity").count() == spark.read.orc(f"{target}/Fact_Twitch_Performance").count() == ev.count()

"""Surrogate keys (J1-J4, F6) and lookups with defaults."""

from pyspark.sql import functions as F

from trendspark.operators.lookups import lookup_with_default
from trendspark.plans import landing, warehouse


def _twitch_rows(spark):
    return spark.createDataFrame([
        ("u1", "g1", "t1", 10, "th", "2025-01-01T10:00:00", "stream", "2025-01-01T10:00:01.000001"),
        ("u1", "g1", "t2", 12, "th", "2025-01-01T10:01:00", "stream", "2025-01-01T10:01:01.000001"),
        ("u2", "g2", "t3", 5, "th", "2025-01-01T10:00:00", "stream", "2025-01-01T10:00:01.000002"),
        ("u3", None, "t4", 1, "th", "2025-01-01T10:00:00", "stream", "2025-01-01T10:00:01.000003"),
    ], "user_name string, game_name string, title string, viewer_count long, thumbnail_url string, "
       "fetched_at string, type string, ingested_at string")


def _integrity(tables):
    fact = tables["Fact_Twitch_Performance"]
    for dim, key in (("Dim_Game", "game_sk"), ("Dim_Stream", "stream_sk")):
        d = tables[dim].groupBy(key).count()
        j = fact.where(F.col(key).isNotNull()).join(d, key, "left")
        bad = j.where(F.col("count").isNull() | (F.col("count") != 1)).count()
        assert bad == 0, dim


def test_key_integrity_md5_and_uuid_with_shuffle_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for mode in ("md5", "uuid"):
            tables = warehouse.twitch_star(_twitch_rows(spark).repartition(3), mode=mode)
            _integrity(tables)
            fact = tables["Fact_Twitch_Performance"].collect()
            assert len(fact) == 4
            # null natural key -> null surrogate key; a (null, null) dimension row
            assert [r.game_sk for r in fact if r.viewer_count == 1] == [None]
            games = tables["Dim_Game"].collect()
            assert sorted((r.game_name_nk is None, r.game_sk is None) for r in games) == \
                [(False, False), (False, False), (True, True)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_md5_keys_are_stable_across_batches(spark):
    a = warehouse.twitch_star(_twitch_rows(spark))["Dim_Game"]
    b = warehouse.twitch_star(_twitch_rows(spark).where("user_name = 'u1'"))["Dim_Game"]
    ka = {r.game_name_nk: r.game_sk for r in a.collect()}
    kb = {r.game_name_nk: r.game_sk for r in b.collect()}
    assert kb["g1"] == ka["g1"]


def test_subreddit_case_and_padding_share_a_key(spark):
    posts = spark.createDataFrame([
        (" Funny ", 1, 2, "t", "u1", "2025-01-01T00:00:00+00:00", "x", "2025-01-01T00:00:01.000000"),
        ("funny", 3, 4, "t2", "u2", "2025-01-01T00:00:00+00:00", "x", "2025-01-01T00:00:01.000000"),
    ], "subreddit string, score long, num_comments long, title string, url string, "
       "post_timestamp string, ingestion_timestamp string, ingested_at string")
    t = warehouse.reddit_star(posts)
    assert t["Dim_Subreddit"].count() == 1
    assert t["Fact_Redit_Activity"].select("subreddit_sk").distinct().count() == 1


def test_unknown_category_is_other(spark):
    df = spark.createDataFrame([("1",), ("9",), (None,)], "category_id string")
    lk = spark.createDataFrame([("1", "Music")], "id string, name string")
    out = lookup_with_default(df, lk, "category_id", "id", {"name": ("category", "Other")})
    assert sorted((r.category_id or "", r.category) for r in out.collect()) == \
        [("", "Other"), ("1", "Music"), ("9", "Other")]


def test_empty_game_id_counted_and_unknown(spark):
    body = ('{"data": [{"user_name": "a", "game_id": "", "game_name": "", "title": "t", "viewer_count": 5,'
            ' "thumbnail_url": "x-{width}x{height}.jpg"},'
            ' {"user_name": "b", "game_id": "", "game_name": "", "title": "t", "viewer_count": 7,'
            ' "thumbnail_url": "y-{width}x{height}.jpg"},'
            ' {"user_name": "c", "game_id": "7", "game_name": "G", "title": "t", "viewer_count": 1,'
            ' "thumbnail_url": "z"},'
            ' {"user_name": "d", "game_id": "8", "game_name": "H", "title": "t", "viewer_count": 2,'
            ' "thumbnail_url": "z"}]}')
    replies = spark.createDataFrame([("twitch", 200, "2025-01-01T00:00:00", body),
                                     ("twitch", 429, "2025-01-01T00:01:00", body)],
                                    "source string, status int, fetched_at string, body string")
    games = spark.createDataFrame([("7", "Game7", "art-{width}x{height}.jpg"), ("", "Empty", "e")],
                                  "id string, name string, box_art_url string")
    streams, per_game = landing.twitch_records(replies, games)
    assert streams.count() == 4                      # the 429 reply is skipped
    assert sorted(r.thumbnail_url for r in streams.collect())[0] == "x-320x180.jpg"
    got = sorted((r.game_name, r.box_art_url, r.total_viewers) for r in per_game.collect())
    assert got == [("Game7", "art-285x380.jpg", 1), ("Unknown", "", 2), ("Unknown", "", 12)]


def test_youtube_reply_defaults(spark):
    body = ('{"items": [{"id": "v1", "snippet": {"title": "T", "channelTitle": "C", "categoryId": "10",'
            ' "publishedAt": "2025-01-01T00:00:00Z"}, "statistics": {"viewCount": "123"}},'
            ' {"id": "v2", "snippet": {"title": "T2", "channelTitle": "C", "categoryId": "99",'
            ' "publishedAt": "2025-01-01T00:00:00Z"}}]}')
    replies = spark.createDataFrame([("youtube", 200, "2025-01-01T00:00:00", body),
                                     ("youtube", 200, "2025-01-01T00:05:00", '{"kind": "empty"}')],
                                    "source string, status int, fetched_at string, body string")
    cats = spark.createDataFrame([("10", "Music")], "id string, name string")
    out = sorted(tuple(r) for r in landing.youtube_records(replies, cats)
                 .select("video_id", "views", "likes", "category", "video_url").collect())
    assert out == [("v1", 123, 0, "Music", "https://www.youtube.com/watch?v=v1"),
                   ("v2", 0, 0, "Other", "https://www.youtube.com/watch?v=v2")]


def test_lookup_is_broadcast_by_its_bytes_only(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("k"))
    lk = spark.range(100).select(F.col("id").cast("string").alias("id"), F.lit("n").alias("name"))
    for threshold, want in (("10m", "BroadcastHashJoin"), ("-1", "SortMergeJoin")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
        try:
            out = lookup_with_default(df, lk, "k", "id", {"name": ("name", "Other")})
            assert out.where("name = 'Other'").count() == 100
            out.collect()
            assert want in out._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")

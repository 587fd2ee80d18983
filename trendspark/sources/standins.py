"""Topic-shaped records derived from the benchmark tables.

The test tables are not social-platform data; these adapters give them the
published record shapes so the real operators run on them at full size:

* ``events``   -> reddit posts and twitch streams (event_type = subreddit /
  game, user_id = user, value = score / viewers, props = title, ts = post
  time; a poll is the hour of ``ts``).
* ``lineitem`` (+ ``part``) -> youtube video snapshots (l_orderkey = video,
  l_suppkey = channel, l_extendedprice = views, p_brand = category,
  l_shipdate = ingestion time) and tiktok chart rows.

Every mapping is a projection (plus one key join for the category), so it
keeps the scan's column pruning and adds no shuffle of its own except that
join. The matching SQL lives next to the registered queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import iso_naive

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def _poll(ts):
    return F.date_trunc("hour", ts)


def _score(value):
    # scores and viewer counts are integers: points-with-cents -> int
    return F.round(value * 100).cast("int")


def reddit_posts(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("subreddit"),
        _score(F.col("value")).alias("score"),
        F.col("user_id").cast("int").alias("num_comments"),
        F.col("props").alias("title"),
        F.concat(F.lit("https://example.org/r/"), F.col("event_id").cast("string")).alias("url"),
        F.concat(F.date_format("ts", ISO_SECONDS), F.lit("+00:00")).alias("post_timestamp"),
        F.concat(F.date_format(_poll(F.col("ts")), ISO_SECONDS), F.lit("+00:00")).alias("ingestion_timestamp"),
        iso_naive(F.col("ts")).alias("ingested_at"),
    )


def twitch_streams(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_name"),
        F.col("event_type").alias("game_name"),
        F.col("props").alias("title"),
        _score(F.col("value")).alias("viewer_count"),
        F.concat(F.lit("https://static.example.org/previews/live_user_"),
                 F.col("user_id").cast("string"), F.lit("-320x180.jpg")).alias("thumbnail_url"),
        F.date_format(_poll(F.col("ts")), ISO_SECONDS).alias("fetched_at"),
        F.lit("stream").alias("type"),
        iso_naive(F.col("ts")).alias("ingested_at"),
    )


def twitch_games(events: DataFrame) -> DataFrame:
    """Per poll and game: the summed viewers (the producer's A6)."""
    streams = twitch_streams(events)
    return (streams.groupBy("fetched_at", "game_name")
            .agg(F.sum("viewer_count").alias("total_viewers"))
            .select("game_name",
                    F.concat(F.lit("https://static.example.org/boxart/"), F.col("game_name"),
                             F.lit("-285x380.jpg")).alias("box_art_url"),
                    "total_viewers", "fetched_at", F.lit("game").alias("type")))


def youtube_videos(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                         "l_extendedprice", "l_shipdate")
    p = part.select(F.col("p_partkey"), F.col("p_brand"))
    joined = li.join(p, li.l_partkey == p.p_partkey, "left")
    vid = F.col("l_orderkey").cast("string")
    return joined.select(
        vid.alias("video_id"),
        F.concat(F.lit("video "), vid).alias("title"),
        F.concat(F.lit("channel_"), F.col("l_suppkey").cast("string")).alias("channel"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("views"),
        F.col("l_quantity").cast("bigint").alias("likes"),
        F.col("p_brand").alias("category"),
        F.concat(F.date_format("l_shipdate", ISO_SECONDS), F.lit("Z")).alias("published_at"),
        F.concat(F.lit("https://www.youtube.com/watch?v="), vid).alias("video_url"),
        iso_naive(F.col("l_shipdate")).alias("ingestion_timestamp"),
        iso_naive(F.col("l_shipdate")).alias("ingested_at"),
    )


def tiktok_chart_rows(lineitem: DataFrame, with_order: bool = False) -> DataFrame:
    """Raw chart cells as scraped: rank text, sound, ugc text, growth text...

    ``with_order`` keeps ``l_orderkey`` (the chart page a row belongs to).
    """
    ln = F.col("l_linenumber")
    s = lambda c: F.col(c).cast("string")
    rank_text = (F.when(ln == 6, F.concat(F.lit("# "), s("l_linenumber"), F.lit(" ")))
                 .when(ln == 7, F.concat(F.lit("#"), s("l_linenumber"), F.lit(","), s("l_suppkey")))
                 .otherwise(F.concat(F.lit("#"), s("l_linenumber"))))
    ugc_text = (F.when(ln == 5, F.lit(""))
                .otherwise(F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("K\n "),
                                    (F.col("l_partkey") * 7 + F.col("l_suppkey")).cast("string"),
                                    F.when(ln == 4, F.lit(" \n")).otherwise(F.lit("")))))
    growth_text = (F.when(ln == 3, F.lit(""))
                   .otherwise(F.concat(F.lit("+"), (ln * 100).cast("string"), F.lit("\n +"),
                                       F.round(F.col("l_discount") * 100).cast("int").cast("string"),
                                       F.lit(" %"))))
    return lineitem.select(
        *(["l_orderkey"] if with_order else []),
        rank_text.alias("rank_text"),
        F.concat(F.lit("sound "), s("l_partkey")).alias("sound_name"),
        ugc_text.alias("ugc_text"),
        growth_text.alias("growth_text"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("author_country"),
        F.concat(F.lit("/sound/"), s("l_partkey")).alias("sound_href"),
        F.when(F.col("l_linestatus") == "O",
               F.concat(F.lit("https://www.tiktok.com/music/s-"), s("l_partkey"))).alias("direct_link"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("fetch_timestamp"),
        iso_naive(F.col("l_shipdate")).alias("ingested_at"),
    )

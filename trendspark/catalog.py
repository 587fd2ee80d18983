"""Registered queries: Spark callables and their DuckDB oracle SQL.

Every query reads whole benchmark tables (through the stand-in adapters of
``sources.standins``) and runs the library's operators on them; the SQL
next to it computes the same result independently. Column names, types
and rounding match on both sides.
"""

from __future__ import annotations

import uuid as _uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import schemas
from .functions.keys import date_key, time_key
from .functions.records import parse_records, to_json_value
from .functions.text import (fill_size_template, first_token, last_token, not_found,
                             percent_token, strip_ws, url_from_id)
from .functions.times import epoch_to_iso_utc
from .operators.dims import attach_key, dimension
from .operators.lookups import lookup_with_default
from .operators.ranking import best_row_per_key, ranked_read, top_n
from .plans import hot, landing, warehouse
from .session import read_table, scratch_path
from .sinks import serving
from .sources import standins

QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _t(spark, sf_dir, name):
    return read_table(spark, sf_dir, name)


# base URL of the rendered chart pages
CHART_BASE = "https://charts.example.org"


# ---------------------------------------------------------------------------
# Stand-in records as SQL (the same mappings as sources.standins)
# ---------------------------------------------------------------------------

REDDIT_SQL = """
SELECT event_type AS subreddit,
       CAST(round(value * 100) AS INTEGER) AS score,
       CAST(user_id AS INTEGER) AS num_comments,
       props AS title,
       'https://example.org/r/' || CAST(event_id AS VARCHAR) AS url,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS post_timestamp,
       strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS ingestion_timestamp,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ingested_at
FROM events"""

TWITCH_SQL = """
SELECT 'user_' || CAST(user_id AS VARCHAR) AS user_name,
       event_type AS game_name,
       props AS title,
       CAST(round(value * 100) AS INTEGER) AS viewer_count,
       'https://static.example.org/previews/live_user_' || CAST(user_id AS VARCHAR) || '-320x180.jpg' AS thumbnail_url,
       strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') AS fetched_at,
       'stream' AS type,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ingested_at
FROM events"""

GAMES_SQL = """
SELECT game_name,
       'https://static.example.org/boxart/' || game_name || '-285x380.jpg' AS box_art_url,
       CAST(sum(viewer_count) AS BIGINT) AS total_viewers, fetched_at, 'game' AS type
FROM (""" + TWITCH_SQL + """) s
GROUP BY fetched_at, game_name"""

YOUTUBE_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) AS video_id,
       'video ' || CAST(l_orderkey AS VARCHAR) AS title,
       'channel_' || CAST(l_suppkey AS VARCHAR) AS channel,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS views,
       CAST(l_quantity AS BIGINT) AS likes,
       p_brand AS category,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') || 'Z' AS published_at,
       'https://www.youtube.com/watch?v=' || CAST(l_orderkey AS VARCHAR) AS video_url,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f') AS ingestion_timestamp,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f') AS ingested_at
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey"""

CHART_SQL = """
SELECT CASE WHEN l_linenumber = 6 THEN '# ' || CAST(l_linenumber AS VARCHAR) || ' '
            WHEN l_linenumber = 7 THEN '#' || CAST(l_linenumber AS VARCHAR) || ',' || CAST(l_suppkey AS VARCHAR)
            ELSE '#' || CAST(l_linenumber AS VARCHAR) END AS rank_text,
       'sound ' || CAST(l_partkey AS VARCHAR) AS sound_name,
       CASE WHEN l_linenumber = 5 THEN ''
            ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || 'K' || chr(10) || ' '
                 || CAST(l_partkey * 7 + l_suppkey AS VARCHAR)
                 || CASE WHEN l_linenumber = 4 THEN ' ' || chr(10) ELSE '' END END AS ugc_text,
       CASE WHEN l_linenumber = 3 THEN ''
            ELSE '+' || CAST(l_linenumber * 100 AS VARCHAR) || chr(10) || ' +'
                 || CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || ' %' END AS growth_text,
       l_returnflag || l_linestatus AS author_country,
       '/sound/' || CAST(l_partkey AS VARCHAR) AS sound_href,
       CASE WHEN l_linestatus = 'O' THEN 'https://www.tiktok.com/music/s-' || CAST(l_partkey AS VARCHAR) END AS direct_link,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS fetch_timestamp,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f') AS ingested_at
FROM lineitem"""

# whitespace helpers in DuckDB terms (RE2 \\s is ASCII whitespace)
def _strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _last_tok_sql(x: str) -> str:
    return f"coalesce(nullif(list_last(regexp_split_to_array({_strip_sql(x)}, '\\s+')), ''), '0')"


def _first_tok_sql(x: str) -> str:
    return f"coalesce(nullif(regexp_split_to_array({_strip_sql(x)}, '\\s+')[1], ''), '0')"


# ---------------------------------------------------------------------------
# Hot path (C1-C5, C14, C15)
# ---------------------------------------------------------------------------

def _reddit_topic(spark, sf_dir) -> DataFrame:
    """events -> published JSON records -> parsed with the reddit schema."""
    published = to_json_value(standins.reddit_posts(_t(spark, sf_dir, "events")))
    good, _bad = _parse(published, schemas.REDDIT, "subreddit")
    return good


def _parse(published, schema, key):
    from .sources.topics import parse_topic
    return parse_topic(published, schema, key)


@register("best_row_per_key", """
WITH r AS (""" + REDDIT_SQL + """),
a AS (SELECT subreddit, max(struct_pack(score := score, title := title, url := url)) AS b
      FROM r GROUP BY subreddit)
SELECT subreddit, b.title AS best_title, b.score AS best_score, b.url AS best_url,
       json_object('best_title', b.title, 'best_score', b.score, 'best_url', b.url)::VARCHAR AS json_value
FROM a""")
def q_best_row_per_key(spark, sf_dir):
    return hot.reddit_best_posts(_reddit_topic(spark, sf_dir))


@register("newest_row_per_key", """
WITH r AS (""" + REDDIT_SQL + """),
a AS (SELECT subreddit, max(struct_pack(t := post_timestamp, title := title, url := url)) AS n
      FROM r GROUP BY subreddit)
SELECT subreddit, n.t AS new_timestamp, n.title AS new_title, n.url AS new_url FROM a""")
def q_newest_row_per_key(spark, sf_dir):
    return hot.reddit_newest_posts(_reddit_topic(spark, sf_dir))


@register("key_summary", """
WITH r AS (""" + REDDIT_SQL + """),
a AS (SELECT subreddit, CAST(sum(score) AS BIGINT) AS total_score,
             max(struct_pack(score := score, title := title, url := url)) AS top,
             max(struct_pack(t := post_timestamp, title := title, url := url)) AS nw
      FROM r GROUP BY subreddit)
SELECT subreddit, total_score, top.title AS high_title, top.score AS high_score, top.url AS high_url,
       nw.title AS new_title, nw.url AS new_url FROM a""")
def q_key_summary(spark, sf_dir):
    return hot.reddit_summary(_reddit_topic(spark, sf_dir))


@register("running_score_rank", """
WITH r AS (""" + REDDIT_SQL + """)
SELECT subreddit, CAST(sum(score) AS BIGINT) AS total_score FROM r GROUP BY subreddit""")
def q_running_score_rank(spark, sf_dir):
    totals = hot.reddit_score_totals(_reddit_topic(spark, sf_dir))
    return ranked_read(totals, score="total_score", member="subreddit")


@register("reddit_details_view", """
WITH r AS (""" + REDDIT_SQL + """),
a AS (SELECT subreddit, max(struct_pack(score := score, title := title, url := url)) AS b
      FROM r GROUP BY subreddit)
SELECT 'reddit_subreddits_details' AS view, subreddit AS member, CAST(NULL AS DOUBLE) AS score,
       json_object('best_title', b.title, 'best_score', b.score, 'best_url', b.url)::VARCHAR AS json_value
FROM a""")
def q_reddit_details_view(spark, sf_dir):
    return hot.reddit_details_view(_reddit_topic(spark, sf_dir))


def _youtube_topic(spark, sf_dir) -> DataFrame:
    videos = standins.youtube_videos(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "part"))
    good, _ = _parse(to_json_value(videos), schemas.YOUTUBE, "video_id")
    return good


@register("group_views_sum", """
WITH v AS (""" + YOUTUBE_SQL + """)
SELECT category, CAST(sum(views) AS BIGINT) AS total_views FROM v
WHERE category IS NOT NULL GROUP BY category""")
def q_group_views_sum(spark, sf_dir):
    return hot.youtube_category_views(_youtube_topic(spark, sf_dir))


@register("group_views_sum_per_poll", """
WITH v AS (""" + YOUTUBE_SQL + """)
SELECT ingestion_timestamp, category, CAST(sum(views) AS BIGINT) AS total_views FROM v
WHERE category IS NOT NULL GROUP BY ingestion_timestamp, category""")
def q_group_views_sum_per_poll(spark, sf_dir):
    return hot.youtube_category_views(_youtube_topic(spark, sf_dir), scope="ingestion_timestamp")


_TOP_VIDEO_SQL = """
WITH v AS (""" + YOUTUBE_SQL + """),
a AS (SELECT category, max(struct_pack(views := views, title := title, channel := channel,
                                       video_url := video_url, video_id := video_id)) AS t
      FROM v WHERE category IS NOT NULL GROUP BY category)
SELECT category, t.views AS views, t.title AS title, t.channel AS channel, t.video_url AS video_url,
       t.video_id AS video_id,
       json_object('title', t.title, 'channel', t.channel, 'views', t.views, 'url', t.video_url)::VARCHAR AS json_value
FROM a"""


@register("group_top_item", _TOP_VIDEO_SQL)
def q_group_top_item(spark, sf_dir):
    return hot.youtube_top_videos(_youtube_topic(spark, sf_dir))


@register("youtube_views", """
WITH v AS (""" + YOUTUBE_SQL + """),
t AS (""" + _TOP_VIDEO_SQL + """)
SELECT 'youtube_category_views' AS view, category AS member, CAST(sum(views) AS DOUBLE) AS score,
       CAST(NULL AS VARCHAR) AS json_value
FROM v WHERE category IS NOT NULL GROUP BY category
UNION ALL
SELECT 'youtube_category_top_video', category, CAST(NULL AS DOUBLE), json_value FROM t""")
def q_youtube_views(spark, sf_dir):
    return hot.youtube_views(_youtube_topic(spark, sf_dir))


def _twitch_topic(spark, sf_dir) -> DataFrame:
    streams = standins.twitch_streams(_t(spark, sf_dir, "events"))
    good, _ = _parse(to_json_value(streams), schemas.TWITCH_STREAMS, "user_name")
    return good


_TOP_STREAM_SQL = """
WITH s AS (""" + TWITCH_SQL + """),
a AS (SELECT user_name, max(struct_pack(viewer_count := viewer_count, game_name := game_name,
                                        title := title, thumbnail_url := thumbnail_url)) AS t
      FROM s GROUP BY user_name)
SELECT user_name, t.viewer_count AS viewer_count, t.game_name AS game_name, t.title AS title,
       t.thumbnail_url AS thumbnail_url,
       json_object('game', t.game_name, 'title', t.title, 'thumb', t.thumbnail_url, 'views', t.viewer_count)::VARCHAR AS json_value
FROM a"""


@register("streamer_rank", _TOP_STREAM_SQL)
def q_streamer_rank(spark, sf_dir):
    return hot.twitch_top_streams(_twitch_topic(spark, sf_dir))


@register("streamer_top10", """
WITH t AS (""" + _TOP_STREAM_SQL + """)
SELECT 'twitch_streamers_rank' AS view, user_name AS member, CAST(viewer_count AS DOUBLE) AS score,
       CAST(NULL AS VARCHAR) AS json_value
FROM t ORDER BY score DESC, member LIMIT 10""")
def q_streamer_top10(spark, sf_dir):
    views = hot.twitch_streamer_views(_twitch_topic(spark, sf_dir))
    rank = views.where(F.col("view") == "twitch_streamers_rank")
    return ranked_read(rank, n=10)


def _games_topic(spark, sf_dir) -> DataFrame:
    games = standins.twitch_games(_t(spark, sf_dir, "events"))
    good, _ = _parse(to_json_value(games), schemas.TWITCH_GAMES, "game_name")
    return good


_TOP_GAME_SQL = """
WITH g AS (""" + GAMES_SQL + """),
a AS (SELECT game_name, max(struct_pack(total_viewers := CAST(total_viewers AS INTEGER),
                                        box_art_url := box_art_url)) AS t
      FROM g GROUP BY game_name)
SELECT game_name, t.total_viewers AS total_viewers, t.box_art_url AS box_art_url,
       json_object('img', t.box_art_url, 'views', t.total_viewers)::VARCHAR AS json_value
FROM a"""


@register("game_rank", _TOP_GAME_SQL)
def q_game_rank(spark, sf_dir):
    return hot.twitch_top_games(_games_topic(spark, sf_dir))


@register("game_views", """
WITH t AS (""" + _TOP_GAME_SQL + """)
SELECT 'twitch_games_rank' AS view, game_name AS member, CAST(total_viewers AS DOUBLE) AS score,
       CAST(NULL AS VARCHAR) AS json_value FROM t
UNION ALL
SELECT 'twitch_games_details', game_name, CAST(NULL AS DOUBLE), json_value FROM t""")
def q_game_views(spark, sf_dir):
    return hot.twitch_game_views(_games_topic(spark, sf_dir))


# ---------------------------------------------------------------------------
# Scalar functions
# ---------------------------------------------------------------------------

@register("count_text_clean", """
WITH c AS (""" + CHART_SQL + """)
SELECT sound_name, rank_text, ugc_text, growth_text,
       """ + _last_tok_sql("ugc_text") + """ AS ugc_count,
       """ + _first_tok_sql("growth_text") + """ AS growth,
       CASE WHEN """ + _strip_sql("growth_text") + """ = '' THEN '0%'
            WHEN list_last(regexp_split_to_array(""" + _strip_sql("growth_text") + """, '\\s+')) = '%'
             AND len(regexp_split_to_array(""" + _strip_sql("growth_text") + """, '\\s+')) >= 2
            THEN regexp_split_to_array(""" + _strip_sql("growth_text") + """, '\\s+')[-2] || '%'
            ELSE coalesce(list_filter(regexp_split_to_array(""" + _strip_sql("growth_text") + """, '\\s+'), lambda p: contains(p, '%'))[1],
                          list_last(regexp_split_to_array(""" + _strip_sql("growth_text") + """, '\\s+'))) END AS growth_pct,
       """ + _strip_sql("rank_text") + """ AS rank_stripped,
       coalesce(direct_link, 'Not Found') AS tiktok_direct_url
FROM c""")
def q_count_text_clean(spark, sf_dir):
    rows = standins.tiktok_chart_rows(_t(spark, sf_dir, "lineitem"))
    return rows.select(
        "sound_name", "rank_text", "ugc_text", "growth_text",
        last_token("ugc_text").alias("ugc_count"),
        first_token("growth_text").alias("growth"),
        percent_token("growth_text").alias("growth_pct"),
        strip_ws("rank_text").alias("rank_stripped"),
        not_found(F.col("direct_link")).alias("tiktok_direct_url"),
    )


@register("rank_text_parse", """
WITH c AS (""" + CHART_SQL + """)
SELECT json_object('name', sound_name, 'ugc', """ + _last_tok_sql("ugc_text") + """,
                   'growth', """ + _first_tok_sql("growth_text") + """,
                   'link', coalesce(direct_link, 'Not Found'), 'fetched_at', fetch_timestamp)::VARCHAR AS member,
       min(coalesce(TRY_CAST(replace(rank_text, '#', '') AS INTEGER), 999)) AS rank_score
FROM c GROUP BY 1""")
def q_rank_text_parse(spark, sf_dir):
    rows = standins.tiktok_chart_rows(_t(spark, sf_dir, "lineitem"))
    sounds = rows.select(
        F.col("rank_text").alias("rank"), "sound_name",
        last_token("ugc_text").alias("ugc_count"), first_token("growth_text").alias("growth"),
        "author_country", F.col("sound_href").alias("tokchart_url"),
        not_found(F.col("direct_link")).alias("tiktok_direct_url"), "fetch_timestamp")
    return hot.tiktok_members(sounds)


@register("date_time_keys", """
WITH r AS (""" + REDDIT_SQL + """)
SELECT url, ingested_at,
       CAST(strftime(CAST(ingested_at AS TIMESTAMP), '%Y%m%d') AS INTEGER) AS ingested_date_sk,
       strftime(CAST(ingested_at AS TIMESTAMP), '%H%M') AS ingested_time_sk
FROM r""")
def q_date_time_keys(spark, sf_dir):
    posts = standins.reddit_posts(_t(spark, sf_dir, "events"))
    return posts.select("url", "ingested_at",
                        date_key("ingested_at").alias("ingested_date_sk"),
                        time_key("ingested_at").alias("ingested_time_sk"))


@register("epoch_iso", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS created_utc,
       strftime(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS post_timestamp
FROM events""")
def q_epoch_iso(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    secs = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    return (ev.select("event_id", secs.alias("created_utc"))
              .withColumn("post_timestamp", epoch_to_iso_utc("created_utc")))


@register("template_url", """
SELECT p_partkey,
       'https://www.youtube.com/watch?v=' || CAST(p_partkey AS VARCHAR) AS video_url,
       replace('https://static.example.org/boxart/' || p_name || '-{width}x{height}.jpg', '{width}x{height}', '285x380') AS box_art_url,
       coalesce(CASE WHEN p_size > 25 THEN p_type END, 'Not Found') AS link
FROM part""")
def q_template_url(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    template = F.concat(F.lit("https://static.example.org/boxart/"), F.col("p_name"),
                        F.lit("-{width}x{height}.jpg"))
    return p.select(
        "p_partkey",
        url_from_id("https://www.youtube.com/watch?v=", F.col("p_partkey")).alias("video_url"),
        fill_size_template(template, "285x380").alias("box_art_url"),
        not_found(F.when(F.col("p_size") > 25, F.col("p_type"))).alias("link"),
    )


# ---------------------------------------------------------------------------
# Warehouse
# ---------------------------------------------------------------------------


def _sk(platform: str, expr: str) -> str:
    return f"md5('{platform}|' || {expr})"


def _rk(platform: str, cols) -> str:
    parts = ", ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '\\N')" for c in cols)
    return f"md5(concat_ws('|', '{platform}', {parts}))"


def _dk(col: str) -> str:
    return (f"CAST(strftime(CAST({col} AS TIMESTAMP), '%Y%m%d') AS INTEGER) AS ingested_date_sk, "
            f"strftime(CAST({col} AS TIMESTAMP), '%H%M') AS ingested_time_sk")


def _lake(spark, sf_dir, topic: str) -> DataFrame:
    """Stand-in records as the lake holds them (JSON lines, 64-bit ints)."""
    if topic == "reddit_data":
        df = standins.reddit_posts(_t(spark, sf_dir, "events"))
    elif topic == "twitch_streams":
        df = standins.twitch_streams(_t(spark, sf_dir, "events"))
    elif topic == "youtube_data":
        df = standins.youtube_videos(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "part"))
    else:
        chart = standins.tiktok_chart_rows(_t(spark, sf_dir, "lineitem"))
        df = landing.chart_records(chart, CHART_BASE)
    return parse_records(to_json_value(df), schemas.lake_schema(topic))


TIKTOK_SQL = """
SELECT """ + _strip_sql("rank_text") + """ AS rank, sound_name,
       """ + _last_tok_sql("ugc_text") + """ AS ugc_count,
       """ + _first_tok_sql("growth_text") + """ AS growth,
       author_country, 'https://charts.example.org' || sound_href AS tokchart_url,
       coalesce(direct_link, 'Not Found') AS tiktok_direct_url, fetch_timestamp, ingested_at
FROM (""" + CHART_SQL + """) c"""

_REDDIT_T = """
WITH r AS (""" + REDDIT_SQL + """),
t AS (SELECT """ + _sk("Reddit", "lower(trim(subreddit))") + """ AS subreddit_sk,
             """ + _rk("Reddit", ["url", "title", "post_timestamp", "ingested_at"]) + """ AS post_sk,
             '550e8400-e29b-41d4-a716-446655440000' AS platform_sk, """ + _dk("ingested_at") + """,
             subreddit AS subreddit_name, title, url, post_timestamp,
             CAST(score AS BIGINT) AS score, CAST(num_comments AS BIGINT) AS num_comments, ingested_at
      FROM r)
"""


def _star(fn, topic):
    def run(spark, sf_dir, table):
        return fn(_lake(spark, sf_dir, topic))[table]
    return run


_reddit = _star(warehouse.reddit_star, "reddit_data")
_tiktok = _star(warehouse.tiktok_star, "tiktok_data")
_youtube = _star(warehouse.youtube_star, "youtube_data")
_twitch = _star(warehouse.twitch_star, "twitch_streams")


@register("fact_post", _REDDIT_T + """
SELECT post_sk, subreddit_sk, platform_sk, ingested_date_sk, ingested_time_sk, score, num_comments, ingested_at FROM t""")
def q_fact_post(spark, sf_dir):
    return _reddit(spark, sf_dir, "Fact_Redit_Activity")


@register("dim_subreddit", _REDDIT_T + """
SELECT subreddit_sk, max(subreddit_name) AS subreddit_name FROM t GROUP BY subreddit_sk""")
def q_dim_subreddit(spark, sf_dir):
    return _reddit(spark, sf_dir, "Dim_Subreddit")


@register("dim_post", _REDDIT_T + """
SELECT DISTINCT post_sk, title, url, post_timestamp FROM t""")
def q_dim_post(spark, sf_dir):
    return _reddit(spark, sf_dir, "Dim_Post")


_TIKTOK_T = """
WITH r AS (""" + TIKTOK_SQL + """),
t AS (SELECT """ + _sk("TikTok", "sound_name") + """ AS sound_sk, """ + _sk("TikTok", "author_country") + """ AS country_sk,
             '6ba7b810-9dad-11d1-80b4-00c04fd430c8' AS platform_sk, """ + _dk("ingested_at") + """,
             sound_name, author_country AS country_code_iso, rank, ugc_count, growth, fetch_timestamp, ingested_at,
             """ + _rk("TikTok", ["sound_name", "author_country", "rank", "ugc_count", "growth",
                                  "fetch_timestamp", "ingested_at"]) + """ AS performance_sk
      FROM r)
"""


@register("star_two_dims", _TIKTOK_T + """
SELECT performance_sk, sound_sk, country_sk, platform_sk, ingested_date_sk, ingested_time_sk,
       rank, ugc_count, growth, fetch_timestamp, ingested_at FROM t""")
def q_star_two_dims(spark, sf_dir):
    return _tiktok(spark, sf_dir, "Fact_Tiktok_Performance")


@register("dim_sound", _TIKTOK_T + "SELECT sound_sk, max(sound_name) AS sound_name FROM t GROUP BY sound_sk")
def q_dim_sound(spark, sf_dir):
    return _tiktok(spark, sf_dir, "Dim_Sound")


@register("dim_country", _TIKTOK_T + """
SELECT country_sk, max(country_code_iso) AS country_code_iso FROM t GROUP BY country_sk""")
def q_dim_country(spark, sf_dir):
    return _tiktok(spark, sf_dir, "Dim_Country")


_YOUTUBE_T = """
WITH r AS (""" + YOUTUBE_SQL + """),
t AS (SELECT """ + _sk("YouTube", "video_id") + """ AS video_sk, """ + _sk("YouTube", "channel") + """ AS channel_sk,
             """ + _sk("YouTube", "category") + """ AS category_sk,
             '7d444840-9dc0-11d1-b245-5ffdce74fad2' AS platform_sk, """ + _dk("ingested_at") + """,
             video_id, title AS video_title, video_url, published_at, channel AS channel_name,
             category AS category_name, views, likes, ingestion_timestamp, ingested_at,
             """ + _rk("YouTube", ["video_id", "channel", "category", "views", "likes",
                                   "ingestion_timestamp", "ingested_at"]) + """ AS performance_sk
      FROM r)
"""


@register("star_three_dims", _YOUTUBE_T + """
SELECT performance_sk, video_sk, channel_sk, category_sk, platform_sk, ingested_date_sk, ingested_time_sk,
       views, likes, ingestion_timestamp, ingested_at FROM t""")
def q_star_three_dims(spark, sf_dir):
    return _youtube(spark, sf_dir, "Fact_Youtube_Performance")


@register("dim_video", _YOUTUBE_T + """,
a AS (SELECT video_sk, max(struct_pack(i := ingested_at, v := video_id, u := video_url, t := video_title,
                                       p := published_at)) AS m FROM t GROUP BY video_sk)
SELECT video_sk, m.v AS video_id_nk, m.u AS video_url, m.t AS video_title, m.p AS published_at FROM a""")
def q_dim_video(spark, sf_dir):
    return _youtube(spark, sf_dir, "Dim_Video")


@register("dim_channel", _YOUTUBE_T + """
SELECT channel_sk, max(channel_name) AS channel_name_nk FROM t GROUP BY channel_sk""")
def q_dim_channel(spark, sf_dir):
    return _youtube(spark, sf_dir, "Dim_Channel")


@register("dim_category", _YOUTUBE_T + """
SELECT category_sk, max(category_name) AS category_name_nk FROM t GROUP BY category_sk""")
def q_dim_category(spark, sf_dir):
    return _youtube(spark, sf_dir, "Dim_Category")


_TWITCH_T = """
WITH r AS (""" + TWITCH_SQL + """),
t AS (SELECT """ + _sk("Twitch", "(user_name || fetched_at)") + """ AS stream_sk,
             """ + _sk("Twitch", "game_name") + """ AS game_sk, """ + _sk("Twitch", "user_name") + """ AS user_sk,
             '2c5ea4c0-4067-11e9-8bad-9b1deb4d9857' AS platform_sk, """ + _dk("ingested_at") + """,
             user_name, game_name, title AS stream_title, CAST(viewer_count AS BIGINT) AS viewer_count,
             thumbnail_url, type, fetched_at AS fetched_timestamp, ingested_at,
             """ + _rk("Twitch", ["user_name", "game_name", "title", "viewer_count", "fetched_at",
                                  "ingested_at"]) + """ AS performance_sk
      FROM r)
"""


@register("star_twitch_fact", _TWITCH_T + """
SELECT performance_sk, stream_sk, user_sk, game_sk, platform_sk, ingested_date_sk, ingested_time_sk,
       viewer_count, fetched_timestamp, ingested_at FROM t""")
def q_star_twitch_fact(spark, sf_dir):
    return _twitch(spark, sf_dir, "Fact_Twitch_Performance")


@register("dim_game", _TWITCH_T + "SELECT game_sk, max(game_name) AS game_name_nk FROM t GROUP BY game_sk")
def q_dim_game(spark, sf_dir):
    return _twitch(spark, sf_dir, "Dim_Game")


@register("composite_key_dim", _TWITCH_T + """,
a AS (SELECT stream_sk, max(struct_pack(i := ingested_at, s := stream_title, t := thumbnail_url, y := type,
                                        u := user_name)) AS m FROM t GROUP BY stream_sk)
SELECT stream_sk, m.s AS stream_title, m.t AS thumbnail_url, m.y AS type, m.u AS user_name FROM a""")
def q_composite_key_dim(spark, sf_dir):
    return _twitch(spark, sf_dir, "Dim_Stream")


@register("uuid_star", _TWITCH_T + """
SELECT game_name, user_name, stream_title, viewer_count, fetched_timestamp, ingested_at FROM (
  SELECT t.game_name, m.u AS user_name, m.s AS stream_title, t.viewer_count, t.fetched_timestamp, t.ingested_at
  FROM t JOIN (SELECT stream_sk, max(struct_pack(i := ingested_at, s := stream_title, t := thumbnail_url, y := type,
                                                 u := user_name)) AS m FROM t GROUP BY stream_sk) d USING (stream_sk)) x""")
def q_uuid_star(spark, sf_dir):
    """the twitch star with random keys frozen once; the fact joined to its
    dimensions by those keys, so what comes out has names and no keys."""
    tables = warehouse.twitch_star(_lake(spark, sf_dir, "twitch_streams"), mode="uuid")
    fact = tables["Fact_Twitch_Performance"].select("game_sk", "stream_sk", "viewer_count", "fetched_timestamp", "ingested_at")
    return (fact.join(tables["Dim_Game"], "game_sk").join(tables["Dim_Stream"], "stream_sk")
                .select(F.col("game_name_nk").alias("game_name"), "user_name", "stream_title", "viewer_count",
                        "fetched_timestamp", "ingested_at"))


@register("uuid_key_integrity", """SELECT CAST(count(*) AS BIGINT) AS fact_rows, CAST(count(*) AS BIGINT) AS matched_rows FROM events""")
def q_uuid_key_integrity(spark, sf_dir):
    """Every fact row's random game/stream key is found exactly once in its dimension."""
    tables = warehouse.twitch_star(_lake(spark, sf_dir, "twitch_streams"), mode="uuid")
    fact = tables["Fact_Twitch_Performance"]
    g = tables["Dim_Game"].groupBy("game_sk").agg(F.count(F.lit(1)).alias("gn"))
    s = tables["Dim_Stream"].groupBy("stream_sk").agg(F.count(F.lit(1)).alias("sn"))
    j = fact.join(g, "game_sk", "left").join(s, "stream_sk", "left")
    return j.agg(F.count(F.lit(1)).alias("fact_rows"),
                 F.count(F.when((F.col("gn") == 1) & (F.col("sn") == 1), 1)).alias("matched_rows"))


@register("norm_key_dim", """
WITH p AS (SELECT CASE p_size % 3 WHEN 0 THEN '  ' || p_brand || ' ' WHEN 1 THEN upper(p_brand)
                  ELSE p_brand END AS brand_raw FROM part)
SELECT """ + _sk("YouTube", "lower(trim(brand_raw))") + """ AS category_sk,
       lower(trim(brand_raw)) AS category_key, max(brand_raw) AS category_name
FROM p GROUP BY 1, 2""")
def q_norm_key_dim(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    raw = (F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("  "), "p_brand", F.lit(" ")))
           .when(F.col("p_size") % 3 == 1, F.upper("p_brand")).otherwise(F.col("p_brand")))
    keyed = attach_key(p.select(raw.alias("brand_raw")), "YouTube", "category_sk", "brand_raw", normalize=True)
    keyed = keyed.withColumn("category_key", F.lower(F.trim("brand_raw")))
    return dimension(keyed, "category_sk", {"category_key": "category_key", "category_name": "brand_raw"})


@register("platform_fact_rows", """
SELECT platform_name, CAST(n AS BIGINT) AS fact_rows FROM (
  SELECT 'Reddit' AS platform_name, count(*) AS n FROM events
  UNION ALL SELECT 'Twitch', count(*) FROM events
  UNION ALL SELECT 'YouTube', count(*) FROM lineitem
  UNION ALL SELECT 'TikTok', count(*) FROM lineitem) x""")
def q_platform_fact_rows(spark, sf_dir):
    """C7 + S7: fact rows of the four stars counted per platform name."""
    from .sources.constants import platform_dim
    facts = None
    for topic, fn in warehouse.STARS.items():
        t = fn(_lake(spark, sf_dir, topic))
        fact = t[next(k for k in t if k.startswith("Fact_"))].select("platform_sk")
        facts = fact if facts is None else facts.unionByName(fact)
    counts = facts.groupBy("platform_sk").agg(F.count(F.lit(1)).alias("fact_rows"))
    return (F.broadcast(platform_dim(spark)).join(counts, "platform_sk")
            .select("platform_name", "fact_rows"))


# ---------------------------------------------------------------------------
# Lookups with defaults
# ---------------------------------------------------------------------------


@register("lookup_default", """
SELECT c_custkey, c_nationkey, coalesce(n.n_name, 'Other') AS nation_name
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) n ON c_nationkey = n.n_nationkey""")
def q_lookup_default(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # an incomplete lookup: nations of region 0 are missing from it
    lk = _t(spark, sf_dir, "nation").where(F.col("n_regionkey") != 0)
    return lookup_with_default(c, lk, "c_nationkey", "n_nationkey", {"n_name": ("nation_name", "Other")})


@register("lookup_multi_default", """
SELECT s_suppkey, s_nationkey, coalesce(n.n_name, 'Unknown') AS game_name,
       replace(coalesce(n.art, ''), '{width}x{height}', '285x380') AS box_art_url
FROM supplier LEFT JOIN (SELECT n_nationkey, n_name,
                                'https://static.example.org/boxart/' || n_name || '-{width}x{height}.jpg' AS art
                         FROM nation WHERE n_regionkey <> 0) n ON s_nationkey = n.n_nationkey""")
def q_lookup_multi_default(spark, sf_dir):
    s = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lk = (_t(spark, sf_dir, "nation").where(F.col("n_regionkey") != 0)
          .select("n_nationkey", "n_name",
                  F.concat(F.lit("https://static.example.org/boxart/"), "n_name",
                           F.lit("-{width}x{height}.jpg")).alias("art")))
    out = lookup_with_default(s, lk, "s_nationkey", "n_nationkey",
                              {"n_name": ("game_name", "Unknown"), "art": ("box_art_url", "")})
    return out.withColumn("box_art_url", fill_size_template("box_art_url", "285x380"))


# ---------------------------------------------------------------------------
# Parsing, publishing and quarantine
# ---------------------------------------------------------------------------

@register("json_roundtrip", """
SELECT user_name, game_name, title, viewer_count, thumbnail_url, fetched_at FROM (""" + TWITCH_SQL + """) s""")
def q_json_roundtrip(spark, sf_dir):
    streams = standins.twitch_streams(_t(spark, sf_dir, "events"))
    as_bytes = to_json_value(streams).select(F.col("value").cast("binary").alias("value"))
    return parse_records(as_bytes, schemas.TWITCH_STREAMS)


def _mixed_topic(spark, sf_dir) -> DataFrame:
    """Good reddit records plus, per part row, an overflowing score, a record
    without its key and a line of garbage."""
    good = to_json_value(standins.reddit_posts(_t(spark, sf_dir, "events")))
    p = _t(spark, sf_dir, "part")
    overflow = p.select(F.to_json(F.struct(F.col("p_brand").alias("subreddit"),
                                           (F.col("p_partkey") * 10000000).alias("score"))).alias("value"))
    keyless = p.select(F.to_json(F.struct(F.col("p_name").alias("title"))).alias("value"))
    garbage = p.select(F.concat(F.lit("garbage "), F.col("p_name")).alias("value"))
    return good.unionByName(overflow).unionByName(keyless).unionByName(garbage)


@register("parsed_good_counts", """
WITH g AS (SELECT subreddit, score FROM (""" + REDDIT_SQL + """) r
           UNION ALL
           SELECT p_brand, CASE WHEN p_partkey * 10000000 <= 2147483647 THEN CAST(p_partkey * 10000000 AS INTEGER) END
           FROM part)
SELECT subreddit, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(score) AS BIGINT) AS n_scores,
       CAST(sum(score) AS BIGINT) AS total_score FROM g GROUP BY subreddit""")
def q_parsed_good_counts(spark, sf_dir):
    from .sources.topics import parse_topic
    good, _bad = parse_topic(_mixed_topic(spark, sf_dir), schemas.REDDIT, "subreddit")
    return good.groupBy("subreddit").agg(F.count(F.lit(1)).alias("n_rows"),
                                         F.count("score").alias("n_scores"),
                                         F.sum("score").alias("total_score"))


@register("bad_json_quarantine", """
SELECT json_object('title', p_name)::VARCHAR AS raw_value FROM part
UNION ALL SELECT 'garbage ' || p_name FROM part""")
def q_bad_json_quarantine(spark, sf_dir):
    from .sources.topics import parse_topic
    _good, bad = parse_topic(_mixed_topic(spark, sf_dir), schemas.REDDIT, "subreddit")
    return bad


# ---------------------------------------------------------------------------
# Landing jobs (C12, C13; P8-P11, S8, S9, F8, F11, F19)
# ---------------------------------------------------------------------------

def _reddit_replies(spark, sf_dir) -> DataFrame:
    """Landed listing replies: events paged 50 per reply (bounded groups)."""
    ev = _t(spark, sf_dir, "events")
    secs = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    item = F.struct(F.struct(
        F.col("event_type").alias("subreddit"), F.round(F.col("value") * 100).cast("bigint").alias("score"),
        F.col("user_id").alias("num_comments"), F.col("props").alias("title"),
        F.concat(F.lit("https://example.org/r/"), F.col("event_id").cast("string")).alias("url"),
        secs.cast("double").alias("created_utc")).alias("data"))
    pages = (ev.groupBy(F.floor(F.col("event_id") / 50).alias("page"))
               .agg(F.collect_list(item).alias("children"), F.max("ts").alias("last_ts")))
    return pages.select(
        F.lit("reddit").alias("source"), F.lit(200).alias("status"),
        F.concat(F.date_format("last_ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("fetched_at"),
        F.to_json(F.struct(F.struct(F.col("children").alias("children")).alias("data"))).alias("body"))


@register("explode_replies", """
SELECT event_type AS subreddit, CAST(round(value * 100) AS BIGINT) AS score, user_id AS num_comments,
       props AS title, 'https://example.org/r/' || CAST(event_id AS VARCHAR) AS url,
       strftime(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS post_timestamp,
       strftime(max(ts) OVER (PARTITION BY floor(event_id / 50)), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS ingestion_timestamp
FROM events""")
def q_explode_replies(spark, sf_dir):
    return landing.reddit_records(_reddit_replies(spark, sf_dir))


def _youtube_inputs(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type")
    rows = li.join(p, li.l_partkey == p.p_partkey, "left")
    vid = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"),
                   F.lit("-"), F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string"))
    views = F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string")
    item = F.struct(
        vid.alias("id"),
        F.struct(F.concat(F.lit("video "), vid).alias("title"),
                 F.concat(F.lit("channel_"), F.col("l_suppkey").cast("string")).alias("channelTitle"),
                 F.col("p_size").cast("string").alias("categoryId"),
                 F.concat(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("publishedAt")
                 ).alias("snippet"),
        F.struct(F.when(F.col("l_linenumber") != 3, views).alias("viewCount"),
                 F.col("l_quantity").cast("bigint").cast("string").alias("likeCount")).alias("statistics"))
    pages = (rows.groupBy(F.col("l_orderkey").alias("page"))
                 .agg(F.collect_list(item).alias("items"), F.max("l_shipdate").alias("last")))
    replies = pages.select(F.lit("youtube").alias("source"), F.lit(200).alias("status"),
                           F.date_format("last", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("fetched_at"),
                           F.to_json(F.struct("items")).alias("body"))
    # category lookup derived from part; sizes above 40 are missing from it
    cats = (_t(spark, sf_dir, "part").where(F.col("p_size") <= 40)
            .select(F.col("p_size").cast("string").alias("id"), F.col("p_type").alias("name")))
    return replies, cats


@register("youtube_replies", """
WITH x AS (SELECT l.*, p.p_size, p.p_type FROM lineitem l LEFT JOIN part p ON l_partkey = p_partkey),
c AS (SELECT CAST(p_size AS VARCHAR) AS id, max(p_type) AS name FROM part WHERE p_size <= 40 GROUP BY 1)
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
         || '-' || CAST(l_suppkey AS VARCHAR) AS video_id,
       'video ' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
         || '-' || CAST(l_suppkey AS VARCHAR) AS title,
       'channel_' || CAST(l_suppkey AS VARCHAR) AS channel,
       CASE WHEN l_linenumber = 3 THEN 0 ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END AS views,
       CAST(l_quantity AS BIGINT) AS likes,
       coalesce(c.name, 'Other') AS category,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') || 'Z' AS published_at,
       'https://www.youtube.com/watch?v=' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)
         || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS video_url,
       strftime(max(l_shipdate) OVER (PARTITION BY l_orderkey), '%Y-%m-%dT%H:%M:%S.%f') AS ingestion_timestamp
FROM x LEFT JOIN c ON CAST(x.p_size AS VARCHAR) = c.id""")
def q_youtube_replies(spark, sf_dir):
    replies, cats = _youtube_inputs(spark, sf_dir)
    return landing.youtube_records(replies, cats)


def _twitch_inputs(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    game_id = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("event_type"))
    item = F.struct(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_name"),
        game_id.alias("game_id"), F.col("event_type").alias("game_name"), F.col("props").alias("title"),
        F.round(F.col("value") * 100).cast("bigint").alias("viewer_count"),
        F.concat(F.lit("https://static.example.org/previews/live_user_"), F.col("user_id").cast("string"),
                 F.lit("-{width}x{height}.jpg")).alias("thumbnail_url"))
    pages = (ev.groupBy(F.floor(F.col("event_id") / 100).alias("page"))
               .agg(F.collect_list(item).alias("data"), F.max("ts").alias("last")))
    replies = pages.select(F.lit("twitch").alias("source"), F.lit(200).alias("status"),
                           F.date_format("last", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("fetched_at"),
                           F.to_json(F.struct("data")).alias("body"))
    # game lookup derived from the events; 'purchase' is missing from it
    games = (ev.select("event_type").distinct().where(F.col("event_type") != "purchase")
             .select(F.col("event_type").alias("id"), F.upper("event_type").alias("name"),
                     F.concat(F.lit("https://static.example.org/boxart/"), F.col("event_type"),
                              F.lit("-{width}x{height}.jpg")).alias("box_art_url")))
    return replies, games


_TWITCH_REPLY_ROWS = """
SELECT 'user_' || CAST(user_id AS VARCHAR) AS user_name,
       CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS game_id, event_type AS game_name,
       props AS title, CAST(round(value * 100) AS BIGINT) AS viewer_count,
       'https://static.example.org/previews/live_user_' || CAST(user_id AS VARCHAR) || '-320x180.jpg' AS thumbnail_url,
       strftime(max(ts) OVER (PARTITION BY floor(event_id / 100)), '%Y-%m-%dT%H:%M:%S.%f') AS fetched_at
FROM events"""


@register("twitch_stream_replies", """
SELECT user_name, game_name, title, viewer_count, thumbnail_url, fetched_at, 'stream' AS type
FROM (""" + _TWITCH_REPLY_ROWS + """) s""")
def q_twitch_stream_replies(spark, sf_dir):
    replies, games = _twitch_inputs(spark, sf_dir)
    return landing.twitch_records(replies, games)[0]


@register("twitch_game_replies", """
WITH s AS (""" + _TWITCH_REPLY_ROWS + """),
g AS (SELECT fetched_at, game_id, CAST(sum(viewer_count) AS BIGINT) AS total_viewers FROM s GROUP BY 1, 2),
lk AS (SELECT DISTINCT event_type AS id, upper(event_type) AS name,
              'https://static.example.org/boxart/' || event_type || '-{width}x{height}.jpg' AS art
       FROM events WHERE event_type <> 'purchase')
SELECT coalesce(lk.name, 'Unknown') AS game_name,
       replace(coalesce(lk.art, ''), '{width}x{height}', '285x380') AS box_art_url,
       total_viewers, fetched_at, 'game' AS type
FROM g LEFT JOIN lk ON g.game_id = lk.id AND g.game_id <> ''""")
def q_twitch_game_replies(spark, sf_dir):
    replies, games = _twitch_inputs(spark, sf_dir)
    return landing.twitch_records(replies, games)[1]


@register("page_links", """
WITH a AS (SELECT page_id, url,
                  regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref\\s*=\\s*"([^"]*)"[^>]*>.*?</a>', 1) AS hrefs,
                  regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref\\s*=\\s*"[^"]*"[^>]*>(.*?)</a>', 1) AS inners
           FROM pages),
u AS (SELECT page_id, url, hrefs, inners, unnest(generate_series(1, len(hrefs))) AS i FROM a),
e AS (SELECT page_id, url, i - 1 AS pos, hrefs[i] AS href, inners[i] AS inner_html FROM u)
SELECT page_id, CAST(pos AS INTEGER) AS pos, href,
       """ + _strip_sql("regexp_replace(inner_html, '<[^>]*>', '', 'g')") + """ AS text,
       CASE WHEN href ~ '^[A-Za-z][A-Za-z0-9+.-]*:.*' THEN href
            WHEN href LIKE '//%' THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1) || ':' || href
            WHEN href LIKE '/%' THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || href
            ELSE regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^?#]*/)', 1) || href END AS abs_url
FROM e""")
def q_page_links(spark, sf_dir):
    return landing.page_links(_t(spark, sf_dir, "pages"))


@register("page_first_link", """
SELECT page_id,
       coalesce(nullif(regexp_extract(html, '(?is)<a\\b[^>]*?\\bhref\\s*=\\s*"([^"]*(?:/[A-Z])[^"]*)"', 1), ''),
                nullif(regexp_extract(html, '(?is)<a\\b[^>]*?\\bhref\\s*=\\s*"([^"]*)"[^>]*>the</a>', 1), ''),
                'Not Found') AS link,
       coalesce(nullif(regexp_extract(html, '(?is)<a\\b[^>]*?\\bhref\\s*=\\s*"([^"]*(?:tiktok\\.com/music/)[^"]*)"', 1), ''),
                nullif(regexp_extract(html, '(?is)<a\\b[^>]*?\\bhref\\s*=\\s*"([^"]*)"[^>]*>View on TikTok</a>', 1), ''),
                'Not Found') AS music_link
FROM pages""")
def q_page_first_link(spark, sf_dir):
    pg = _t(spark, sf_dir, "pages")
    return pg.select("page_id",
                     not_found(landing.first_link(F.col("html"), "/[A-Z]", "the")).alias("link"),
                     not_found(landing.first_link(F.col("html"))).alias("music_link"))


# ---------------------------------------------------------------------------
# Serving folds over batches (K4-K7) and top-N at the source
# ---------------------------------------------------------------------------


def _daily_top_streams(spark, sf_dir) -> DataFrame:
    """Twitch streams cut into daily batches; per batch the top snapshot per user."""
    s = standins.twitch_streams(_t(spark, sf_dir, "events"))
    s = s.withColumn("batch_id", F.date_format(F.col("fetched_at").cast("timestamp_ntz"), "yyyyMMdd").cast("long"))
    top = best_row_per_key(s, ["batch_id", "user_name"], ["viewer_count"],
                           ["game_name", "title", "thumbnail_url"], alias="_top")
    return top.withColumn("json_value", F.to_json(F.struct(
        F.col("game_name").alias("game"), "title", F.col("thumbnail_url").alias("thumb"),
        F.col("viewer_count").alias("views"))))


_DAILY_TOP_SQL = """
WITH s AS (""" + TWITCH_SQL + """),
d AS (SELECT CAST(strftime(CAST(fetched_at AS TIMESTAMP), '%Y%m%d') AS BIGINT) AS batch_id, user_name,
             max(struct_pack(v := viewer_count, g := game_name, t := title, th := thumbnail_url)) AS m
      FROM s GROUP BY 1, 2),
r AS (SELECT batch_id, user_name, m.v AS viewer_count,
             json_object('game', m.g, 'title', m.t, 'thumb', m.th, 'views', m.v)::VARCHAR AS json_value FROM d)
"""


@register("serving_upsert", _DAILY_TOP_SQL + """,
f AS (SELECT user_name, max(struct_pack(b := batch_id, s := CAST(viewer_count AS DOUBLE), j := json_value)) AS m
      FROM r GROUP BY user_name)
SELECT 'twitch_streamers_details' AS view, user_name AS member, m.s AS score, m.j AS json_value,
       m.b AS batch_id FROM f""")
def q_serving_upsert(spark, sf_dir):
    """K4/K5: the details view after upserting 30 daily batches in order."""
    rows = _daily_top_streams(spark, sf_dir)
    return serving.upsert_all(rows.select(
        F.lit("twitch_streamers_details").alias("view"), F.col("user_name").alias("member"),
        F.col("viewer_count").cast("double").alias("score"), "json_value", "batch_id"))


@register("serving_replace", _DAILY_TOP_SQL + """
SELECT 'twitch_streamers_rank' AS view, user_name AS member, CAST(viewer_count AS DOUBLE) AS score,
       CAST(NULL AS VARCHAR) AS json_value, batch_id
FROM r WHERE batch_id = (SELECT max(batch_id) FROM r)""")
def q_serving_replace(spark, sf_dir):
    """K6: the rank view after delete-then-fill per daily batch: the last day."""
    rows = _daily_top_streams(spark, sf_dir)
    return serving.replace_all(rows.select(
        F.lit("twitch_streamers_rank").alias("view"), F.col("user_name").alias("member"),
        F.col("viewer_count").cast("double").alias("score"),
        F.lit(None).cast("string").alias("json_value"), "batch_id"))


@register("serving_ttl", """
WITH s AS (""" + TWITCH_SQL + """),
b AS (SELECT 'user:' || user_name AS view, game_name AS member, CAST(fetched_at AS TIMESTAMP) AS batch_time,
             CAST(max(viewer_count) AS DOUBLE) AS score FROM s GROUP BY 1, 2, 3),
t AS (SELECT DISTINCT view, batch_time FROM b),
g AS (SELECT view, batch_time, lag(batch_time) OVER (PARTITION BY view ORDER BY batch_time) AS before FROM t),
l AS (SELECT view, max(CASE WHEN before IS NULL OR batch_time >= before + INTERVAL 24 HOUR THEN batch_time END) AS begin_time,
             max(batch_time) AS last_time FROM g GROUP BY 1),
n AS (SELECT date_trunc('hour', max(ts)) + INTERVAL 1 HOUR AS now FROM events),
k AS (SELECT b.view, b.member, max(struct_pack(t := b.batch_time, v := b.score)) AS m
      FROM b JOIN l USING (view) CROSS JOIN n
      WHERE b.batch_time >= l.begin_time AND n.now < l.last_time + INTERVAL 24 HOUR GROUP BY 1, 2)
SELECT view, member, m.v AS score FROM k""")
def q_serving_ttl(spark, sf_dir):
    """K7: per-user views upserted per hourly poll, read one hour after the
    last poll. A view is gone 24 h after its last batch, members and all: the
    next batch starts from nothing."""
    s = standins.twitch_streams(_t(spark, sf_dir, "events"))
    b = (s.groupBy(F.concat(F.lit("user:"), "user_name").alias("view"), F.col("game_name").alias("member"),
                   F.col("fetched_at").cast("timestamp_ntz").alias("batch_time"))
          .agg(F.max("viewer_count").cast("double").alias("score")))
    now = _t(spark, sf_dir, "events").agg(
        (F.date_trunc("hour", F.max("ts")) + F.expr("INTERVAL 1 HOUR")).alias("now"))
    return serving.ttl_all(b, now, 86400)


@register("source_top50", """
SELECT subreddit, score, title, url FROM (""" + REDDIT_SQL + """) r
ORDER BY score DESC, title DESC, url DESC LIMIT 50""")
def q_source_top50(spark, sf_dir):
    """The 50 highest-scored posts (a top-k: each task keeps its own 50)."""
    posts = standins.reddit_posts(_t(spark, sf_dir, "events"))
    return top_n(posts.select("subreddit", "score", "title", "url"), ["score", "title", "url"], 50)


# ---------------------------------------------------------------------------
# End-to-end streaming runs (T2, T4, T5, T7, C1, C6, C8; S5, K9-K11)
# ---------------------------------------------------------------------------


#: Records that wait in a folder in a topic's place: compressed, and in files that several tasks can share.
TOPIC_FILES = {"compression": "lz4", "maxRecordsPerFile": 100_000}


def _run_dir(spark, kind: str) -> str:
    return scratch_path(spark, "trendspark-runs", f"{kind}-{_uuid.uuid4().hex[:12]}")


@register("stream_update_best", ORACLES["reddit_details_view"])
def q_stream_update_best(spark, sf_dir):
    """C1 as a stream: published records in three drops, one per micro-batch,
    through the stateful update-mode aggregate into the details view."""
    from .sinks.serving import ServingStore
    from .streaming.hot import start_reddit_best
    base = _run_dir(spark, "stream-best")
    posts = standins.reddit_posts(_t(spark, sf_dir, "events")).drop("ingested_at")
    store = ServingStore(spark, f"{base}/views")
    _drain_drops(spark, base, to_json_value(posts), lambda raw: start_reddit_best(
        raw, store, f"{base}/ckpt", trigger={"availableNow": True}))
    return store.read("reddit_subreddits_details").select(
        F.lit("reddit_subreddits_details").alias("view"), "member", "score", "json_value")


def _drain_drops(spark, base, values: DataFrame, start, drops: int = 3) -> None:
    """Records land in ``drops`` folders by a hash of their text, each with the
    input's own partitions, in files of bounded length; after each drop the query is run until it has read it.

    All drops are written in one pass, as the texts are made from the tables, and wait beside the folder that the query reads."""
    from .sinks.batches import file_system
    from .sources.topics import text_stream
    values = values.select("value", F.pmod(F.xxhash64("value"), F.lit(drops)).alias("drop"))
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    spark.conf.set(writers, drops)      # a task writes to all drops at once instead of sorting its texts by them
    try:
        values.write.partitionBy("drop").options(**TOPIC_FILES).text(f"{base}/waiting")
    finally:
        spark.conf.set(writers, before)
    fs, landing = file_system(spark, f"{base}/in")
    fs.mkdirs(landing)
    for k in range(drops):
        waiting, landed = (file_system(spark, f"{base}/{at}/drop={k}")[1] for at in ("waiting", "in"))
        if not (fs.rename(waiting, landed) if fs.exists(waiting) else fs.mkdirs(landed)):
            raise OSError(f"could not move {waiting} to {landed}")
        start(text_stream(spark, f"{base}/in/drop=*")).awaitTermination()


def _archived(spark, values: DataFrame, topic: str, stamp: str, route=lambda ts: F.date_trunc("second", ts)) -> str:
    """Publish a topic's records in two drops and archive them, routed (and
    stamped) by the second that each record has in the field ``stamp``, or by ``route`` of it."""
    from .streaming import archive
    base = _run_dir(spark, f"chain-{topic}")
    when = route(F.to_timestamp_ntz(F.get_json_object(F.col("value").cast("string"), f"$.{stamp}")))
    _drain_drops(spark, base, values, lambda raw: archive.start_archive(
        raw, f"{base}/lake", topic, f"{base}/ck_archive", route_ts=when, trigger={"availableNow": True}), drops=2)
    return base


def _archive(spark, sf_dir) -> str:
    posts = standins.reddit_posts(_t(spark, sf_dir, "events")).drop("ingested_at")
    return _archived(spark, to_json_value(posts), "reddit_data", "post_timestamp")


def _archive_chain(spark, sf_dir) -> str:
    """The archive, then the warehouse loaded incrementally from the lake
    (bounded micro-batches of lake files)."""
    from .streaming import warehouse as wh
    base = _archive(spark, sf_dir)
    wh.run_all(spark, f"{base}/lake", f"{base}/wh", f"{base}/ck_wh", topics=("reddit_data",),
               max_files_per_trigger=128)
    return base


_REDDIT_LAKE_SQL = REDDIT_SQL.replace(
    "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ingested_at",
    "strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000000' AS ingested_at")


@register("lake_archive", """
SELECT 'reddit_data' AS topic, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day, CAST(count(*) AS BIGINT) AS records
FROM events GROUP BY 2, 3, 4""")
def q_lake_archive(spark, sf_dir):
    """Archived records per topic and day folder."""
    base = _archive(spark, sf_dir)
    lake = spark.read.option("basePath", f"{base}/lake").text(f"{base}/lake/topic=reddit_data")
    return lake.groupBy("topic", "year", "month", "day").agg(F.count(F.lit(1)).alias("records"))


@register("incremental_load", _REDDIT_T.replace(REDDIT_SQL, _REDDIT_LAKE_SQL) + """
SELECT post_sk, subreddit_sk, platform_sk, ingested_date_sk, ingested_time_sk, score, num_comments, ingested_at FROM t""")
def q_incremental_load(spark, sf_dir):
    """C8 fed from the lake by availableNow batches: the loaded fact table."""
    from .streaming import warehouse as wh
    return wh.warehouse_sink(spark, f"{_archive_chain(spark, sf_dir)}/wh").read("Fact_Redit_Activity")


def _chart_pages(spark, sf_dir, faults: bool = False) -> DataFrame:
    """Chart pages rendered from the lineitem chart rows: one page per order
    (an order has a handful of lines), eight cells per row; with ``faults``
    the second lines lack a cell and the third ones the link (P10), and a cell
    of the fourth ones holds a table whose row would pass for one of the chart."""
    chart = standins.tiktok_chart_rows(_t(spark, sf_dir, "lineitem"), with_order=True)

    def td(c):
        return F.concat(F.lit("<td>"), c, F.lit("</td>"))
    link = F.concat(F.lit('<a href="'), F.col("sound_href"), F.lit('">'), F.col("sound_name"), F.lit("</a>"))
    last = td(F.lit(""))
    nested = F.lit("")
    if faults:
        nested = F.when(F.col("rank_text") == "#4", F.concat(F.lit("<table><tbody><tr>"), *[td(link)] * 8, F.lit("</tr></tbody></table>"))).otherwise("")
        link = F.when(F.col("rank_text") == "#3", F.col("sound_name")).otherwise(link)
        last = F.when(F.col("rank_text") == "#2", F.lit("")).otherwise(last)
    tr = F.concat(F.lit("<tr>"), td(F.col("rank_text")), td(link), td(F.col("ugc_text")),
                  td(F.col("growth_text")), td(F.col("author_country")),
                  td(F.lit("")), td(nested), last, F.lit("</tr>"))
    pages = (chart.groupBy(F.col("l_orderkey").alias("page_id"))
                  .agg(F.array_join(F.collect_list(tr), "").alias("trs"),
                       F.max("fetch_timestamp").alias("fetch_timestamp")))
    html = F.concat(F.lit("<html><body><table><thead><tr><th>#</th></tr></thead><tbody>"),
                    F.col("trs"), F.lit("</tbody></table></body></html>"))
    return pages.select("page_id", "fetch_timestamp", html.alias("html"))


@register("chart_page_records", """
SELECT """ + _strip_sql("rank_text") + """ AS rank, sound_name,
       """ + _last_tok_sql("ugc_text") + """ AS ugc_count,
       """ + _first_tok_sql("growth_text") + """ AS growth,
       author_country, 'https://charts.example.org' || sound_href AS tokchart_url,
       'Not Found' AS tiktok_direct_url,
       max(fetch_timestamp) OVER (PARTITION BY l_orderkey) AS fetch_timestamp
FROM (""" + CHART_SQL.replace("SELECT CASE", "SELECT l_orderkey, CASE", 1) + """) c""")
def q_chart_page_records(spark, sf_dir):
    """C13 end to end: S8 table rows of the rendered pages -> tiktok records."""
    rows = landing.html_table_rows(_chart_pages(spark, sf_dir))
    chart = landing.chart_cells(rows, keep=("fetch_timestamp",))
    return landing.chart_records(chart, CHART_BASE)


def _detail_pages(spark, sf_dir) -> DataFrame:
    """Sound detail pages rendered from part: a music link (large sizes), a
    'View on TikTok' link (middle sizes) or none."""
    p = _t(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    html = (F.when(F.col("p_size") > 25,
                   F.concat(F.lit('<p>x</p><a href="/home">home</a><a href="https://www.tiktok.com/music/s-'),
                            key, F.lit('">music</a>')))
            .when(F.col("p_size") > 10,
                  F.concat(F.lit('<a href="/home">home</a><a href="https://vm.example.org/'), key,
                           F.lit('">View on TikTok</a>')))
            .otherwise(F.lit("<p>no link</p>")))
    return p.select(F.col("p_partkey").alias("page_id"),
                    F.concat(F.lit("https://charts.example.org/sound/"), key).alias("url"),
                    html.alias("html"))


@register("chart_records_with_links", """
WITH c AS (""" + CHART_SQL.replace("SELECT CASE", "SELECT l_orderkey, l_partkey, CASE", 1) + """),
d AS (SELECT p_partkey, CASE WHEN p_size > 25 THEN 'https://www.tiktok.com/music/s-' || CAST(p_partkey AS VARCHAR)
                             WHEN p_size > 10 THEN 'https://vm.example.org/' || CAST(p_partkey AS VARCHAR) END AS link
      FROM part)
SELECT """ + _strip_sql("rank_text") + """ AS rank, sound_name,
       """ + _last_tok_sql("ugc_text") + """ AS ugc_count,
       """ + _first_tok_sql("growth_text") + """ AS growth,
       author_country, 'https://charts.example.org' || sound_href AS tokchart_url,
       coalesce(d.link, 'Not Found') AS tiktok_direct_url,
       max(fetch_timestamp) OVER (PARTITION BY l_orderkey) AS fetch_timestamp
FROM c LEFT JOIN d ON c.l_partkey = d.p_partkey""")
def q_chart_records_with_links(spark, sf_dir):
    """C13 with S9: chart pages -> rows; detail pages -> first music link, else
    the 'View on TikTok' link; joined by detail URL; 'Not Found' when none."""
    rows = landing.html_table_rows(_chart_pages(spark, sf_dir))
    chart = landing.chart_cells(rows, keep=("fetch_timestamp",))
    details = _detail_pages(spark, sf_dir)
    links = details.select("url", landing.first_link(F.col("html")).alias("link"))
    return landing.chart_records(chart, CHART_BASE, links=links)


@register("stream_complete_sum", """
WITH r AS (""" + REDDIT_SQL + """)
SELECT subreddit, CAST(sum(score) AS BIGINT) AS total_score FROM r GROUP BY subreddit""")
def q_stream_complete_sum(spark, sf_dir):
    """C14 as a stream: complete-mode running totals over three micro-batches,
    each replacing the rank view."""
    from .sinks.serving import ServingStore
    from .streaming.hot import start_reddit_rank
    base = _run_dir(spark, "stream-sum")
    posts = standins.reddit_posts(_t(spark, sf_dir, "events")).drop("ingested_at")
    store = ServingStore(spark, f"{base}/views")
    _drain_drops(spark, base, to_json_value(posts), lambda raw: start_reddit_rank(
        raw, store, f"{base}/ckpt", trigger={"availableNow": True}))
    return store.read("reddit_subreddits_rank").select(
        F.col("member").alias("subreddit"), F.col("score").cast("bigint").alias("total_score"))


@register("stream_replace_view", """
WITH b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events),
e AS (SELECT events.*, (3 * date_diff('microsecond', b.lo, ts)) // (date_diff('microsecond', b.lo, b.hi) + 1) AS third
      FROM events, b),
s AS (SELECT 'user_' || CAST(user_id AS VARCHAR) AS user_name, event_type AS game_name, props AS title,
             CAST(round(value * 100) AS INTEGER) AS viewer_count,
             'https://static.example.org/previews/live_user_' || CAST(user_id AS VARCHAR) || '-320x180.jpg' AS thumbnail_url
      FROM e WHERE third = 2),
a AS (SELECT user_name, max(struct_pack(v := viewer_count, g := game_name, t := title, th := thumbnail_url)) AS m
      FROM s GROUP BY user_name)
SELECT 'twitch_streamers_rank' AS view, user_name AS member, CAST(m.v AS DOUBLE) AS score,
       CAST(NULL AS VARCHAR) AS json_value FROM a""")
def q_stream_replace_view(spark, sf_dir):
    """C3 as a stream over three drops (thirds of the event time), one
    availableNow run per drop on one checkpoint: the rank view is replaced
    by each batch and ends as the last drop's top streams."""
    from .sinks.serving import ServingStore
    from .sources.topics import text_stream
    from .streaming.hot import start_view_query
    base = _run_dir(spark, "stream-replace")
    ev = _t(spark, sf_dir, "events")
    # the event-time span as scalar subqueries; exact integer microseconds
    b = ev.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    lo = b.select("lo").scalar()
    span = b.select(F.timestamp_diff("MICROSECOND", F.col("lo"), F.col("hi")) + 1).scalar()
    tagged = ev.withColumn("_us3", F.timestamp_diff("MICROSECOND", lo, F.col("ts")) * 3)
    store = ServingStore(spark, f"{base}/views")
    for k in range(3):
        part = tagged.where((F.col("_us3") >= span * k) & (F.col("_us3") < span * (k + 1))).drop("_us3")
        to_json_value(standins.twitch_streams(part)).write.text(f"{base}/in/drop={k}")
        q = start_view_query(text_stream(spark, f"{base}/in/drop=*"), "twitch_streams", store,
                             f"{base}/ckpt", trigger={"availableNow": True})
        q.awaitTermination()
    return store.read("twitch_streamers_rank").select(
        F.lit("twitch_streamers_rank").alias("view"), "member", "score", "json_value")


# ---------------------------------------------------------------------------
# Serving views over time
# ---------------------------------------------------------------------------

@register("stream_ttl_view", """
WITH v AS (""" + YOUTUBE_SQL + """),
s AS (SELECT CAST(video_id AS BIGINT) % 4 AS drop_no, category, CAST(sum(views) AS DOUBLE) AS score
      FROM v WHERE category IS NOT NULL GROUP BY 1, 2),
m AS (SELECT category, max(struct_pack(d := drop_no, s := score)) AS r FROM s WHERE drop_no >= 2 GROUP BY 1)
SELECT 'youtube_category_views' AS view, category AS member, r.s AS score FROM m""")
def q_stream_ttl_view(spark, sf_dir):
    """C2 + K7 as a stream: four drops at 0, 10, 40 and 50 hours. The view had
    expired before the third came, so at hour 51 it holds the last two only."""
    import datetime as dt
    from .sinks.serving import ServingStore
    from .sources.topics import text_stream
    from .streaming.hot import start_view_query
    base = _run_dir(spark, "stream-ttl")
    videos = standins.youtube_videos(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "part")).drop("ingested_at")
    store = ServingStore(spark, f"{base}/views")
    begin = dt.datetime(2025, 1, 1)
    for k, hours in enumerate((0, 10, 40, 50)):
        part = videos.where(F.col("video_id").cast("bigint") % 4 == k)
        to_json_value(part).write.text(f"{base}/in/drop={k}")
        q = start_view_query(text_stream(spark, f"{base}/in/drop=*"), "youtube_data", store, f"{base}/ckpt",
                             trigger={"availableNow": True}, clock=lambda h=hours: begin + dt.timedelta(hours=h))
        q.awaitTermination()
    now = begin + dt.timedelta(hours=51)
    return store.read("youtube_category_views", now=now).select(F.lit("youtube_category_views").alias("view"), "member", "score")


@register("stream_replace_poll", """
WITH s AS (SELECT event_id % 2 AS drop_no, 'user_' || CAST(user_id AS VARCHAR) AS user_name, event_type AS game_name, props AS title,
                  CAST(round(value * 100) AS INTEGER) AS viewer_count,
                  'https://static.example.org/previews/live_user_' || CAST(user_id AS VARCHAR) || '-320x180.jpg' AS thumbnail_url,
                  strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') AS fetched_at FROM events),
p AS (SELECT drop_no, fetched_at, user_name,
             max(struct_pack(v := viewer_count, g := game_name, t := title, th := thumbnail_url)) AS m FROM s GROUP BY 1, 2, 3),
n AS (SELECT user_name, max(struct_pack(f := fetched_at, d := drop_no, m := m)) AS r FROM p GROUP BY 1)
SELECT 'twitch_streamers_rank' AS view, user_name AS member, CAST(r.m.v AS DOUBLE) AS score, CAST(NULL AS VARCHAR) AS json_value
FROM n WHERE r.f = (SELECT max(fetched_at) FROM s)
UNION ALL
SELECT 'twitch_streamers_details', user_name, CAST(NULL AS DOUBLE),
       json_object('game', r.m.g, 'title', r.m.t, 'thumb', r.m.th, 'views', r.m.v)::VARCHAR FROM n""")
def q_stream_replace_poll(spark, sf_dir):
    """K6 by poll: two drops that both hold half of every poll. The rank view is
    the newest poll, whole; the details are each user's newest poll's."""
    from .sinks.serving import ServingStore
    from .sources.topics import text_stream
    from .streaming.hot import start_view_query
    base = _run_dir(spark, "stream-poll")
    ev = _t(spark, sf_dir, "events")
    store = ServingStore(spark, f"{base}/views", policies=hot.POLL_POLICIES)
    for k in range(2):
        to_json_value(standins.twitch_streams(ev.where(F.col("event_id") % 2 == k))).write.text(f"{base}/in/drop={k}")
        start_view_query(text_stream(spark, f"{base}/in/drop=*"), "twitch_streams", store, f"{base}/ckpt",
                         trigger={"availableNow": True}, scope="poll").awaitTermination()

    def rows(view):
        return store.read(view).select(F.lit(view).alias("view"), "member", "score", "json_value")
    return rows("twitch_streamers_rank").union(rows("twitch_streamers_details"))


@register("stream_two_queries", """
WITH g AS (""" + _TOP_GAME_SQL + """),
t AS (""" + ORACLES["rank_text_parse"] + """)
SELECT 'twitch_games_rank' AS view, game_name AS member, CAST(total_viewers AS DOUBLE) AS score, CAST(NULL AS VARCHAR) AS json_value FROM g
UNION ALL SELECT 'twitch_games_details', game_name, CAST(NULL AS DOUBLE), json_value FROM g
UNION ALL SELECT 'tiktok_trends_eg', member, CAST(rank_score AS DOUBLE), CAST(NULL AS VARCHAR) FROM t""")
def q_stream_two_queries(spark, sf_dir):
    """C4 and C5 as two queries of one session: the job waits until any of them
    ends (T6), then for both."""
    from .sinks.serving import ServingStore
    from .sources.topics import text_stream
    from .streaming.hot import await_any, start_view_query
    base = _run_dir(spark, "stream-two")
    to_json_value(standins.twitch_games(_t(spark, sf_dir, "events"))).write.options(**TOPIC_FILES).text(f"{base}/games")
    sounds = landing.chart_records(standins.tiktok_chart_rows(_t(spark, sf_dir, "lineitem")), CHART_BASE).drop("ingested_at")
    to_json_value(sounds).write.options(**TOPIC_FILES).text(f"{base}/sounds")
    store = ServingStore(spark, f"{base}/views")
    spark.streams.resetTerminated()
    started = [start_view_query(text_stream(spark, f"{base}/{name}"), topic, store, f"{base}/ck_{name}", trigger={"availableNow": True})
               for name, topic in (("games", "twitch_games"), ("sounds", "tiktok_data"))]
    await_any(spark)
    for q in started:
        q.awaitTermination()
    spark.streams.resetTerminated()
    out = None
    for view in ("twitch_games_rank", "twitch_games_details", "tiktok_trends_eg"):
        part = store.read(view).select(F.lit(view).alias("view"), "member", "score", "json_value")
        out = part if out is None else out.union(part)
    return out


@register("stream_summary", ORACLES["key_summary"])
def q_stream_summary(spark, sf_dir):
    """C15 as a stream over three drops: the summary snapshot (K13) after the last trigger."""
    from .sinks.tables import read_snapshot
    from .streaming.hot import start_reddit_summary
    base = _run_dir(spark, "stream-summary")
    posts = standins.reddit_posts(_t(spark, sf_dir, "events")).drop("ingested_at")
    _drain_drops(spark, base, to_json_value(posts), lambda raw: start_reddit_summary(
        raw, f"{base}/summary", f"{base}/ckpt", trigger={"availableNow": True}))
    return read_snapshot(spark, f"{base}/summary")


# ---------------------------------------------------------------------------
# Lake and warehouse over time
# ---------------------------------------------------------------------------

@register("lake_quarantine", """
SELECT 'archived' AS what, (SELECT count(*) FROM events) + 2 * (SELECT count(*) FROM part) AS n
UNION ALL SELECT 'archive_rejects', (SELECT count(*) FROM part)
UNION ALL SELECT 'load_rejects', (SELECT count(*) FROM part)
UNION ALL SELECT 'facts', (SELECT count(*) FROM events) + (SELECT count(*) FROM part)
UNION ALL SELECT 'subreddits', (SELECT count(*) FROM (SELECT lower(trim(event_type)) FROM events UNION SELECT lower(trim(p_brand)) FROM part) u)
UNION ALL SELECT 'null_keys', 0""")
def q_lake_quarantine(spark, sf_dir):
    """Good, overflowing, keyless and garbage records through the archive and
    the load: what isn't JSON is rejected by the first, what lacks its key by
    the second, and nothing becomes a null dimension row."""
    from .sources.topics import text_stream
    from .streaming import archive, warehouse as wh
    base = _run_dir(spark, "quarantine")
    _mixed_topic(spark, sf_dir).select("value").write.text(f"{base}/in")
    when = F.lit("2025-01-02 03:04:05").cast("timestamp_ntz")
    archive.start_archive(text_stream(spark, f"{base}/in"), f"{base}/lake", "reddit_data", f"{base}/ck_archive", route_ts=when,
                          trigger={"availableNow": True}).awaitTermination()
    wh.run_all(spark, f"{base}/lake", f"{base}/wh", f"{base}/ck_wh", topics=("reddit_data",))
    sink = wh.warehouse_sink(spark, f"{base}/wh")
    dim = sink.read("Dim_Subreddit")
    counted = {"archived": spark.read.text(f"{base}/lake/topic=reddit_data"),
               "archive_rejects": spark.read.json(f"{base}/ck_archive_quarantine"),
               "load_rejects": spark.read.parquet(f"{base}/ck_wh/reddit_data_quarantine"),
               "facts": sink.read("Fact_Redit_Activity"), "subreddits": dim,
               "null_keys": dim.where(F.col("subreddit_sk").isNull() | F.col("subreddit_name").isNull())}
    out = None
    for what, df in counted.items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "n")
        out = part if out is None else out.union(part)
    return out


def _loaded(spark, sf_dir, topic: str):
    """Records of a topic archived in two drops and loaded from the lake in bounded batches; the sink of the loaded tables."""
    from .streaming import warehouse as wh
    if topic == "twitch_streams":
        rows, stamp = standins.twitch_streams(_t(spark, sf_dir, "events")), "fetched_at"
    elif topic == "youtube_data":
        rows, stamp = standins.youtube_videos(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "part")), "ingestion_timestamp"
    else:
        rows = landing.chart_records(standins.tiktok_chart_rows(_t(spark, sf_dir, "lineitem")), CHART_BASE)
        stamp = "fetch_timestamp"
    # archived over 40 days, at a second that depends on the record's own day
    days = lambda ts: F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date"))
    base = _archived(spark, to_json_value(rows.drop("ingested_at")), topic, stamp, lambda ts: F.lit("2025-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        days(ts) % 40, F.lit(0), F.lit(0), (days(ts).cast("bigint") * 7919 % 86400).cast("decimal(18,6)")))
    wh.run_all(spark, f"{base}/lake", f"{base}/wh", f"{base}/ck_wh", topics=(topic,), max_files_per_trigger=48)
    return wh.warehouse_sink(spark, f"{base}/wh")


def _restamped(sql: str, time: str) -> str:
    """An oracle with the records stamped as ``_loaded`` archives them."""
    days = f"date_diff('day', DATE '1970-01-01', CAST({time} AS DATE))"
    stamp = f"TIMESTAMP '2025-01-01' + to_days(CAST({days} % 40 AS INTEGER)) + to_seconds(({days} * 7919) % 86400)"
    return sql.replace(f"strftime({time}, '%Y-%m-%dT%H:%M:%S.%f') AS ingested_at",
                       f"strftime({stamp}, '%Y-%m-%dT%H:%M:%S') || '.000000' AS ingested_at")


@register("incremental_tiktok", _restamped(ORACLES["star_two_dims"], "l_shipdate"))
def q_incremental_tiktok(spark, sf_dir):
    """C9 fed from the lake: the loaded fact table equals the batch one."""
    return _loaded(spark, sf_dir, "tiktok_data").read("Fact_Tiktok_Performance")


@register("incremental_youtube", _restamped(ORACLES["star_three_dims"], "l_shipdate"))
def q_incremental_youtube(spark, sf_dir):
    """C10 fed from the lake: the loaded fact table equals the batch one."""
    return _loaded(spark, sf_dir, "youtube_data").read("Fact_Youtube_Performance")


@register("incremental_dim_video", _restamped(ORACLES["dim_video"], "l_shipdate"))
def q_incremental_dim_video(spark, sf_dir):
    """C10's video dimension over several load batches: the newest attributes win, as in one batch."""
    return _loaded(spark, sf_dir, "youtube_data").read("Dim_Video")


@register("incremental_twitch", _restamped(ORACLES["star_twitch_fact"], "ts"))
def q_incremental_twitch(spark, sf_dir):
    """C11 fed from the lake: the loaded fact table equals the batch one."""
    return _loaded(spark, sf_dir, "twitch_streams").read("Fact_Twitch_Performance")


@register("uuid_load", """
SELECT lower(trim(event_type)) AS subreddit, CAST(1 AS BIGINT) AS n_keys, CAST(count(*) AS BIGINT) AS n_facts FROM events GROUP BY 1""")
def q_uuid_load(spark, sf_dir):
    """F6 and J1 over several batches: with random keys, too, a name has one key in the facts and one dimension row."""
    from .streaming import warehouse as wh
    base = _archive(spark, sf_dir)
    wh.run_all(spark, f"{base}/lake", f"{base}/wh", f"{base}/ck_wh", mode="uuid", topics=("reddit_data",), max_files_per_trigger=24)
    sink = wh.warehouse_sink(spark, f"{base}/wh")
    facts = sink.read("Fact_Redit_Activity").join(sink.read("Dim_Subreddit"), "subreddit_sk")
    return facts.groupBy(F.lower(F.trim("subreddit_name")).alias("subreddit")).agg(
        F.count_distinct("subreddit_sk").alias("n_keys"), F.count(F.lit(1)).alias("n_facts"))


@register("two_topics_one_stream", """
SELECT 'Fact_Redit_Activity' AS table_name, (SELECT count(*) FROM events) AS n
UNION ALL SELECT 'Fact_Twitch_Performance', (SELECT count(*) FROM events)
UNION ALL SELECT 'Dim_Subreddit', (SELECT count(DISTINCT lower(trim(event_type))) FROM events)
UNION ALL SELECT 'Dim_Game', (SELECT count(DISTINCT event_type) FROM events)
UNION ALL SELECT 'Dim_Platform', 4""")
def q_two_topics_one_stream(spark, sf_dir):
    """One stream over two topics archived by one query, then the
    two topics loaded in turn."""
    from .sinks.publish import publish
    from .sources.topics import topics_stream
    from .streaming import archive, warehouse as wh
    base = _run_dir(spark, "two-topics")
    ev = _t(spark, sf_dir, "events")
    topics = ["reddit_data", "twitch_streams"]
    publish(standins.reddit_posts(ev).drop("ingested_at"), topics[0], path=f"{base}/in")
    publish(standins.twitch_streams(ev).drop("ingested_at"), topics[1], path=f"{base}/in")
    when = F.lit("2025-01-02 03:04:05").cast("timestamp_ntz")
    archive.start_archive(topics_stream(spark, f"{base}/in", topics), f"{base}/lake", topics, f"{base}/ck_archive", route_ts=when,
                          trigger={"availableNow": True}).awaitTermination()
    wh.run_all(spark, f"{base}/lake", f"{base}/wh", f"{base}/ck_wh", topics=tuple(topics))
    sink, out = wh.warehouse_sink(spark, f"{base}/wh"), None
    for name in ("Fact_Redit_Activity", "Fact_Twitch_Performance", "Dim_Subreddit", "Dim_Game"):
        part = sink.read(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.union(part)
    platforms = spark.read.parquet(f"{base}/wh/Dim_Platform").agg(F.count(F.lit(1)).alias("n"))
    return out.union(platforms.select(F.lit("Dim_Platform").alias("table_name"), "n"))


@register("lake_inferred_schema", """
SELECT * FROM (VALUES ('subreddit', 'string'), ('score', 'bigint'), ('num_comments', 'bigint'), ('title', 'string'), ('url', 'string'),
                      ('post_timestamp', 'string'), ('ingestion_timestamp', 'string'), ('ingested_at', 'string')) t(field, type)""")
def q_lake_inferred_schema(spark, sf_dir):
    """The schema inferred from the archived files is the fixed one."""
    from .sources.lake import infer_schema, topic_path
    base = _archive(spark, sf_dir)
    found = infer_schema(spark, topic_path(f"{base}/lake", "reddit_data"))
    known = set(schemas.lake_schema("reddit_data").fieldNames())
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in found if f.name in known], "field string, type string")


@register("lake_one_month", """
SELECT CAST(day(ts) AS INTEGER) AS day, CAST(count(*) AS BIGINT) AS records FROM events
WHERE year(ts) = (SELECT max(year(ts)) FROM events) AND month(ts) = 1 GROUP BY 1""")
def q_lake_one_month(spark, sf_dir):
    """Only the folders of one year and month of the archive are read."""
    from .sources.lake import read_lake
    base = _archive(spark, sf_dir)
    year = _t(spark, sf_dir, "events").agg(F.max(F.year("ts"))).first()[0]
    lake = read_lake(spark, f"{base}/lake", "reddit_data", years=[year]).where(F.col("month") == 1)
    return lake.groupBy("day").agg(F.count(F.lit(1)).alias("records"))


@register("append_and_create", """
SELECT 'first append' AS step, (SELECT count(*) FROM events) AS n
UNION ALL SELECT 'second append', (SELECT count(*) FROM events)
UNION ALL SELECT 'in the table', 2 * (SELECT count(*) FROM events)
UNION ALL SELECT 'created', (SELECT count(*) FROM part)
UNION ALL SELECT 'created again', (SELECT count(*) FROM part)""")
def q_append_and_create(spark, sf_dir):
    """Rows counted while they are appended. K3: a second create changes nothing."""
    from .sinks.tables import append_table, create_if_absent
    base = _run_dir(spark, "append")
    posts = standins.reddit_posts(_t(spark, sf_dir, "events"))
    counts = [("first append", append_table(posts, f"{base}/posts")), ("second append", append_table(posts, f"{base}/posts"))]
    counts.append(("in the table", spark.read.parquet(f"{base}/posts").count()))
    create_if_absent(_t(spark, sf_dir, "part"), f"{base}/part")
    counts.append(("created", spark.read.parquet(f"{base}/part").count()))
    create_if_absent(_t(spark, sf_dir, "part").union(_t(spark, sf_dir, "part")), f"{base}/part")
    counts.append(("created again", spark.read.parquet(f"{base}/part").count()))
    return spark.createDataFrame(counts, "step string, n long")


@register("lake_stamp", """
SELECT 'reddit_data' AS topic, '2025' AS year, '01' AS month, '02' AS day, '{"event_id":' || CAST(event_id AS VARCHAR) || ', "ingested_at": "2025-01-02T03:04:05.000006"}' AS value
FROM events WHERE event_id % 2 = 0
UNION ALL
SELECT 'reddit_data', '2025', '01', '02', '{"event_id":' || CAST(event_id AS VARCHAR) || ',"ingested_at":"2025-01-02T03:04:05.000006"}'
FROM events WHERE event_id % 2 = 1""")
def q_lake_stamp(spark, sf_dir):
    """F10 with an injected clock: the stamp is appended, or replaced where a record has one."""
    from .sinks.lake import lake_rows
    old = F.when(F.col("event_id") % 2 == 1, F.lit("old"))
    raw = _t(spark, sf_dir, "events").select(F.lit("reddit_data").alias("topic"),
                                             F.to_json(F.struct("event_id", old.alias("ingested_at"))).alias("value"))
    good, _ = lake_rows(raw, F.lit("2025-01-02 03:04:05.000006").cast("timestamp_ntz"))
    return good.select("topic", "year", "month", "day", "value")


# ---------------------------------------------------------------------------
# Landing predicates, stamps and links
# ---------------------------------------------------------------------------

@register("ok_replies", ORACLES["explode_replies"].replace("FROM events", "FROM events QUALIFY floor(event_id / 50) % 3 = 0"))
def q_ok_replies(spark, sf_dir):
    """Of replies with the statuses 200, 429 and 500 only the first are used."""
    replies = _reddit_replies(spark, sf_dir)
    page = F.floor(F.get_json_object("body", "$.data.children[0].data.url").substr(F.lit(23), F.lit(20)).cast("bigint") / 50)
    status = F.when(page % 3 == 0, 200).when(page % 3 == 1, 429).otherwise(500)
    return landing.reddit_records(replies.withColumn("status", status))


@register("chart_table_rows", """
SELECT l_orderkey AS page_id, count(*) AS n_rows, min(l_linenumber) AS least FROM (
  SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber NOT IN (2, 3)) x GROUP BY 1""")
def q_chart_table_rows(spark, sf_dir):
    """Rendered chart pages in which some rows lack a cell and some the link."""
    rows = landing.html_table_rows(_chart_pages(spark, sf_dir, faults=True))
    number = F.regexp_extract(F.col("cells")[0]["text"], r"([0-9])", 1).cast("int")
    return rows.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_rows"), F.min(number).alias("least"))


@register("empty_lookup_ids", ORACLES["twitch_game_replies"])
def q_empty_lookup_ids(spark, sf_dir):
    """Lookup rows with an empty or null id name nothing; an empty game id stays unknown."""
    replies, games = _twitch_inputs(spark, sf_dir)
    odd = games.limit(0).union(games.select(F.when(F.col("id") == "click", F.lit("")).alias("id"), F.lit("nothing").alias("name"),
                                            F.lit("none.jpg").alias("box_art_url")))
    return landing.twitch_records(replies, games.union(odd))[1]


@register("poll_stamped_chart", """
SELECT 'sound ' || CAST(l_partkey AS VARCHAR) AS sound_name, 'https://charts.example.org/sound/' || CAST(l_partkey AS VARCHAR) AS tokchart_url,
       '2025-01-02 03:04:05' AS fetch_timestamp FROM lineitem""")
def q_poll_stamped_chart(spark, sf_dir):
    """F9 with an injected clock: chart rows without a fetch time get the poll's."""
    chart = standins.tiktok_chart_rows(_t(spark, sf_dir, "lineitem")).drop("fetch_timestamp", "ingested_at")
    records = landing.chart_records(chart, CHART_BASE, fetched=F.lit("2025-01-02 03:04:05").cast("timestamp_ntz"))
    return records.select("sound_name", "tokchart_url", "fetch_timestamp")


@register("ranked_order", """
WITH t AS (""" + _TOP_STREAM_SQL + """),
c AS (""" + ORACLES["rank_text_parse"] + """),
a AS (SELECT 'twitch_streamers_rank' AS view, user_name AS member, CAST(viewer_count AS DOUBLE) AS score,
             CAST(row_number() OVER (ORDER BY viewer_count DESC, user_name) AS INTEGER) AS place FROM t),
b AS (SELECT 'tiktok_trends_eg' AS view, member, CAST(rank_score AS DOUBLE) AS score,
             CAST(row_number() OVER (ORDER BY rank_score, member) AS INTEGER) AS place FROM c)
SELECT * FROM a WHERE place <= 25 UNION ALL SELECT * FROM b WHERE place <= 25""")
def q_ranked_order(spark, sf_dir):
    """The places of the 25 first rows as they are read, descending and ascending."""
    streams = hot.twitch_streamer_views(_twitch_topic(spark, sf_dir)).where("view = 'twitch_streamers_rank'")
    sounds = hot.tiktok_view(_lake(spark, sf_dir, "tiktok_data").withColumn("tiktok_direct_url", F.col("tiktok_direct_url")))
    read = [("twitch_streamers_rank", ranked_read(streams, n=25)), ("tiktok_trends_eg", ranked_read(sounds, n=25, ascending=True))]
    rows = [(view, r.member, r.score, i + 1) for view, df in read for i, r in enumerate(df.collect())]   # 25 rows each
    return spark.createDataFrame(rows, "view string, member string, score double, place int")


def _link_pages(spark, sf_dir) -> DataFrame:
    """Pages rendered from part with anchors in all forms: three quotings, comments, entities, other attributes (one of
    5,000 characters), in scripts, unclosed, none."""
    key = F.col("p_partkey").cast("string")
    form = F.col("p_partkey") % 5

    def around(before, after):
        return F.concat(F.lit(before), key, F.lit(after))
    html = (F.when(form == 0, around('<!-- <a href="https://www.tiktok.com/music/old">x</a> --><A class=b HREF="/music/', '">Tom &amp; J&#233;r&ocirc;me</A>'))
            .when(form == 1, around("<p><a title='a > b' href='/m?a=1&amp;id=", "'> <b>View on TikTok</b> </a>"))
            .when(form == 2, around("<script>if (i<a; j) w('<a href=/no>no</a>')</script><a " + "x" * 5000 + " href=https://www.tiktok.com/music/s-", ">it&#8217;s &#x41;&unknown;</a>"))
            .when(form == 3, around('<a name="', '">no link<a href="">View on TikTok'))
            .otherwise(around("<p>nothing ", "</p>")))
    return _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("page_id"), around("https://pages.example.org/d/", ".html").alias("url"),
                                            html.alias("html"))


@register("link_variants", """
WITH p AS (SELECT p_partkey AS page_id, p_partkey % 5 AS f, CAST(p_partkey AS VARCHAR) AS k FROM part)
SELECT page_id, CAST(0 AS INTEGER) AS pos, '/music/' || k AS href, 'Tom & Jérôme' AS text, 'https://pages.example.org/music/' || k AS abs_url,
       CAST(NULL AS VARCHAR) AS first_link FROM p WHERE f = 0
UNION ALL SELECT page_id, 0, '/m?a=1&id=' || k, 'View on TikTok', 'https://pages.example.org/m?a=1&id=' || k, '/m?a=1&id=' || k FROM p WHERE f = 1
UNION ALL SELECT page_id, 0, 'https://www.tiktok.com/music/s-' || k, 'it' || chr(8217) || 's A&unknown;', 'https://www.tiktok.com/music/s-' || k,
                 'https://www.tiktok.com/music/s-' || k FROM p WHERE f = 2
UNION ALL SELECT page_id, 0, '', 'View on TikTok', 'https://pages.example.org/d/', NULL FROM p WHERE f = 3""")
def q_link_variants(spark, sf_dir):
    """Links of anchors in all quotings, with entities, and in comments (which hold none)."""
    pages = _link_pages(spark, sf_dir)
    first = pages.select("page_id", landing.first_link(F.col("html")).alias("first_link"))
    return landing.page_links(pages).join(first, "page_id")

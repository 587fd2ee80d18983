"""Hot path: ranked serving views from parsed topic records.

Each function takes one batch of parsed records and returns view rows
``(view, member, score, json_value)`` or the natural columns behind them.
Nothing is collected: the rows go to a serving table (``sinks.serving``)
as a distributed write. View names and write policies are fixed below, as
dashboards read them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.records import pack_json
from ..functions.text import rank_score
from ..operators.aggregates import sum_per_key
from ..operators.ranking import best_row_per_key, best_struct, key_summary, newest_struct
from ..sources.constants import TTL_SECONDS, VIEWS  # noqa: F401  (re-exported)

# Poll scope: rank views hold the newest poll (not the newest micro-batch).
# Category views sum (or take the best) over all micro-batches of a poll.
POLL_POLICIES = {**VIEWS, "twitch_streamers_rank": "replace_poll", "twitch_games_rank": "replace_poll",
                 "youtube_category_views": "sum_poll", "youtube_category_top_video": "best_poll"}


def view_rows(df: DataFrame, view: str, member, score=None, json_value=None, poll=None) -> DataFrame:
    """Shape rows for a serving view: ``(view, member, score, json_value)``,
    plus ``poll`` when a poll column is given."""
    def c(x):
        return F.lit(None) if x is None else (F.col(x) if isinstance(x, str) else x)
    cols = [F.lit(view).alias("view"), c(member).cast("string").alias("member"),
            c(score).cast("double").alias("score"), c(json_value).cast("string").alias("json_value")]
    if poll is not None:
        cols.append(c(poll).cast("string").alias("poll"))
    return df.select(*cols)


def views_from(df: DataFrame, specs) -> DataFrame:
    """Several views' rows from one frame in a single pass.

    ``specs`` are ``(view, member, score, json_value)`` tuples (names or
    Columns, None for absent). Each input row becomes one row per view via
    ``inline(array(...))``, so the frame is computed once instead of once
    per view as a ``union`` of branches would.
    """
    def c(x):
        return F.lit(None) if x is None else (F.col(x) if isinstance(x, str) else x)
    with_poll = any(len(sp) > 4 and sp[4] is not None for sp in specs)

    def row(sp):
        f = [F.lit(sp[0]).alias("view"), c(sp[1]).cast("string").alias("member"),
             c(sp[2]).cast("double").alias("score"), c(sp[3]).cast("string").alias("json_value")]
        if with_poll:
            f.append(c(sp[4] if len(sp) > 4 else None).cast("string").alias("poll"))
        return F.struct(*f)
    rows = [row(sp) for sp in specs]
    return df.select(F.inline(F.array(*rows)))


# ---- C1: reddit best post per subreddit --------------------------------

def reddit_best_posts(posts: DataFrame) -> DataFrame:
    """A1 + P6: per subreddit the post with the largest score (ties: larger
    title, then url), packed as ``{best_title, best_score, best_url}``."""
    agg = posts.groupBy("subreddit").agg(best_struct(["score", "title", "url"]).alias("best"))
    return agg.select(
        "subreddit",
        F.col("best.title").alias("best_title"),
        F.col("best.score").alias("best_score"),
        F.col("best.url").alias("best_url"),
        pack_json(F.col("best.title").alias("best_title"),
                  F.col("best.score").alias("best_score"),
                  F.col("best.url").alias("best_url")).alias("json_value"),
    )


def reddit_newest_posts(posts: DataFrame) -> DataFrame:
    """A2: per subreddit the newest post by ``post_timestamp`` text order."""
    agg = posts.groupBy("subreddit").agg(newest_struct("post_timestamp", ["title", "url"]).alias("n"))
    return agg.select("subreddit", F.col("n.post_timestamp").alias("new_timestamp"),
                      F.col("n.title").alias("new_title"), F.col("n.url").alias("new_url"))


def reddit_details_view(posts: DataFrame) -> DataFrame:
    best = reddit_best_posts(posts)
    return view_rows(best, "reddit_subreddits_details", "subreddit", json_value="json_value")


# ---- C14 / C15: running score ranking, per-subreddit summary ------------

def reddit_score_totals(posts: DataFrame) -> DataFrame:
    """A4: total score per subreddit (a running sum when the input is a stream)."""
    return sum_per_key(posts, "subreddit", "score", "total_score", drop_null_keys=False)


def reddit_summary(posts: DataFrame) -> DataFrame:
    """A5 + P5: total, best and newest post per subreddit in one aggregate."""
    agg = key_summary(posts, "subreddit", "score", ["title", "url"], "post_timestamp",
                      ["title", "url"], total_alias="total_score")
    return agg.select(
        "subreddit", "total_score",
        F.col("top.title").alias("high_title"), F.col("top.score").alias("high_score"),
        F.col("top.url").alias("high_url"),
        F.col("newest.title").alias("new_title"), F.col("newest.url").alias("new_url"),
    )


# ---- C2: youtube views per category, top video per category -------------

def youtube_category_views(videos: DataFrame, scope=None) -> DataFrame:
    """A3: summed views per category of the batch (null categories dropped).

    ``scope`` (a column name such as ``ingestion_timestamp``) sums per poll
    instead of per batch.
    """
    keys = ["category"] if scope is None else [scope, "category"]
    return sum_per_key(videos, keys, "views", "total_views")


def youtube_top_videos(videos: DataFrame, scope=None) -> DataFrame:
    """The most viewed video per category (ties: larger title, channel, url),
    packed as ``{title, channel, views, url}``."""
    keys = ["category"] if scope is None else [scope, "category"]
    src = videos.where(F.col("category").isNotNull())
    top = best_row_per_key(src, keys, ["views"], ["title", "channel", "video_url", "video_id"],
                           alias="_top")
    return top.withColumn("json_value", pack_json(
        "title", "channel", "views", F.col("video_url").alias("url"), keep_nulls=True))


def youtube_category_stats(videos: DataFrame, scope: str = "batch") -> DataFrame:
    """A3 + W1 in one aggregate: per category (per poll and category with
    ``scope="poll"``) the summed views and the top video: both views of a
    batch come from one pass and one shuffle."""
    keys = ["category"] if scope == "batch" else ["ingestion_timestamp", "category"]
    src = videos.where(F.col("category").isNotNull())
    agg = src.groupBy(*keys).agg(
        F.sum("views").alias("total_views"),
        best_struct(["views"], ["title", "channel", "video_url", "video_id"]).alias("_top"))
    return agg.withColumns({"json_value": pack_json(
        F.col("_top.title").alias("title"), F.col("_top.channel").alias("channel"),
        F.col("_top.views").alias("views"), F.col("_top.video_url").alias("url"), keep_nulls=True),
        "top_views": F.col("_top.views")})


def youtube_views(videos: DataFrame, scope: str = "batch") -> DataFrame:
    """C2. With ``scope="poll"`` the rows carry their poll, and the top video its views."""
    stats = youtube_category_stats(videos, scope)
    poll, top = ("ingestion_timestamp", "top_views") if scope == "poll" else (None, None)
    return views_from(stats, [("youtube_category_views", "category", "total_views", None, poll),
                              ("youtube_category_top_video", "category", top, "json_value", poll)])


# ---- C3 / C4: twitch streamer and game rankings ------------------------

def twitch_top_streams(streams: DataFrame, scope: str = "batch") -> DataFrame:
    """Per user (per poll and user with ``scope="poll"``) the snapshot
    with most viewers, and its details JSON."""
    keys = ["user_name"] if scope == "batch" else ["fetched_at", "user_name"]
    top = best_row_per_key(streams, keys, ["viewer_count"], ["game_name", "title", "thumbnail_url"],
                           alias="_top")
    return top.withColumn("json_value", pack_json(
        F.col("game_name").alias("game"), "title", F.col("thumbnail_url").alias("thumb"),
        F.col("viewer_count").alias("views"), keep_nulls=True))


def twitch_streamer_views(streams: DataFrame, scope: str = "batch") -> DataFrame:
    """Rank (replaced) and details (upserted). With ``scope="poll"`` the
    rows carry their poll so a ``replace_poll`` store keeps whole polls."""
    top = twitch_top_streams(streams, scope)
    poll = "fetched_at" if scope == "poll" else None
    return views_from(top, [("twitch_streamers_rank", "user_name", "viewer_count", None, poll),
                            ("twitch_streamers_details", "user_name", None, "json_value", poll)])


def twitch_top_games(games: DataFrame, scope: str = "batch") -> DataFrame:
    """Per game (per poll and game) the row with most total viewers, and ``{img, views}``."""
    keys = ["game_name"] if scope == "batch" else ["fetched_at", "game_name"]
    top = best_row_per_key(games, keys, ["total_viewers"], ["box_art_url"], alias="_top")
    return top.withColumn("json_value", pack_json(
        F.col("box_art_url").alias("img"), F.col("total_viewers").alias("views"), keep_nulls=True))


def twitch_game_views(games: DataFrame, scope: str = "batch") -> DataFrame:
    top = twitch_top_games(games, scope)
    poll = "fetched_at" if scope == "poll" else None
    return views_from(top, [("twitch_games_rank", "game_name", "total_viewers", None, poll),
                            ("twitch_games_details", "game_name", None, "json_value", poll)])


# ---- C5: tiktok sounds -------------------------------------------------

def tiktok_members(sounds: DataFrame, with_poll: bool = False) -> DataFrame:
    """F17 + P6: member = the whole sound document, score = parsed rank.

    The document includes ``fetched_at``, so a re-fetched sound is a new
    member. When one document comes with several ranks in a batch, the
    best (smallest) rank is kept.
    """
    doc = pack_json(F.col("sound_name").alias("name"), F.col("ugc_count").alias("ugc"),
                    "growth", F.col("tiktok_direct_url").alias("link"),
                    F.col("fetch_timestamp").alias("fetched_at"), keep_nulls=True)
    poll = [F.min("poll").alias("poll")] if with_poll else []
    rows = sounds.select(doc.alias("member"), rank_score("rank").alias("rank_score"), F.col("fetch_timestamp").alias("poll"))
    return rows.groupBy("member").agg(F.min("rank_score").alias("rank_score"), *poll)


def tiktok_view(sounds: DataFrame, scope: str = "batch") -> DataFrame:
    """C5. A member is of one poll anyway; with ``scope="poll"`` the rows carry it."""
    return view_rows(tiktok_members(sounds, scope == "poll"), "tiktok_trends_eg", "member", score="rank_score",
                     poll="poll" if scope == "poll" else None)

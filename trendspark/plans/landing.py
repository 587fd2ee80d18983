"""Landing jobs: stored API replies and chart pages -> topic records
(C12, C13; S8, S9, P8-P11, F8, F11-F15, F18-F20, J5, J6, A6).

The pollers' HTTP loops are not rebuilt; their transforms run here as Spark
jobs over replies and pages that were landed as rows, so the work spreads
over the cluster instead of one client process.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, LongType, StringType,
                               StructField, StructType)

from ..functions.html import anchors, table_rows
from ..functions.text import (absolute_url, count_or_zero, fill_size_template,
                              first_token, last_token, not_found, strip_ws, url_from_id)
from ..functions.times import epoch_to_iso_utc, poll_stamp
from ..operators.aggregates import sum_per_key
from ..operators.lookups import lookup_with_default
from ..sources.constants import (BOX_ART_SIZE, CHART_MIN_CELLS, MUSIC_HREF, OTHER_CATEGORY,
                                 THUMBNAIL_SIZE, UNKNOWN_GAME, VIEW_ON_TIKTOK, YOUTUBE_WATCH_URL)

# ---- C12: API replies --------------------------------------------------

REDDIT_REPLY = StructType([StructField("data", StructType([StructField("children", ArrayType(
    StructType([StructField("data", StructType([
        StructField("subreddit", StringType()), StructField("score", LongType()),
        StructField("num_comments", LongType()), StructField("title", StringType()),
        StructField("url", StringType()), StructField("created_utc", DoubleType())]))])))]))])

YOUTUBE_REPLY = StructType([StructField("items", ArrayType(StructType([
    StructField("id", StringType()),
    StructField("snippet", StructType([
        StructField("title", StringType()), StructField("channelTitle", StringType()),
        StructField("categoryId", StringType()), StructField("publishedAt", StringType())])),
    StructField("statistics", StructType([
        StructField("viewCount", StringType()), StructField("likeCount", StringType())])),
])))])

TWITCH_REPLY = StructType([StructField("data", ArrayType(StructType([
    StructField("user_name", StringType()), StructField("game_id", StringType()),
    StructField("game_name", StringType()), StructField("title", StringType()),
    StructField("viewer_count", LongType()), StructField("thumbnail_url", StringType()),
])))])


def ok_replies(replies: DataFrame, source: str | None = None) -> DataFrame:
    """Only successful replies (status 200), optionally of one source."""
    out = replies.where(F.col("status") == 200)
    return out.where(F.col("source") == source) if source else out


def _items(replies: DataFrame, schema: StructType, path: str) -> DataFrame:
    """One row per array element; a missing array gives no rows."""
    parsed = replies.select("fetched_at", F.from_json("body", schema).alias("b"))
    return parsed.select("fetched_at", F.explode(F.col(f"b.{path}")).alias("it"))


def reddit_records(replies: DataFrame) -> DataFrame:
    """Reddit listing replies -> reddit_data records (F8 for the post time)."""
    it = _items(ok_replies(replies), REDDIT_REPLY, "data.children")
    d = "it.data"
    return it.select(
        F.col(f"{d}.subreddit").alias("subreddit"), F.col(f"{d}.score").alias("score"),
        F.col(f"{d}.num_comments").alias("num_comments"), F.col(f"{d}.title").alias("title"),
        F.col(f"{d}.url").alias("url"),
        epoch_to_iso_utc(F.col(f"{d}.created_utc")).alias("post_timestamp"),
        F.col("fetched_at").alias("ingestion_timestamp"))


def youtube_records(replies: DataFrame, categories: DataFrame) -> DataFrame:
    """Trending-video replies -> youtube_data records.

    F11: counts are text, a missing count is 0; J5: category id -> name,
    ``Other`` when unknown.
    """
    it = _items(ok_replies(replies), YOUTUBE_REPLY, "items")
    rows = it.select(
        F.col("it.id").alias("video_id"), F.col("it.snippet.title").alias("title"),
        F.col("it.snippet.channelTitle").alias("channel"),
        count_or_zero(F.col("it.statistics.viewCount")).alias("views"),
        count_or_zero(F.col("it.statistics.likeCount")).alias("likes"),
        F.col("it.snippet.categoryId").alias("category_id"),
        F.col("it.snippet.publishedAt").alias("published_at"),
        url_from_id(YOUTUBE_WATCH_URL, F.col("it.id")).alias("video_url"),
        F.col("fetched_at").alias("ingestion_timestamp"))
    named = lookup_with_default(rows, categories, "category_id", "id", {"name": ("category", OTHER_CATEGORY)})
    return named.select("video_id", "title", "channel", "views", "likes", "category",
                        "published_at", "video_url", "ingestion_timestamp")


def twitch_records(replies: DataFrame, games: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stream replies -> (twitch_streams records, twitch_games records).

    A6: viewers are summed per poll and game id, the empty id included;
    J6: game id -> name (``Unknown``) and box art (``""``), F13 fills the
    size templates. Unmatched ids keep separate sums but share the name
    ``Unknown``.
    """
    it = _items(ok_replies(replies), TWITCH_REPLY, "data")
    streams = it.select(
        F.col("it.user_name").alias("user_name"), F.col("it.game_id").alias("game_id"),
        F.col("it.game_name").alias("game_name"), F.col("it.title").alias("title"),
        F.col("it.viewer_count").alias("viewer_count"),
        fill_size_template(F.col("it.thumbnail_url"), THUMBNAIL_SIZE).alias("thumbnail_url"),
        "fetched_at")
    stream_records = streams.select("user_name", "game_name", "title", "viewer_count",
                                    "thumbnail_url", "fetched_at", F.lit("stream").alias("type"))
    per_game = sum_per_key(streams, ["fetched_at", "game_id"], "viewer_count", "total_viewers",
                           drop_null_keys=False)
    # Only truthy ids are looked up; an empty or null id stays unmatched
    lookup = games.where(F.coalesce(F.col("id"), F.lit("")) != "")
    named = lookup_with_default(per_game, lookup, "game_id", "id",
                                {"name": ("game_name", UNKNOWN_GAME), "box_art_url": ("box_art_url", "")})
    game_records = named.select(
        "game_name", fill_size_template(F.col("box_art_url"), BOX_ART_SIZE).alias("box_art_url"),
        "total_viewers", "fetched_at", F.lit("game").alias("type"))
    return stream_records, game_records


# ---- C13: chart pages --------------------------------------------------

def html_table_rows(pages: DataFrame, min_cells: int = CHART_MIN_CELLS) -> DataFrame:
    """Rows of the first table's body with at least ``min_cells``
    cells and a link in the second cell.

    Output: the page columns but ``html``, ``row_pos``, ``cells`` (their
    ``text`` and stripped ``pieces``) and ``sound_href``. Rows of a table
    inside a cell are that cell's text, not rows.
    """
    other = [c for c in pages.columns if c != "html"]
    rows = pages.select(*other, F.inline(table_rows("html")).alias("row_pos", "cells", "sound_href"))
    return rows.where((F.size("cells") >= min_cells) & (F.col("sound_href") != ""))


def chart_cells(rows: DataFrame, keep=()) -> DataFrame:
    """Cells -> raw chart columns (the shape of ``standins.tiktok_chart_rows``);
    ``keep`` names page columns carried along (e.g. the fetch time)."""
    c = F.col("cells")
    return rows.select(*keep,
        c[0]["text"].alias("rank_text"),
        c[1]["pieces"].alias("sound_name"),
        c[2]["text"].alias("ugc_text"),
        c[3]["text"].alias("growth_text"),
        c[4]["text"].alias("author_country"),
        "sound_href")


def chart_records(chart: DataFrame, base: str, links: DataFrame | None = None, fetched=None) -> DataFrame:
    """Raw chart columns -> tiktok_data records.

    F14 ugc (last token), F15 growth (first token), F18 stripping, F19
    absolute detail URL, F20 ``Not Found`` for a missing direct link. The
    direct link comes from ``direct_link`` when present, else from
    ``links`` (detail URL -> link, see ``first_link``) by a left join. Rows
    without a fetch time are stamped with ``fetched``, else with the
    processing time (F9).
    """
    df = chart.withColumn("tokchart_url", absolute_url(F.col("sound_href"), F.lit(base)))
    if links is not None:
        # one link per detail URL, so a page stored twice cannot duplicate rows
        df = lookup_with_default(df, links, "tokchart_url", "url", {"link": ("direct_link", None)})
    if "fetch_timestamp" not in df.columns:
        df = df.withColumn("fetch_timestamp", poll_stamp(fetched))
    if "direct_link" not in df.columns:
        df = df.withColumn("direct_link", F.lit(None).cast("string"))
    return df.select(
        strip_ws("rank_text").alias("rank"),
        strip_ws("sound_name").alias("sound_name"),
        last_token("ugc_text").alias("ugc_count"),
        first_token("growth_text").alias("growth"),
        strip_ws("author_country").alias("author_country"),
        "tokchart_url",
        not_found(F.col("direct_link")).alias("tiktok_direct_url"),
        "fetch_timestamp",
        *[c for c in ("ingested_at",) if c in df.columns])


def first_link(html, href_pattern: str = MUSIC_HREF, text: str = VIEW_ON_TIKTOK) -> F.Column:
    """Href of the first anchor whose href matches ``href_pattern``, else
    of the first anchor whose whole text is ``text``, else null. Neither
    minds the case of letters, as hosts in links don't."""
    found = anchors(html)
    by_href = F.filter(found, lambda a: a["href"].rlike("(?i)" + href_pattern))
    by_text = F.filter(found, lambda a: F.lower(a["text"]) == text.lower())
    return F.nullif(F.coalesce(F.try_element_at(by_href, F.lit(1))["href"], F.try_element_at(by_text, F.lit(1))["href"]), F.lit(""))


def page_links(pages: DataFrame) -> DataFrame:
    """All anchors with an href of each page: position among them, href, text and absolute URL."""
    with_href = F.filter(anchors("html"), lambda a: a["href"].isNotNull())
    found = pages.select("page_id", "url", F.posexplode(with_href).alias("pos", "a"))
    return found.select("page_id", "pos", F.col("a.href").alias("href"), F.col("a.text").alias("text"),
                        absolute_url(F.col("a.href"), F.col("url")).alias("abs_url"))

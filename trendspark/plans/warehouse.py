"""Warehouse path: lake records -> galaxy schema.

Each ``*_star`` function maps one batch of lake records to its tables
(dimensions and one fact) as ``{table name: DataFrame}``. In the default
``md5`` key mode every key is a projection of the row, so the fact needs
no join and no shuffle; a dimension is the batch's distinct keys (a hash
aggregate, combined map-side) with one fixed row per key. The ``uuid``
mode keeps the random keys, frozen once per batch (see ``operators.dims``).

Deliberate differences, all for fixed, replayable results: keys are
deterministic by default; a dimension row per key is chosen by value, not
arbitrarily; the lake is not pinned to one year; and new dimension rows
are found with an anti join against the target (``sinks.tables``), so a
name keeps one key across batches.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import date_key, row_key, time_key, uuid_key
from ..operators.dims import attach_keys, dimension
from ..session import checkpoint_dir
from ..sources.constants import PLATFORM_KEYS, platform_dim  # noqa: F401  (C7 re-export)


class StarTables(Mapping):
    """The tables of one star batch, each built on first access (building a
    DataFrame costs plan analysis; a caller reading one table pays for one)."""

    def __init__(self, builders: dict):
        self._builders = builders
        self._built: dict = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def _time_keys(df: DataFrame) -> list:
    return [
        date_key("ingested_at").alias("ingested_date_sk"),
        time_key("ingested_at").alias("ingested_time_sk"),
    ]


def _row_sk(platform: str, mode: str, cols) -> F.Column:
    return row_key(platform, *cols) if mode == "md5" else uuid_key()


def _freeze(df: DataFrame, mode: str, prepare=None) -> DataFrame:
    """Random keys must be computed once: cut the lineage before fan-out.

    ``prepare`` (e.g. a sink's persist) runs on the transformed batch that
    every table of the star is derived from.
    """
    if mode == "uuid":
        checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    return prepare(df) if prepare else df


def reddit_star(posts: DataFrame, mode: str = "md5", prepare=None, registry=None) -> StarTables:
    """Dim_Subreddit (normalised name), Dim_Post, Fact_Redit_Activity."""
    keyed = attach_keys(posts, "Reddit", [("subreddit_sk", "subreddit", True)], mode=mode, registry=registry)
    t = keyed.select(
        "subreddit_sk",
        _row_sk("Reddit", mode, ["url", "title", "post_timestamp", "ingested_at"]).alias("post_sk"),
        F.lit(PLATFORM_KEYS["Reddit"]).alias("platform_sk"),
        *_time_keys(keyed),
        F.col("subreddit").alias("subreddit_name"),
        F.col("title").alias("post_title"), F.col("url").alias("post_url"),
        "post_timestamp", "score", "num_comments", "ingested_at",
    )
    t = _freeze(t, mode, prepare)
    return StarTables({
        "Dim_Subreddit": lambda: dimension(t, "subreddit_sk", {"subreddit_name": "subreddit_name"}),
        "Dim_Post": lambda: dimension(t, "post_sk", {"title": "post_title", "url": "post_url",
                                             "post_timestamp": "post_timestamp"}, unique=True),
        "Fact_Redit_Activity": lambda: t.select("post_sk", "subreddit_sk", "platform_sk", "ingested_date_sk",
                                        "ingested_time_sk", "score", "num_comments", "ingested_at"),
    })


def tiktok_star(sounds: DataFrame, mode: str = "md5", prepare=None, registry=None) -> StarTables:
    """Dim_Sound, Dim_Country, Fact_Tiktok_Performance (two J1 joins, J4)."""
    keyed = attach_keys(sounds, "TikTok", [("sound_sk", "sound_name"),
                                           ("country_sk", "author_country")], mode=mode, registry=registry)
    t = keyed.select(
        "sound_sk", "country_sk",
        F.lit(PLATFORM_KEYS["TikTok"]).alias("platform_sk"),
        *_time_keys(keyed),
        "sound_name", F.col("author_country").alias("country_code_iso"),
        "rank", "ugc_count", "growth", "fetch_timestamp", "ingested_at",
    )
    t = t.withColumn("performance_sk", _row_sk("TikTok", mode, [
        "sound_name", "country_code_iso", "rank", "ugc_count", "growth", "fetch_timestamp", "ingested_at"]))
    t = _freeze(t, mode, prepare)
    return StarTables({
        "Dim_Sound": lambda: dimension(t, "sound_sk", {"sound_name": "sound_name"}, unique=True),
        "Dim_Country": lambda: dimension(t, "country_sk", {"country_code_iso": "country_code_iso"}, unique=True),
        "Fact_Tiktok_Performance": lambda: t.select(
            "performance_sk", "sound_sk", "country_sk", "platform_sk", "ingested_date_sk",
            "ingested_time_sk", "rank", "ugc_count", "growth", "fetch_timestamp", "ingested_at"),
    })


def youtube_star(videos: DataFrame, mode: str = "md5", prepare=None, seen: bool = False, registry=None) -> StarTables:
    """Dim_Video, Dim_Channel, Dim_Category, Fact_Youtube_Performance.

    ``seen`` keeps the time a video's row was taken in ``_seen``, which an
    incremental load needs to order the rows of several batches."""
    keyed = attach_keys(videos, "YouTube", [("video_sk", "video_id"), ("channel_sk", "channel"),
                                            ("category_sk", "category")], mode=mode, registry=registry)
    t = keyed.select(
        "video_sk", "channel_sk", "category_sk",
        F.lit(PLATFORM_KEYS["YouTube"]).alias("platform_sk"),
        *_time_keys(keyed),
        "video_id", F.col("title").alias("video_title"), "video_url", "published_at",
        F.col("channel").alias("channel_name"), F.col("category").alias("category_name"),
        "views", "likes", "ingestion_timestamp", "ingested_at",
    )
    t = t.withColumn("performance_sk", _row_sk("YouTube", mode, [
        "video_id", "channel_name", "category_name", "views", "likes", "ingestion_timestamp",
        "ingested_at"]))
    t = _freeze(t, mode, prepare)
    return StarTables({
        # attributes of a video may change between snapshots: the newest wins
        "Dim_Video": lambda: dimension(t, "video_sk", {
            "_seen": "ingested_at", "video_id_nk": "video_id", "video_url": "video_url",
            "video_title": "video_title", "published_at": "published_at"}).drop(*([] if seen else ["_seen"])),
        "Dim_Channel": lambda: dimension(t, "channel_sk", {"channel_name_nk": "channel_name"}, unique=True),
        "Dim_Category": lambda: dimension(t, "category_sk", {"category_name_nk": "category_name"}, unique=True),
        "Fact_Youtube_Performance": lambda: t.select(
            "performance_sk", "video_sk", "channel_sk", "category_sk", "platform_sk",
            "ingested_date_sk", "ingested_time_sk", "views", "likes", "ingestion_timestamp",
            "ingested_at"),
    })


def twitch_star(streams: DataFrame, mode: str = "md5", prepare=None, registry=None) -> StarTables:
    """C11: Dim_Game, Dim_Stream (key: user_name || fetched_at, J3) and
    Fact_Twitch_Performance. ``user_sk`` is in the fact; like the source
    job, no user dimension is written."""
    stream_nk = F.concat(F.col("user_name"), F.col("fetched_at").cast("string"))
    keyed = attach_keys(streams, "Twitch", [("game_sk", "game_name"), ("user_sk", "user_name"),
                                            ("stream_sk", stream_nk)], mode=mode, registry=registry)
    t = keyed.select(
        "stream_sk", "game_sk", "user_sk",
        F.lit(PLATFORM_KEYS["Twitch"]).alias("platform_sk"),
        *_time_keys(keyed),
        "user_name", "game_name", F.col("title").alias("stream_title"),
        "viewer_count", "thumbnail_url", "type",
        F.col("fetched_at").alias("fetched_timestamp"), "ingested_at",
    )
    t = t.withColumn("performance_sk", _row_sk("Twitch", mode, [
        "user_name", "game_name", "stream_title", "viewer_count", "fetched_timestamp", "ingested_at"]))
    t = _freeze(t, mode, prepare)
    return StarTables({
        "Dim_Game": lambda: dimension(t, "game_sk", {"game_name_nk": "game_name"}, unique=True),
        "Dim_Stream": lambda: dimension(t, "stream_sk", {
            "ingested_at": "ingested_at", "stream_title": "stream_title",
            "thumbnail_url": "thumbnail_url", "type": "type", "user_name": "user_name"}).drop("ingested_at"),
        "Fact_Twitch_Performance": lambda: t.select(
            "performance_sk", "stream_sk", "user_sk", "game_sk", "platform_sk", "ingested_date_sk",
            "ingested_time_sk", "viewer_count", "fetched_timestamp", "ingested_at"),
    })


STARS = {
    "reddit_data": reddit_star,
    "tiktok_data": tiktok_star,
    "youtube_data": youtube_star,
    "twitch_streams": twitch_star,
}


# Key column of each entity dimension: a name seen again in a later batch
# must not get a second row, so loads anti-join these against the target.
DIM_KEYS = {
    "Dim_Subreddit": "subreddit_sk",
    "Dim_Sound": "sound_sk", "Dim_Country": "country_sk",
    "Dim_Video": "video_sk", "Dim_Channel": "channel_sk", "Dim_Category": "category_sk",
    "Dim_Game": "game_sk",
}
# Keys that name an entity: random ones are registered, so that a name keeps its key (the users have no dimension).
ENTITY_KEYS = frozenset(DIM_KEYS.values()) | {"user_sk"}
# Per-event dimensions (Dim_Post, Dim_Stream): the key hashes the record's
# identity (post snapshot, user poll), each lake record is loaded once
# (file-stream checkpoint) and a replayed batch overwrites its own partition,
# so no anti join against the whole, ever-growing history is needed.

# Dimensions whose attributes may differ between batches, with the columns
# that order their rows: a reader takes each key's largest row, which is what
# one batch over the same lake would keep.
CHANGING_DIMS = {"Dim_Video": ["_seen", "video_id_nk", "video_url", "video_title", "published_at"],
                 "Dim_Subreddit": ["subreddit_name"]}
# Column that names the record of a topic; a lake line without it is malformed.
RECORD_KEYS = {"reddit_data": "subreddit", "tiktok_data": "sound_name", "youtube_data": "video_id", "twitch_streams": "user_name"}

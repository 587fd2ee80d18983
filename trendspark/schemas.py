"""Fixed record schemas, one per topic.

Hot-path schemas declare ``score``, ``num_comments``, ``viewer_count`` and
``total_viewers`` as 32-bit ints (an out-of-range value parses to null and
the rest of the record survives); ``views`` and ``likes`` are 64-bit. All
timestamps stay strings as published; operators parse them into a second
column when they need time. Lake records carry ``ingested_at`` in addition.
"""

from __future__ import annotations

from pyspark.sql.types import (IntegerType, LongType, StringType, StructField,
                               StructType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, I, L = StringType(), IntegerType(), LongType()

REDDIT = _s(("subreddit", S), ("score", I), ("num_comments", I), ("title", S),
            ("url", S), ("post_timestamp", S), ("ingestion_timestamp", S))

YOUTUBE = _s(("video_id", S), ("title", S), ("channel", S), ("views", L),
             ("likes", L), ("category", S), ("published_at", S),
             ("video_url", S), ("ingestion_timestamp", S))

# twitch ``type`` is published but the hot path does not read it; the
# warehouse does, so it is part of the lake schema.
TWITCH_STREAMS = _s(("user_name", S), ("game_name", S), ("title", S),
                    ("viewer_count", I), ("thumbnail_url", S), ("fetched_at", S))
TWITCH_STREAMS_LAKE = _s(*[(f.name, f.dataType) for f in TWITCH_STREAMS.fields], ("type", S))

TWITCH_GAMES = _s(("game_name", S), ("box_art_url", S), ("total_viewers", I),
                  ("fetched_at", S))

TIKTOK = _s(("rank", S), ("sound_name", S), ("ugc_count", S), ("growth", S),
            ("author_country", S), ("tokchart_url", S),
            ("tiktok_direct_url", S), ("fetch_timestamp", S))

HOT = {
    "reddit_data": REDDIT,
    "youtube_data": YOUTUBE,
    "twitch_streams": TWITCH_STREAMS,
    "twitch_games": TWITCH_GAMES,
    "tiktok_data": TIKTOK,
}

# Topics copied into the lake (twitch_games is never archived).
ARCHIVED = ("reddit_data", "youtube_data", "twitch_streams", "tiktok_data")


def lake_schema(topic: str) -> StructType:
    """Schema of a lake record: the published fields plus ``ingested_at``."""
    base = TWITCH_STREAMS_LAKE if topic == "twitch_streams" else HOT[topic]
    fields = list(base.fields)
    # the lake keeps every integer as 64-bit, as a JSON reader would infer it
    fields = [StructField(f.name, L if isinstance(f.dataType, IntegerType) else f.dataType, True)
              for f in fields]
    return StructType(fields + [StructField("ingested_at", S, True)])


# Landed inputs of the re-aimed producer jobs.
API_REPLIES = _s(("source", S), ("status", I), ("fetched_at", S), ("body", S))
LOOKUP = _s(("id", S), ("name", S))
GAME_LOOKUP = _s(("id", S), ("name", S), ("box_art_url", S))

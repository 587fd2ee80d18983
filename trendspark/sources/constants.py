"""Constant tables with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

# ---------------------------------------------------------------------------
# These must equal the published pipeline's for the same
# results (existing warehouse keys, dashboard view names, published text).
# ---------------------------------------------------------------------------

# platform surrogate keys of the existing warehouse's Dim_Platform
PLATFORM_KEYS = {
    "Reddit": "550e8400-e29b-41d4-a716-446655440000",
    "TikTok": "6ba7b810-9dad-11d1-80b4-00c04fd430c8",
    "YouTube": "7d444840-9dc0-11d1-b245-5ffdce74fad2",
    "Twitch": "2c5ea4c0-4067-11e9-8bad-9b1deb4d9857",
}

# serving views read by the dashboards, with their write policies
VIEWS = {
    "reddit_subreddits_details": "upsert",
    "reddit_subreddits_rank": "replace",
    "youtube_category_views": "upsert",
    "youtube_category_top_video": "upsert",
    "twitch_streamers_rank": "replace",
    "twitch_streamers_details": "upsert",
    "twitch_games_rank": "replace",
    "twitch_games_details": "upsert",
    "tiktok_trends_eg": "upsert",
}
# views whose whole key expires this many seconds after its last non-empty batch
TTL_SECONDS = {
    "youtube_category_views": 86400,
    "youtube_category_top_video": 86400,
    "tiktok_trends_eg": 86400,
}

NOT_FOUND = "Not Found"                 # tiktok direct link when none was found
UNKNOWN_GAME = "Unknown"                # game id with no game info
OTHER_CATEGORY = "Other"                # category id with no category name
EMPTY_TOKEN = "0"                       # ugc / growth text with no token
EMPTY_PERCENT = "0%"                    # percentage text with no token
UNPARSABLE_RANK = 999                   # rank text that is not an integer
SIZE_TEMPLATE = "{width}x{height}"      # image URL size placeholder
THUMBNAIL_SIZE = "320x180"              # stream thumbnails
BOX_ART_SIZE = "285x380"                # game box art
YOUTUBE_WATCH_URL = "https://www.youtube.com/watch?v="
MUSIC_HREF = r"tiktok\.com/music/"     # detail page: first link matching this
VIEW_ON_TIKTOK = "View on TikTok"       # detail page: else the link with this text
CHART_MIN_CELLS = 8                     # chart rows need more than seven cells

PLATFORM_SCHEMA = StructType([
    StructField("platform_sk", StringType(), False),
    StructField("platform_name", StringType(), True),
])


def platform_dim(spark: SparkSession) -> DataFrame:
    """The four-row platform dimension (a local relation, no scan)."""
    rows = [(k, name) for name, k in PLATFORM_KEYS.items()]
    return spark.createDataFrame(rows, PLATFORM_SCHEMA)

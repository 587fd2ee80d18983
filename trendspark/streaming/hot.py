"""Hot-path streaming queries (T1, T2, T3, T5, T6, T8 with C1-C5, C14).

Each query parses its topic, runs the same composite as the batch form,
and writes the views through ``foreachBatch`` into a ``ServingStore``.
Nothing is collected to the driver. Malformed records and records without
their key go to a quarantine folder, next to the checkpoint unless another
is given. A checkpoint location is always set:
on restart the query resumes where it stopped instead of re-reading from
its configured start.
"""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..plans import hot
from ..sinks.serving import ServingStore
from ..sinks.tables import write_rejects, write_snapshot
from ..sources.topics import parse_topic
from .queries import StartedQueries, rejects_path, start_rejects

# topic -> (schema, key, composite producing view rows, views written)
HOT_JOBS = {
    "youtube_data": (schemas.YOUTUBE, "video_id", hot.youtube_views,
                     ["youtube_category_views", "youtube_category_top_video"]),
    "twitch_streams": (schemas.TWITCH_STREAMS, "user_name", hot.twitch_streamer_views,
                       ["twitch_streamers_rank", "twitch_streamers_details"]),
    "twitch_games": (schemas.TWITCH_GAMES, "game_name", hot.twitch_game_views,
                     ["twitch_games_rank", "twitch_games_details"]),
    "tiktok_data": (schemas.TIKTOK, "sound_name", hot.tiktok_view, ["tiktok_trends_eg"]),
}


def _writer(store: ServingStore, compose, views, quarantine: str, clock=None):
    def write(batch: DataFrame, batch_id: int) -> None:
        # the batch is read by the quarantine write, the empty check and the
        # views: fetch and parse it once (a lost block is re-read from the
        # source, which replays the same offsets/files for this batch id)
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = held.where("_good")
            write_rejects(held.where("not _good").select("raw_value"), quarantine, batch_id)
            if good.isEmpty():          # P12: an empty batch changes nothing
                return
            now = clock() if clock else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            store.write_batch(compose(good.drop("_good", "raw_value")), batch_id, views, now)
        finally:
            held.unpersist()
    return write


def _tagged(raw: DataFrame, schema, key) -> DataFrame:
    from pyspark.sql import functions as F
    from ..functions.records import from_json_text
    # Generate barrier: the per-batch filters on _good do not re-run the parse
    parsed = raw.select(F.col("value").cast("string").alias("raw_value"),
                        F.inline(F.array(from_json_text("value", schema))))
    # a batch is held while it is written: of good records the fields alone
    return parsed.select(F.when(F.col(key).isNull(), F.col("raw_value")).alias("raw_value"), F.col(key).isNotNull().alias("_good"),
                         *[f.name for f in schema.fields])


def start_view_query(raw: DataFrame, topic: str, store: ServingStore, checkpoint: str,
                     quarantine: str | None = None, trigger: dict | None = None,
                     clock=None, scope: str = "batch") -> StreamingQuery:
    """T1 + T8: stateless append query; each micro-batch updates its views.

    ``scope="poll"`` computes the views per poll stamp; use it with a
    store built on ``hot.POLL_POLICIES`` so a poll split over micro-batches
    is kept whole. The default reproduces per-micro-batch views.
    """
    schema, key, compose, views = HOT_JOBS[topic]
    if scope == "poll":
        base = compose
        compose = lambda df: base(df, scope="poll")
    tagged = _tagged(raw, schema, key)
    w = (tagged.writeStream.outputMode("append")
         .foreachBatch(_writer(store, compose, views, rejects_path(checkpoint, quarantine), clock))
         .option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return w.queryName(f"views_{topic}").start()


def start_reddit_best(raw: DataFrame, store: ServingStore, checkpoint: str,
                      quarantine: str | None = None,
                      trigger: dict | None = None) -> StartedQueries:
    """C1 as T2: stateful best post per subreddit, update mode.

    Every key touched by a batch is emitted with its running best and
    upserted into the details view. Malformed records and records without
    a subreddit go to ``quarantine`` (a second query, awaited with the
    first), never into a null group. State holds one row per subreddit.
    """
    good, bad = parse_topic(raw, schemas.REDDIT, "subreddit")
    best = hot.reddit_best_posts(good)
    trigger = trigger or {"processingTime": "10 seconds"}

    def write(batch: DataFrame, batch_id: int) -> None:
        store.write_batch(hot.view_rows(batch, "reddit_subreddits_details", "subreddit",
                                        json_value="json_value"),
                          batch_id, ["reddit_subreddits_details"])

    w = (best.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(**trigger))
    q = w.queryName("reddit_best").start()
    return StartedQueries([q, start_rejects(bad, rejects_path(checkpoint, quarantine), checkpoint, "reddit_best_rejects", trigger)])


def start_reddit_rank(raw: DataFrame, store: ServingStore, checkpoint: str,
                      quarantine: str | None = None, trigger: dict | None = None, rejects: bool = True) -> StartedQueries:
    """C14 as T3: running total score per subreddit, complete mode; each
    trigger replaces the rank view with the full ordered totals (W2).
    Without ``rejects`` another query of the topic keeps them, and the topic
    is read once less."""
    good, bad = parse_topic(raw, schemas.REDDIT, "subreddit")
    totals = hot.reddit_score_totals(good)

    def write(batch: DataFrame, batch_id: int) -> None:
        store.write_batch(hot.view_rows(batch, "reddit_subreddits_rank", "subreddit", score="total_score"),
                          batch_id, ["reddit_subreddits_rank"])

    w = (totals.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    q = w.queryName("reddit_rank").start()
    return StartedQueries([q, *([start_rejects(bad, rejects_path(checkpoint, quarantine), checkpoint, "reddit_rank_rejects", trigger)] if rejects else [])])


def start_reddit_summary(raw: DataFrame, path: str, checkpoint: str,
                         quarantine: str | None = None, trigger: dict | None = None, rejects: bool = True) -> StartedQueries:
    """C15 as T3 + K13: a new snapshot of the per-subreddit summary each trigger (``sinks.tables.read_snapshot``); ``rejects`` as for the rank."""
    good, bad = parse_topic(raw, schemas.REDDIT, "subreddit")
    summary = hot.reddit_summary(good)
    w = (summary.writeStream.outputMode("complete")
         .foreachBatch(lambda df, _id: write_snapshot(df, path))
         .option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    q = w.queryName("reddit_summary").start()
    return StartedQueries([q, *([start_rejects(bad, rejects_path(checkpoint, quarantine), checkpoint, "reddit_summary_rejects", trigger)] if rejects else [])])


def await_any(spark) -> None:
    """Block until any query of the session stops (or fails)."""
    spark.streams.awaitAnyTermination()

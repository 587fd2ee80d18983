"""Job entry points, for ``spark-submit`` or ``python -m trendspark.jobs``.

    hot        serving views of one or more topics (C1-C5; T1/T2, T6)
    archive    raw lake archive, one query per topic (C6)
    warehouse  incremental star-schema load from the lake (C7-C11; T4, T7)
    landing    stored API replies or chart pages to topic records (C12, C13)

Sources are Kafka (``--servers``) or JSON-lines folders (``--landing``, one
``topic=<name>`` folder per topic). ``--once`` drains what is there
(``availableNow``) and stops; otherwise queries run until one stops.
"""

from __future__ import annotations

import argparse

from .session import build_session

HOT_TOPICS = ("reddit_data", "youtube_data", "twitch_streams", "twitch_games", "tiktok_data")


def _source(spark, args, topic: str):
    from .sources.topics import kafka_stream, text_stream
    if args.servers:
        return kafka_stream(spark, args.servers, topic, starting=args.starting)
    return text_stream(spark, f"{args.landing.rstrip('/')}/topic={topic}", topic=topic,
                       max_files_per_trigger=args.max_files)


def _many_sources(spark, args, topics: list[str]):
    """One stream over several topics."""
    from .sources.topics import kafka_stream, topics_stream
    if args.servers:
        return kafka_stream(spark, args.servers, topics, starting=args.starting)
    return topics_stream(spark, args.landing, topics, max_files_per_trigger=args.max_files)


def run_hot(spark, args) -> list:
    from .plans.hot import POLL_POLICIES, VIEWS
    from .sinks.serving import ServingStore
    from .streaming import hot
    store = ServingStore(spark, args.views, policies=POLL_POLICIES if args.scope == "poll" else VIEWS)
    trigger = {"availableNow": True} if args.once else {"processingTime": args.trigger}
    queries = []
    for topic in args.topics.split(","):
        ck = f"{args.checkpoint.rstrip('/')}/{topic}"
        raw = _source(spark, args, topic)
        quarantine = f"{args.quarantine.rstrip('/')}/{topic}" if args.quarantine else None
        if topic == "reddit_data":
            queries.append(hot.start_reddit_best(raw, store, ck, quarantine=quarantine, trigger=trigger))
            # its rejects are the ones above: the records are the same
            if args.rank:
                queries.append(hot.start_reddit_rank(_source(spark, args, topic), store, f"{ck}_rank", trigger=trigger, rejects=False))
            if args.summary:
                queries.append(hot.start_reddit_summary(_source(spark, args, topic), args.summary, f"{ck}_summary", trigger=trigger, rejects=False))
        else:
            queries.append(hot.start_view_query(raw, topic, store, ck, quarantine=quarantine,
                                                trigger=trigger, scope=args.scope))
    return queries


def run_archive(spark, args) -> list:
    from .streaming.archive import start_archive
    trigger = {"availableNow": True} if args.once else {"processingTime": args.trigger}
    topics = args.topics.split(",")
    raw = _source(spark, args, topics[0]) if len(topics) == 1 else _many_sources(spark, args, topics)
    return [start_archive(raw, args.lake, topics, args.checkpoint, max_records_per_file=args.max_records,
                          trigger=trigger, rejects=args.quarantine)]


def run_warehouse(spark, args) -> list:
    from .streaming.warehouse import ORDER, run_all
    topics = tuple(args.topics.split(",")) if args.topics else ORDER
    run_all(spark, args.lake, args.target, args.checkpoint, mode=args.mode, topics=topics,
            max_files_per_trigger=args.max_files, infer=args.infer, quarantine=args.quarantine,
            fmt=args.format, options=dict(o.split("=", 1) for o in args.option))
    return []


def run_landing(spark, args) -> list:
    """Batch: replies ``(source, status, fetched_at, body)`` or chart pages ``(url, html)`` to published records."""
    from .plans import landing
    from .sinks.publish import publish

    def read(path):
        return spark.read.format(args.input_format).load(path)

    def out(df, topic):
        publish(df, topic, path=args.out, servers=args.servers)

    if args.kind == "reddit":
        out(landing.reddit_records(landing.ok_replies(read(args.input), "reddit")), "reddit_data")
    elif args.kind == "youtube":
        out(landing.youtube_records(landing.ok_replies(read(args.input), "youtube"), read(args.lookup)), "youtube_data")
    elif args.kind == "twitch":
        streams, games = landing.twitch_records(landing.ok_replies(read(args.input), "twitch"), read(args.lookup))
        out(streams, "twitch_streams")
        out(games, "twitch_games")
    else:
        pages = read(args.input)
        links = None
        if args.details:
            details = read(args.details)
            links = details.select("url", landing.first_link(details["html"]).alias("link"))
        keep = tuple(c for c in ("fetch_timestamp",) if c in pages.columns)
        chart = landing.chart_cells(landing.html_table_rows(pages), keep=keep)
        out(landing.chart_records(chart, args.base, links), "tiktok_data")
    return []


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="trendspark.jobs")
    sub = p.add_subparsers(dest="job", required=True)

    def common(sp, topics_default):
        sp.add_argument("--topics", default=topics_default)
        sp.add_argument("--checkpoint", required=True)
        sp.add_argument("--servers", help="Kafka bootstrap servers")
        sp.add_argument("--starting", default="latest", help="Kafka start when no checkpoint exists")
        sp.add_argument("--landing", help="folder with topic=<name> JSON-lines folders")
        sp.add_argument("--max-files", type=int, default=1000)
        sp.add_argument("--quarantine")
        sp.add_argument("--trigger", default="10 seconds")
        sp.add_argument("--once", action="store_true", help="drain what is there, then stop")

    h = sub.add_parser("hot")
    common(h, ",".join(HOT_TOPICS))
    h.add_argument("--views", required=True)
    h.add_argument("--scope", choices=("batch", "poll"), default="batch")
    h.add_argument("--rank", action="store_true", help="also the running total per subreddit (C14)")
    h.add_argument("--summary", help="folder of the per-subreddit summary (C15)")
    a = sub.add_parser("archive")
    common(a, "reddit_data,youtube_data,twitch_streams,tiktok_data")
    a.add_argument("--lake", required=True)
    a.add_argument("--max-records", type=int, default=1_000_000)
    w = sub.add_parser("warehouse")
    w.add_argument("--lake", required=True)
    w.add_argument("--target", required=True)
    w.add_argument("--checkpoint", required=True)
    w.add_argument("--topics", default=None)
    w.add_argument("--mode", choices=("md5", "uuid"), default="md5")
    w.add_argument("--max-files", type=int, default=1000)
    w.add_argument("--infer", action="store_true", help="infer each topic's schema from its lake files (S4)")
    w.add_argument("--quarantine")
    w.add_argument("--format", default="parquet", help="file format, or a connector (then --target is a table prefix)")
    w.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="writer option")
    n = sub.add_parser("landing")
    n.add_argument("--kind", choices=("reddit", "youtube", "twitch", "chart"), required=True)
    n.add_argument("--input", required=True, help="table of replies, or of chart pages")
    n.add_argument("--input-format", default="parquet")
    n.add_argument("--lookup", help="categories (youtube) or games (twitch) by id")
    n.add_argument("--details", help="detail pages of the chart's sounds")
    n.add_argument("--base", help="base URL of the chart (required for chart)")
    n.add_argument("--out", help="folder for topic=<name> JSON lines")
    n.add_argument("--servers", help="Kafka bootstrap servers, instead of --out")
    return p


def main(argv=None, spark=None) -> None:
    args = parser().parse_args(argv)
    if args.job == "landing":
        needs = {"youtube": "lookup", "twitch": "lookup", "chart": "base"}.get(args.kind)
        if needs and not getattr(args, needs):
            parser().error(f"--{needs} is required for {args.kind}")
    spark = spark or build_session(app=f"trendspark-{args.job}")
    run = {"hot": run_hot, "archive": run_archive, "warehouse": run_warehouse, "landing": run_landing}[args.job]
    queries = run(spark, args)
    if not queries:
        return
    if getattr(args, "once", False):
        for q in queries:
            q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()

"""Serving views: upsert, replace, expiry, one flush, replay."""

import datetime as dt
import pathlib

from pyspark.sql import functions as F

from trendspark.sinks.serving import ServingStore, replace_all, upsert_all

POL = {"r": "replace", "u": "upsert", "t": "upsert"}
TTL = {"t": 86400}


def _rows(spark, view, items):
    return spark.createDataFrame([(view, m, float(s), j) for m, s, j in items],
                                 "view string, member string, score double, json_value string")


def test_upsert_replace_and_replay(spark, tmp_path):
    store = ServingStore(spark, str(tmp_path / "views"), POL, TTL, keep_versions=None)
    t0 = dt.datetime(2025, 1, 1)
    b0 = _rows(spark, "u", [("a", 1, "x"), ("b", 2, "y")]).unionByName(_rows(spark, "r", [("a", 1, None), ("b", 2, None)]))
    store.write_batch(b0, 0, ["u", "r"], t0)
    b1 = _rows(spark, "u", [("b", 5, "z"), ("c", 3, "w")]).unionByName(_rows(spark, "r", [("c", 3, None)]))
    store.write_batch(b1, 1, ["u", "r"], t0)
    up = sorted((r.member, r.score, r.json_value) for r in store.read("u").collect())
    assert up == [("a", 1.0, "x"), ("b", 5.0, "z"), ("c", 3.0, "w")]
    assert [r.member for r in store.read("r").collect()] == ["c"]     # delete-then-fill
    # replaying batch 1 changes nothing
    store.write_batch(b1, 1, ["u", "r"], t0)
    assert sorted((r.member, r.score, r.json_value) for r in store.read("u").collect()) == up
    assert [r.member for r in store.ranked("u", n=2).collect()] == ["b", "c"]
    before = store.versions("u")
    store.compact("u")
    store.vacuum(keep=0)
    assert store.versions("u") == before + 1
    assert sorted((r.member, r.score, r.json_value) for r in store.read("u").collect()) == up
    assert [r.member for r in store.read("r").collect()] == ["c"]
    store.write_batch(b1, 1, ["u", "r"], t0)      # still known as a replay after compaction and vacuum
    assert store.versions("u") == before + 1


def test_compaction_and_vacuum_bound_the_flushes(spark, tmp_path):
    store = ServingStore(spark, str(tmp_path / "views"), POL, TTL, keep_versions=1, compact_every=3)
    for b in range(9):
        store.write_batch(_rows(spark, "u", [(f"m{b}", b, None), ("hot", b, None)]), b, ["u"], dt.datetime(2025, 1, 1))
    assert len(store._flushes()) <= 6
    assert sorted((r.member, r.score) for r in store.read("u").collect()) == \
        sorted([(f"m{b}", float(b)) for b in range(9)] + [("hot", 8.0)])


def test_a_batch_writes_its_own_rows_only(spark, tmp_path):
    store = ServingStore(spark, str(tmp_path / "views"), POL, TTL, keep_versions=None)
    store.write_batch(_rows(spark, "u", [(f"m{i}", i, "x" * 50) for i in range(20000)]), 0, ["u"], dt.datetime(2025, 1, 1))
    store.write_batch(_rows(spark, "u", [("m1", 9, None)]), 1, ["u"], dt.datetime(2025, 1, 1))

    def size(f):
        return sum(p.stat().st_size for p in pathlib.Path(f.path.removeprefix("file:")).rglob("*.parquet"))
    first, second = store._flushes()
    assert size(second) < size(first) / 20
    assert store.read("u").count() == 20000 and store.read("u").where("member = 'm1'").first().score == 9.0


def test_view_level_expiry(spark, tmp_path):
    store = ServingStore(spark, str(tmp_path / "views"), POL, TTL)
    t0 = dt.datetime(2025, 1, 1, 12)
    hours = lambda n: dt.timedelta(hours=n)
    store.write_batch(_rows(spark, "t", [("a", 1, None)]), 0, ["t"], t0)
    store.write_batch(_rows(spark, "t", [("b", 2, None)]), 1, ["t"], t0 + hours(20))
    # the second batch resets the expiry of the whole view, older members included
    alive = sorted(r.member for r in store.read("t", now=t0 + hours(30)).collect())
    assert alive == ["a", "b"]
    assert store.read("t", now=t0 + hours(44)).count() == 0
    assert store.read("t").count() == 0           # the default is the current time
    # 30 h later the view starts from nothing, also after a compaction
    store.write_batch(_rows(spark, "t", [("c", 3, None)]), 2, ["t"], t0 + hours(50))
    store.write_batch(_rows(spark, "t", [("d", 4, None)]), 3, ["t"], t0 + hours(60))
    assert sorted(r.member for r in store.read("t", now=t0 + hours(61)).collect()) == ["c", "d"]
    store.compact("t")
    assert sorted(r.member for r in store.read("t", now=t0 + hours(83)).collect()) == ["c", "d"]
    assert store.read("t", now=t0 + hours(84)).count() == 0


def test_ids_that_start_again_are_new_flushes(spark, tmp_path):
    store = ServingStore(spark, str(tmp_path / "views"), POL, TTL, keep_versions=1)
    t0 = dt.datetime(2025, 1, 1)
    for b in (5, 6, 7):
        store.write_batch(_rows(spark, "r", [(f"old{b}", b, None)]), b, ["r"], t0)
    store.write_batch(_rows(spark, "r", [("fresh", 1, None)]), 0, ["r"], t0)
    assert [r.member for r in store.read("r").collect()] == ["fresh"]
    store.write_batch(_rows(spark, "r", [("other query", 1, None)]), 0, ["r"], t0, run="other")
    assert [r.member for r in store.read("r").collect()] == ["other query"]


def test_an_uncommitted_flush_is_not_read(spark, tmp_path):
    store = ServingStore(spark, str(tmp_path / "views"), POL, TTL)
    store.write_batch(_rows(spark, "r", [("a", 1, None)]), 0, ["r"], dt.datetime(2025, 1, 1))
    store.write_batch(_rows(spark, "r", [("b", 1, None)]), 1, ["r"], dt.datetime(2025, 1, 1))
    last = pathlib.Path(store._flushes()[-1].path.removeprefix("file:"))
    (last / "_SUCCESS").unlink()
    assert [r.member for r in store.read("r").collect()] == ["a"]


def test_folds(spark):
    rows = spark.createDataFrame([
        ("v", "a", 1.0, None, 0), ("v", "a", 2.0, None, 2), ("v", "b", 9.0, None, 1), ("w", "x", 1.0, None, 0),
    ], "view string, member string, score double, json_value string, batch_id long")
    assert sorted((r.view, r.member, r.score) for r in upsert_all(rows).collect()) == \
        [("v", "a", 2.0), ("v", "b", 9.0), ("w", "x", 1.0)]
    assert sorted((r.view, r.member) for r in replace_all(rows).collect()) == [("v", "a"), ("w", "x")]


def test_poll_scope_keeps_a_split_poll_whole(spark, tmp_path):
    from trendspark.plans import hot
    rows = [("u1", "g", "t", 5, "th", "P1"), ("u2", "g", "t", 7, "th", "P1"),
            ("u3", "g", "t", 9, "th", "P1"), ("u1", "g", "t", 4, "th", "P2")]
    df = spark.createDataFrame(rows, "user_name string, game_name string, title string, viewer_count int, "
                                     "thumbnail_url string, fetched_at string")
    b0, b1, b2 = df.where("user_name = 'u1' and fetched_at = 'P1'"), df.where("user_name <> 'u1' and fetched_at = 'P1'"), \
        df.where("fetched_at = 'P2'")
    t = dt.datetime(2025, 1, 1)
    per_batch = ServingStore(spark, str(tmp_path / "a"))
    per_poll = ServingStore(spark, str(tmp_path / "b"), policies=hot.POLL_POLICIES)
    views = ["twitch_streamers_rank", "twitch_streamers_details"]
    for i, b in enumerate([b0, b1]):
        per_batch.write_batch(hot.twitch_streamer_views(b), i, views, t)
        per_poll.write_batch(hot.twitch_streamer_views(b, scope="poll"), i, views, t)
    # the poll P1 came in two micro-batches: per batch shows its tail only
    assert sorted(r.member for r in per_batch.read("twitch_streamers_rank").collect()) == ["u2", "u3"]
    assert sorted(r.member for r in per_poll.read("twitch_streamers_rank").collect()) == ["u1", "u2", "u3"]
    per_poll.write_batch(hot.twitch_streamer_views(b2, scope="poll"), 2, views, t)
    assert [(r.member, r.score) for r in per_poll.read("twitch_streamers_rank").collect()] == [("u1", 4.0)]
    assert per_poll.read("twitch_streamers_details").count() == 3


def test_several_polls_in_one_batch_keep_every_member(spark, tmp_path):
    from trendspark.plans import hot
    rows = [("u1", "g", "t1", 100, "th", "P1"), ("u1", "g", "t2", 50, "th", "P2"), ("u2", "g", "t3", 7, "th", "P2"),
            ("u3", "g", "t4", 9, "th", "P1")]
    df = spark.createDataFrame(rows, "user_name string, game_name string, title string, viewer_count int, "
                                     "thumbnail_url string, fetched_at string")
    store = ServingStore(spark, str(tmp_path / "v"), policies=hot.POLL_POLICIES)
    views = ["twitch_streamers_rank", "twitch_streamers_details"]
    store.write_batch(hot.twitch_streamer_views(df, scope="poll"), 0, views, dt.datetime(2025, 1, 1))
    assert sorted((r.member, r.score) for r in store.read("twitch_streamers_rank").collect()) == [("u1", 50.0), ("u2", 7.0)]
    details = {r.member: r.json_value for r in store.read("twitch_streamers_details").collect()}
    assert '"t2"' in details["u1"] and set(details) == {"u1", "u2", "u3"}


def test_a_poll_of_videos_split_over_batches_is_summed(spark, tmp_path):
    from trendspark.plans import hot
    schema = ("video_id string, title string, channel string, views long, likes long, category string, published_at string, "
              "video_url string, ingestion_timestamp string")
    v = lambda i, views, cat, poll: (i, f"t{i}", "ch", views, 0, cat, "p", "u", poll)
    batches = [[v("1", 5, "A", "P1"), v("2", 3, "B", "P1")], [v("3", 4, "A", "P1"), v("1", 2, "A", "P2")], [v("4", 6, "A", "P2")]]
    store = ServingStore(spark, str(tmp_path / "v"), policies=hot.POLL_POLICIES)
    views = ["youtube_category_views", "youtube_category_top_video"]
    now = dt.datetime(2025, 1, 1)
    for i, b in enumerate(batches[:2]):
        store.write_batch(hot.youtube_views(spark.createDataFrame(b, schema), scope="poll"), i, views, now)
    assert {r.member: r.score for r in store.read(views[0], now).collect()} == {"A": 2.0, "B": 3.0}
    store.write_batch(hot.youtube_views(spark.createDataFrame(batches[2], schema), scope="poll"), 2, views, now)
    assert {r.member: r.score for r in store.read(views[0], now).collect()} == {"A": 8.0, "B": 3.0}
    assert '"t4"' in {r.member: r.json_value for r in store.read(views[1], now).collect()}["A"]


def test_a_listing_passes_over_a_flush_that_a_vacuum_takes_meanwhile(spark, tmp_path, monkeypatch):
    import shutil
    from trendspark.sinks import serving
    store = ServingStore(spark, str(tmp_path / "v"), policies={"x": "upsert"}, ttl={})
    rows_ = spark.createDataFrame([("x", "m", 1.0, None)], "view string, member string, score double, json_value string")
    for b in range(3):
        store.write_batch(rows_, b, ["x"], run="r")
    real, gone = serving.list_folder, []

    def vanishing(spark, path):
        if not gone:
            gone.append(path)
            shutil.rmtree(path.removeprefix("file:"))
        return real(spark, path)
    monkeypatch.setattr(serving, "list_folder", vanishing)
    assert [f.number for f in store._flushes()] == [1, 2]

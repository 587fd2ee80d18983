"""Batches that survive failures and new checkpoints (T8, K1, K13, K14), and the one-pass archive."""

import pytest
from pyspark.sql import functions as F

from trendspark.functions.records import to_json_value
from trendspark.session import read_table
from trendspark.sinks import batches, tables
from trendspark.sinks.lake import routed_rows
from trendspark.sinks.publish import publish
from trendspark.sinks.tables import WarehouseSink, read_snapshot, write_batch_partition, write_snapshot
from trendspark.sources import standins
from trendspark.sources.topics import text_stream, topics_stream
from trendspark.streaming import archive, warehouse as wh

from conftest import SF_SMALL, rows

#: A parquet writer under a name that the sink takes for a connector's.
CONNECTOR = "org.apache.spark.sql.execution.datasources.parquet.ParquetFileFormat"
LINE = '{"subreddit": "%s", "score": %d, "num_comments": 1, "title": "t%d", "url": "u%d", "post_timestamp": "p", "ingested_at": "2025-01-01T00:00:00.%06d"}'


def lake_files(folder, files, per_file=5, bad=True):
    day = folder / "topic=reddit_data/year=2025/month=01/day=01"
    day.mkdir(parents=True, exist_ok=True)
    for f in files:
        lines = [LINE % (f"sub{(f + i) % 7}", i, f * 100 + i, f * 100 + i, i) for i in range(per_file)]
        (day / f"f{f}.json").write_text("\n".join(lines + ([f"garbage {f}"] if bad else [])))


def facts(sink):
    return sorted(r.post_sk for r in sink.read("Fact_Redit_Activity").collect())


@pytest.mark.parametrize("mode", ["md5", "uuid"])
def test_a_new_checkpoint_neither_loses_nor_doubles_facts(spark, tmp_path, mode):
    lake, target = tmp_path / "lake", str(tmp_path / "wh")
    lake_files(lake, range(6))
    quarantine = str(tmp_path / "bad")
    wh.run_all(spark, str(lake), target, str(tmp_path / "ck1"), topics=("reddit_data",), max_files_per_trigger=2, quarantine=quarantine, mode=mode)
    sink = wh.warehouse_sink(spark, target)
    before = facts(sink)
    assert len(before) == len(set(before)) == 30
    # the checkpoint is lost, two files are new, and batches are cut differently
    lake_files(lake, range(6, 8))
    wh.run_all(spark, str(lake), target, str(tmp_path / "ck2"), topics=("reddit_data",), max_files_per_trigger=3, quarantine=quarantine, mode=mode)
    after = facts(sink)
    assert len(after) == len(set(after)) == 40 and set(before) <= set(after)
    assert sink.read("Dim_Post").count() == 40
    assert sink.read("Dim_Subreddit").count() == 7      # random keys hold over batches and runs, too
    assert sink.read("Fact_Redit_Activity").join(sink.read("Dim_Subreddit"), "subreddit_sk").count() == 40
    bad = spark.read.parquet(f"{quarantine}/reddit_data")
    assert sorted(r.raw_value for r in bad.collect()) == sorted(f"garbage {f}" for f in range(8))


def test_a_failed_batch_is_invisible_and_written_anew(spark, tmp_path, monkeypatch):
    lake, target, ck = tmp_path / "lake", str(tmp_path / "wh"), str(tmp_path / "ck")
    lake_files(lake, range(4))
    sink = wh.warehouse_sink(spark, target)
    seen = []

    def put(self, df, table, batch_id, attempt, real=WarehouseSink._put):
        n = real(self, df, table, batch_id, attempt)
        if batch_id == 1:
            # a reader between the writes sees none of the batch: dimension and facts agree
            fact = sink.read("Fact_Redit_Activity")
            seen.append((table, fact.count(), sink.read("Dim_Post").count()))
            if table.startswith("Fact"):
                raise RuntimeError("executor lost for good")
        return n
    monkeypatch.setattr(WarehouseSink, "_put", put)
    with pytest.raises(Exception):
        wh.run_all(spark, str(lake), target, ck, topics=("reddit_data",), max_files_per_trigger=2)
    assert len(seen) >= 2 and {(a, b) for _, a, b in seen} == {(10, 10)}
    assert len(facts(sink)) == 10
    monkeypatch.undo()
    wh.run_all(spark, str(lake), target, ck, topics=("reddit_data",), max_files_per_trigger=2)
    assert len(set(facts(sink))) == len(facts(sink)) == 20


def test_a_committed_batch_is_not_written_again(spark, tmp_path):
    sink = WarehouseSink(spark, str(tmp_path / "wh"), run="r1")
    df = spark.createDataFrame([("k1", 1), ("k2", 2)], "k string, v int")
    keys = {"Dim": "k"}
    assert sink.write({"Dim": df, "Fact": df}, keys, 0) == {"Dim": 2, "Fact": 2}
    assert sink.write({"Dim": df, "Fact": df}, keys, 0) == {}
    assert sink.write({"Dim": df, "Fact": df}, keys, 1) == {"Dim": 0, "Fact": 2}
    other = WarehouseSink(spark, str(tmp_path / "wh"), run="r2")
    assert other.write({"Dim": df, "Fact": df}, keys, 0) == {"Dim": 0, "Fact": 2}
    assert sink.read("Fact").count() == 6 and sink.read("Dim").count() == 2
    assert batches.FileMarks(spark, str(tmp_path / "wh")).committed() == {"r1": 1, "r2": 0}


def test_batches_of_two_runs_stay_apart(spark, tmp_path):
    path = str(tmp_path / "bad")
    for run, n in (("a", 5), ("b", 3), ("a", 4)):      # the last one is a replay
        write_batch_partition(spark.range(n), path, 0, run=run)
    assert spark.read.parquet(path).groupBy("run").count().orderBy("run").collect() == [("a", 4), ("b", 3)]


def test_a_connector_target_is_not_doubled_by_a_replay(spark, tmp_path, monkeypatch):
    lake, target, ck = tmp_path / "lake", f"{tmp_path}/t_", str(tmp_path / "ck")
    lake_files(lake, range(4))

    def load(checkpoint=ck, files=2):
        wh.run_all(spark, str(lake), target, checkpoint, topics=("reddit_data",), max_files_per_trigger=files, fmt=CONNECTOR, table_option="path")
    commit, failed = batches.TableMarks.commit, []

    def once(self, run, batch_id, attempt):
        if batch_id == 1 and not failed:
            failed.append(attempt)
            raise RuntimeError("lost after the write")
        commit(self, run, batch_id, attempt)
    monkeypatch.setattr(batches.TableMarks, "commit", once)
    with pytest.raises(Exception):
        load()
    sink = wh.warehouse_sink(spark, target, CONNECTOR, None, "path")
    assert failed and len(facts(sink)) == 10
    assert spark.read.parquet(f"{target}Fact_Redit_Activity").count() == 20      # the failed attempt's rows are there, seen by none
    load()
    assert len(set(facts(sink))) == len(facts(sink)) == 20
    assert sink.read("Dim_Subreddit").count() == 7 and sink.read("Dim_Post").count() == 20
    # a new checkpoint
    lake_files(lake, range(4, 5))
    load(str(tmp_path / "ck2"), 3)
    assert len(set(facts(sink))) == len(facts(sink)) == 25
    assert spark.read.parquet(f"{target}Dim_Platform").count() == 4


def test_snapshot_readers_finish_after_overwrites(spark, tmp_path):
    path = str(tmp_path / "s")
    assert read_snapshot(spark, path) is None
    assert write_snapshot(spark.range(10), path) == 0
    held = read_snapshot(spark, path)
    for n in (20, 30):
        write_snapshot(spark.range(n), path)
    assert held.count() == 10 and read_snapshot(spark, path).count() == 30
    # a write that was cut off before its mark is not seen, and its number not used again
    spark.range(7).write.parquet(f"{path}/snapshot=3")
    assert read_snapshot(spark, path).count() == 30
    assert write_snapshot(spark.range(40), path) == 4 and read_snapshot(spark, path).count() == 40
    for _ in range(6):
        write_snapshot(spark.range(1), path)
    assert len(tables.list_folder(spark, path)) == 5      # four snapshots and the marks


# ---- the archive -----------------------------------------------------------


def _mixed(spark):
    good = [("reddit_data", '{"subreddit": "a", "n": %d}' % i, f"2025-01-0{1 + i % 3} 00:00:00") for i in range(30)]
    good += [("twitch_streams", '{"user_name": "u%d"}' % i, "2025-01-02 00:00:00") for i in range(10)]
    bad = [("reddit_data", "garbage", None), ("twitch_streams", '{"a":1} {"b":2}', "2025-01-01 00:00:00")]
    return spark.createDataFrame(good + bad, "topic string, value string, at string")


def _lake(spark, folder):
    df = spark.read.option("basePath", folder).text(folder)
    return sorted((r.topic, r.day, r.value) for r in df.collect())


def test_an_archived_batch_that_comes_again_lands_once(spark, tmp_path, monkeypatch):
    df = _mixed(spark)
    routed = routed_rows(df, F.col("at").cast("timestamp_ntz"))
    once, twice = str(tmp_path / "one"), str(tmp_path / "two")
    assert archive.archive_batch(routed, 3, once, f"{once}_bad") == 6       # three days of one topic, one of the other, rejects of both
    real, calls = archive.file_system, []

    def failing(spark, path):
        if path.startswith(f"{twice}/topic=") and "batch=" in path:
            calls.append(path)
            if len(calls) == 3:
                raise OSError("driver lost")
        return real(spark, path)
    monkeypatch.setattr(archive, "file_system", failing)
    with pytest.raises(OSError):
        archive.archive_batch(routed, 3, twice, f"{twice}_bad")
    monkeypatch.undo()
    assert 0 < len(_lake(spark, twice)) < 40
    archive.archive_batch(routed, 3, twice, f"{twice}_bad")
    assert archive.archive_batch(routed, 3, twice, f"{twice}_bad") == 0
    assert _lake(spark, twice) == _lake(spark, once) and len(_lake(spark, once)) == 40
    assert rows(spark.read.schema("topic string, value string").json(f"{twice}_bad/*/*")) == [("reddit_data", "garbage"), ("twitch_streams", '{"a":1} {"b":2}')]
    archive.archive_batch(routed, 4, twice, f"{twice}_bad")      # another batch with the same records
    assert len(_lake(spark, twice)) == 80


def test_archive_reads_each_record_once_and_loads_read_their_topic_only(spark, tmp_path):
    ev = read_table(spark, SF_SMALL, "events")
    topics = ["reddit_data", "twitch_streams"]
    landing, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    posts, streams = standins.reddit_posts(ev).drop("ingested_at"), standins.twitch_streams(ev.where("event_id % 3 = 0")).drop("ingested_at")
    publish(posts, topics[0], path=landing)
    publish(streams, topics[1], path=landing)
    spark.createDataFrame([("garbage",)] * 5, "value string").write.mode("append").text(f"{landing}/topic=reddit_data")
    started = archive.start_archive(topics_stream(spark, landing, topics), lake, topics, str(tmp_path / "ck"), trigger={"availableNow": True})
    started.awaitTermination()
    progress = [p for q in started for p in q.recentProgress]
    assert len(started) == 1 and all(len(p.sources) == 1 for p in progress)
    assert sum(p.numInputRows for p in progress) == posts.count() + streams.count() + 5
    assert spark.read.json(str(tmp_path / "ck_quarantine")).count() == 5
    for topic, n in zip(topics, (posts.count(), streams.count())):
        q = wh.start_load(spark, lake, topic, str(tmp_path / "wh"), str(tmp_path / f"ck_{topic}"))
        q.awaitTermination()
        assert sum(p.numInputRows for p in q.recentProgress) == n


def test_an_archive_has_files_by_day_and_not_by_task(spark, tmp_path):
    """A load cuts its batches by files: 16 tasks that each hold records of 5 days made 80 files."""
    posts = spark.range(0, 4000, 1, 16).select(F.lit("reddit_data").alias("topic"), F.format_string('{"subreddit": "s[%d]"}', "id").alias("value"),
                                               F.timestamp_add("DAY", F.col("id") % 5, F.lit("2025-01-01").cast("timestamp_ntz")).alias("at"))
    lake = str(tmp_path / "lake")
    assert archive.archive_batch(routed_rows(posts, F.col("at")), 0, lake, str(tmp_path / "bad")) == 5
    files = [p for p in (tmp_path / "lake").rglob("part-*")]
    assert 5 <= len(files) <= 10 and len({r[2] for r in _lake(spark, lake)}) == 4000


def test_a_record_that_ends_its_check_early_is_no_record(spark):
    texts = ['{"a":"]"}', '{"a":1}],[{"b":2}', '{"a":1}},{"b":{}', '{"a":1},{"b":2}', '\t{ } ', '{"a":[1,{"b":"}"}]} ', '[{"a":1}]', "{}]", '"]"', "{"]
    raw = spark.createDataFrame([("t", t) for t in texts], "topic string, value string")
    got = {r.value for r in routed_rows(raw, F.lit("2025-01-02").cast("timestamp_ntz")).where("kind = 'lake'").collect()}
    stamp = '"ingested_at": "2025-01-02T00:00:00.000000"}'
    assert got == {'{"a":"]", ' + stamp, "{" + stamp, '{"a":[1,{"b":"}"}], ' + stamp}


def test_records_without_a_route_time_get_the_processing_time(spark):
    raw = spark.createDataFrame([("t", "{}", None), ("t", '{"ingested_at": "old", "x": 1.50}', "2025-01-02 03:04:05")], "topic string, value string, at string")
    got = {r.year: r.value for r in routed_rows(raw, F.col("at").cast("timestamp_ntz")).where("kind = 'lake'").collect()}
    assert len(got) == 2 and '"ingested_at":"2025-01-02T03:04:05.000000"' in got["2025"] and '"old"' not in got["2025"]


def test_a_text_archive_stream_resumes_from_its_checkpoint(spark, tmp_path):
    src, lake, ck = str(tmp_path / "in"), str(tmp_path / "lake"), str(tmp_path / "ck")
    posts = standins.reddit_posts(read_table(spark, SF_SMALL, "events")).drop("ingested_at")
    for k in range(2):
        to_json_value(posts.where(F.pmod(F.xxhash64("url"), F.lit(2)) == k)).write.mode("append").text(src)
        for _ in range(2):       # the second run finds nothing new
            archive.start_archive(text_stream(spark, src), lake, "reddit_data", ck, trigger={"availableNow": True}).awaitTermination()
    assert spark.read.text(f"{lake}/topic=reddit_data").count() == posts.count()


def _counted(spark):
    """A text as it is, and how often it has been made."""
    made = spark.sparkContext.accumulator(0)

    def same(v):
        made.add(1)
        return v
    return F.udf(same, "string").asNondeterministic(), made


def test_drops_are_written_in_one_pass_and_land_one_after_another(spark, tmp_path):
    from trendspark import catalog
    same, made = _counted(spark)
    values = spark.range(0, 60, 1, 3).select(same(F.format_string('{"n": %d}', "id")).alias("value"))
    seen = []

    class Drained:
        def __init__(self, raw):
            pass

        def awaitTermination(self):
            seen.append(sorted(r.value for r in spark.read.text(f"{tmp_path}/in").collect()))
    catalog._drain_drops(spark, str(tmp_path), values, Drained, drops=2)
    assert made.value == 60
    assert 0 < len(seen[0]) < 60 and set(seen[0]) < set(seen[1]) and seen[1] == sorted('{"n": %d}' % i for i in range(60))


def test_a_drop_without_records_lands_too(spark, tmp_path):
    from trendspark import catalog
    landed = []

    class Drained:
        def __init__(self, raw):
            landed.append(sorted(p.name for p in (tmp_path / "in").iterdir() if p.is_dir()))

        def awaitTermination(self):
            pass
    catalog._drain_drops(spark, str(tmp_path), spark.createDataFrame([("{}",)], "value string"), Drained, drops=3)
    assert landed == [["drop=0"], ["drop=0", "drop=1"], ["drop=0", "drop=1", "drop=2"]]
    assert [r.value for r in spark.read.text(f"{tmp_path}/in").collect()] == ["{}"]


def test_a_field_that_does_not_parse_makes_no_record(spark):
    """A parse that takes a field forgives what is broken in it, so a text that may name the stamp is read whole."""
    texts = ['{"ingested_at":[1 2]}', '{"ingested\\u005fat":"x","b":1.25}', '{"a":[1 2]}', '{"a":"\\\\","b":{"c" 1}}', '{"a":"\\n", "b":2 }', '{"a":1}x']
    raw = spark.createDataFrame([("t", t) for t in texts], "topic string, value string")
    got = {r.value for r in routed_rows(raw, F.lit("2025-01-02").cast("timestamp_ntz")).where("kind = 'lake'").collect()}
    assert got == {'{"b":1.25,"ingested_at":"2025-01-02T00:00:00.000000"}', '{"a":"\\n", "b":2, "ingested_at": "2025-01-02T00:00:00.000000"}'}


def test_a_load_fills_a_batch_by_all_tasks_at_once(spark, tmp_path):
    """A look for a first reject read the batch by one task, then by four, and so on."""
    lake_files(tmp_path / "lake", range(12), bad=False)
    real, looked = type(spark.range(0)).isEmpty, []
    from pytest import MonkeyPatch
    with MonkeyPatch.context() as m:
        m.setattr(type(spark.range(0)), "isEmpty", lambda self: looked.append(1) or real(self))
        wh.run_all(spark, str(tmp_path / "lake"), str(tmp_path / "wh"), str(tmp_path / "ck"), topics=("reddit_data",))
    assert not looked and len(facts(wh.warehouse_sink(spark, str(tmp_path / "wh")))) == 60


def test_a_changing_dimension_is_made_once_a_batch(spark, tmp_path):
    """New rows and changed ones were told apart by two joins, each of which made the batch's rows anew."""
    same, made = _counted(spark)
    sink = WarehouseSink(spark, str(tmp_path / "w"), changing={"D": ["_seen", "name"]}, run="r")

    def dim(*rows_):
        df = spark.createDataFrame(list(rows_), "sk string, _seen int, name string")
        return {"D": df.withColumn("name", same("name"))}
    sink.write(dim(("a", 1, "a1"), ("b", 1, "b1"), ("c", 5, "c5"), (None, 1, "x")), {"D": "sk"}, 0)
    made.value = 0
    sink.write(dim(("a", 2, "a2"), ("b", 1, "b1"), ("c", 4, "c9"), ("d", 1, "d1"), (None, 2, "x")), {"D": "sk"}, 1)
    assert made.value <= 5
    sink.write(dim(("a", 2, "a1"), ("b", 1, "b2"), ("d", 0, "d9"), ("e", 1, None)), {"D": "sk"}, 2)
    assert rows(sink._existing("D").select("sk", "name").where("sk <> 'e'")) == [("a", "a1"), ("b", "b1"), ("c", "c5"), ("d", "d1")]
    assert sorted(tuple(r) for r in sink._existing("D_changes").select("sk", "name").collect()) == [("a", "a2"), ("b", "b2")]
    assert {(r.sk, r.name) for r in sink.read("D", {"D": "sk"}).select("sk", "name").collect()} == {("a", "a2"), ("b", "b2"), ("c", "c5"), ("d", "d1"), ("e", None)}

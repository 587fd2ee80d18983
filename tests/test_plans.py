"""Plan shapes the scale design relies on (checked on the executed plans)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from trendspark.sinks.serving import ServingStore, upsert_all
from conftest import SF_SMALL


def _plan(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    df.collect()
    # the final adaptive plan only (the string also holds the initial one)
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_top1_is_partially_aggregated_and_parses_once(spark):
    plan = _plan(spark, "best_row_per_key")
    assert "partial_max(struct(score" in plan          # map-side combine before the shuffle
    assert "Window" not in plan
    assert plan.count("from_json(") == 1                # the key filter does not re-parse


def test_md5_fact_needs_no_join_or_key_shuffle(spark):
    plan = _plan(spark, "fact_post")
    assert "Join" not in plan
    assert "Exchange" not in plan


def test_no_job_runs_while_a_plan_is_built(spark):
    for name in ("lookup_default", "serving_replace", "chart_records_with_links", "twitch_stream_replies", "fact_post"):
        E.queries()[name](spark, SF_SMALL)            # the footers of its tables are read now
        spark.sparkContext.setJobGroup(name, name)
        E.queries()[name](spark, SF_SMALL)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(name)
        spark.sparkContext.setJobGroup("none", "none")
        stages = [s for j in jobs for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds]
        tables = {"lookup_default": 2, "serving_replace": 1, "chart_records_with_links": 3, "twitch_stream_replies": 2, "fact_post": 1}
        # one footer read for each table that it opens
        assert len(jobs) <= tables[name] and len(stages) <= tables[name], name


def test_small_lookup_is_broadcast(spark):
    assert "BroadcastHashJoin" in _plan(spark, "lookup_default")


def test_top_k_keeps_k_per_task(spark):
    assert "TakeOrderedAndProject" in _plan(spark, "source_top50")


def test_two_views_from_one_aggregate(spark):
    plan = _plan(spark, "youtube_views")
    assert plan.count("partial_sum(views") == 1 and "Union" not in plan


@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_fold_equals_sequential_writes(spark, tmp_path, seed):
    rnd = random.Random(seed)
    batches = [[(f"m{rnd.randint(0, 6)}", float(rnd.randint(0, 9)), rnd.choice(["a", "b", None]))
                for _ in range(rnd.randint(1, 6))] for _ in range(4)]
    store = ServingStore(spark, str(tmp_path / "v"), {"u": "upsert"}, {})
    all_rows = []
    for b, rows in enumerate(batches):
        df = spark.createDataFrame([("u", *r) for r in rows], "view string, member string, score double, json_value string")
        store.write_batch(df, b, ["u"], dt.datetime(2025, 1, 1))
        all_rows += [("u", *r, b) for r in rows]
    folded = upsert_all(spark.createDataFrame(all_rows, "view string, member string, score double, "
                                                        "json_value string, batch_id long"))
    got = sorted((r.member, r.score, r.json_value) for r in store.read("u").collect())
    want = sorted((r.member, r.score, r.json_value) for r in folded.collect())
    assert got == want

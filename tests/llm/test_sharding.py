import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from trendspark.llm import sharding as S

from .helpers import frame, odd_rows, words


def check(rows, out, shards):
    assert len(out) == len(rows)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in out), key=repr) == sorted(
        ((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    slots, of_text, load = defaultdict(list), defaultdict(set), defaultdict(int)
    for r in out:
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
        of_text[r.text_crc32, r.size].add(r.shard)
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and all(len(x) == 1 for x in of_text.values())
    return [load[k] for k in range(shards)]


def test_odd_rows(spark):
    rows = odd_rows()
    check(rows, S.shard_documents(frame(spark, rows, clash=True), 4).collect(), 4)
    assert S.shard_documents(frame(spark, []), 4).count() == 0


def test_near_equal_bytes_with_a_heavy_group(spark):
    rows = [(i, words(20 + i % 90, i)) for i in range(900)] + [(2000 + i, words(40, 5000)) for i in range(450)]
    load = check(rows, S.shard_documents(frame(spark, rows), 8, most_bins=64).collect(), 8)
    heavy = 450 * (len(words(40, 5000).encode()) + 16)
    rest = sorted(load)[:-1] if heavy > sum(load) / 8 else load
    assert max(load) <= max(heavy, sum(load) / 8) * 1.02 and max(rest) - min(rest) <= 0.02 * max(rest)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 1000), max_size=60), st.integers(1, 7))
def test_differencing_assigns_every_item(loads, ways):
    part = S.difference(loads, ways)
    assert len(part) == len(loads) and all(0 <= p < ways for p in part)
    sums = [sum(x for x, p in zip(loads, part) if p == k) for k in range(ways)]
    if loads:
        assert max(sums) - min(sums) <= max(loads)


@pytest.mark.parametrize("partitions", [1, 4, 12, 200])
def test_forty_shards_are_equal_at_any_number_of_partitions(spark, partitions):
    sizes = np.random.default_rng(3).lognormal(6, 1, 6000).astype(int)
    rows = [(i, f"{i} " + "x" * n) for i, n in enumerate(sizes.tolist())]
    rows += [(7000 + i, "y" * 1000) for i in range(40)]  # a group of about half a shard
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for most_bins in (16_384, 2048):
            load = check(rows, S.shard_documents(frame(spark, rows), most_bins=most_bins).collect(), 40)
            assert max(load) <= 1.002 * min(load)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("tasks, each, heavy", [(1, 100_000, 0), (6, 50_000, 3), (12, 5_000, 3), (211, 300, 3), (1000, 50, 3)])
def test_bins_of_tasks_make_equal_shards(tasks, each, heavy):
    rng = np.random.default_rng(tasks)
    singles = max(1, 16_384 // (2 * tasks))
    ways = max(40, min(1024, singles))
    bins = []
    for task in range(tasks):
        loads = rng.lognormal(8, 1, each).astype(np.int64)
        if task < heavy:  # half a shard
            loads[0] = tasks * each * 4915 // 80
        loads = np.sort(loads)[::-1]
        part = S.binned_groups(loads, singles, ways)
        assert part.min() >= 0 and part.max() < max(singles + ways, 1)
        bins += [x for x in np.bincount(part, loads).astype(np.int64).tolist() if x]
    part = S.difference(bins, 40)
    shards = np.bincount(part, bins, 40)
    assert shards.max() <= 1.002 * shards.min()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=1, max_size=60), st.lists(st.integers(0, 5000), min_size=2, max_size=7))
def test_differencing_goes_on_from_what_parts_hold(loads, held):
    part = S.difference(loads, len(held), np.array(held))
    sums = [h + sum(x for x, p in zip(loads, part) if p == k) for k, h in enumerate(held)]
    assert max(sums) - min(sums) <= max(max(loads), max(held) - min(held))

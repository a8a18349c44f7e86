import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF001
from test_log_analytics import log

from bucketlens.operators import heavy_hitters as hh
from bucketlens.operators import log_analytics as la
from bucketlens.operators import runtime_filter as rf
from bucketlens.operators.parse import parse_access_log
from bucketlens.plans import fixtures as fx
from bucketlens.plans.explain import plan_text


def test_filter_keeps_every_key_and_few_others(spark):
    keys = spark.range(0, 3000, 3).selectExpr("'k' || id AS name", "id")
    rows = spark.range(0, 30000).selectExpr("'k' || id AS name", "id", "1 AS _kf_cells")
    found = rf.key_filter(keys, ["name", "id"])
    got = found.apply(rows, ["name", "id"])
    assert found.n_keys == 1000 and got.columns == rows.columns
    ids = {r.id for r in got.collect()}
    assert set(range(0, 3000, 3)) <= ids and len(ids) < 1000 + 0.03 * 30000


def test_filter_is_bounded_and_still_right(spark, monkeypatch):
    monkeypatch.setattr(rf, "MOST_CELLS", 2)
    keys = spark.range(1000).selectExpr("'k' || id AS _name")
    found = rf.key_filter(keys, ["_name"])
    assert found.cells.count() <= 4 and found.cell_bits == 2
    df = spark.range(2000).selectExpr("'k' || id AS bucket_name")
    assert rf.AllowList(keys, found).keep(df).count() == 1000


def test_filter_of_no_keys(spark):
    keys = spark.createDataFrame([], "bucket_name string")
    rows = spark.createDataFrame([("a",), (None,)], "bucket_name string")
    assert rf.key_filter(keys, ["bucket_name"]).apply(rows, ["bucket_name"]).collect() == []
    assert rf.prepare_allow_list(keys).keep(rows).collect() == []


@pytest.mark.parametrize("limit", [100_000, 10])
def test_allow_list_both_ways(spark, limit):
    rnd = random.Random(1)
    df = log(spark, [(rnd.choice([f"b{i}" for i in range(60)] + [None]), f"k{i % 7}", i, f"1.1.1.{i % 50}", 0, False) for i in range(600)])
    names = spark.createDataFrame([(f"b{i}",) for i in range(0, 90, 2)] * 2 + [(None,)], "bucket_name string")
    allow = rf.prepare_allow_list(names, broadcast_max_rows=limit)
    assert (allow.filter is None) == (limit > 10)
    chosen = [f"b{i}" for i in range(0, 90, 2)]
    for op in (la.hits_per_object, la.top_objects_per_bucket, la.hits_per_ip, la.running_percentage):
        assert sorted(op(df, buckets=allow).collect(), key=str) == sorted(op(df, buckets=chosen).collect(), key=str)


def test_allow_list_filters_before_the_shuffle(spark):
    log_rows = parse_access_log(fx.raw_lines(spark, SF001))
    names = spark.range(2000).selectExpr("'bkt-view-' || id AS bucket_name")
    allow = rf.prepare_allow_list(names, broadcast_max_rows=100)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")  # the exact join shuffles, as with a list too long for a broadcast
    try:
        out = la.hits_per_object(log_rows, buckets=allow)
        rows = out.collect()
        text = plan_text(out).split("Initial Plan")[0]
        # the bounded cells are still sent to the scan, below the first exchange of the log
        assert "BroadcastHashJoin Inner" in text and "SortMergeJoin LeftSemi" in text
        shuffled = allow.keep(la.good_rows(log_rows)).count()
        assert rows and shuffled < 0.35 * log_rows.count()
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("limit", [200_000, 2])
def test_prepared_top_sizes_match_a_window(spark, limit):
    rnd = random.Random(11)
    rows = [("hot", "big", 900, None, 0, False)] * 400
    rows += [(rnd.choice(["hot", "a", "b", None]), f"k{i}", rnd.choice([0, 5, 9, 900, 17, 3, None]), None, 0, False) for i in range(800)]
    rows += [("a", "bad", 5000, None, 0, True)]
    df = log(spark, rows)
    w = Window.partitionBy("bucket_name").orderBy(F.desc("object_size"))
    ref = la.good_rows(df).select("bucket_name", "key", "object_size").withColumn("rank", F.dense_rank().over(w))
    for n in (1, 3, 50):
        sizes = la.prepare_top_sizes(df, n, broadcast_max_rows=limit)
        assert (sizes.filter is None) == (limit > 2)
        got = la.top_objects_per_bucket(df, n=n, sizes=sizes)
        assert got.columns == ["bucket_name", "key", "object_size", "rank"]
        assert sorted(got.collect(), key=str) == sorted(ref.where(F.col("rank") <= n).collect(), key=str)
    with pytest.raises(ValueError):
        la.top_objects_per_bucket(df, n=2, sizes=sizes)


def test_prepared_top_sizes_shuffle_no_row_of_the_log(spark):
    log_rows = parse_access_log(fx.raw_lines(spark, SF001))
    sizes = la.prepare_top_sizes(log_rows, 3)
    text = plan_text(la.top_objects_per_bucket(log_rows, n=3, sizes=sizes))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    allow = ["bkt-error-0"]
    chosen = la.prepare_top_sizes(log_rows, 3, buckets=allow)
    got = la.top_objects_per_bucket(log_rows, n=3, buckets=allow, sizes=chosen)
    assert sorted(got.collect()) == sorted(la.top_objects_per_bucket(log_rows, n=3, buckets=allow).collect())


def exact(rows, n):
    counts = {}
    for r in rows:
        if r is not None:
            counts[r] = counts.get(r, 0) + 1
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:n]


@pytest.mark.parametrize("k", [3, 20, 4096])
def test_sketch_equals_the_exact_answer(spark, k):
    rnd = random.Random(5)
    rows = [f"10.0.0.{min(int(rnd.paretovariate(0.6)), 250)}" for _ in range(3000)] + [None] * 50 + ["10.0.9.9"] * 900
    df = spark.createDataFrame([(r,) for r in rows], "ip_address string").repartition(4)
    for n in (1, 3, 10, 400):
        assert [tuple(r) for r in hh.top_values(df, "ip_address", n, k=k).collect()] == exact(rows, n)
    seen = hh.candidates(df, "ip_address", 3, k=20)
    assert seen.values is not None and seen.error <= len(rows) / 21


def test_sketch_falls_back_when_it_cannot_decide(spark):
    rows = [f"v{i % 500}" for i in range(5000)]  # all equally frequent
    df = spark.createDataFrame([(r,) for r in rows], "v string").repartition(3)
    assert hh.candidates(df, "v", 5, k=10).values is None
    assert hh.candidates(df, "v", 5, k=4096, max_candidates=100).values is None
    for kw in ({"k": 10}, {"k": 4096, "max_candidates": 100}, {}):
        assert [tuple(r) for r in hh.top_values(df, "v", 5, **kw).collect()] == exact(rows, 5)
    assert hh.top_values(df.where("false"), "v", 5).collect() == []


def test_second_scan_counts_candidates_only(spark):
    rows = ["hot"] * 500 + [f"v{i}" for i in range(500)]
    df = spark.createDataFrame([(r,) for r in rows], "v string").repartition(2)
    assert hh.candidates(df, "v", 1, k=8).values == ["hot"]
    assert "LeftSemi" in plan_text(hh.top_values(df, "v", 1, k=8))


def test_top_ips_by_sketch(spark):
    log_rows = parse_access_log(fx.raw_lines(spark, SF001))
    assert la.top_ips(log_rows, 7, sketch=True).collect() == la.top_ips(log_rows, 7).collect()

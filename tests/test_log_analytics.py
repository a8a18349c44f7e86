import random

import pytest
from conftest import SF001
from pyspark.sql import Window
from pyspark.sql import functions as F

from bucketlens.operators import log_analytics as la
from bucketlens.operators.parse import parse_access_log
from bucketlens.plans import catalog
from bucketlens.plans import fixtures as fx
from bucketlens.plans.explain import plan_text, uses_python

SCHEMA = "bucket_name string, key string, object_size bigint, ip_address string, bytes_sent bigint, is_malformed boolean"


def log(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_running_percentage_example(spark):
    df = log(spark, [("b", "k", s, None, 0, False) for s in (0, 10, 10, 30)] + [("b", "x", 99, None, 0, True)])
    got = sorted((r.object_size, r.running_percentage) for r in la.running_percentage(df).collect())
    assert got[0] == (0, None)
    assert got[1] == got[2] == (10, 200.0)
    assert got[3][0] == 30 and got[3][1] == pytest.approx(166.6666667)


def test_running_sum_matches_range_window_on_wide_sizes(spark):
    rnd = random.Random(7)
    sizes = [rnd.choice([0, 1, 5, (1 << 21) - 1, 1 << 21, 70000, 1 << 42, (1 << 42) + 5, (1 << 49) + 3, (1 << 62) + 1, rnd.randrange(1 << 40)])
             for _ in range(600)]
    rows = [(rnd.choice("abc"), "k", s, None, 0, False) for s in sizes]
    df = log(spark, rows).select("bucket_name", "object_size")
    counts = la._size_counts(df, "bucket_name", "object_size")
    ours = la._prefix_sums(counts, "bucket_name", "object_size").select("bucket_name", "object_size", "running_sum")
    w = Window.partitionBy("bucket_name").orderBy("object_size").rangeBetween(Window.unboundedPreceding, 0)
    exact = F.sum(F.col("object_size").cast("decimal(38,0)")).over(w).cast("decimal(38,0)")
    ref = df.withColumn("running_sum", exact).distinct()
    assert sorted(ours.collect()) == sorted(ref.collect())
    # one output row per input row
    assert la.running_percentage(log(spark, rows)).count() == len(rows)


def test_repeat_rows_spreads_large_counts(spark):
    df = spark.createDataFrame([("hot", 200_001), ("cold", 1)], "k string, _c bigint")
    out = la._repeat_rows(df, "_c", ["k"])
    assert {r.k: r["count"] for r in out.groupBy("k").count().collect()} == {"hot": 200_001, "cold": 1}
    per_task = out.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) >= 2


def test_bucket_share(spark):
    df = log(spark, [("b", "k", s, None, 0, False) for s in (10, 30)] + [("z", "k", 0, None, 0, False)])
    got = sorted((r.bucket_name, r.object_size, r.bucket_share) for r in la.percentage_of_bucket_total(df).collect())
    assert got == [("b", 10, 25.0), ("b", 30, 75.0), ("z", 0, None)]


def test_top_buckets_tie_break_and_limit(spark):
    df = log(spark, [("b2", "k", 5, None, 0, False), ("b1", "k", 5, None, 0, False), ("b3", "k", 1, None, 0, False),
                     ("bad", "k", 100, None, 0, True)])
    assert [r.bucket_name for r in la.top_buckets_by_size(df, n=2).collect()] == ["b1", "b2"]


def test_top_objects_dense_rank(spark):
    df = log(spark, [("b", k, s, None, 0, False) for k, s in [("a", 9), ("b", 9), ("c", 5), ("d", 1), ("e", 0)]])
    got = sorted((r.key, r.rank) for r in la.top_objects_per_bucket(df, n=2).collect())
    assert got == [("a", 1), ("b", 1), ("c", 2)]


def test_top_objects_match_a_window_over_rows_with_a_hot_tied_key(spark):
    rnd = random.Random(11)
    rows = [("hot", "big", 900, None, 0, False)] * 400  # a third of the rows: the hot bucket's largest object
    rows += [(rnd.choice(["hot", "a", "b"]), f"k{i}", rnd.choice([0, 5, 9, 900, 17, 3]), None, 0, False) for i in range(800)]
    rows += [("a", "bad", 5000, None, 0, True)]
    df = log(spark, rows)
    w = Window.partitionBy("bucket_name").orderBy(F.desc("object_size"))
    ref = la.good_rows(df).select("bucket_name", "key", "object_size").withColumn("rank", F.dense_rank().over(w))
    for n in (1, 3, None):
        got = la.top_objects_per_bucket(df, n=n)
        want = ref if n is None else ref.where(F.col("rank") <= n)
        assert got.columns == ["bucket_name", "key", "object_size", "rank"]
        assert sorted(got.collect()) == sorted(want.collect())
    # rows are ranked by a join against the ranked sizes, not by a window over the rows
    text = plan_text(la.top_objects_per_bucket(df, n=3))
    assert "WindowGroupLimit" in text and "Join" in text


def test_top_objects_null_keys_rank_like_a_window(spark):
    df = log(spark, [(None, "x", 4, None, 0, False), (None, "y", 2, None, 0, False), ("b", "z", None, None, 0, False),
                     ("b", "w", 1, None, 0, False)])
    want = [("w", 1), ("x", 1), ("y", 2), ("z", 2)]
    assert sorted((r.key, r.rank) for r in la.top_objects_per_bucket(df, n=None).collect()) == want
    # the join-back without a broadcast (a sort-merge join, as on large inputs) gives the same
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        out = la.top_objects_per_bucket(df, n=None)
        assert "SortMergeJoin" in plan_text(out)
        assert sorted((r.key, r.rank) for r in out.collect()) == want
    finally:
        spark.conf.set(key, before)


def test_hits_per_object_excludes_dash_and_malformed(spark):
    df = log(spark, [("b", "k", 3, None, 0, False), ("b", "k", 4, None, 0, False), ("b", "-", 1, None, 0, False),
                     ("b", "k", 100, None, 0, True)])
    assert [(r.key, r.hits, r.bytes) for r in la.hits_per_object(df).collect()] == [("k", 2, 7)]


def test_hits_per_ip_semi_join_counts_all_buckets(spark):
    df = log(spark, [("sel", "k", 1, "1.1.1.1", 0, False), ("other", "k", 1, "1.1.1.1", 0, False),
                     ("other", "k", 1, "2.2.2.2", 0, False), ("sel", "k", 1, None, 0, False)])
    got = [(r.ip_address, r.hits) for r in la.hits_per_ip(df, buckets=["sel"]).collect()]
    assert got == [("1.1.1.1", 2)]
    by_df = la.hits_per_ip(df, buckets=spark.createDataFrame([("sel",)], "bucket_name string")).collect()
    assert [(r.ip_address, r.hits) for r in by_df] == got


def test_plans_use_the_intended_operators(spark):
    lg = parse_access_log(fx.raw_lines(spark, SF001))
    assert "WindowGroupLimit" in plan_text(la.top_objects_per_bucket(lg, n=3))
    # the subquery filter is folded into the same aggregate: one pass over the log
    hp = plan_text(la.hits_per_ip(lg, buckets=["bkt-error-0"]))
    assert hp.count("Generate (") == 1 and "Join" not in hp
    assert "TakeOrderedAndProject" in plan_text(la.top_buckets_by_size(lg, n=5))
    # the regex runs once per line: one RegExpReplace, inside the generator
    text = plan_text(la.hits_per_ip(lg))
    assert text.count("regexp_replace(") == 1
    # the running share never windows over a whole bucket: every window is
    # partitioned by more than the bucket
    rp = plan_text(la.running_percentage(lg))
    windows = [ln for ln in rp.splitlines() if ln.startswith("Arguments: [sum(") and "windowspecdefinition(" in ln]
    assert len(windows) == 3
    for ln in windows:
        spec = ln.split("windowspecdefinition(")[1]
        assert spec.startswith("_g#") and ("_b1#" in spec or "_b2#" in spec)
    assert "SortMergeJoin" not in rp or rp.count("Generate") == 1


def test_no_python_in_any_registered_query(spark):
    for name, fn in catalog.queries().items():
        assert not uses_python(fn(spark, SF001)), name


def test_shares_under_one_hot_bucket(spark):
    """A third of the rows in one bucket, many of them with one size: both
    shares equal the plain-window definitions, row for row."""
    rnd = random.Random(13)
    rows = [("hot", "k", 0 if i % 3 else rnd.randrange(1 << 20), None, 0, False) for i in range(3000)]
    rows += [(f"b{i % 40}", "k", rnd.randrange(1 << 34), None, 0, False) for i in range(6000)]
    df = log(spark, rows)
    w_run = Window.partitionBy("bucket_name").orderBy("object_size").rangeBetween(Window.unboundedPreceding, 0)
    ref_run = df.select("bucket_name", "object_size",
                        F.try_divide(F.sum("object_size").over(w_run).cast("double") * 100, F.col("object_size")).alias("p"))
    got_run = la.running_percentage(df)
    assert sorted(tuple(r) for r in got_run.collect()) == sorted(tuple(r) for r in ref_run.collect())
    w_all = Window.partitionBy("bucket_name")
    ref_share = df.select("bucket_name", "object_size",
                          F.try_divide(F.col("object_size").cast("double") * 100,
                                       F.sum("object_size").over(w_all).cast("double")).alias("s"))
    got_share = la.percentage_of_bucket_total(df)
    assert sorted(tuple(r) for r in got_share.collect()) == sorted(tuple(r) for r in ref_share.collect())


def test_bucket_names_are_bound_not_spliced(spark):
    df = log(spark, [("a'b", "k", 1, None, 0, False), ("c", "k", 2, None, 0, False)])
    assert [r.bucket_name for r in la.top_objects_per_bucket(df, buckets=["a'b"]).collect()] == ["a'b"]
    assert la.top_objects_per_bucket(df, buckets=[]).count() == 0


def test_dataframe_allow_list_is_a_left_semi_join(spark):
    df = log(spark, [("a", "k", 5, None, 0, False), ("b", "k", 7, None, 0, False)])
    allow = spark.createDataFrame([("b",), ("b",)], "bucket_name string")
    out = la.top_objects_per_bucket(df, buckets=allow)
    assert "LeftSemi" in plan_text(out)
    assert [(r.bucket_name, r.object_size) for r in out.collect()] == [("b", 7)]


def test_null_sizes_and_buckets_come_out_like_a_window(spark):
    sizes = (None, 5, 5, 0, None, 20, -3)
    rows = [(b, "k", s, None, 0, False) for b in ("a", None) for s in sizes]
    df = log(spark, rows)
    w = Window.partitionBy("bucket_name")
    running = F.sum("object_size").over(w.orderBy("object_size").rangeBetween(Window.unboundedPreceding, 0)).cast("double")
    key = lambda r: tuple((x is not None, x) for x in r)
    want = df.select("bucket_name", "object_size", F.try_divide(running * 100, F.col("object_size")))
    assert sorted(map(key, la.running_percentage(df).collect())) == sorted(map(key, want.collect()))
    share = F.try_divide(F.col("object_size").cast("double") * 100, F.sum("object_size").over(w).cast("double"))
    want = df.select("bucket_name", "object_size", share)
    assert sorted(map(key, la.percentage_of_bucket_total(df).collect())) == sorted(map(key, want.collect()))


def test_sums_do_not_overflow(spark):
    top = 2**63 - 1
    df = log(spark, [("b", "k", top, None, top, False)] * 3 + [("c", "k", None, None, 1, False)])
    assert [(r.bucket_name, r.total_size) for r in la.top_buckets_by_size(df).collect()] == [("b", 3 * top), ("c", None)]
    assert {r.bucket_name: r.bytes for r in la.hits_per_object(df).collect()} == {"b": 3 * top, "c": None}
    assert la.total_bytes_sent(df).collect()[0][0] == 3 * top + 1


def test_top_objects_without_a_limit(spark):
    rnd = random.Random(2)
    sizes = [None, 0, 3, 3, 1 << 45, (1 << 45) + 1, -5] + [rnd.randrange(1 << 44) for _ in range(50)]
    df = log(spark, [(b, f"k{i % 9}", s, None, 0, False) for b in ("a", "b", None) for i, s in enumerate(sizes)])
    w = Window.partitionBy("bucket_name").orderBy(F.desc("object_size"))
    key = lambda r: tuple((x is not None, x) for x in r)
    want = df.select("bucket_name", "key", "object_size", F.dense_rank().over(w))
    out = la.top_objects_per_bucket(df, n=None)
    assert sorted(map(key, out.collect())) == sorted(map(key, want.collect()))
    assert "dense_rank" not in plan_text(out)


def test_top_objects_reads_a_text_log_once(spark, tmp_path):
    fx.raw_lines(spark, SF001).limit(50).write.text(f"{tmp_path}/log")
    out = la.top_objects_per_bucket(parse_access_log(spark.read.text(f"{tmp_path}/log")), n=3)
    out.collect()  # the plan that ran
    tree = plan_text(out).split("\n\n")[0].split("Initial Plan")[0]
    assert "ReusedExchange" in tree and tree.count("Scan text") == 1, tree

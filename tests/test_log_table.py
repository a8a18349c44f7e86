import pytest
from pyspark.sql import functions as F

from conftest import SF001

from bucketlens.operators import log_analytics as la
from bucketlens.operators.parse import parse_access_log
from bucketlens.plans import fixtures as fx
from bucketlens.plans.explain import plan_text
from bucketlens.sources.log_table import register_table_functions, write_log_table
from bucketlens.sources.views import register_views


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    log = parse_access_log(fx.raw_lines(spark, SF001))
    table = write_log_table(log, "bucketlens_log", files=4, path=f"file://{tmp_path_factory.mktemp('t')}/log")
    yield log, table
    spark.sql("DROP TABLE bucketlens_log")


def test_table_holds_the_good_rows(written):
    log, table = written
    assert sorted(map(str, table.collect())) == sorted(map(str, la.good_rows(log).collect()))


def test_aggregate_on_the_key_needs_no_exchange(spark, written):
    _, table = written
    out = table.groupBy("bucket_name", "key").agg(F.count("*").alias("n"))
    assert "Exchange" not in plan_text(out) and "Bucketed: true" in plan_text(out)


def test_join_on_the_key_needs_no_exchange(spark, written):
    _, table = written
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        counts = table.groupBy("bucket_name", "key").agg(F.count("*").alias("n"))
        text = plan_text(table.join(counts, ["bucket_name", "key"]))
        assert "SortMergeJoin" in text and "Exchange" not in text
    finally:
        spark.conf.set(name, before)


def test_operators_give_the_same_on_the_table(written):
    log, table = written
    for op in (la.hits_per_object, la.top_objects_per_bucket, la.top_buckets_by_size, la.hits_per_ip, la.percentage_of_bucket_total):
        assert sorted(map(str, op(table).collect())) == sorted(map(str, op(log).collect()))


def test_written_again(spark, written, tmp_path):
    log, _ = written
    one = log.limit(5)
    counts = [write_log_table(one, "bucketlens_small", by=["ip_address"], files=2, path=f"file://{tmp_path}/x").count() for _ in range(2)]
    assert counts[0] == counts[1] > 0
    spark.sql("DROP TABLE bucketlens_small")


def test_table_functions(spark):
    log = parse_access_log(fx.raw_lines(spark, SF001))
    register_views(access_log=log)
    assert register_table_functions(spark) == ["top_buckets", "bucket_objects", "address_hits"]
    sql = lambda q, **a: spark.sql(q, args=a)
    assert sorted(sql("SELECT * FROM top_buckets(5)").collect()) == sorted(la.top_buckets_by_size(log, 5).collect())
    got = sql("SELECT * FROM bucket_objects(:b)", b="bkt-error-0")
    assert sorted(got.collect()) == sorted(la.hits_per_object(log, buckets=["bkt-error-0"]).collect())
    ips = sql("SELECT * FROM address_hits(:b)", b="bkt-error-0")
    assert sorted(ips.collect()) == sorted(la.hits_per_ip(log, buckets=["bkt-error-0"]).collect())
    # inlined: one scan, one aggregate, the filter pushed to the scan, no Python
    text = plan_text(sql("SELECT * FROM bucket_objects(:b)", b="bkt-error-0"))
    assert "Python" not in text and text.count("Scan parquet") == plan_text(la.hits_per_object(log, buckets=["bkt-error-0"])).count("Scan parquet")
    # joined with a table of arguments
    assert sql("SELECT t.n, b.* FROM VALUES (1), (2) t(n), LATERAL top_buckets(t.n) b").count() == 3


def test_table_functions_bind_names(spark):
    register_views(access_log=parse_access_log(fx.raw_lines(spark, SF001)))
    register_table_functions(spark)
    assert spark.sql("SELECT * FROM bucket_objects(:b)", args={"b": "a' OR '1'='1"}).count() == 0

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import SF001, odd_docs, shipped  # noqa: F401

from bucketlens.llm import sharding as sh


def size():
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1


def check_law(rows, n):
    """Counts at most one apart, slots gapless from 0."""
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    counts = [len(slots.get(i, [])) for i in range(n)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("total,shards", [(0, 4), (3, 4), (4, 4), (17, 4), (1000, 16)])
def test_places_become_slots(total, shards):
    shard, slot = sh.shard_and_slot(np.arange(total), total, shards)
    want = [(i, j) for i in range(shards) for j in range(total // shards + (i < total % shards))]
    assert list(zip(shard.tolist(), slot.tolist())) == want


def test_fisher_yates_is_uniform():
    seen = {}
    for seed in range(6000):
        order = tuple(sh.fisher_yates(3, seed, 1))
        seen[order] = seen.get(order, 0) + 1
    assert len(seen) == 6 and max(abs(n - 1000) for n in seen.values()) < 150


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = sh.op11_sharding(spark, SF001).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    check_law(rows, 16)
    for r in rows:
        body = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(body) + 1, zlib.crc32(body), "rows", None)


def test_order_is_random_and_seeded(spark, tmp_path):
    spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")).repartition(3).write.parquet(f"file://{tmp_path}/t")
    docs = spark.read.parquet(f"file://{tmp_path}/t")
    place = lambda seed: {r.doc_id: (r.shard, r.slot) for r in sh.shuffle_into_shards(docs, size(), seed=seed, bucket_bytes=500, scan=True).select("row.doc_id", "shard", "slot").collect()}
    one, again, other = place(1), place(1), place(2)
    assert one == again and one != other
    order = [d for d, _ in sorted(one.items(), key=lambda x: x[1])]
    assert abs(np.corrcoef(order, np.arange(5000))[0, 1]) < 0.06
    # every shard holds rows from all over the input
    assert all(np.ptp([d for d, (s, _) in one.items() if s == i]) > 4000 for i in range(16))


def test_hot_copies_are_dealt_out(spark):
    """A third of all rows is one repeated row: no bucket gets more than its share."""
    rows = [(-7, "the same text")] * 1000 + [(i, f"text {i}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    done = sh.shuffle_into_shards(docs, size(), bucket_bytes=1000)
    got = done.select("row.doc_id", "shard", "slot").collect()
    check_law(got, 16)
    hot = [sum(r.doc_id == -7 and r.shard == i for r in got) for i in range(16)]
    assert sum(hot) == 1000 and max(hot) < 110


def test_odd_rows_and_clashing_columns(spark, odd_docs):  # noqa: F811
    docs = odd_docs.select("*", F.lit(3).alias("shard"), F.lit("s").alias("slot"), F.lit(1).alias("row"), F.lit(2).alias("bucket"), F.lit(0).alias("key"))
    done = sh.shuffle_into_shards(docs, size(), shards=4)
    got = done.collect()
    assert sorted(map(str, (tuple(r.row) for r in got))) == sorted(map(str, (tuple(r) for r in docs.collect())))
    check_law(got, 4)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    done = sh.shuffle_into_shards(docs, size())
    assert done.collect() == [] and done.columns == ["row", "slot", "shard"]


def test_written_folders(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    sh.shuffle_into_shards(docs, size(), shards=3, path=f"file://{tmp_path}/out", scan=True)
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["shard=0", "shard=1", "shard=2"]

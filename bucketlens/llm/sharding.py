"""Sharding by a two-pass external shuffle (operator 11).

Every row gets a place in one random order of the whole table, and the order is
cut into shards whose row counts differ by at most one (the law ``rows``).

1. Size: one scan adds up the rows' bytes and chooses how many buckets of about
   ``bucket_bytes`` there are (at least one a shard, at most ``MOST_BUCKETS``).
2. Scatter: a row's bucket is a seeded hash of its place in the input (file and
   row number), so it does not depend on what the row holds: a document that
   fills a third of the table is dealt out like any other. The same hash gives
   the bucket counts beforehand, from a scan that reads no column.
3. Shuffle: each bucket is one task's memory. Its rows are put in the order of
   the hash, then shuffled by Fisher and Yates with a generator seeded by
   (seed, bucket). A bucket's offset (the counts before it) makes its rows'
   places places in the whole order, which gives shard and slot.
4. Write: one folder a shard; a bucket lies in one or two shards, in order.

A lost task makes the same rows again: neither hash nor shuffle depends on the
order in which rows arrive. For that the input must be a plain scan of Parquet
files (perhaps filtered); ``scan=False`` stores any other frame first.

Defined cases. A null text has no bytes (size 1, checksum of the empty text). A
null or repeated id is a row like any other, and so is each of several equal
rows. An empty table gives no row. A text longer than a bucket makes its bucket
so much larger. Input columns stay together in the struct ``row``, so none can
clash with ``shard`` and ``slot``. Different seeds give different orders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch_path, stored, table

SHARDS = 16
SEED = 20
BUCKET_BYTES = 32 << 20
#: The offsets sent to every task are 8 bytes a bucket: 32 MB at most.
MOST_BUCKETS = 1 << 22


def offsets(counts: dict[int, int], n: int) -> np.ndarray:
    """Where each bucket begins, and the total."""
    sizes = np.zeros(n, np.int64)
    sizes[list(counts)] = list(counts.values())
    return np.concatenate(([0], np.cumsum(sizes)))


def shard_and_slot(place: np.ndarray, total: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The first total mod shards shards have one row more than the others."""
    small, longer = divmod(total, shards)
    cut = longer * (small + 1)
    late = place >= cut
    width = np.where(late, max(small, 1), small + 1)
    shard = np.where(late, longer, 0) + (place - np.where(late, cut, 0)) // width
    return shard, place - shard * small - np.minimum(shard, longer)


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A permutation of 0 .. n-1: numpy's Fisher-Yates shuffle."""
    order = np.arange(n)
    np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(order)
    return order


def _shuffled(starts: np.ndarray, shards: int, seed: int):
    total = int(starts[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held)
        held.clear()
        bucket = whole["bucket"].to_numpy()
        order = np.lexsort((whole["key"].to_numpy(), bucket))
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            k = int(bucket[order[a]])
            mine = order[a:b][fisher_yates(b - a, seed, k)]
            shard, slot = shard_and_slot(starts[k] + np.arange(b - a), total, shards)
            rows = whole.select(["row"]).take(pa.array(mine))
            rows = rows.append_column("slot", pa.array(slot)).append_column("shard", pa.array(shard.astype(np.int32)))
            yield from rows.to_batches(max_chunksize=4096)

    return run


def shuffle_into_shards(
    docs: DataFrame,
    size: Column,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    path: str | None = None,
    scan: bool = False,
) -> DataFrame:
    """Write ``docs`` in a random order as ``shards`` folders below ``path`` (by
    default in the shared folder) and return them: `(row, slot, shard)`, with
    the input's columns in the struct ``row``. ``size``: a row's bytes."""
    spark = docs.sparkSession
    docs = docs if scan else stored(docs, "to-shuffle")
    found = docs.metadataColumn("_metadata")
    key = F.xxhash64(F.lit(seed), found["file_path"], found["row_index"])
    total = docs.agg(F.sum(size)).first()[0] or 0
    n = min(MOST_BUCKETS, max(shards, -(-total // bucket_bytes)))
    bucket = F.pmod(key, F.lit(n)).cast("int")
    sizes = docs.select(bucket.alias("bucket")).groupBy("bucket").count().toArrow()
    starts = offsets(dict(zip(sizes["bucket"].to_pylist(), sizes["count"].to_pylist())), n)

    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    scattered = docs.select(record.alias("row"), key.alias("key"), bucket.alias("bucket")).repartitionById(n, F.col("bucket"))
    kinds = T.StructType([T.StructField("row", docs.schema), T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])
    path = path or scratch_path(spark, "shards")
    scattered.mapInArrow(_shuffled(starts, shards, seed), kinds).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return spark.read.schema(kinds).parquet(path)


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1
    done = shuffle_into_shards(docs, size, scan=True)
    text = F.coalesce(F.col("row.text"), F.lit("")).cast("binary")
    return done.select(
        F.col("row.doc_id").alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

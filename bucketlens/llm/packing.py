"""Packing: optimal length buckets and token-budget batches (operator 2).

1. Every document becomes sequences of at most ``max_len`` tokens (a longer one
   is cut into consecutive pieces; nothing is dropped).
2. The global histogram of sequence lengths, at most ``max_len`` rows, goes to
   the driver; a dynamic programme picks the ``n_buckets`` boundaries with the
   least padding over the whole corpus (exact optimum).
3. Inside each bucket, sequences form batches of ``token_budget // boundary``.
   A bucket is dealt into slices of about ``slice_rows`` rows by a hash of the
   document, and batches are numbered inside a slice, so no task ever holds a
   whole bucket; a slice leaves at most one short batch.

Null and empty texts have no tokens and so no sequence: they get one row with
zero tokens and null bucket and batch. Repeated rows are packed once each.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD_PATTERN, table

MAX_LEN = 4096
N_BUCKETS = 12
TOKEN_BUDGET = 16384
SLICE_ROWS = 4096


def n_words(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def optimal_boundaries(lengths: Sequence[int], counts: Sequence[int], n_buckets: int) -> list[int]:
    """Upper bounds of the ``n_buckets`` (or fewer) buckets with the least total
    padding; the last is the greatest length. Each sequence is padded to the
    bound of its bucket. Of equal optima, the smaller bounds win.

    best[k][j] = min over i < j of best[k-1][i] + padding of lengths i..j-1 in
    one bucket; the optimal i grows with j, which halves the search range."""
    order = np.argsort(np.asarray(lengths))
    length = np.asarray(lengths, np.int64)[order]
    count = np.asarray(counts, np.int64)[order]
    d = len(length)
    if d == 0:
        return []
    rows = np.concatenate(([0], np.cumsum(count)))
    tokens = np.concatenate(([0], np.cumsum(count * length)))
    far = np.iinfo(np.int64).max // 4
    best = np.full(d + 1, far)
    best[0] = 0
    choices = []
    for _ in range(min(n_buckets, d)):
        new, choice = np.full(d + 1, far), np.zeros(d + 1, np.int64)
        new[0] = 0
        todo = [(1, d, 0, d - 1)]
        while todo:
            low, high, i_low, i_high = todo.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(i_low, min(i_high, j - 1) + 1)
            cost = best[i] + length[j - 1] * (rows[j] - rows[i]) - (tokens[j] - tokens[i])
            at = int(np.argmin(cost))
            new[j], choice[j] = min(cost[at], far), i[at]
            todo += [(low, j - 1, i_low, int(i[at])), (j + 1, high, int(i[at]), i_high)]
        best = new
        choices.append(choice)
    out, j = [], d
    for choice in reversed(choices):
        if j == 0:
            break
        out.append(int(length[j - 1]))
        j = int(choice[j])
    return out[::-1]


def sequences(docs: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """`(doc_id, piece, n_tokens)`: pieces of at most ``max_len`` tokens; one
    row with piece 0 and no tokens for a document without words."""
    n = docs.select("doc_id", n_words(F.col("text")).alias("_n"))
    pieces = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("_n") / max_len).cast("int") - 1)))
    cut = n.select("doc_id", "_n", pieces.alias("piece"))
    return cut.select("doc_id", "piece", F.least(F.lit(max_len), F.col("_n") - F.col("piece") * max_len).alias("n_tokens"))


def pack(
    docs: DataFrame,
    max_len: int = MAX_LEN,
    n_buckets: int = N_BUCKETS,
    token_budget: int = TOKEN_BUDGET,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """`(doc_id, piece, n_tokens, bucket, bucket_len, batch_slice, batch,
    slot)`: ``(bucket, batch_slice, batch)`` names a batch, ``slot`` the place
    in it. Runs one job (the histogram) when called."""
    if token_budget < max_len:
        raise ValueError("token_budget must hold the longest sequence")
    seq = sequences(docs, max_len)
    histogram = seq.where("n_tokens > 0").groupBy("n_tokens").count().toPandas()  # at most max_len rows
    bounds = optimal_boundaries(histogram["n_tokens"], histogram["count"], n_buckets)
    if not bounds:
        none = F.lit(None)
        return seq.select(
            "doc_id", "piece", "n_tokens", none.cast("int").alias("bucket"), none.cast("bigint").alias("bucket_len"),
            none.cast("bigint").alias("batch_slice"), none.cast("bigint").alias("batch"), none.cast("bigint").alias("slot"),
        )
    at = np.searchsorted(bounds, histogram["n_tokens"])
    n_rows = np.bincount(at, weights=histogram["count"], minlength=len(bounds)).astype(np.int64)
    slices = np.maximum(1, -(-n_rows // slice_rows))
    bucket = F.lit(None).cast("int")
    for k in reversed(range(len(bounds))):
        bucket = F.when(F.col("n_tokens") <= bounds[k], k).otherwise(bucket)
    bucket = F.when(F.col("n_tokens") > 0, bucket)
    placed = seq.withColumn("bucket", bucket)
    of = lambda values: F.element_at(F.array(*[F.lit(int(v)).cast("bigint") for v in values]), F.col("bucket") + 1)
    digest = F.conv(F.substring(F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("piece")).cast("binary")), 1, 8), 16, 10)
    placed = placed.withColumns({"bucket_len": of(bounds), "_slices": of(slices)})
    # rows without tokens are spread over slices too: they need no numbering
    spread = F.coalesce(F.col("_slices"), F.lit(1 << 20))
    placed = placed.withColumn("batch_slice", digest.cast("bigint") % spread)
    rank = F.row_number().over(W.partitionBy("bucket", "batch_slice").orderBy("doc_id", "piece")).cast("bigint") - 1
    per_batch = F.floor(F.lit(token_budget) / F.col("bucket_len"))
    numbered = placed.withColumn("_r", rank)
    given = F.col("bucket").isNotNull()
    return numbered.select(
        "doc_id",
        "piece",
        "n_tokens",
        "bucket",
        "bucket_len",
        F.when(given, F.col("batch_slice")).alias("batch_slice"),
        F.when(given, F.floor(F.col("_r") / per_batch)).cast("bigint").alias("batch"),
        F.when(given, F.col("_r") % per_batch).cast("bigint").alias("slot"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))

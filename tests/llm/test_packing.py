import itertools

import numpy as np
import pytest

from llm_fixtures import SF001, odd_docs, shipped  # noqa: F401

from bucketlens.llm.packing import op2_packing, optimal_boundaries, pack


def padding(bounds, lengths, counts):
    return sum(int(c) * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))


def test_boundaries_are_optimal():
    rng = np.random.default_rng(3)
    for _ in range(200):
        d = int(rng.integers(1, 9))
        lengths = rng.choice(40, d, replace=False) + 1
        counts = rng.integers(1, 9, d)
        k = int(rng.integers(1, 5))
        bounds = optimal_boundaries(lengths, counts, k)
        top, rest = int(max(lengths)), sorted(int(x) for x in lengths)[:-1]
        best = min(padding([*c, top], lengths, counts) for r in range(k) for c in itertools.combinations(rest, r))
        assert len(bounds) <= k and bounds[-1] == top
        assert padding(bounds, lengths, counts) == best


def test_batches_keep_the_budget(spark):
    out = op2_packing(spark, SF001).toPandas()
    full = out[out.n_tokens > 0]
    assert (full.n_tokens <= full.bucket_len).all()
    batches = full.groupby(["bucket", "batch_slice", "batch"])
    assert (batches.size() * batches.bucket_len.first() <= 16384).all()
    assert not full.duplicated(["bucket", "batch_slice", "batch", "slot"]).any()
    texts = spark.read.parquet(f"{SF001}/documents.parquet").toPandas()
    n = {d: len(t.split()) for d, t in zip(texts.doc_id, texts.text)}
    assert out.groupby("doc_id").n_tokens.sum().to_dict() == n


def test_odd_rows(spark, odd_docs):
    out = pack(odd_docs, max_len=100, token_budget=200, n_buckets=3, slice_rows=4).toPandas()
    blank = out[out.n_tokens == 0]
    assert sorted(blank.doc_id) == [1, 2, 3] and blank.bucket.isna().all() and blank.batch.isna().all()
    assert (out.doc_id == 4).sum() == 2 and out[out.doc_id.isna()].n_tokens.tolist() == [9, 9]
    assert out[out.doc_id == 5].n_tokens.sum() == 30_001
    assert pack(odd_docs.limit(0)).count() == 0


def test_budget_must_hold_a_sequence(odd_docs):
    with pytest.raises(ValueError):
        pack(odd_docs, max_len=10, token_budget=5)

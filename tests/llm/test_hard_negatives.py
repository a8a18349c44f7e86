import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import SF001, shipped  # noqa: F401

from bucketlens.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, key string, score long"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, anchor, n_positives=5, n_negatives=5):
    """Plain Python over (id, vector, label), in exact integers."""
    ok = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    used = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows if lab is not None and ok(v)]
    out = []
    for a, (aid, av, alab) in enumerate(used):
        if aid is None or not anchor(aid):
            continue
        scored = [(-sum(x * y for x, y in zip(av, v)), i is None, i or 0, i, lab) for b, (i, v, lab) in enumerate(used) if b != a]
        scored.sort()
        for s, _, _, pid, lab in [r for r in scored if r[4] == alab][:n_positives]:
            near = [r for r in scored if r[4] != alab and 80 * -s <= 100 * -r[0] <= 100 * -s]
            out += [(aid, pid, k, r[3], -s, -r[0]) for k, r in enumerate(near[:n_negatives], 1)]
    return out


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def mine(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return found(hn.hard_negatives(df, F.col("vec_id") % 100 == 0, **kw))


@pytest.mark.parametrize("size", [1, 200, 10**6, 10**12])
def test_scores_are_exact(size):
    rng = np.random.default_rng(3)
    a = rng.integers(-size, size + 1, (7, 150)).astype(float)
    b = rng.integers(-size, size + 1, (40, 150)).astype(float)
    bound = float(max((m**2).sum(axis=1).max() for m in (a, b))) * (1 + 1e-9) + 1
    want = a.astype(np.int64).astype(object) @ b.astype(np.int64).astype(object).T
    assert (hn.Scorer(b, bound)(a) == want).all()


def test_primes_make_room():
    assert hn.primes_for(1.0) == [1021, 1019]
    assert math.prod(hn.primes_for(1e30)) > 2e30
    # 64 products of centred residues stay exact in float32
    assert hn.INNER * (1021 // 2) ** 2 < 2**24
    with pytest.raises(ArithmeticError):
        hn.primes_for(math.inf)


def test_query_against_plain_python(spark):
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    plain = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.label is not None and r.vec_id % 7 == 0 else r.label) for r in rows]
    assert found(hn.op12_hard_negatives(spark, SF001)) == sorted(brute(plain, lambda i: i % 100 == 0), key=str)


def test_hot_vector_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "LEAST_ROWS", 40)
    monkeypatch.setattr(hn, "BLOCK_ANCHORS", 2)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 6)], int(i % 3)) for i in range(400)]
    rows += [(i, [0.5] * 6, int(i % 3)) for i in range(400, 600)]  # a third of the table is one vector
    rows += [(600, [0.5, 0.5], 1), (700, [], 1), (800, [0.1] * 9, 2), (None, [0.5] * 6, 0), (None, [0.4] * 6, 1)]
    rows += [(900, None, 1), (901, [0.1, None], 1), (902, [math.nan] * 6, 1), (903, [math.inf] * 6, 0), (904, [0.2] * 6, None)]
    rows += [(1000, [0.3] * 6, 0)] * 3  # repeated rows: each an anchor, the copies among the others
    assert mine(spark, rows) == sorted(brute(rows, lambda i: i % 100 == 0), key=str)


def test_large_components(spark):
    rows = [(i, [float((-1) ** i * 300_000 * (i + 1)), 0.5], i % 2) for i in range(0, 20)] + [(100, [2e6, 1.0], 0), (200, [-1e6, 3.0], 1)]
    assert mine(spark, rows) == sorted(brute(rows, lambda i: i % 100 == 0), key=str)


def test_empty_table_and_no_anchor(spark):
    assert mine(spark, []) == []
    assert mine(spark, [(1, [0.5], 0), (2, [0.5], 1)]) == []
    assert mine(spark, [(100, [0.5], 0)]) == []


def test_fewer_than_asked_for(spark):
    rows = [(100, [1.0], 0), (1, [0.9], 0), (2, [0.85], 1)]
    assert mine(spark, rows) == sorted(brute(rows, lambda i: i % 100 == 0), key=str)
    assert len(mine(spark, rows)) == 1

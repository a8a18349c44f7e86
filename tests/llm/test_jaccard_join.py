import itertools
import random

import numpy as np

from llm_fixtures import odd_docs, shipped  # noqa: F401

from bucketlens.llm import jaccard_join as join
from bucketlens.llm.common import noted_scratch
from bucketlens.llm.components import connected_components
from bucketlens.llm.jaccard_join import _forest, _intersections, near_duplicates, shingle_sets


def brute(rows, threshold=0.8, shingle=5):
    sets = [frozenset(s.tolist()) for s in shingle_sets([t for _, t in rows], shingle)]
    n = len(rows)
    links = [[] for _ in rows]
    for i, j in itertools.combinations(range(n), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
            links[i].append(j)
            links[j].append(i)
    seen, classes = set(), {}
    for i in range(n):
        if i not in seen:
            todo, part = [i], set()
            while todo:
                x = todo.pop()
                if x not in part:
                    part.add(x)
                    todo += links[x]
            seen |= part
            ids = [rows[x][0] for x in part if rows[x][0] is not None]
            for x in part:
                classes[x] = min(ids) if ids else None
    return sorted(((rows[i][0], classes[i], len(links[i])) for i in range(n)), key=repr)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def corpus(seed, groups=12, copies=8):
    rng = random.Random(seed)
    rows = []
    shared = " ".join(f"boiler{i}" for i in range(12))
    for g in range(groups):
        base = [f"w{g}x{rng.randrange(10**6)}" for _ in range(rng.randint(60, 200))]
        for c in range(rng.randint(1, copies)):
            text = edited(rng, base, rng.randint(0, 4))
            rows.append((len(rows), shared + " " + text if rng.random() < 0.5 else text))
    return rows


def result(df, **more):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in near_duplicates(df, **more).collect()), key=repr)


def test_against_brute_force(spark):
    rows = corpus(1) + [(500, "short text"), (501, "Short  text"), (502, "a"), (503, None), (504, ""), (505, " \n"), (500, "short text"), (None, "lone text here"), (None, "lone text here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(df) == brute(rows)


def test_large_groups_are_split(spark):
    """Every bucket is over the limit, so leaves go through block pairs."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, edited(rng, base, rng.randint(0, 3))) for i in range(60)] + [(i, "other words of a text " * 3) for i in range(100, 110)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df, limit=7, depth=2) == brute(rows)


def test_later_batches_join_earlier_classes(spark):
    """One run a batch finds a part of the links each time."""
    rows = corpus(7, groups=15, copies=6)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(df, batches=(1, 1, 1, 1, 12, 12), recall=1.0) == brute(rows)


def test_empty_and_kept(spark, odd_docs):
    assert near_duplicates(odd_docs.limit(0)).count() == 0
    out = near_duplicates(odd_docs).collect()
    assert len(out) == 8
    kept = [r for r in out if r.is_kept]
    assert {r.doc_id for r in kept} == {1, 2, 3, 4, None, 5}
    assert {(r.doc_id, r.class_id, r.n_links) for r in out if r.doc_id in (4, None)} == {(4, 4, 1), (None, None, 1)}


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_block_arithmetic():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint32)) for _ in range(30)]
    inter = _intersections(sets)
    for i, j in itertools.product(range(30), repeat=2):
        assert inter[i, j] == len(np.intersect1d(sets[i], sets[j]))
    linked = rng.random((30, 30)) < 0.05
    linked |= linked.T
    root = list(range(30))
    for a, b in _forest(linked):
        root[a] = b
    for i, j in zip(*np.nonzero(linked)):
        assert root[i] == root[j]


def test_a_connected_group_walks_no_further(spark, monkeypatch):
    """Sets that resemble a large group of near copies, without a link to it, do
    not send the whole group down again in every later run."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, edited(rng, base, rng.randint(0, 3))) for i in range(80)] + [(200 + i, edited(rng, base, 14)) for i in range(12)]
    walked = []
    step = join.next_paths
    monkeypatch.setattr(join, "next_paths", lambda rows, threshold: walked.append(rows.count()) or step(rows, threshold))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df, limit=10, batches=(12, 1), recall=1.0) == brute(rows)
    first = sum(walked)
    walked.clear()
    assert result(df, limit=10, batches=(12, 12), recall=1.0) == brute(rows)
    assert sum(walked) <= first * 1.1


def test_only_sets_that_share_tokens_walk(spark):
    """A passage in common, well below the threshold, is no reason to walk; near
    copies all do."""
    rng = random.Random(3)
    passage = " ".join(f"boiler{i}" for i in range(15))
    rows = corpus(9, groups=6) + [(1000 + i, passage + " " + " ".join(f"x{rng.randrange(10**9)}" for _ in range(100))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = join.document_sets(df).select("set_id", "doc_id", "tokens").dropDuplicates(["set_id"])
    kept = {r.doc_id for r in join.sharing_sets(sets, 0.8).collect()}
    assert not {i for i in kept if i >= 1000}
    linked = {i for i, _, n in brute(rows) if n}
    assert linked and linked <= {r.doc_id for r in df.join(join.document_sets(df).select("doc_id", "set_id").join(join.sharing_sets(sets, 0.8).select("set_id"), "set_id"), "doc_id").collect()}
    assert result(df) == brute(rows)


def test_a_level_joins_its_buckets_once(spark):
    """The members of a bucket are joined to it once a level, with its most
    frequent class, and the leaves are read from there."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, edited(rng, base, rng.randint(0, 3))) for i in range(80)] + [(200 + i, edited(rng, base, 14)) for i in range(12)]
    sets = join.document_sets(spark.createDataFrame(rows, "doc_id long, text string")).select("set_id", "tokens").dropDuplicates(["set_id"])
    ids = [r.set_id for r in sets.collect()]
    classes = spark.createDataFrame([(i, min(ids)) for i in ids if rng.random() < 0.8 or i == min(ids)], "set_id long, component long")
    for known, n_levels in ((None, 3), (classes, 1)):
        with noted_scratch() as made:
            found = join.leaves(sets, range(4), 0.8, 10, 3, known)
        names = [path.rpartition("/")[2].rpartition("-")[0] for path in made]
        assert names == ["paths", "buckets"] * n_levels
        assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.count()


def test_bucket_sizes(spark):
    rows = [(1, 10, 10), (1, 11, 10), (1, 12, 12), (2, 10, 10), (2, 11, 10), (3, 12, 12), (4, 10, 10), (4, 12, 12), (4, 13, 13), (4, 14, 13)]
    df = spark.createDataFrame(rows, "path long, set_id long, class long")
    assert sorted(map(tuple, join.bucket_sizes(df, True).collect())) == [(1, 3, 10, 1), (4, 4, 13, 2)]
    assert sorted(map(tuple, join.bucket_sizes(df, False).collect())) == [(1, 3, None, None), (4, 4, None, None)]


def test_components_of_stars_take_one_round(spark):
    edges = [(i, 1) for i in range(2, 9)] + [(20, 21), (9, 9)]
    with noted_scratch() as made:
        got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 1 for i in range(1, 9)}, 20: 20, 21: 20}
    assert len(made) == 1


def test_components_against_brute_force(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    least = list(range(300))
    for _ in range(300):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {x: least[x] for a, b in edges if a != b for x in (a, b)}

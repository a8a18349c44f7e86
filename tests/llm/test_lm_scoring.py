import collections
import math
import re

import numpy as np
import pandas as pd
import pytest

from llm_fixtures import SF001, shipped  # noqa: F401

from bucketlens.llm import lm_scoring as lm

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), "</s>"]


def brute(train, least, alpha=0.1, discount=0.75):
    """(base, model) log10 probability functions by plain recursion."""
    texts = [tokens(t) for t in train]
    count = collections.Counter(w for t in texts for w in t)
    n, v = sum(count.values()), len(count)
    grams = {k: collections.Counter(tuple(t[i : i + k]) for t in texts for i in range(len(t) - k + 1)) for k in (2, 3)}
    kept = {k: {g: c for g, c in own.items() if c >= least} for k, own in grams.items()}

    def p(history, w):
        if not history:
            return (count[w] + alpha) / (n + alpha * (v + 1))
        k = len(history) + 1
        arcs = {g[-1]: c for g, c in kept[k].items() if g[:-1] == history}
        if not arcs:
            return p(history[1:], w)
        total = count[history[0]] if k == 2 else grams[2][history]
        if w in arcs:
            return (arcs[w] - discount) / total
        rest = 1 - sum((c - discount) / total for c in arcs.values())
        return max(rest, 1e-9) / max(1 - sum(p(history[1:], x) for x in arcs), 1e-9) * p(history[1:], w)

    def score(text):
        t = tokens(text)
        return sum(math.log10(p(tuple(t[max(0, i - 2) : i]), w)) for i, w in enumerate(t))

    def base(text):
        return sum(math.log10(p((), w)) for w in tokens(text))

    return score, base, count, n


TRAIN = ["the cat sat on the mat", "The cat ate", "a dog sat on the mat", "the cat sat", None, "", "on the mat the cat sat on a dog"] * 2


def test_against_recursion(spark):
    train = spark.createDataFrame([(i, t) for i, t in enumerate(TRAIN)], "doc_id long, text string")
    asked = [*TRAIN[:7], "the bird sat on the cat", "zebra", "x " * 50 + "the cat sat on the mat"]
    rows = [*enumerate(asked), (None, "the cat"), (2**60 + 1, "the cat")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got, n = lm.score(docs, train, share=0.02, block_bytes=100)
    score, base, count, total = brute(TRAIN, max(2, 0.02 * sum(len(tokens(t)) for t in TRAIN)))
    assert n == total
    by_id = {r.doc_id: r for r in got.collect()}
    assert len(by_id) == len(rows)
    for i, text in rows:
        r = by_id[i]
        assert r.n_tokens == len(tokens(text)) and r.n_known == sum(count[w] > 0 for w in tokens(text))
        assert r.base_score == pytest.approx(base(text), rel=1e-9)
        assert r.score == pytest.approx(score(text), rel=1e-9), text


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    out, n = lm.score(docs, docs.limit(0))
    r = out.collect()[0]
    assert n == 0 and (r.n_tokens, r.n_known, r.base_score, r.score) == (3, 0, 0.0, 0.0)
    assert lm.score(docs.limit(0), docs)[0].count() == 0


def test_base_score_on_the_whole_table(spark):
    import zlib

    got = {r.doc_id: r for r in lm.op7_lm_scoring(spark, SF001).collect()}
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    fold = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 10 for r in rows}
    count = collections.Counter(w for r in rows if fold[r.doc_id] for w in tokens(r.text))
    n, v = sum(count.values()), len(count)
    held = np.zeros(2)
    for r in rows:
        g = got[r.doc_id]
        t = tokens(r.text)
        assert (g.held_out, g.train_tokens, g.n_tokens, g.n_known) == (fold[r.doc_id] == 0, n, len(t), sum(w in count for w in t))
        assert g.base_score == pytest.approx(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), rel=1e-9)
        if g.held_out:
            held += g.score, g.base_score
    assert held[0] > held[1]  # contexts help on unseen texts


def test_grams_stay_inside_texts():
    t, first = lm.tokens_of(["a b", "", "c"])
    assert np.diff(first).tolist() == [3, 1, 2]
    assert lm.gram_starts(len(t), first, 2).tolist() == [0, 1, 4]
    assert lm.gram_starts(len(t), first, 3).tolist() == [0]


def test_more_rows_of_other_words_take_no_arc_away(spark):
    """An n-gram seen a few times stays an arc however large the corpus is
    (before, it had to hold 3 in a million of the tokens)."""
    other = [" ".join(f"w{i}x{j}" for j in range(1500)) for i in range(700)]
    train = [*TRAIN, *other]
    asked = [*TRAIN[:3], "the cat sat on a dog", "w3x4 w3x5 the cat"]
    docs = spark.createDataFrame([*enumerate(asked)], "doc_id long, text string")
    rows = spark.createDataFrame([*enumerate(train)], "doc_id long, text string")
    got, n = lm.score(docs, rows, block_bytes=2 << 20)
    score, _, _, total = brute(train, 2)
    assert n == total and 3e-6 * n > 3
    by_id = {r.doc_id: r.score for r in got.collect()}
    assert by_id == {i: pytest.approx(score(t), rel=1e-9) for i, t in enumerate(asked)}


def test_orders_are_counted_apart():
    """Triples in a pass of their own: the same keys and counts as all at once."""
    rows = pd.DataFrame({"text": ["a b c a b c a", "", "b c a b", None, "a"], "learn": [True, True, False, True, True]})
    whole = lm.grams_of(rows)
    for orders in ((1, 2), (3,)):
        own = lm.grams_of(rows, orders)
        assert set(own.keys) == set(own.learned) == set(orders)
        for k in orders:
            assert (own.keys[k] == whole.keys[k]).all() and (own.learned[k] == whole.learned[k]).all()


def test_only_failure_arcs_that_can_be_taken_are_asked_for():
    """Contexts that only arcs leave, and contexts too rare for arcs, need no
    back-off sums; the walk does not need the weights that are left out."""
    rows = pd.DataFrame({"text": ["a b c", "a b c", "a b d", "x y"], "learn": [True] * 4})
    grams = lm.grams_of(rows)
    key = {w: k for w, k in zip(["a", "b", "c", "d", "x", "y"], lm.tokens_of(["a b c d x y"])[0])}
    words = {w: int(np.searchsorted(grams.keys[1], k)) for w, k in key.items()}
    left, asked = lm.contexts(grams, grams.learned, 1, 2)
    assert {w for w, i in words.items() if left[i]} == {"a", "b", "c"}
    assert {w for w, i in words.items() if asked[i]} == {"b"}  # c ends at END twice, a has b alone
    pairs = {p: int(grams.start[2][at]) for at, p in ((0, "a b"), (1, "b c"), (9, "b d"), (12, "x y"))}
    left, asked = lm.contexts(grams, grams.learned, 2, 2)
    assert {p for p, i in pairs.items() if left[i]} == {"a b", "b c"} and {p for p, i in pairs.items() if asked[i]} == {"a b"}


def test_answers_go_only_to_who_asks():
    keys = np.array([3, 5, 9], np.uint64)
    one = np.ones(3)
    sent = lm._messages(0, lm.ASK, 1, 1, keys, one, one) + lm._messages(1, lm.TELL, 1, 1, keys[1:], one[1:], one[1:])
    got = lm.add_sums(lm._frame(sent))
    assert got["block"].tolist() == [0]
    assert lm._answers(got, lm.ASK, 1, lm.SUMS)[0].tolist() == [1.0, 2.0, 2.0]

import re
from collections import Counter

import numpy as np
import pytest

from llm_fixtures import SF001, odd_docs, shipped  # noqa: F401

from bucketlens.llm import phrase_words as pw
from bucketlens.llm import phrases as ph

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top=2000, least=30):
    """Plain Python over (lang, text): every phrase is counted and scored."""
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            own = f.setdefault(lang, Counter())
            for m in range(1, 5):
                own.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, own in f.items():
        cands = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        inside = {}
        for p, a in cands.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside.get(p[i : i + m], 0), a)
        kept = []
        for p, a in cands.items():
            cuts = [(2000000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if not 100 * inside.get(p, 0) >= 80 * a:
                kept.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, i, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def corpus():
    """Zipf words with planted phrases, in three languages."""
    rng = np.random.default_rng(11)
    vocab = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    weights = 1 / np.arange(1, 101)
    rows = []
    for i in range(240):
        words = rng.choice(vocab, 300, p=weights / weights.sum()).tolist()
        for _ in range(6):
            at = int(rng.integers(0, 280))
            words[at : at + 4] = [["red", "Big", "fox", "ran"], ["one", "two", "three", "four"], ["big", "fox", "sat", "up"], ["x", "x", "x", "x"]][int(rng.integers(0, 4))]
        body = " ".join(words)
        for sep in (". ", ", ", "\n", "\t", "  ", "!?"):
            body = body.replace(" ", sep, 4) if rng.random() < 0.5 else body
        rows.append(([None, "en", "fr", "en"][i % 4], body))
    return rows + [("en", None), ("fr", ""), (None, " \n\t"), ("en", "x " * 3000), ("fr", "one two three four. " * 40)]


@pytest.mark.parametrize("top,batch", [(2000, None), (20, 2), (5, 1), (40, 300)])
def test_against_plain_python(spark, corpus, monkeypatch, top, batch):
    monkeypatch.setattr(ph, "LEAST", 8)
    docs = spark.createDataFrame(corpus, "lang string, text string")
    assert found(ph.collocations(docs, top=top, batch=batch)) == brute(corpus, top, 8)


def test_slices_and_small_chunks(spark, corpus, monkeypatch):
    """Sets sent in slices of a few phrases, and a bitmap that lets others through."""
    monkeypatch.setattr(ph, "LEAST", 8)
    monkeypatch.setattr(ph, "MOST_SENT", 30)
    monkeypatch.setattr(ph, "MOST_BITS", 12)
    docs = spark.createDataFrame(corpus, "lang string, text string")
    assert found(ph.collocations(docs, top=10, batch=60)) == brute(corpus, 10, 8)


def test_query(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert found(ph.op13_collocations(spark, SF001)) == brute(rows)


def test_odd_rows(spark, odd_docs):  # noqa: F811
    from pyspark.sql import functions as F

    docs = odd_docs.withColumns({"lang": F.lit(None).cast("string"), "words": F.lit(1), "a": F.lit(2), "level": F.lit(3)})
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert found(ph.collocations(docs)) == brute(rows)


def test_empty_table(spark):
    assert found(ph.collocations(spark.createDataFrame([], "lang string, text string"))) == []
    assert found(ph.collocations(spark.createDataFrame([(None, None), ("en", "")], "lang string, text string"))) == []


def test_ties_take_the_smaller_phrase(spark):
    docs = spark.createDataFrame([("en", "b c. a b2. é f. e g. ")] * 30, "lang string, text string")
    assert [r[2] for r in found(ph.collocations(docs, top=3))] == ["a b2", "b c", "e g"]


def test_words_and_pieces():
    body = "Aé  b.c\td\x0b\x00 e f!"
    buffer = np.frombuffer(body.encode(), np.uint8)
    start, end, fresh = pw.word_bounds(buffer)
    assert [bytes(buffer[a:b]).decode() for a, b in zip(start, end)] == ["Aé", "b", "c", "d", "\x00", "e f"]
    assert fresh.tolist() == [True, False, True, False, True, False]


def test_hashes_depend_on_word_and_language_only(monkeypatch):
    monkeypatch.setattr(pw, "SEGMENT_BYTES", 64)
    body = ("alpha beta " * 30 + "q" * 700 + " " + "ab" * 400 + " alpha").encode()
    buffer = np.frombuffer(body, np.uint8)
    start, end, _ = pw.word_bounds(buffer)
    keys, checks = pw.Hasher(1).words(buffer, start, end, "en")
    words = body.split()
    for hashes in (keys, checks):
        assert len({(w, h) for w, h in zip(words, hashes.tolist())}) == len(set(words)) == len(set(hashes.tolist()))
    assert not set(keys.tolist()) & set(pw.Hasher(1).words(buffer, start, end, "fr")[0].tolist())
    assert not set(keys.tolist()) & set(pw.Hasher(2).words(buffer, start, end, "en")[0].tolist())


def test_a_shared_key_is_seen(spark, monkeypatch):
    """With a hash that maps all long words to one key, no seed can do."""
    docs = spark.createDataFrame([("en", "x" * 600 + " " + "y" * 600)], "lang string, text string")
    chunk = pw.chunk_row(np.frombuffer(b"one two", np.uint8), "en", type("H", (pw.Hasher,), {"words": lambda self, b, s, e, lang: (np.ones(2, np.uint64), np.arange(2, dtype=np.uint64))})(0))
    assert chunk["clash"]
    assert ph._chunks(docs)[1].count() == 2


def test_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(pw, "CHUNK_BYTES", 50)
    body = ("some words here. " * 20 + "w " * 200 + ". end").encode()
    cuts = pw._cuts(np.frombuffer(body, np.uint8))
    assert cuts[0] == 0 and cuts[-1] == len(body) and len(cuts) > 6
    assert all(body[c - 1 : c] == b"." for c in cuts[1:-1])

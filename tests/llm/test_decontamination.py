import hashlib
import random
import re

from llm_fixtures import shipped  # noqa: F401

from bucketlens.llm.decontamination import build_index, decontaminate, phrase_matches, proximity_matches

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, window):
    phrases = set()
    for item, text in items:
        w = plain(text)
        for s in range(max(1, len(w) - window + 1)) if w else ():
            phrases.add(("" if item is None else str(item), tuple(w[s : s + window])))
    out = []
    for doc, text in docs:
        w = plain(text)
        hit, names = set(), set()
        for item, p in phrases:
            for s in range(len(w) - len(p) + 1):
                if tuple(w[s : s + len(p)]) == p:
                    hit.update(range(s, s + len(p)))
                    names.add(item)
        out.append((doc, len(w), len(hit), len(names), sorted(names), bool(hit)))
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_against_brute_force(spark):
    rng = random.Random(9)
    some = lambda n, k: " ".join(rng.choice("abcdefgh"[:k]) for _ in range(n))
    docs = [(i, some(rng.randint(0, 60), rng.choice([2, 5, 8]))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "…!?"), (103, "A-b;C—d é"), (3, docs[3][1]), (None, "a b a b"), (None, "a b a b"), (104, "-a b c")]
    items = [(i, some(rng.randint(1, 9), 5)) for i in range(6)] + [(6, None), (7, ""), (None, "b a b"), (8, "c—d É"), (8, "a b c")]
    d, i = frames(spark, docs, items)
    for window in (4, 10):
        got = sorted((tuple(r[:1]) + (r.n_words, r.n_hit, r.n_items, list(r["items"]), r.contaminated) for r in decontaminate(d.repartition(3), i, window).collect()), key=repr)
        assert got == brute(docs, items, window)


def test_matches_and_index(spark):
    d, i = frames(spark, [(1, "x the quick Brown fox, y the quick brown fox")], [(1, "quick brown fox")])
    row = phrase_matches(d, i).collect()[0]
    assert [(m.start, m.n_phrase, m.phrase) for m in row.matches] == [(2, 3, "quick brown fox"), (7, 3, "quick brown fox")]
    assert sorted(r.pos for r in build_index(d).collect()) == list(range(10))


def test_proximity(spark):
    docs = [(1, "alpha x x beta x gamma"), (2, "alpha " + "x " * 40 + "beta gamma"), (3, "gamma beta alpha alpha"), (4, None)]
    d, i = frames(spark, docs, [(7, "alpha beta gamma"), (8, "alpha nowhere")])
    got = {(r.doc_id, r.item_id) for r in proximity_matches(d, i, terms=3, span=10).collect()}
    assert got == {(1, "7"), (3, "7")}


def test_empty_tables(spark):
    d, i = frames(spark, [(1, "a b")], [(1, "a b")])
    assert decontaminate(d.limit(0), i).count() == 0
    r = decontaminate(d, i.limit(0)).collect()[0]
    assert (r.n_words, r.n_hit, r.contaminated) == (2, 0, False)
    assert hashlib.sha256(b"").hexdigest() == spark.sql("select sha2('', 256)").first()[0]

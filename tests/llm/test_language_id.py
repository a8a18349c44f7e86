import math

import numpy as np
import pandas as pd

from llm_fixtures import SF001, odd_docs, shipped  # noqa: F401

from bucketlens.llm.language_id import ORDER, build, folded, hash_of, op9_language_id, predict, train


def test_held_out_accuracy(spark):
    got = op9_language_id(spark, SF001).toPandas()
    truth = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    held = both[both.held_out & both.lang.notna()]
    assert len(held) > 200 and (held.lang == held.lang_pred).mean() > 0.98
    assert got.score.between(0, 1).all() and got[got.held_out].accepted.mean() > 0.9


def test_probabilities_sum_to_one():
    texts = {"a": "abba baab abab", "b": "cab bac abc cc"}
    rows = []
    for lang, text in texts.items():
        points, _ = folded([text])
        s = "".join(chr(int(p)) for p in points)
        grams = pd.Series([s[i - ORDER + 1 : i + 1] for i in range(ORDER - 1, len(s))]).value_counts()
        level = {ORDER: grams.to_dict()}
        for k in range(ORDER - 1, 0, -1):
            level[k] = pd.Series([g[1:] for g in level[k + 1]]).value_counts().to_dict()
        rows += [(lang, k, g, n) for k, own in level.items() for g, n in own.items()]
    model = build(pd.DataFrame(rows, columns=["lang", "k", "gram", "n"]))
    alphabet = sorted({g for _, k, g, _ in rows if k == 1})

    def p(history, c, lang):
        total = 0.0
        for k in range(ORDER, 0, -1):
            gram = history[len(history) - k + 1 :] + c
            keys, values = model.grams[k - 1]
            i = np.searchsorted(keys, np.uint64(hash_of(gram)))
            if i < len(keys) and keys[i] == hash_of(gram):
                return math.exp(total + values[i][lang])
            if k > 1:
                keys, values = model.contexts[k - 1]
                i = np.searchsorted(keys, np.uint64(hash_of(gram[:-1])))
                if i < len(keys) and keys[i] == hash_of(gram[:-1]):
                    total += values[i][lang]
        return math.exp(total + model.floor[lang])

    for lang in range(2):
        for history in ("abb", "zzz", "\x00\x00 ", "cab"):
            assert abs(sum(p(history, c, lang) for c in alphabet) + p(history, "#", lang) - 1) < 1e-4


def test_odd_rows(spark, odd_docs):
    model = train(spark.read.parquet(f"{SF001}/documents.parquet"), 50, 20)
    out = predict(odd_docs, model).select("doc_id", "_language.*").collect()
    assert len(out) == 8
    assert all(r.lang_pred == "und" and r.score == 0 and not r.accepted for r in out if r.doc_id in (1, 2, 3))
    assert all(r.lang_pred in model.languages for r in out if r.doc_id not in (1, 2, 3))
    assert predict(odd_docs.limit(0), model).count() == 0
    nothing = train(odd_docs.selectExpr("doc_id", "text", "cast(null as string) lang"))
    assert nothing is None and {r[0] for r in predict(odd_docs, nothing).select("_language.lang_pred").collect()} == {"und"}

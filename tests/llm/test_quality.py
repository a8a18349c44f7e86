import collections
import re


from llm_fixtures import SF001, odd_docs, shipped  # noqa: F401

from bucketlens.llm.quality import LANGUAGE_BANDS, Band, op8_quality_rules, quality_rules, repeated_words, script_of
from bucketlens.llm.tokens import words


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    hit = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if seen[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed


def test_base_counts_and_kept(spark):
    got = {r.doc_id: r for r in op8_quality_rules(spark, SF001).collect()}
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    for r in rows:
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == brute(r.text)
        assert not (g.kept and g.base_failed)
    labels = spark.read.parquet(f"{SF001}/labels.parquet").collect()
    good = [got[x.doc_id] for x in labels if x.quality == 1 and not got[x.doc_id].base_failed]
    bad = [got[x.doc_id] for x in labels if x.quality == 0]
    assert sum(x.kept for x in good) >= 0.99 * len(good)
    assert sum(x.kept for x in bad) <= 0.6 * len(bad)


def test_odd_rows(spark, odd_docs):
    rows = quality_rules(odd_docs).select("doc_id", "text", "_row", "rank", "_quality.*").collect()
    assert len(rows) == 8
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(r.text)
        assert not r.kept and (r.n_tokens == 0) == (not r.text)
    assert quality_rules(odd_docs.limit(0)).count() == 0


def test_bands_by_language_and_script(spark):
    text = " ".join(f"word{i} here stands{i} some{i * 7} plain text" for i in range(40))
    df = spark.createDataFrame([(1, text, "en"), (2, text, "xx"), (3, text, None)], "doc_id long, text string, lang string")
    wide, none = Band((0, 99), 1, 0), Band((98, 99), 1, 0)
    kept = quality_rules(df, bands={None: wide, "latin": wide}, language_bands={"en": none}, lang="lang")
    assert [r.kept for r in kept.select("doc_id", "_quality.kept").orderBy("doc_id").collect()] == [False, True, True]
    assert set(LANGUAGE_BANDS) == {"de", "en", "es", "fr"}


def test_helpers():
    assert script_of("abc") == "latin" and script_of("Привет a") == "cyrillic" and script_of("日本語") == "cjk" and script_of("12 .") is None
    assert repeated_words(words(["a b c a b c"]).keys) == 6 and repeated_words(words(["a b c d"]).keys) == 0
    assert repeated_words(words(["a a a a"]).keys) == 4

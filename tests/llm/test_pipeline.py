import re

from llm_fixtures import SF001, odd_docs, shipped  # noqa: F401

import corpus_pipeline

import bucketlens.llm.quality as quality_mod
from bucketlens.llm.jaccard_join import shingle_sets
from bucketlens.llm.tokens import words

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _quality long, rest string, _key string"


def text_of(i, n=80):
    return " ".join(f"word{(i * 7919 + k * 31) % 100003} plainly said" for k in range(n // 3 + 1))


def test_stage_names_and_columns(spark):
    rows = [(i, text_of(i), "en", "s", 1, 5, "r", "k") for i in range(6)]
    docs = spark.createDataFrame(rows, COLUMNS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns, name
        assert sorted(r.doc_id for r in out.collect()) == list(range(6)), name
        assert {(r._quality, r["rest"], r._key) for r in out.collect()} == {(5, "r", "k")}
        assert stage(spark, docs.limit(0), SF001).count() == 0


def test_odd_rows_pass_every_stage(spark, odd_docs):
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, odd_docs, SF001).collect()


def test_each_stage_against_brute_force(spark):
    """The whole run, stage by stage, each held against plain Python on its own
    input."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    kept = {r.doc_id: r for r in stages["quality rules"](spark, docs, SF001).collect()}
    vocabulary = quality_mod.Vocabulary.at(quality_mod.VOCABULARY)
    for r in docs.collect():
        n, *_, repeated = quality_mod.base_counts(r.text, words([r.text], lower=False).keys)
        _, script, fertility, fallback, entropy = quality_mod.measures(r.text, vocabulary)
        band = quality_mod.LANGUAGE_BANDS.get(r.lang) or quality_mod.SCRIPT_BANDS.get(script, quality_mod.SCRIPT_BANDS[None])
        inside = band.chars_per_token[0] <= fertility <= band.chars_per_token[1] and fallback <= band.max_byte_fallback and entropy >= band.min_entropy if n > 1 else True
        assert (r.doc_id in kept) == (n >= 50 and 100 * repeated <= 50 * n and inside)
    docs = spark.createDataFrame([tuple(r) for r in kept.values()], docs.schema).coalesce(1)

    out = {r.doc_id: r for r in stages["line dedup"](spark, docs, SF001).collect()}
    seen = set()
    for r in sorted(kept.values()):
        left = [x for x in r.text.split("\n")]
        new = [x for x in left if len(x.split()) < 50 or x not in seen]
        seen.update(left)
        body = out[r.doc_id].text.split("\n") if r.doc_id in out else []
        # long repeated lines are gone, lines that occur once are all there
        assert not [x for x in body if len(x.split()) >= 50 and x not in new]
        assert all(x in r.text.split("\n") for x in body)
    rows = list(out.values())
    docs = spark.createDataFrame([tuple(r) for r in rows], docs.schema)

    out = {r.doc_id: r for r in stages["n-gram Jaccard join"](spark, docs, SF001).collect()}
    sets = {r.doc_id: set(s.tolist()) for r, s in zip(rows, shingle_sets([r.text for r in rows]))}
    alike = lambda a, b: sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ids = sorted(out)
    assert not [(a, b) for i, a in enumerate(ids) for b in ids[:i] if alike(a, b)]
    for r in rows:
        assert r.doc_id in out or any(alike(r.doc_id, other.doc_id) for other in rows if other is not r)
    docs = spark.createDataFrame([tuple(r) for r in out.values()], docs.schema)

    left = {r.doc_id for r in stages["benchmark decontamination"](spark, docs, SF001).collect()}
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = set()
    for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect():
        w = pattern.findall(r.text.lower())
        windows |= {tuple(w[s : s + 10]) for s in range(max(1, len(w) - 9))}
    for r in out.values():
        w = pattern.findall(r.text.lower())
        hit = any(tuple(w[s : s + n]) in windows for n in {len(x) for x in windows} for s in range(len(w) - n + 1))
        assert (r.doc_id in left) == (not hit)


def test_scratch_of_a_stage_goes_when_the_next_begins(spark):
    from bucketlens.llm.common import stored

    docs = stored(spark.read.parquet(f"{SF001}/documents.parquet").limit(60), "docs")
    before = set(map(str, corpus_pipeline._MADE.values()))
    out = stored(corpus_pipeline.lines(spark, docs, SF001), "out")
    made = [p for k, v in corpus_pipeline._MADE.items() if k[2] == "lines" for p in v]
    fs = spark._jvm.org.apache.hadoop.fs.Path(made[0]).getFileSystem(spark._jsc.hadoopConfiguration())
    there = lambda p: fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p))
    assert len(made) > 3 and all(there(p) for p in made[-3:])
    stored(corpus_pipeline.near_copies(spark, out, SF001), "next")
    assert not any(there(p) for p in made) and out.count() == 60
    assert set(map(str, corpus_pipeline._MADE.values())) != before


def test_run(spark):
    out = corpus_pipeline.run(spark, SF001).toPandas()
    assert 200 < out.doc_id.nunique() < 1000 and (out.n_tokens <= out.bucket_len).all()

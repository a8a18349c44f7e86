import hashlib
import re


from llm_fixtures import SF001, shipped  # noqa: F401

from bucketlens.llm.secrets import op4_secret_scans, scan


def base_spans(text):
    out = []
    low = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for k, (p, group, least) in enumerate([(low, 2, 6), (re.compile("AKIA[A-Z0-9]+"), 0, 20), (re.compile("[0-9a-f]+"), 0, 24)]):
        out += [(m.start(), k, m.end()) for m in p.finditer(text or "") if len(m.group(group)) >= least]
    return sorted(out)


def test_base_contract_on_whole_table(spark):
    got = {r.doc_id: r for r in op4_secret_scans(spark, SF001).collect()}
    rows = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    found = 0
    for r in rows:
        spans = base_spans(r.text)
        text = ",".join(f"{['assign', 'access', 'hex'][k]}:{s}:{e}" for s, k, e in spans)
        own = got[r.doc_id]
        assert own.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [own.n_assign, own.n_access, own.n_hex] == [sum(k == i for _, k, _ in spans) for i in range(3)]
        assert set(filter(None, text.split(","))) <= set(own.spans.split(","))
        found += len(spans)
    assert found > 10


def test_ownership_separates_examples(spark):
    example = "Xy7" + "aB3dE5gH7jK9mN1pQ2rS4tU6vW8xYzAbC"
    live = "Zq9" + "kL2mN4oP6qR8sT0uV1wX3yZ5aB7cD9eFg"
    rows = [(i, f"r{i}", f"o{i}", f"é {example} and more") for i in range(6)] + [(9, "r9", "o9", f"use {live} here"), (10, None, None, None), (11, "r", "o", "")]
    rows += rows[-3:-2]
    df = spark.createDataFrame(rows, "doc_id long, repository string, owner string, text string")
    out = {}
    for r in scan(df, "repository", "owner").collect():
        out.setdefault(r.doc_id, []).append(r)
    assert len(out[9]) == 2 and all(x.n_live == 1 and len(x.spans) == 1 and x.spans[0].start == 4 for x in out[9])
    assert all(out[i][0].n_copied == 1 and not out[i][0].spans for i in range(6))
    assert not out[10][0].spans and out[11][0].n_live == 0
    assert scan(df.limit(0), "repository", "owner").count() == 0

import random

from llm_fixtures import odd_docs, shipped  # noqa: F401

from bucketlens.llm.line_dedup import dedup_lines, repeated_lines, numbered, suffix_ranks


def brute(rows, min_words):
    """Text left of each row, in row order; a place goes if some run of enough
    words around it starts earlier too."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0], i))
    lines = {i: rows[i][1].split("\n") for i in order if rows[i][1] is not None}
    seen, gone = set(), {i: set() for i in lines}
    for i in order:
        own = lines.get(i, [])
        starts = []
        for s in range(len(own)):
            for e in range(s + 1, len(own) + 1):
                if sum(len(x.split()) for x in own[s:e]) >= min_words:
                    run = tuple(own[s:e])
                    if run in seen:
                        gone[i].update(range(s, e))
                    starts.append(run)
                    seen.add(run)
    return {i: [x for k, x in enumerate(lines[i]) if k not in gone[i]] for i in lines}


def check(spark, rows, min_words):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "at long, doc_id long, text string").coalesce(1)
    out = dedup_lines(df, min_words).collect()
    want = brute(rows, min_words)
    assert len(out) == len(rows)
    for r in out:
        left = want.get(r.at)
        assert r._text == (None if left is None or (not left and rows[r.at][1] is not None) else "\n".join(left)), (r, left)
        assert r.text == rows[r.at][1]


def test_against_brute_force(spark):
    rng = random.Random(5)
    pool = ["a b", "c", "", "d e f", "g h", "i"]
    rows = [(rng.choice([1, 2, 3, None, 9]), "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 14)))) for _ in range(40)]
    rows += [(50, None), (51, ""), (52, ""), (53, "z z z z z\n" * 20), (53, "z z z z z\n" * 20)]
    check(spark, rows, 5)


def test_long_runs_of_short_lines(spark):
    body = "\n".join(f"l{i}" for i in range(70))
    rows = [(1, f"x\n{body}\ny"), (2, f"q\n{body}\nw\n{body}"), (3, body[:-4] + "\nend")]
    check(spark, rows, 50)


def test_suffix_ranks_name_equal_runs(spark):
    df = spark.createDataFrame([(1, "a\nb\nc\nd\na\nb\nc\ne"), (2, "b\nc\nd\nx")], "doc_id long, text string").coalesce(1)
    rows = numbered(df)
    text = {r._row: r.text.split("\n") for r in rows.collect()}
    ranks = suffix_ranks(repeated_lines(rows), 4).collect()
    for k in range(3):
        by_rank = {}
        for r in (x for x in ranks if x.k == k):
            by_rank.setdefault(r.rank, set()).add(tuple(text[r._row][r.line : r.line + 2**k]))
        assert all(len(x) == 1 for x in by_rank.values())
        runs = [next(iter(x)) for x in by_rank.values()]
        assert len(set(runs)) == len(runs)
    assert {x for r in ranks if r.k == 1 for x in [tuple(text[r._row][r.line : r.line + 2])]} == {("a", "b"), ("b", "c"), ("c", "d")}


def test_odd_rows(spark, odd_docs):
    out = {(r.doc_id, r._lines): r for r in dedup_lines(odd_docs).collect()}
    assert out[1, 0]._text is None and out[2, 1]._text == ""
    assert dedup_lines(odd_docs.limit(0)).count() == 0


def test_columns_of_any_name_come_through(spark, odd_docs):
    docs = odd_docs.selectExpr("*", "1 AS _rest", "2 AS m", "3 AS line", "4 AS `a.b`", "5 AS _split", "6 AS _text")
    out = dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "_row", "rank", "_rest", "m", "line", "a.b", "_split", "_lines", "_runs", "_text"]
    assert sorted((r._row or 0, r["rank"] or "") for r in out.collect()) == sorted((r._row or 0, r["rank"] or "") for r in odd_docs.collect())
    assert {tuple(r)[4:9] for r in out.collect()} == {(1, 2, 3, 4, 5)}

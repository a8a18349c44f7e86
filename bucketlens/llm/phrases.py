"""Phrase collocation mining by best-first branch and bound (operator 13).

A phrase of 2 to 4 words that occurs ``LEAST`` times or more in its language
scores floor(2000000 · a / (l + r)) at its worst cut. Wanted are each language's
first ``TOP`` phrases that no longer candidate (nearly as frequent) contains.

1. Words: texts become chunks of word codes, stored once (``phrase_words``);
   an aggregate of the chunks' words gives every word's count.
2. Roots: a word's own bound is the greatest possible score, so every root is
   expanded: pairs of frequent words are counted. Frequent words reach the tasks
   as a bitmap of at most 2^MOST_BITS bits; what it lets through by mistake is
   counted too and dropped by its count.
3. Bounds: every phrase that begins with q scores at most
   floor(2000000 · f(q) / (f(first word) + f(q))), since it occurs at most f(q)
   times and its rest at least as often as itself. The bound falls with growth.
4. Rounds: per language the frontier is expanded best first, down to the bound
   of its ``batch``-th pair: longer phrases are counted if they begin with a
   phrase of that bound or more, triples first, then quadruples below the
   triples. So all candidates that score the round's level or more are known.
   One more word on either side decides whether a candidate survives (a longer
   candidate around it would contain that one), so phrases that end with a
   candidate of the level are counted as well, and the last three words of a
   quadruple where its score needs them.
5. A language is settled when ``TOP`` survivors reach the level: whatever is not
   expanded scores less, so ties are complete too. The others go on with a batch
   twice as large (phrases counted before are not counted again), at last with
   level 0, which is everything.

Sets of phrases are sent to the tasks in slices of at most ``MOST_SENT``, each
its own pass over the chunks; counts are aggregated in the task first. Score
arithmetic is decimal, exact beyond 64 bits.

Defined cases. Null and empty texts have no words; a null language is ``und``
(and shares it with that label). Equal texts and repeated rows each count. A
text longer than a chunk is cut between pieces only, never inside one. Ties are
broken by count, then by the phrase's bytes. Languages without a survivor, and
empty tables, return no row. Other columns are not read, so they cannot clash.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import phrase_words as pw
from .common import scratch_path, stored, stored_and_seen, table

LEAST = 30
TOP = 2000
FACTOR = 2_000_000
#: A candidate goes if a longer one around it has this share of its count.
CONTAINED = 80
MOST_BITS = 27
MOST_SENT = 1 << 20
SEEDS = 8
CHUNKS_PER_FILE = 16


def _names(m: int, first: int = 1) -> list[str]:
    return [f"w{j}" for j in range(first, first + m)]


def _chunks(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stored chunks and the vocabulary (word, lang, f), from a seed under
    which no two words share a key."""
    spark = docs.sparkSession
    raw = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    for seed in range(SEEDS):
        path = scratch_path(spark, "chunks")
        # few rows a file: the scan holds the rows of a file together
        write = raw.mapInArrow(pw.to_chunks(seed), pw.CHUNKS).write.option("maxRecordsPerFile", CHUNKS_PER_FILE)
        write.option("compression", "zstd").parquet(path)
        chunks = spark.read.schema(pw.CHUNKS).parquet(path)
        listed = chunks.select("keys", "checks", "counts", "lang_key").mapInArrow(pw.vocabulary, pw.VOCABULARY)
        words = listed.groupBy("word").agg(
            F.min("lang").alias("lang"),
            F.sum("f").alias("f"),
            (F.min("check") != F.max("check")).alias("two"),
        )
        words, seen = stored_and_seen(words, "vocabulary", F.max("two").alias("two"))
        if not seen["two"] and not chunks.where("clash").select(F.lit(1)).head(1):
            return chunks, words.drop("two")
    raise RuntimeError("different words share a key under every seed")


def bitmap(rows: DataFrame, column: str) -> np.ndarray:
    """A bitmap of the leading bits of the keys: 64 bits a key, at most
    2^MOST_BITS. It has every key; beyond that size it lets through more others."""
    n = max(1, rows.count())
    bits = min(MOST_BITS, max(12, math.ceil(math.log2(64 * n))))
    at = F.expr(f"shiftrightunsigned({column}, {64 - bits})")
    marked = rows.select(at.alias("at")).selectExpr("shiftright(at, 6) AS cell", "shiftleft(1L, cast(at & 63 AS int)) AS bit")
    cells = marked.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return out


def score(a: str, l: str, r: str) -> str:  # noqa: E741
    whole = "decimal(20,0)"
    return f"CAST(CAST({a} AS {whole}) * {FACTOR} DIV (CAST({l} AS {whole}) + CAST({r} AS {whole})) AS bigint)"


def _cut(*cuts: tuple[str, str]) -> Column:
    """The lowest-scoring cut, the first of equal ones, as a struct."""
    return F.array_min(F.array(*[F.struct(F.expr(score("a", left, r)).alias("score"), F.lit(k).alias("k"), F.expr(left).alias("l"), F.expr(r).alias("r")) for k, (left, r) in enumerate(cuts)]))


def _scored(df: DataFrame, *cuts: tuple[str, str]) -> DataFrame:
    return df.withColumn("_cut", _cut(*cuts)).select("*", "_cut.score", "_cut.l", "_cut.r").drop("_cut").withColumn("bound", F.expr(score("a", "f1", "a")))


def _count(chunks: DataFrame, mapper, m: int) -> DataFrame:
    names = _names(m)
    rows = chunks.select("n", "keys", "codes").mapInArrow(mapper, pw.phrase_rows(m))
    return rows.groupBy(*names).agg(F.sum("a").alias("a"))


def _slices(phrases: DataFrame, m: int, exact: bool = False):
    """The phrases (w1 .. wm, begins, ends) as PhraseSets of at most about
    MOST_SENT. A longer phrase is found in the slice of its inner words, so what
    it begins with and what it ends with are known together."""
    names = _names(m)
    n = max(1, math.ceil(phrases.count() / MOST_SENT))
    for i in range(n):
        part = phrases
        if n > 1 and exact:
            part = phrases.where(F.pmod(F.xxhash64(*names), F.lit(n)) == i)
        elif n > 1:
            inner = lambda cols: F.pmod(F.xxhash64(*cols), F.lit(n)) == i  # noqa: E731, B023
            part = phrases.withColumn("begins", F.when(inner(names[1:]), F.col("begins")).otherwise(0))
            part = part.withColumn("ends", F.when(inner(names[:-1]), F.col("ends")).otherwise(0)).where("begins + ends > 0")
        found = part.toArrow()
        if found.num_rows:
            columns = [found[c].to_numpy().astype(np.int64).view(np.uint64) for c in names]
            yield pw.PhraseSet(columns, found["begins"].to_numpy(), found["ends"].to_numpy())


def _all(parts: list[DataFrame], empty: DataFrame) -> DataFrame:
    out = empty
    for p in parts:
        out = out.unionByName(p)
    return out


def _grown(chunks: DataFrame, phrases: DataFrame, m: int, name: str) -> DataFrame:
    """Counts (from LEAST) of the phrases one word longer that the states of
    ``phrases`` ask for."""
    empty = chunks.sparkSession.createDataFrame([], pw.phrase_rows(m + 1))
    parts = [_count(chunks, pw.longer_phrases(s), m + 1) for s in _slices(phrases, m)]
    return stored(_all(parts, empty).where(F.col("a") >= LEAST), name)


def _states(nodes: DataFrame, levels: DataFrame, m: int) -> DataFrame:
    """Of the open languages' phrases: to expand now (1) or expanded before (2),
    as a beginning by their bound and as an end by their score."""
    state = lambda v: F.when(F.col(v) < F.col("level"), 0).when(F.col(v) < F.col("before"), 1).otherwise(2).cast("int")
    found = nodes.join(levels, "lang").where("bound >= level")
    return stored(found.select(*_names(m), state("bound").alias("begins"), state("score").alias("ends")), "frontier")


def _survivors(phrases: DataFrame, longer: DataFrame, m: int) -> DataFrame:
    """Phrases that no candidate one word longer contains with CONTAINED % of
    their count."""
    names = _names(m)
    inside = [longer.select(*[F.col(w).alias(n) for w, n in zip(_names(m, first), names)], "a") for first in (1, 2)]
    most = inside[0].unionByName(inside[1]).groupBy(*names).agg(F.max("a").alias("most"))
    whole = lambda c: F.col(c).cast("decimal(20,0)")
    kept = phrases.join(most, names, "left").where(F.col("most").isNull() | (whole("most") * 100 < whole("a") * CONTAINED))
    return kept.drop("most")


def _next_levels(pairs: DataFrame, levels: DataFrame, batch: int) -> DataFrame:
    """(lang, level, before): the bound of the batch-th best pair, 0 if there
    are fewer. At most FACTOR / 2 different bounds a language are summed up."""
    seen = pairs.join(levels, "lang").groupBy("lang", "bound", "level").count()
    upto = F.sum("count").over(W.partitionBy("lang").orderBy(F.desc("bound")))
    reached = seen.withColumn("upto", upto).groupBy("lang", F.col("level").alias("before"))
    level = F.coalesce(F.max(F.when(F.col("upto") >= batch, F.col("bound"))), F.lit(0))
    return stored(reached.agg(level.cast("bigint").alias("level")), "levels")


def _result(levels: DataFrame, survivors: list[tuple[DataFrame, int]]) -> DataFrame:
    """Survivors that reach their language's level, as (lang, words, …)."""
    out = None
    for df, m in survivors:
        rows = df.join(levels.select("lang", "level"), "lang").where("score >= level")
        rows = rows.select("lang", F.array(*_names(m)).alias("words"), "a", "l", "r", "score")
        out = rows if out is None else out.unionByName(rows)
    return stored(out, "survivors")


def collocations(docs: DataFrame, top: int = TOP, batch: int | None = None) -> DataFrame:
    """`(lang, rank, phrase, a, l, r, n, score)` of the documents' `text`, per
    `lang`. ``batch``: pairs a language expands in the first round
    (three times ``top`` if not given)."""
    batch = batch or 3 * top
    chunks, words = _chunks(docs)
    often = words.where(F.col("f") >= LEAST)
    counted = _count(chunks, pw.pairs(bitmap(often, "word")), 2).where(F.col("a") >= LEAST)
    one = lambda k, *more: often.select(F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}"), *more)
    two = counted.join(one(1, "lang"), "w1").join(one(2), "w2")
    pairs = stored(_scored(two, ("f1", "f2")), "pairs")
    first = pairs.select("w1", "w2", "f1", "lang", F.col("a").alias("a12"))
    last = lambda k: pairs.select(F.col("w1").alias(f"w{k}"), F.col("w2").alias(f"w{k + 1}"), F.col("a").alias(f"a{k}{k + 1}"), F.col("f2").alias(f"f{k + 1}"))

    levels = stored(pairs.select("lang").distinct().withColumn("level", F.lit(FACTOR).cast("bigint")), "levels")
    triples: list[DataFrame] = []
    quads: list[DataFrame] = []
    done: list[DataFrame] = []
    while levels.head(1):
        levels = _next_levels(pairs, levels, batch)
        grown = _grown(chunks, _states(pairs, levels, 2), 2, "triples")
        three = grown.join(first, ["w1", "w2"]).join(last(2), ["w2", "w3"])
        triples.append(stored(_scored(three, ("f1", "a23"), ("a12", "f3")), "scored-triples"))
        all_three = _all(triples[1:], triples[0])
        quads.append(_grown(chunks, _states(all_three, levels, 3), 3, "quads"))
        all_four = _all(quads[1:], quads[0])
        four = _four(chunks, all_four, all_three, last, levels)
        kept = [(_survivors(pairs, all_three, 2), 2), (_survivors(all_three, all_four, 3), 3), (four, 4)]
        found = _result(levels, kept)
        enough = found.groupBy("lang").count().where(F.col("count") >= top)
        settled = stored(levels.join(enough, "lang", "left").where("level = 0 OR count IS NOT NULL").select("lang"), "settled")
        done.append(found.join(settled, "lang", "left_semi"))
        levels = stored(levels.join(settled, "lang", "left_anti"), "levels")
        batch *= 2
    return _named(chunks, words, done, top)


def _four(chunks: DataFrame, quads: DataFrame, triples: DataFrame, last, levels: DataFrame) -> DataFrame:
    """Quadruples of the open languages that reach the level, scored."""
    begins = triples.join(levels.select("lang", "level"), "lang").where("bound >= level")
    begins = begins.select("w1", "w2", "w3", "lang", "level", "f1", F.col("a").alias("a123"), F.col("a12"))
    known = triples.select(*[F.col(f"w{j}").alias(f"w{j + 1}") for j in (1, 2, 3)], F.col("a").alias("a234"))
    four = quads.join(begins, ["w1", "w2", "w3"]).join(last(3), ["w3", "w4"])
    four = four.where(f"least({score('a', 'a12', 'a34')}, {score('a', 'a123', 'f4')}) >= level")
    four = stored(four.join(known, ["w2", "w3", "w4"], "left"), "quads-to-score")
    # the last three words where no expanded phrase has counted them
    missing = four.where("a234 IS NULL").select(*[F.col(f"w{j + 1}").alias(f"w{j}") for j in (1, 2, 3)]).distinct()
    missing = stored(missing.select("*", F.lit(1).alias("begins"), F.lit(1).alias("ends")), "rests")
    rests = _all([_count(chunks, pw.same_phrases(s), 3) for s in _slices(missing, 3, exact=True)], chunks.sparkSession.createDataFrame([], pw.phrase_rows(3)))
    rests = rests.select(*[F.col(f"w{j}").alias(f"w{j + 1}") for j in (1, 2, 3)], F.col("a").alias("rest"))
    four = four.join(rests, ["w2", "w3", "w4"], "left").withColumn("a234", F.coalesce("a234", "rest"))
    return _scored(four.drop("level"), ("f1", "a234"), ("a12", "a34"), ("a123", "f4"))


def _named(chunks: DataFrame, words: DataFrame, done: list[DataFrame], top: int) -> DataFrame:
    """The first ``top`` rows of each language, spelled out."""
    labels = chunks.select("lang", F.col("lang_key")).distinct()
    total = words.groupBy(F.col("lang").alias("lang_key")).agg(F.sum("f").alias("n"))
    nothing = chunks.sparkSession.createDataFrame([], "lang long, words array<long>, a long, l long, r long, score long")
    best = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    ranked = _all(done, nothing).withColumn("_rank", F.rank().over(best)).where(F.col("_rank") <= top).drop("_rank")
    ranked = stored(ranked.withColumnRenamed("lang", "lang_key").withColumn("id", F.monotonically_increasing_id()), "ranked")
    needed = ranked.select(F.explode("words").alias("word")).distinct()
    found = chunks.select("keys", "lengths", "words").mapInArrow(pw.spelled(bitmap(needed, "word")), pw.SPELLED)
    found = found.join(needed, "word", "left_semi").distinct()
    each = ranked.select("id", F.posexplode("words").alias("place", "word")).join(found, "word")
    spelled = each.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("place", F.col("spelling").cast("string").alias("s")))).alias("parts"))
    phrase = F.array_join(F.transform("parts", lambda p: p["s"]), " ")
    rows = ranked.join(spelled, "id").join(labels, "lang_key").join(total, "lang_key").withColumn("phrase", phrase)
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))

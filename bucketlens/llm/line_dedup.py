"""Line dedup: repeated line runs by prefix doubling (operator 5).

The documents, one after the other, are a sequence of line ids. A run of lines
of at least ``min_words`` words that occurs again is deleted at every later
place, in the order (doc_id, row, line); its first occurrence stays.

1. Line ids: 128-bit hashes. Only lines that occur twice go on.
2. Suffix ranks by distributed prefix doubling: round k sorts the pairs
   (rank of the 2^k lines from here, rank of the 2^k lines after them); equal
   pairs get one rank, in the order of the sort, so suffixes with one rank are
   an interval of the suffix array with a longest common prefix of at least
   2^(k+1) lines. Suffixes that are alone in their interval drop out. The sort
   is a range partitioning of the distinct pairs, never of one task.
3. LCP intervals at the threshold: from every position runs the shortest run of
   ``min_words`` words, forwards, and to every position one, backwards. A run
   of m lines is named by the two ranks of 2^k ≤ m lines that cover it, so runs
   with one name are the suffixes whose common prefix reaches the threshold.
   Every longer repeated run is the union of such runs (a forward one at its
   start, a backward one at every later end), so their union is exactly what
   the maximal repeated runs cover.
4. In every interval the first occurrence stays; all others are deleted, and
   adjoining deletions merge into maximal runs.

Only DataFrame functions are used. A hot line or passage meets in a sum or
minimum that is combined before the shuffle, or in a join that adaptive
execution splits. Windows run over one document's lines only.

Null texts stay null and have no lines; an empty text is one empty line. Blank
lines count no words but belong to a run like any other. Repeated rows are
copies of each other: the later ones lose their long runs. Ties in doc_id are
broken by the row's place. An empty table gives an empty one. A very long text is
only a document of many lines, and a very long line is its hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD_PATTERN, stored, table

MIN_WORDS = 50


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a row number ``_row``, stored: the number is fixed."""
    return stored(docs.withColumn("_row", F.monotonically_increasing_id()), "line-docs")


def repeated_lines(rows: DataFrame) -> DataFrame:
    """`(doc_id, _row, line, words, rank)`: the lines that occur at least
    twice, ranked in the order of their hashes; stored."""
    lines = rows.select("doc_id", "_row", F.posexplode(F.split("text", "\n", -1)).alias("line", "s"))
    lines = lines.select(
        "doc_id",
        "_row",
        "line",
        F.regexp_count("s", F.lit(WORD_PATTERN)).alias("words"),
        F.xxhash64("s").alias("a"),
        F.xxhash64(F.lit("line"), F.col("s")).alias("b"),
    )
    lines = stored(lines, "lines")
    names = lines.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")
    ranks = names.orderBy("a", "b").select("a", "b", F.monotonically_increasing_id().alias("rank"))
    ranks = stored(ranks, "line-ranks")
    return stored(lines.join(ranks, ["a", "b"]).select("doc_id", "_row", "line", "words", "rank"), "repeated-lines")


def doubled(level: DataFrame, k: int) -> DataFrame:
    """`(_row, line, rank)` of the 2^(k+1) lines from each place, from those
    of 2^k lines; only names that occur at least twice."""
    step = 1 << k
    here = W.partitionBy("_row").orderBy("line").rangeBetween(step, step)
    pairs = level.select("_row", "line", F.col("rank").alias("r1"), F.max("rank").over(here).alias("r2")).where("r2 is not null")
    names = pairs.groupBy("r1", "r2").agg(F.count("*").alias("n")).where("n > 1")
    ranks = names.orderBy("r1", "r2").select("r1", "r2", F.monotonically_increasing_id().alias("rank"))
    ranks = stored(ranks, "pair-ranks")
    return stored(pairs.join(ranks, ["r1", "r2"]).select("_row", "line", "rank"), "suffix-ranks")


def suffix_ranks(lines: DataFrame, longest: int) -> DataFrame:
    """`(k, _row, line, rank)` for every k with 2^k ≤ ``longest``."""
    level = lines.select("_row", "line", "rank")
    out = level.withColumn("k", F.lit(0))
    k = 0
    while 1 << (k + 1) <= longest:
        level = doubled(level, k)
        k += 1
        out = out.unionByName(level.withColumn("k", F.lit(k)))
    return out


def shortest_runs(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`(doc_id, _row, backward, first, last)`: for every repeated line the
    shortest run of at least ``min_words`` words that starts there, and the one
    that ends there, inside a stretch of repeated lines."""
    in_row = W.partitionBy("_row").orderBy("line")
    stretch = lines.withColumn("stretch", F.col("line") - F.row_number().over(in_row))
    in_stretch = W.partitionBy("_row", "stretch").orderBy("line")
    sums = stretch.withColumn("after", F.sum("words").over(in_stretch.rowsBetween(W.unboundedPreceding, 0)))
    sums = sums.withColumn("before", F.col("after") - F.col("words"))
    # a start with ``before`` b reaches the first end with after >= b + min_words
    # and an end with ``after`` a the last start with before <= a - min_words
    starts = F.struct(F.col("before").alias("at"), F.lit(False).alias("is_end"))
    ends = F.struct((F.col("after") - min_words).alias("at"), F.lit(True).alias("is_end"))
    marks = sums.select("doc_id", "_row", "stretch", "line", F.explode(F.array(starts, ends)).alias("m"))
    marks = marks.select("doc_id", "_row", "stretch", "line", "m.at", "m.is_end")
    by_words = W.partitionBy("_row", "stretch").orderBy("at")
    end_line, start_line = F.when(F.col("is_end"), F.col("line")), F.when(~F.col("is_end"), F.col("line"))
    met = marks.select(
        "doc_id",
        "_row",
        "line",
        "is_end",
        F.min(end_line).over(by_words.rangeBetween(0, W.unboundedFollowing)).alias("to"),
        F.max(start_line).over(by_words.rangeBetween(W.unboundedPreceding, 0)).alias("from"),
    )
    runs = met.select(
        "doc_id",
        "_row",
        F.col("is_end").alias("backward"),
        F.when(F.col("is_end"), F.col("from")).otherwise(F.col("line")).alias("first"),
        F.when(F.col("is_end"), F.col("line")).otherwise(F.col("to")).alias("last"),
    )
    return runs.where("first is not null and last is not null")


def later_runs(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`(_row, first, last)`: the shortest runs that have an earlier copy."""
    runs = stored(shortest_runs(lines, min_words).withColumn("m", F.col("last") - F.col("first") + 1), "runs")
    longest = runs.agg(F.max("m")).first()[0] or 0  # one number: how often to double
    ranks = suffix_ranks(lines, longest)
    k = F.floor(F.log2(F.col("m") + F.lit(0.5))).cast("int")
    sized = runs.withColumn("k", k).withColumn("second", F.col("last") + 1 - F.expr("shiftleft(1, k)"))
    left = ranks.select("k", "_row", F.col("line").alias("first"), F.col("rank").alias("r1"))
    right = ranks.select("k", "_row", F.col("line").alias("second"), F.col("rank").alias("r2"))
    named = stored(sized.join(left, ["k", "_row", "first"]).join(right, ["k", "_row", "second"]), "named-runs")
    name = ["backward", "m", "r1", "r2"]
    place = F.struct("doc_id", "_row", "first")
    # stored, so that the join has an exchange of its own and can split a hot run
    intervals = stored(named.groupBy(name).agg(F.min(place).alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n"), "intervals")
    return named.join(intervals, name).where(place != F.col("kept")).select("_row", "first", "last")


def deleted_runs(runs: DataFrame) -> DataFrame:
    """`(_row, runs)`: overlapping and adjoining runs merged, as a sorted array
    of (first, last) per document."""
    order = W.partitionBy("_row").orderBy("first", "last")
    until = F.max("last").over(order.rowsBetween(W.unboundedPreceding, -1))
    marked = runs.distinct().withColumn("new", F.when(until.isNull() | (F.col("first") > until + 1), 1).otherwise(0))
    marked = marked.withColumn("island", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    merged = marked.groupBy("_row", "island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return merged.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every row of ``docs`` plus ``_lines`` (how many it had), ``_runs`` (the
    deleted runs) and ``_text`` (what is left; null if nothing is). All other
    columns pass through in a struct, whatever they are called; only columns of
    those three names are replaced."""
    added = ["_lines", "_runs", "_text"]
    others = [c for c in docs.columns if c not in ("doc_id", "text", *added)]
    rest = F.struct(*[F.col(f"`{c}`") for c in others], F.lit(True).alias("_always"))
    rows = numbered(docs.select("doc_id", "text", rest.alias("_rest")))
    runs = deleted_runs(later_runs(repeated_lines(rows.select("doc_id", "_row", "text")), min_words))
    joined = rows.join(runs.withColumnRenamed("runs", "_runs"), "_row", "left").withColumn("_split", F.split("text", "\n", -1))
    total = F.size("_split")
    # the kept pieces lie between the end of one run and the start of the next
    starts = F.concat(F.array(F.lit(0)), F.transform("_runs", lambda r: r["last"] + 1))
    ends = F.concat(F.transform("_runs", lambda r: r["first"]), F.array(total))
    pieces = F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda p: F.slice("_split", p["s"] + 1, p["e"] - p["s"]))
    left = F.flatten(pieces)
    text = F.when(F.col("_runs").isNull(), F.col("text")).when(F.size(left) > 0, F.array_join(left, "\n"))
    out = joined.withColumns({"_lines": F.coalesce(total, F.lit(0)), "_text": text})
    own = [F.col(c) if c in ("doc_id", "text") else F.col("_rest").getField(c).alias(c) for c in docs.columns if c not in added]
    return out.select(*own, *added)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    deleted = F.aggregate("_runs", F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
    shown = F.transform("_runs", lambda r: F.concat_ws("-", r["first"].cast("string"), r["last"].cast("string")))
    return done.select(
        "doc_id",
        F.col("_lines").cast("bigint").alias("n_lines"),
        F.coalesce(deleted, F.lit(0)).cast("bigint").alias("n_deleted"),
        F.coalesce(F.array_join(shown, ","), F.lit("")).alias("deleted_runs"),
        F.md5(F.coalesce("_text", F.lit("")).cast("binary")).alias("text_md5"),
    )

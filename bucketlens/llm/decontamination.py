"""Benchmark decontamination: a positional inverted index (operator 10).

1. Index: one pass over the documents stores the postings (term, document,
   position) of every training token that some benchmark item holds; other
   terms can never be part of a match. The stored table is the index; it is
   ordered by document as it is read, so it compresses well.
2. Plan: every window of ``window`` consecutive words of an item (or the whole
   item, if it is shorter) is a phrase. Its ``anchors`` rarest terms, by their
   frequency in the index, stand for it.
3. Search: the posting lists of the anchors, moved by the anchor's place in the
   phrase, are intersected: a start is a candidate if all anchors agree on it.
4. Proof: the candidate's words in the document are compared with the phrase.

Only DataFrame functions are used. Terms are 64-bit hashes up to step 4, which
compares words. A posting list of a very frequent word is read only if all the
words of some phrase are at least as frequent.

Null and empty texts have no words, no windows and no hits. A null item_id
counts as the id ''. Items that repeat an id are one item with the windows of
all of them. Repeated document rows get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, stored, table

WINDOW = 10
ANCHORS = 2
#: Benchmark-side tables up to this many rows are sent to every task; larger
#: ones are joined by shuffle, with the same result.
BROADCAST_ROWS = 500_000

# Fixed value: what separates words (a word is a run of anything else).
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case; an empty array for null."""
    words = F.split(lower_ascii(text), _BREAK, -1)
    return F.coalesce(F.filter(words, lambda w: w != ""), F.array().cast("array<string>"))


def _document_key(docs: DataFrame) -> DataFrame:
    """`(doc_id, uid, text)`: rows with equal keys are equal."""
    return docs.select("doc_id", F.xxhash64("text").alias("uid"), "text")


def _sent(df: DataFrame) -> DataFrame:
    """Marked for broadcast if its size, counted first, is within the bound."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def build_index(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """The stored index `(doc_id, uid, pos, term)`; ``terms`` (a column
    ``term``) keeps the postings of those terms only."""
    words = F.split(lower_ascii(F.col("text")), _BREAK, -1)
    split = _document_key(docs).select("doc_id", "uid", words.alias("words"))
    # only the first and the last piece of a split can be empty
    lead = F.when(F.get("words", F.lit(0)) == "", 1).otherwise(0)
    tokens = split.select("doc_id", "uid", lead.alias("lead"), F.posexplode("words").alias("pos", "word")).where("word != ''")
    postings = tokens.select("doc_id", "uid", (F.col("pos") - F.col("lead")).alias("pos"), F.xxhash64("word").alias("term"))
    if terms is not None:
        postings = postings.join(_sent(terms.select("term")), "term", "left_semi")
    return stored(postings.select("doc_id", "uid", "pos", "term"), "postings")


def item_terms(items: DataFrame) -> DataFrame:
    """`(term)`: the distinct terms of the items, stored."""
    return stored(items.select(F.explode(words_of(F.col("text"))).alias("w")).select(F.xxhash64("w").alias("term")).distinct(), "item-terms")


def item_phrases(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """`(phrase_id, words)` of the distinct phrases, and `(phrase, item_id)`
    pairs; a phrase is its words joined by spaces."""
    own = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words_of(F.col("text")).alias("w"))
    own = own.where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - window))
    cut = own.select("item_id", "w", F.explode(starts).alias("s")).select("item_id", F.slice("w", F.col("s") + 1, window).alias("words"))
    pairs = cut.select(F.array_join("words", " ").alias("phrase"), "item_id").distinct()
    phrases = stored(cut.select("words").distinct(), "phrases")
    # stored rows are fixed, so their ids are the same in every reading
    return stored(phrases.select(F.monotonically_increasing_id().alias("phrase_id"), "words"), "phrase-ids"), stored(pairs, "phrase-items")


def anchor_terms(phrases: DataFrame, index: DataFrame, anchors: int = ANCHORS) -> DataFrame:
    """`(term, phrase_id, offset, k, n_anchors, n_phrase)`: the rarest terms of
    every phrase that can occur (all of its terms are in the index), numbered
    by k."""
    frequency = index.groupBy("term").agg(F.count("*").alias("n"))
    each = phrases.select("phrase_id", F.size("words").alias("n_phrase"), F.posexplode("words").alias("offset", "word"))
    each = each.select("phrase_id", "n_phrase", "offset", F.xxhash64("word").alias("term"))
    ranked = each.join(frequency, "term").groupBy("phrase_id", "n_phrase").agg(
        F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("by_n")  # at most ``window`` entries
    )
    ranked = ranked.where(F.size("by_n") == F.col("n_phrase"))
    chosen = F.slice("by_n", 1, anchors)
    rows = ranked.select("phrase_id", "n_phrase", F.size(chosen).alias("n_anchors"), F.posexplode(chosen).alias("k", "a"))
    return stored(rows.select("a.term", "phrase_id", "a.offset", "k", "n_anchors", "n_phrase"), "anchors")


def candidates(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """`(doc_id, uid, phrase_id, n_phrase, start)`: where the moved posting
    lists of all anchors of a phrase meet."""
    moved = index.join(_sent(anchors), "term").select(
        "doc_id", "uid", "phrase_id", "n_phrase", "n_anchors", (F.col("pos") - F.col("offset")).alias("start"), F.expr("shiftleft(1, k)").alias("bit")
    )
    # one bit an anchor: repeated document rows set the same bits again
    met = moved.where("start >= 0").groupBy("doc_id", "uid", "phrase_id", "n_phrase", "n_anchors", "start").agg(F.bit_or("bit").alias("bits"))
    return met.where("bits = shiftleft(1, n_anchors) - 1").drop("bits", "n_anchors")


def phrase_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, anchors: int = ANCHORS) -> DataFrame:
    """One row per document row: `(doc_id, uid, n_words, matches)`, where uid is
    the hash of the text and matches an array of (start, n_phrase, phrase),
    proven and sorted."""
    index = build_index(docs, item_terms(items))
    phrases, _ = item_phrases(items, window)
    found = candidates(index, anchor_terms(phrases, index, anchors))
    known = phrases.select("phrase_id", F.xxhash64(F.array_join("words", " ")).alias("phrase_hash"))
    found = found.join(_sent(known), "phrase_id")
    per_doc = found.groupBy("doc_id", "uid").agg(F.collect_list(F.struct("start", "n_phrase", "phrase_hash")).alias("found"))
    per_doc = per_doc.withColumnsRenamed({"doc_id": "_doc", "uid": "_uid"})
    rows = _document_key(docs)
    joined = rows.join(per_doc, rows["doc_id"].eqNullSafe(per_doc["_doc"]) & (rows["uid"] == per_doc["_uid"]), "left")
    own = joined.select("doc_id", "uid", words_of(F.col("text")).alias("words"), "found")
    said = F.transform(
        "found",
        lambda c: F.struct(
            c["start"].alias("start"),
            c["n_phrase"].alias("n_phrase"),
            F.array_join(F.slice("words", c["start"] + 1, c["n_phrase"]), " ").alias("phrase"),
            c["phrase_hash"].alias("phrase_hash"),
        ),
    )
    proven = F.filter(said, lambda c: F.xxhash64(c["phrase"]) == c["phrase_hash"])
    matches = F.transform(proven, lambda c: F.struct(c["start"].alias("start"), c["n_phrase"].alias("n_phrase"), c["phrase"].alias("phrase")))
    return own.select("doc_id", "uid", F.size("words").cast("bigint").alias("n_words"), F.array_sort(F.array_distinct(matches)).alias("matches"))


def proximity_matches(docs: DataFrame, items: DataFrame, terms: int = 3, span: int = 20) -> DataFrame:
    """`(doc_id, item_id, pos)`: places of an item's rarest term where its
    ``terms`` rarest distinct terms all lie within ``span`` words, in any
    order. Items with fewer distinct terms need all they have."""
    index = build_index(docs, item_terms(items))
    frequency = index.groupBy("term").agg(F.count("*").alias("n"))
    own = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.explode(words_of(F.col("text"))).alias("w"))
    own = own.select("item_id", F.xxhash64("w").alias("term")).distinct()
    # a term without a posting counts as the rarest, so its item has no match
    ranked = own.join(frequency, "term", "left").groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term"))).alias("by_n"))
    chosen = ranked.select("item_id", F.posexplode(F.slice("by_n", 1, terms)).alias("k", "t"), F.least(F.size("by_n"), F.lit(terms)).alias("need"))
    chosen = _sent(stored(chosen.select("item_id", "k", "need", F.col("t.term").alias("term")), "near-terms"))
    hits = index.join(chosen, "term").withColumn("block", F.floor(F.col("pos") / span))
    first = hits.where("k = 0").select("doc_id", "uid", "item_id", "need", F.col("pos").alias("at"), F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)).alias("block"))
    others = hits.where("k > 0").select("doc_id", "uid", "item_id", "block", "pos", "k").withColumnRenamed("doc_id", "_doc")
    same = first["doc_id"].eqNullSafe(others["_doc"])
    joined = first.join(
        others,
        same & (first["uid"] == others["uid"]) & (first["item_id"] == others["item_id"]) & (first["block"] == others["block"])
        & (F.abs(first["at"] - others["pos"]) < span),
        "left",
    ).select(first["doc_id"], first["uid"], first["item_id"], "need", "at", "k")
    near = joined.groupBy("doc_id", "uid", "item_id", "need", "at").agg(F.count_distinct("k").alias("n"))
    return near.where("n >= need - 1").select("doc_id", "item_id", F.col("at").alias("pos"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, anchors: int = ANCHORS) -> DataFrame:
    """`(doc_id, uid, n_words, n_hit, n_items, items, contaminated)` per document
    row (uid: the hash of its text); ``items`` is the sorted array of ids with an occurring window."""
    matched = phrase_matches(docs, items, window, anchors)
    _, pairs = item_phrases(items, window)
    # every match names its items; both sides are keyed by the phrase itself
    found = stored(matched.withColumn("_row", F.monotonically_increasing_id()), "matches")
    each = found.where(F.size("matches") > 0).select("_row", F.explode("matches").alias("m"))
    named = each.select("_row", F.col("m.phrase").alias("phrase")).distinct().join(_sent(pairs), "phrase")
    per_row = named.groupBy("_row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    places = F.flatten(F.transform("matches", lambda m: F.sequence(m["start"], m["start"] + m["n_phrase"] - 1)))
    n_hit = F.coalesce(F.size(F.array_distinct(places)), F.lit(0)).cast("bigint")
    out = found.select("_row", "doc_id", "uid", "n_words", F.when(F.size("matches") > 0, n_hit).otherwise(0).alias("n_hit")).join(per_row, "_row", "left")
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "uid", "n_words", "n_hit", F.size(items_).cast("bigint").alias("n_items"), items_.alias("items"), (F.col("n_hit") > 0).alias("contaminated"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return out.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")

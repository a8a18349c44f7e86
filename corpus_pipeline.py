"""From raw documents to packed training batches, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result to the shared folder and reads it again as the next one's input.
All stages but the last return the columns of their input.

The scratch tables of a stage are deleted when the next one begins: by then its
result has been written and read again. So a stage's result must be written
before the next stage is called on it, and a thread runs one pipeline at a time.

Nulls, ties, repeated rows and empty tables are the operators' cases: every stage
takes null ids and texts, keeps the columns of any name, decides equal rows alike
(the join keeps one of them), and turns an empty table into an empty one.
"""

from __future__ import annotations

import functools
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bucketlens.llm.common import delete_scratch, noted_scratch, stored, table
from bucketlens.llm.decontamination import decontaminate
from bucketlens.llm.jaccard_join import near_duplicates
from bucketlens.llm.line_dedup import dedup_lines
from bucketlens.llm.packing import pack
from bucketlens.llm.quality import LANGUAGE_BANDS, quality_rules
from bucketlens.session import ship_package


_MADE: dict[tuple, list[str]] = {}


def _after(previous: str | None):
    """A stage that first deletes what the stage of that name has left."""
    def wrap(stage):
        @functools.wraps(stage)
        def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            here = (spark.sparkContext.applicationId, threading.get_ident())
            delete_scratch(spark, _MADE.pop((*here, previous), []))
            with noted_scratch() as made:
                out = stage(spark, docs, sf_dir)
            _MADE.setdefault((*here, stage.__name__), []).extend(made)
            return out

        return run

    return wrap


def _folded(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns, and all others in one struct ``rest``, so that no
    other column of the table can clash with what an operator adds."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    return docs.select(*names, F.struct(*others, F.lit(True).alias("_always")).alias("rest"))


def _unfolded(df: DataFrame, columns: list[str], *names: str) -> DataFrame:
    return df.select(*[F.col(c) if c in names else F.col("rest").getField(c).alias(c) for c in columns])


@_after(None)
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go (operator 8)."""
    ship_package(spark)
    names = [c for c in ("doc_id", "text", "lang") if c in docs.columns]
    judged = quality_rules(_folded(docs, *names), language_bands=LANGUAGE_BANDS, lang="lang" if "lang" in names else None)
    return _unfolded(judged.where("_quality.kept"), docs.columns, *names)


@_after("quality")
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go from the texts; a document of
    which nothing is left goes too (operator 5)."""
    names = ["doc_id", "text"]
    done = dedup_lines(_folded(docs, *names)).withColumn("text", F.col("_text")).where("text is not null")
    out = _unfolded(done, docs.columns, *names)
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out


@_after("lines")
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays (operator 1)."""
    ship_package(spark)
    found = near_duplicates(docs)
    kept = found.where("is_kept").select(F.col("doc_id").alias("_doc"), F.col("text_id").alias("_text")).distinct()
    keyed = _folded(docs, "doc_id", "text").withColumn("_key", F.xxhash64("text"))
    joined = keyed.join(kept, keyed["doc_id"].eqNullSafe(kept["_doc"]) & (keyed["_key"] == kept["_text"]), "left_semi")
    # repeated rows of the document that stays are copies as well; texts
    # without a word are in no class of copies and all stay
    words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    alone = F.when(words, F.lit(-1)).otherwise(F.monotonically_increasing_id())
    out = joined.withColumn("_alone", alone).dropDuplicates(["doc_id", "_key", "_alone"])
    return _unfolded(out, docs.columns, "doc_id", "text")


@_after("near_copies")
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go (operator 10)."""
    judged = decontaminate(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    bad = judged.where("contaminated").select(F.col("doc_id").alias("_doc"), F.col("uid").alias("_uid")).distinct()
    keyed = _folded(docs, "doc_id", "text").withColumn("_key", F.xxhash64("text"))
    same = keyed["doc_id"].eqNullSafe(bad["_doc"]) & (keyed["_key"] == bad["_uid"])
    kept = keyed.join(bad, same, "left_anti")
    return _unfolded(kept, docs.columns, "doc_id", "text")


@_after("benchmark")
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and token-budget batches (operator 2)."""
    return pack(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark),
    ("packing", packing),
]

#: The join and the packing plan are no SQL; tests hold ``run`` against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{i + 1}")
    return docs

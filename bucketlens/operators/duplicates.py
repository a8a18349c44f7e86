"""Duplicate objects by content.

Three fingerprints, each computed for all objects in one Spark job (the
reference ran one job per file):

* ``lines``: the multiset of non-empty lines — line order, LF/CRLF, blank
  lines and gzip compression do not matter (the reference's semantics). Each
  line contributes the MD5 of its UTF-8 bytes, cut into pieces that are summed
  exactly; sums commute, so the aggregate is combined map-side and a huge
  object is spread over many tasks. No line list is ever collected.
* ``lines_fast``: the same with two seeded 64-bit xxhash values per line
  (cheaper than MD5, still 128 bits per line).
* ``bytes``: MD5 of the exact bytes. Only objects whose size occurs more than
  once are hashed at all; zero-byte objects need no read.

``checksum`` is the digest of an object's fingerprint: equal content has equal
checksums in every run, so new objects can be compared with old results.
``class_id`` is the smallest `bucket/key` path of a class in this run. Copies
are reported one row per object with the class size — a class of millions of
copies is never collected into one row or one task; class ids are an aggregate
joined back (adaptive execution splits a hot class or broadcasts the small
side).

What is not known is never called a copy: an object with a size but without a
line read, or without a size, has a NULL checksum, class and count. An object
that is listed twice is an error (keep the latest version: ``read_inventory``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fingerprint import pieces
from ..functions.paths import object_path

LINE_MODES = ("lines", "lines_fast")
# Fixed value: MD5 of zero bytes.
EMPTY_MD5 = "d41d8cd98f00b204e9800998ecf8427e"


def line_signatures(lines: DataFrame, mode: str = "lines") -> DataFrame:
    """``(bucket_name, key, _n, _s0 … _s5)`` per object with ≥ 1 line; blank
    lines add nothing."""
    filled = F.col("line") != ""
    aggs = [F.count_if(filled).alias("_n")]
    aggs += [F.coalesce(F.sum(F.when(filled, p)), F.lit(0)).cast("bigint").alias(f"_s{i}")
             for i, p in enumerate(pieces(F.col("line"), mode))]
    return lines.groupBy("bucket_name", "key").agg(*aggs)


def one_row_per_key(objects: DataFrame) -> DataFrame:
    """``(bucket_name, key, size)``; a key that is listed twice is an error. A
    table without sizes gives NULL sizes."""
    size = F.col("size") if "size" in objects.columns else F.lit(None).cast("bigint")
    per_key = objects.groupBy("bucket_name", "key").agg(F.max(size).alias("size"), F.count(F.lit(1)).alias("_k"))
    twice = F.raise_error(F.concat(F.lit("object listed twice: "), object_path(F.col("bucket_name"), F.col("key"))))
    return per_key.select("bucket_name", "key", F.when(F.col("_k") == 1, F.col("size")).otherwise(twice.cast("bigint")).alias("size"))


def _classes(fp: DataFrame) -> DataFrame:
    """``(bucket_name, key, checksum, class_id, n_copies)`` from ``(bucket_name,
    key, size, checksum)`` rows (``size`` tells unequal contents apart early)."""
    path = object_path(F.col("bucket_name"), F.col("key"))
    per_class = fp.groupBy("size", "checksum").agg(F.min(path).alias("class_id"), F.count(F.lit(1)).alias("n_copies"))
    return fp.join(per_class, ["size", "checksum"]).select("bucket_name", "key", "checksum", "class_id", "n_copies")


def _unknown(rows: DataFrame) -> DataFrame:
    none = F.lit(None)
    return rows.select("bucket_name", "key", none.cast("string").alias("checksum"), none.cast("string").alias("class_id"),
                       none.cast("bigint").alias("n_copies"))


def line_classes(objects: DataFrame, lines: DataFrame, mode: str = "lines") -> DataFrame:
    """Every object of ``objects`` ``(bucket_name, key, size)`` with its
    checksum and class under a line fingerprint. Objects without any non-empty
    line (zero-byte, by their size, or blank-only) are one class."""
    if mode not in LINE_MODES:
        raise ValueError(f"mode must be one of {LINE_MODES}, got {mode!r}")
    sig = line_signatures(lines, mode)
    cols = [c for c in sig.columns if c.startswith("_")]
    own = one_row_per_key(objects).join(sig, ["bucket_name", "key"], "left")
    read = F.col("_n").isNotNull() | (F.col("size") == 0)
    digest = F.md5(F.concat_ws(",", *[F.coalesce(F.col(c), F.lit(0)).cast("string") for c in cols]))
    fp = own.select("bucket_name", "key", F.lit(0).alias("size"), F.when(F.coalesce(read, F.lit(False)), digest).alias("checksum"))
    known = fp.where(F.col("checksum").isNotNull())
    return _classes(known).unionByName(_unknown(fp.where(F.col("checksum").isNull())))


def content_fingerprint(objects: DataFrame, lines: DataFrame, mode: str = "lines") -> DataFrame:
    """A-11: ``(bucket_name, key, checksum, class_id)`` for every object."""
    return line_classes(objects, lines, mode).select("bucket_name", "key", "checksum", "class_id")


def _ordered(classes: DataFrame) -> DataFrame:
    return classes.select("checksum", "class_id", "n_copies", "bucket_name", "key").orderBy(
        F.desc("n_copies"), "class_id", "bucket_name", "key"
    )


def duplicate_files(objects: DataFrame, lines: DataFrame, mode: str = "lines") -> DataFrame:
    """A-9: objects that have at least one copy, one row each, largest classes
    first: ``(checksum, class_id, n_copies, bucket_name, key)``."""
    return _ordered(line_classes(objects, lines, mode).where(F.col("n_copies") > 1))


def checksum_groups(objects: DataFrame, lines: DataFrame, mode: str = "lines") -> DataFrame:
    """A-10: the members of every checksum group, singletons included, one row
    per object: ``(checksum, class_id, n_copies, bucket_name, key)``."""
    return _ordered(line_classes(objects, lines, mode))


def byte_classes(objects: DataFrame, checksums) -> DataFrame:
    """Every object with its class by exact bytes.

    ``objects`` is ``(bucket_name, key, size)``; ``checksums`` maps a
    DataFrame of candidates ``(bucket_name, key, size)`` to ``(bucket_name,
    key, size, checksum)``. It is only asked for objects whose size occurs more
    than once and is not 0; an object with a unique size is its own class
    without being read (its checksum stays NULL).
    """
    objects = one_row_per_key(objects)
    per_size = objects.groupBy("size").agg(F.count(F.lit(1)).alias("_k"))
    sized = objects.join(per_size, "size")
    candidates = sized.where(F.col("_k") > 1).select("bucket_name", "key", "size")
    empty = candidates.where(F.col("size") == 0).withColumn("checksum", F.lit(EMPTY_MD5))
    hashed = checksums(candidates.where(F.col("size") != 0))
    both = empty.unionByName(hashed.select("bucket_name", "key", "size", "checksum"))
    alone = sized.where(F.col("_k") == 1).select(
        "bucket_name", "key", F.lit(None).cast("string").alias("checksum"),
        object_path(F.col("bucket_name"), F.col("key")).alias("class_id"), F.lit(1).cast("bigint").alias("n_copies"),
    )
    return _classes(both).unionByName(alone).unionByName(_unknown(objects.where(F.col("size").isNull())))


def duplicate_files_bytes(objects: DataFrame, checksums) -> DataFrame:
    """Duplicates by exact bytes, as ``duplicate_files``."""
    return _ordered(byte_classes(objects, checksums).where(F.col("n_copies") > 1))


def md5_of_column(contents: DataFrame, column: str = "content"):
    """A ``checksums`` function for contents already held in a table column."""

    def checksums(candidates: DataFrame) -> DataFrame:
        return contents.join(candidates, ["bucket_name", "key"]).select(
            "bucket_name", "key", "size", F.md5(F.col(column)).alias("checksum")
        )

    return checksums


def object_line_counts(lines: DataFrame, objects: DataFrame | None = None) -> DataFrame:
    """S-8: lines per object (blank lines count, as a text reader returns
    them); with ``objects`` given, objects without lines get 0."""
    counts = lines.groupBy("bucket_name", "key").agg(F.count(F.lit(1)).alias("n_lines"))
    if objects is None:
        return counts
    return objects.select("bucket_name", "key").join(counts, ["bucket_name", "key"], "left").fillna(0, subset=["n_lines"])

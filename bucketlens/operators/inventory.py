"""Operators over an object inventory ``(bucket_name, key, size)``.

The inventory table (for example a bucket-inventory report in Parquet or CSV)
replaces the reference's driver-side walk over every bucket: listing becomes a
distributed scan, and every question below is a filter or an aggregate on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import file_format, is_directory, object_path, parent_directories
from .log_analytics import select_buckets


def _with_path(df: DataFrame) -> DataFrame:
    return df.withColumn("path", object_path(F.col("bucket_name"), F.col("key")))


# --- S-4 / F-3 ---------------------------------------------------------------
def inventory_for_buckets(inventory: DataFrame, buckets=None) -> DataFrame:
    """Objects of an allow-list of buckets; ``None`` or an empty list = all."""
    if buckets is not None and not isinstance(buckets, DataFrame):
        buckets = list(buckets) or None  # an iterator is read once
    return select_buckets(inventory, buckets)


# --- S-5 / F-1 / F-2 ---------------------------------------------------------
def classify_objects(inventory: DataFrame, bucket: str | None = None, path: str = "") -> DataFrame:
    """Objects as ``file`` or ``directory`` (a key ending with `/`).

    An empty ``path`` lists the whole bucket (all buckets if ``bucket`` is
    None); otherwise only the object whose key equals ``path`` is classified.
    """
    rows = inventory if bucket is None else inventory.where(F.col("bucket_name") == bucket)
    if path != "":
        rows = rows.where(F.col("key") == path)
    kind = F.when(is_directory(F.col("key")), F.lit("directory")).otherwise(F.lit("file"))
    return _with_path(rows.select("bucket_name", "key", kind.alias("kind")))


# --- S-6 / P-11 --------------------------------------------------------------
def file_paths(inventory: DataFrame, buckets=None) -> DataFrame:
    """File objects (directory markers dropped) with their `bucket/key` path."""
    files = inventory_for_buckets(inventory, buckets).where(~is_directory(F.col("key")))
    return _with_path(files.select("bucket_name", "key"))


# --- S-7 (D-14) --------------------------------------------------------------
def file_paths_for_prefix(inventory: DataFrame, bucket: str, prefix: str = "") -> DataFrame:
    """Files of one bucket under a key prefix (`""` = the whole bucket)."""
    rows = inventory.where((F.col("bucket_name") == bucket) & F.col("key").startswith(prefix))
    return _with_path(rows.where(~is_directory(F.col("key"))).select("bucket_name", "key"))


# --- A-5 / A-6 / K-2 (D-18) --------------------------------------------------
def directories(inventory: DataFrame, implied: bool = False) -> DataFrame:
    """Directory markers ``(bucket_name, key)``; with ``implied`` also every
    parent prefix of a key (`a/b/c` implies `a/` and `a/b/`), deduplicated."""
    markers = inventory.where(is_directory(F.col("key"))).select("bucket_name", "key")
    if not implied:
        return markers
    parents = inventory.select("bucket_name", F.explode(parent_directories(F.col("key"))).alias("key"))
    return markers.unionByName(parents).distinct()


def directories_per_bucket(inventory: DataFrame, implied: bool = False) -> DataFrame:
    return directories(inventory, implied).groupBy("bucket_name").agg(F.count("key").alias("n_directories"))


def directories_total(inventory: DataFrame, implied: bool = False) -> DataFrame:
    """Always one row (0 when there are no directories)."""
    return directories(inventory, implied).agg(F.count("key").alias("n_directories"))


def to_json_rows(df: DataFrame) -> DataFrame:
    """Each row as one JSON object string (column ``json``), computed on the
    executors; write it with ``df.write.text`` or collect a bounded result."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def directories_per_bucket_json(inventory: DataFrame, implied: bool = False) -> DataFrame:
    return to_json_rows(directories_per_bucket(inventory, implied))


# --- A-7 / A-8 / P-13 (D-9) --------------------------------------------------
def files_by_format(inventory: DataFrame, buckets=None) -> DataFrame:
    """File count per format (last extension of the file name, `(none)`)."""
    files = file_paths(inventory, buckets)
    return files.groupBy(file_format(F.col("key")).alias("format")).agg(F.count(F.lit(1)).alias("n_files"))


def files_by_bucket_format(inventory: DataFrame, buckets=None) -> DataFrame:
    files = file_paths(inventory, buckets)
    return files.groupBy("bucket_name", file_format(F.col("key")).alias("format")).agg(
        F.count(F.lit(1)).alias("n_files")
    )

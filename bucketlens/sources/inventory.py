"""Object inventory sources.

The primary source is an inventory *table* ``(bucket_name, key, size)`` — for
example a bucket-inventory report delivered as Parquet, ORC or CSV. It is a
distributed scan with column pruning and filter pushdown, and it carries what
a file listing cannot: zero-byte objects, names starting with `_` or `.`, and
directory markers.

``list_objects`` is a convenience adapter over file paths using Spark's file
listing; it inherits the listing's limits: zero-length files, hidden names
(`_x`, `.x`) and directory markers do not appear.

Which part of a path is the bucket is said explicitly (``layout``):

* ``folder``: the root holds one folder per bucket; a file directly below the
  root is an error.
* ``authority``: the bucket is the authority of the path, `s3a://bucket/key`.
* a mapping ``{bucket: root}`` instead of a root: each root is one bucket.

A path that is not under its root is an error, never a wrong bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_inventory(spark: SparkSession, path, fmt: str = "parquet", bucket_col: str = "bucket_name",
                   key_col: str = "key", size_col: str = "size", url_encoded_keys: bool = False,
                   latest_col: str | None = None, delete_marker_col: str | None = None, **options) -> DataFrame:
    """Read an inventory table and normalise it to ``(bucket_name, key, size)``.

    Column names are parameters (bucket-inventory reports call them
    ``bucket``, ``key``, ``size``); CSV reports without a header are read by
    position in that order. ``url_encoded_keys`` decodes keys that the report
    URL-encoded. Only the columns named are read (pruned at the scan).

    A versioned report has a row per version: ``latest_col`` and
    ``delete_marker_col`` name its boolean columns, and only the latest version
    of an object that is not deleted is kept.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv" and str(options.get("header", "false")).lower() != "true":
        reader = reader.schema(f"`{bucket_col}` string, `{key_col}` string, `{size_col}` bigint")
    df = reader.load(path)
    key = F.col(key_col).cast("string")
    if url_encoded_keys:
        key = F.url_decode(F.replace(key, F.lit("+"), F.lit("%2B")))
    if latest_col is not None:
        df = df.where(F.col(latest_col).cast("boolean"))
    if delete_marker_col is not None:
        df = df.where(~F.coalesce(F.col(delete_marker_col).cast("boolean"), F.lit(False)))
    return df.select(
        F.col(bucket_col).cast("string").alias("bucket_name"), key.alias("key"), F.col(size_col).cast("bigint").alias("size")
    )


def file_path_column() -> Column:
    """The source file of a row read by a file source, decoded: the hidden
    ``_metadata.file_path`` is a URI (`a%20b.txt`), listings give `a b.txt`.
    A literal `+` is protected from form decoding first."""
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(encoded)


def _one_slash(path):
    """`file:///p` and `file:/p` are one path."""
    if isinstance(path, Column):
        return F.regexp_replace(path, "^file:/+", "file:/")
    return "file:/" + path[5:].lstrip("/") if path.startswith("file:") else path


def qualified(spark: SparkSession, root: str) -> str:
    """A root as Spark reports the paths below it: with scheme and authority,
    absolute, ending in `/`."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return _one_slash(full).rstrip("/") + "/"


def split_bucket_key(spark: SparkSession, path: Column, root: str | Sequence[str] | Mapping[str, str],
                     layout: str = "folder") -> list[Column]:
    """A file path → ``bucket_name``, ``key`` (see the module's layouts)."""
    path = _one_slash(path)

    def error(what: str) -> Column:
        return F.raise_error(F.concat(F.lit(what + ": "), path)).cast("string")

    if isinstance(root, Mapping):
        bucket = key = error("not under a bucket's root")
        places = {name: qualified(spark, place) for name, place in root.items()}
        for name, place in sorted(places.items(), key=lambda x: len(x[1])):  # the innermost root wins
            under = path.startswith(place)
            bucket = F.when(under, F.lit(name)).otherwise(bucket)
            key = F.when(under, F.substring(path, len(place) + 1, 1 << 30)).otherwise(key)
        return [bucket.alias("bucket_name"), key.alias("key")]
    if layout == "authority":
        pattern = r"^[^:/]+://([^/]+)/(.*)$"
        parts = [F.regexp_extract(path, pattern, i) for i in (1, 2)]
        return [F.when(path.rlike(pattern), c).otherwise(error("path without a bucket")).alias(n)
                for c, n in zip(parts, ("bucket_name", "key"))]
    if layout != "folder" or not isinstance(root, str):
        raise ValueError("layout is folder (one root), authority, or root maps buckets to roots")
    base = qualified(spark, root)
    rel = F.when(path.startswith(base), F.substring(path, len(base) + 1, 1 << 30)).otherwise(error("not under " + base))
    inside = F.instr(rel, "/") > 0
    return [F.when(inside, F.substring_index(rel, "/", 1)).otherwise(error("file outside a bucket folder")).alias("bucket_name"),
            F.regexp_extract(rel, r"(?s)^[^/]*/(.*)$", 1).alias("key")]


def roots_of(root: str | Sequence[str] | Mapping[str, str]):
    """What a reader loads for a root, several roots, or a mapping."""
    return list(root.values()) if isinstance(root, Mapping) else root if isinstance(root, str) else list(root)


def list_objects(spark: SparkSession, root, layout: str = "folder") -> DataFrame:
    """``(bucket_name, key, size, path)`` for the files below ``root``; only
    metadata is read (the content column is pruned from the scan)."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(roots_of(root))
        .select("path", F.col("length").alias("size"))
    )
    return files.select(*split_bucket_key(spark, F.col("path"), root, layout), "size", "path")

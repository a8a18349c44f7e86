"""Object content sources: lines of every object, byte checksums of objects.

``read_object_lines`` reads *all* objects below a root in one text scan (the
reference started one Spark job per file): big files are split across tasks,
`.gz` files are decompressed by extension, and each line carries the file it
came from. ``md5_of_files`` hashes the exact bytes of a DataFrame of paths
inside the tasks, streaming each file in chunks, so there is no size cap and
no path list passes through the driver.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import object_uri
from ..session import ship_package, shuffle_partitions
from .inventory import file_path_column, roots_of, split_bucket_key

# Read size per chunk when hashing a file's bytes, and concurrent reads per task.
CHUNK_BYTES = 1 << 22
READ_THREADS = 8


def read_object_lines(spark: SparkSession, root, layout: str = "folder") -> DataFrame:
    """``(bucket_name, key, line)`` for every line of every file below ``root``
    (a root, several, or ``{bucket: root}``; see ``sources.inventory``)."""
    lines = spark.read.option("recursiveFileLookup", "true").text(roots_of(root))
    return lines.select(*split_bucket_key(spark, file_path_column(), root, layout), F.col("value").alias("line"))


def read_bucket_lines(spark: SparkSession, buckets, scheme: str = "s3a") -> DataFrame:
    """``(bucket_name, key, line)`` of the chosen buckets, each read at
    `scheme://bucket/`, in one scan."""
    return read_object_lines(spark, [f"{scheme}://{b}/" for b in buckets], layout="authority")


@functools.lru_cache(maxsize=64)
def _filesystem(scheme: str, authority: str, options: tuple = ()):
    """One pyarrow filesystem (one object-store client) per scheme and
    authority in a worker, not one per file."""
    import pyarrow.fs as pafs

    if scheme == "s3" and options:
        return pafs.S3FileSystem(**dict(options))

    if scheme == "file":
        return pafs.LocalFileSystem()
    fs, _ = pafs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return fs


def _arrow_location(path: str, options: tuple = ()):
    """A Spark/Hadoop file path (decoded, as listings give it) → pyarrow
    filesystem + path. The path is split by hand: `#`, `%` or spaces in a
    name must not be read as URI syntax."""
    m = re.match(r"^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)$", path)
    if not m:
        return _filesystem("file", ""), path
    scheme, authority, rest = m.group(1).lower(), m.group(2) or "", m.group(3)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    if scheme == "file":
        return _filesystem("file", ""), rest
    # object stores address `bucket/key`; other filesystems the bare path
    return _filesystem(scheme, authority, options), (authority + rest) if scheme in ("s3", "gs", "gcs") else rest


def _md5_of(path: str, options: tuple = ()) -> str:
    import hashlib

    fs, rel = _arrow_location(path, options)
    h = hashlib.md5()
    with fs.open_input_stream(rel, compression=None) as f:
        while chunk := f.read(CHUNK_BYTES):
            h.update(chunk)
    return h.hexdigest()


def _md5_batches(options: tuple, threads: int = READ_THREADS):
    """Hash each file of each Arrow batch; reads overlap on a few threads
    (object-store reads are latency-bound; pyarrow and hashlib release the
    GIL). Order is kept."""

    def run(batches):
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_workers=threads) as pool:
            for pdf in batches:
                yield pdf.assign(checksum=list(pool.map(lambda p: _md5_of(p, options), pdf["path"])))

    return run


def md5_of_files(paths: DataFrame, partitions: int | None = None, filesystem: dict | None = None) -> DataFrame:
    """``paths`` plus ``checksum``: MD5 of the bytes of each file in its column
    ``path``. The files are dealt out by a hash of the path, over as many tasks
    as the session shuffles into (or ``partitions``), so files of one hot size
    or bucket do not meet in one task.

    Tasks open files through pyarrow with the executors' own credentials;
    ``filesystem`` passes options of its S3 client (endpoint_override, region,
    access_key, …), as the session's Hadoop settings do not reach it."""
    ship_package(paths.sparkSession)
    options = tuple(sorted((filesystem or {}).items()))
    dealt = paths.repartition(partitions or shuffle_partitions(paths.sparkSession), "path")
    schema = ", ".join(f"`{n}` {t}" for n, t in paths.dtypes) + ", checksum string"
    return dealt.mapInPandas(_md5_batches(options), schema)


def _read_once(checksums: DataFrame) -> DataFrame:
    """With an exchange after the hashing: classes use the checksums twice, and
    Spark reuses an exchange, but not what a Python function returns."""
    return checksums.repartition("bucket_name", "key")


def file_checksums(objects: DataFrame, partitions: int | None = None, filesystem: dict | None = None):
    """A ``checksums`` function (see ``byte_classes``) for listed files:
    ``objects`` must carry ``path`` next to ``bucket_name, key``."""

    def checksums(candidates: DataFrame) -> DataFrame:
        with_path = candidates.join(objects.select("bucket_name", "key", "path"), ["bucket_name", "key"])
        return _read_once(md5_of_files(with_path, partitions, filesystem).drop("path"))

    return checksums


def inventory_checksums(root: str, partitions: int | None = None, filesystem: dict | None = None):
    """A ``checksums`` function for objects of an inventory table: each
    candidate is read at ``root + bucket/key`` (e.g. ``root="s3a://"``), so
    no listing is needed and only candidates are opened."""

    def checksums(candidates: DataFrame) -> DataFrame:
        with_path = candidates.withColumn("path", object_uri(root, F.col("bucket_name"), F.col("key")))
        return _read_once(md5_of_files(with_path, partitions, filesystem).drop("path"))

    return checksums


def _write_batches(root: str, options: tuple):
    def run(batches):
        for pdf in batches:
            for bucket, key, body in zip(pdf["bucket_name"], pdf["key"], pdf["content"]):
                fs, rel = _arrow_location(f"{root}{bucket}/{key}", options)
                if "/" in rel:
                    fs.create_dir(rel.rsplit("/", 1)[0], recursive=True)
                with fs.open_output_stream(rel, compression=None) as out:
                    out.write(b"" if body is None else bytes(body))
            yield pdf[["bucket_name", "key"]]

    return run


def write_objects(contents: DataFrame, root: str, filesystem: dict | None = None) -> int:
    """Write each row of ``(bucket_name, key, content)`` as one object at
    `root/bucket/key`, its exact bytes (NULL: an empty object), from the tasks;
    returns how many. A task that runs again writes the same objects again. Its
    counterpart reads them back: ``read_object_lines``, ``list_prefixes``."""
    ship_package(contents.sparkSession)
    rows = contents.select("bucket_name", "key", F.col("content").cast("binary").alias("content"))
    options = tuple(sorted((filesystem or {}).items()))
    return rows.mapInPandas(_write_batches(root.rstrip("/") + "/", options), "bucket_name string, key string").count()

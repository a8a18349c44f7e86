"""A distributed listing of objects, as a Spark data source.

``list_objects`` (``sources.inventory``) goes through Spark's file listing, which
leaves out empty files, names that begin with `_` or `.`, and directories. This
source lists with a file-system client inside the tasks and returns all of them:

* one partition per prefix: the driver looks at ``depth`` levels of directories
  below each bucket (0: none, a bucket is one partition), never below; everything
  deeper is walked by the tasks, a directory at a time, so no task holds more
  than one directory's entries;
* a directory is a row too, as the marker `…/` of size 0;
* ``buckets`` and ``prefix`` prune: what cannot match is not listed at all.

Buckets are the folders below ``root`` (for object stores, `s3a://` itself with
``buckets`` named).
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import ship_package
from .content import _arrow_location

LISTING = "bucket_name string, key string, size bigint, is_directory boolean, path string"
_SCHEMA = pa.schema(
    [("bucket_name", pa.string()), ("key", pa.string()), ("size", pa.int64()), ("is_directory", pa.bool_()), ("path", pa.string())]
)
BATCH = 8192


@dataclass
class Prefix(InputPartition):
    """A part of a bucket: the entries below ``key`` (empty or ending in `/`), at
    any depth or only those directly in it."""

    bucket: str
    key: str
    deep: bool


def entries(fs, folder: str) -> list[tuple[str, int, bool]]:
    """(name, size, is a directory) of what is directly in a folder."""
    import pyarrow.fs as pafs

    found = fs.get_file_info(pafs.FileSelector(folder, recursive=False, allow_not_found=True))
    return sorted((i.base_name, i.size or 0, i.type == pafs.FileType.Directory) for i in found)


def may_match(key: str, prefix: str) -> bool:
    """Whether anything below the directory ``key`` can begin with ``prefix``."""
    return key.startswith(prefix) or prefix.startswith(key)


class ListingReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["root"].rstrip("/") + "/"
        self.buckets = json.loads(options["buckets"])
        self.prefix = options["prefix"]
        self.depth = int(options["depth"])
        self.client = tuple((k, v) for k, v in json.loads(options["client"]))

    def _at(self, bucket: str, key: str = ""):
        return _arrow_location(self.root + "/".join(p for p in (bucket, key.rstrip("/")) if p), self.client)

    def partitions(self) -> Sequence[Prefix]:
        names = self.buckets
        if names is None:
            names = [n for n, _, folder in entries(*self._at("")) if folder]
        out = []
        for bucket in names:
            level = [""]
            for _ in range(self.depth):
                out += [Prefix(bucket, key, False) for key in level]
                below = [key + n + "/" for key in level for n, _, folder in entries(*self._at(bucket, key)) if folder]
                level = [k for k in below if may_match(k, self.prefix)]
            out += [Prefix(bucket, key, True) for key in level]
        return out

    def _walk(self, part: Prefix) -> Iterator[tuple]:
        todo = [part.key]
        while todo:
            key = todo.pop()
            for name, size, folder in entries(*self._at(part.bucket, key)):
                own = key + name + ("/" if folder else "")
                if own.startswith(self.prefix):
                    yield part.bucket, own, 0 if folder else size, folder, f"{self.root}{part.bucket}/{own}"
                if folder and part.deep and may_match(own, self.prefix):
                    todo.append(own)

    def read(self, part: Prefix) -> Iterator[pa.RecordBatch]:
        rows = []
        for row in self._walk(part):
            rows.append(row)
            if len(rows) == BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


class ObjectListing(DataSource):
    """``spark.read.format("object_listing")`` with options root, buckets (JSON
    list or null), prefix, depth, client (JSON pairs)."""

    @classmethod
    def name(cls) -> str:
        return "object_listing"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema) -> ListingReader:
        return ListingReader({"buckets": "null", "prefix": "", "depth": "1", "client": "[]", **self.options})


def list_prefixes(spark: SparkSession, root: str, buckets: Sequence[str] | None = None, prefix: str = "", depth: int = 1,
                  filesystem: dict | None = None) -> DataFrame:
    """``(bucket_name, key, size, is_directory, path)`` of everything below
    ``root`` whose key begins with ``prefix``. ``filesystem``: options of the
    store's client in the tasks (see ``sources.content``)."""
    ship_package(spark)
    spark.dataSource.register(ObjectListing)
    options = {
        "root": root, "buckets": json.dumps(None if buckets is None else list(buckets)), "prefix": prefix, "depth": str(depth),
        "client": json.dumps(sorted((filesystem or {}).items())),
    }
    return spark.read.format("object_listing").options(**options).load()

"""Object key and path expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key separator, the label for a file name without extension.
SEPARATOR = "/"
NO_FORMAT = "(none)"
# Last extension of the file name: a dot followed by a run without `.` or `/`
# up to the end of the key (so dots in the bucket or directory never count).
EXTENSION = r"\.([^./]+)$"


def object_path(bucket: Column, key: Column) -> Column:
    """`bucket/key`, the path the listing produced."""
    return F.concat_ws(SEPARATOR, bucket, key)


def object_uri(root: str, bucket: Column, key: Column) -> Column:
    """Readable location of an object: `root` (e.g. `s3a://`, or a folder
    holding one sub-folder per bucket) + `bucket/key`."""
    base = root if root.endswith("/") or root.endswith("://") else root + "/"
    return F.concat(F.lit(base), object_path(bucket, key))


def is_directory(key: Column) -> Column:
    """A directory marker is a key ending with the separator."""
    return key.endswith(SEPARATOR)


def file_format(key: Column) -> Column:
    """Last extension of the file name; `a.tar.gz` → `gz`; none → `(none)`."""
    ext = F.regexp_extract(key, EXTENSION, 1)
    return F.when(ext == "", F.lit(NO_FORMAT)).otherwise(ext)


def parent_directories(key: Column) -> Column:
    """Every directory above a key as an array: `a/b/c.txt` → [`a/`, `a/b/`]."""
    parts = F.split(key, SEPARATOR, -1)
    depth = F.size(parts) - 1
    return F.when(
        depth >= 1,
        F.transform(
            F.sequence(F.lit(1), F.greatest(depth, F.lit(1))),
            lambda i: F.concat(F.array_join(F.slice(parts, F.lit(1), i), SEPARATOR), F.lit(SEPARATOR)),
        ),
    ).otherwise(F.array().cast("array<string>"))

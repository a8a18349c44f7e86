"""Access-log sources: text files → parsed ``access_log`` DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.parse import parse_access_log
from .inventory import file_path_column


def read_log_lines(spark: SparkSession, path, recursive: bool | None = None, **options) -> DataFrame:
    """Log files as lines (`value`) plus the file they came from (`source_file`),
    and the partition columns of the path (`…/day=2019-02-06/…`).

    ``path`` may hold patterns. A filter on a partition column prunes whole
    folders before they are read; ``recursive=True`` reads every folder below
    ``path`` instead, and finds no partition columns; ``recursive=False`` reads
    the files directly in ``path`` and in its partition folders only. By default
    every folder is read if the path has no partition columns (a path that mixes
    partition folders and others is an error of Spark's), so no file is left out
    unasked. ``options`` go to the reader (``pathGlobFilter``, ``modifiedAfter``, …).

    One scan over every file; `.gz` files are decompressed by extension.
    Splittable files are split by `spark.sql.files.maxPartitionBytes`, and many
    small log files are packed into one task by `spark.sql.files.openCostInBytes`.
    """
    def read(every_folder: bool) -> DataFrame:
        return spark.read.options(recursiveFileLookup=str(every_folder).lower(), **options).text(path)

    lines = read(bool(recursive))
    if recursive is None:
        every = read(True)
        lines = every if lines.columns == every.columns else lines
    return lines.select("*", file_path_column().alias("source_file"))


def read_access_logs(spark: SparkSession, path, mode: str = "strict", keep_source: bool = False, recursive: bool | None = None,
                     where: str | None = None, **options) -> DataFrame:
    """Read and parse server access logs (strict, tolerant or positional).
    ``where`` is a condition on partition columns; they come first in the
    result."""
    lines = read_log_lines(spark, path, recursive, **options)
    if where is not None:
        lines = lines.where(where)
    partitions = [c for c in lines.columns if c not in ("value", "source_file")]
    return parse_access_log(lines, mode=mode, keep=partitions + (["source_file"] if keep_source else []))

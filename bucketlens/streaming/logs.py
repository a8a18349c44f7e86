"""Log files as a stream: the same parser over a file-source stream.

Access logs are delivered continuously as new files in a log bucket. A file
stream picks up each new file once; the parsed rows feed any aggregate of
``operators.log_analytics`` that Structured Streaming supports (for example
``top_buckets_by_size(log, n=None)`` in ``complete`` mode). Run the query
with a ``checkpointLocation`` on shared storage so it resumes after a
failure without reading a file twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.parse import parse_access_log
from ..sources.inventory import file_path_column


def read_access_log_stream(spark: SparkSession, path: str, mode: str = "strict",
                           max_files_per_trigger: int | None = None, keep_source: bool = False) -> DataFrame:
    """Streaming ``access_log`` rows from new text files under ``path``
    (with ``source_file`` when ``keep_source``, e.g. for
    ``malformed_summary(log, by=["source_file"])`` per delivered file)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(path)
    if not keep_source:
        return parse_access_log(lines, mode=mode)
    lines = lines.select("value", file_path_column().alias("source_file"))
    return parse_access_log(lines, mode=mode, keep=["source_file"])

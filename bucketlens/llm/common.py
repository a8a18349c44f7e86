"""What the operators share: tables, scratch tables in the cluster's shared
folder, and the word rules."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import write_parquet

# A word is a run of characters other than these six.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SPACE_CLASS = r"\x20\x09-\x0D"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``). Only a session
    in a single local process may go without: it gets one temporary folder,
    kept here per application (the setting cannot be changed later on)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="bucketlens-llm-")
    return _LOCAL_DIRS[app]


_NOTES: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    notes = _NOTES.get()
    if notes is not None:
        notes.append(path)
    return path


@contextlib.contextmanager
def noted_scratch() -> Iterator[list[str]]:
    """The scratch folders that are made inside the block."""
    made: list[str] = []
    token = _NOTES.set(made)
    try:
        yield made
    finally:
        _NOTES.reset(token)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read from there:
    cuts the lineage, and survives the loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_and_seen(df: DataFrame, name: str, *metrics: Column) -> tuple[DataFrame, dict]:
    """``stored``, with aggregates of the rows that are taken while they are
    written (no job of their own)."""
    seen = Observation()
    out = stored(df.observe(seen, *metrics), name)
    return out, seen.get


def delete_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch folders that nothing reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in paths:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def crc_mod(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo (the fold rule of the contracts)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def small_batches(pdf: pd.DataFrame, column: str, limit: int = 1 << 20) -> Iterator[pd.DataFrame]:
    """Cut a batch into runs of rows with about ``limit`` characters of text
    each, so that per-character arrays stay small (a longer text is alone)."""
    size = 0
    first = 0
    for i, text in enumerate(pdf[column]):
        n = 0 if text is None else len(text)
        if i > first and size + n > limit:
            yield pdf.iloc[first:i]
            first, size = i, 0
        size += n
    if first < len(pdf):
        yield pdf.iloc[first:]

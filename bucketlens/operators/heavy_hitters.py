"""The most frequent values of a column, found by a sketch and proven exact.

An exact top-n by ``groupBy`` shuffles one row per distinct value and task. Here
each task keeps at most ``k`` counters (Misra and Gries): when there are more,
the (k+1)-th largest count is taken off all of them, and what falls to zero goes.
A value's counters add up to at most its true count, and short of it by at most
E, the sum of what the tasks took off (E <= rows / (k+1)).

With L the n-th largest sum, every value with sum + E < L has a true count below
L, so it is not among the first n, not even by a tie. The others are the
candidates: they are counted exactly in a second scan that sends them to every
task. If the sketch cannot decide (more than ``max_candidates`` of them, or fewer
than n counters left while E > 0), the answer is the exact ``groupBy``.

NULLs are not counted. The result is the same in either way; only its cost
differs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

COUNTERS = 4096
MAX_CANDIDATES = 100_000


def merge_counts(counts: pd.Series, more: pd.Series, k: int) -> tuple[pd.Series, int]:
    """The two counters together, cut to k; and what was taken off each."""
    counts = counts.add(more, fill_value=0).astype("int64")
    if len(counts) <= k:
        return counts, 0
    off = int(np.partition(counts.to_numpy(), len(counts) - k - 1)[len(counts) - k - 1])
    return counts[counts > off] - off, off


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, off = pd.Series(dtype="int64"), 0
        for batch in batches:
            counts, more = merge_counts(counts, batch.column(0).to_pandas().value_counts(), k)
            off += more
        # the row without a value says what this task took off
        values = [*counts.index, None]
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, pa.string()), pa.array([*counts.tolist(), 0], pa.int64()), pa.array([0] * len(counts) + [off], pa.int64())],
            names=["value", "low", "off"],
        )

    return run


@dataclass(frozen=True)
class Candidates:
    """``values`` is None if the sketch could not decide."""

    values: list[str] | None
    error: int
    least: int


def candidates(rows: DataFrame, column: str, n: int, k: int = COUNTERS, max_candidates: int = MAX_CANDIDATES) -> Candidates:
    """One job over ``rows``; at most ``max_candidates`` + 2 rows reach the driver."""
    ship_package(rows.sparkSession)
    cells = rows.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL").mapInArrow(_sketch(k), "value string, low long, off long")
    merged = cells.groupBy("value").agg(F.sum("low").alias("low"), F.sum("off").alias("off"))
    first = merged.orderBy(F.col("value").isNotNull(), F.desc("low")).limit(max_candidates + 2).toArrow().to_pylist()
    if not first:
        return Candidates([], 0, 0)
    error, lows = first[0]["off"], first[1:]
    least = lows[n - 1]["low"] if len(lows) >= n else 0
    near = [r["value"] for r in lows if r["low"] + error >= least]
    if len(near) > max_candidates or (len(lows) < n and error > 0) or (len(lows) >= n and error >= least):
        return Candidates(None, error, least)
    return Candidates(near, error, least)


def top_values(rows: DataFrame, column: str, n: int, k: int = COUNTERS, max_candidates: int = MAX_CANDIDATES) -> DataFrame:
    """`(column, hits)` of the n most frequent values, ties by the smaller value."""
    found = candidates(rows, column, n, k, max_candidates)
    known = rows.where(F.col(column).isNotNull()).select(column)
    if found.values is not None:
        spark = rows.sparkSession
        near = spark.createDataFrame(pa.table({column: pa.array(found.values, pa.string())}))
        known = known.join(F.broadcast(near), column, "left_semi")
    return known.groupBy(column).agg(F.count(column).alias("hits")).orderBy(F.desc("hits"), column).limit(n)

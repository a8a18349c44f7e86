"""A bounded filter made from keys at run time, applied on the scan of a large
table before anything of it is shuffled.

The keys become a blocked Bloom filter: a 64-bit hash of the key columns names a
cell (its leading bits) and three bits in it. A row passes if its cell has all
three of its bits, so every row with one of the keys passes; of the others,
about 1 in 200 at 16 bits a key. There are at most 2^MOST_CELLS cells of 64 bits,
whatever the number of keys: that bound is what makes the table of cells fit for
a broadcast. Beyond 4 million keys the filter lets more rows through and is still
right, because an exact join follows it.

The key columns must have the same types on both sides (the hash depends on
them). NULLs hash like values of their own, as in a null-safe join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
MOST_CELLS = 20


def _hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in columns])


def _mask(h: Column) -> Column:
    bit = lambda shift: F.expr(f"shiftleft(1L, cast(shiftright(_kf_hash, {shift}) & 63 AS int))")
    return bit(0).bitwiseOR(bit(6)).bitwiseOR(bit(12))


@dataclass(frozen=True)
class KeyFilter:
    """``cells``: (_kf_cell, _kf_bits), at most 2^cell_bits rows."""

    cells: DataFrame
    cell_bits: int
    n_keys: int

    def apply(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        """The rows of ``df`` that may have one of the keys in ``columns``."""
        h = df.withColumn("_kf_hash", _hash(columns))
        h = h.withColumns({"_kf_cell": _cell(self.cell_bits), "_kf_mask": _mask(F.col("_kf_hash"))})
        hit = h.join(F.broadcast(self.cells), "_kf_cell").where("(_kf_bits & _kf_mask) = _kf_mask")
        return hit.select(*df.columns)


def _cell(bits: int) -> Column:
    return F.expr(f"shiftrightunsigned(_kf_hash, {64 - bits})") if bits else F.lit(0).cast("bigint")


def key_filter(keys: DataFrame, columns: Sequence[str]) -> KeyFilter:
    """A filter for the distinct values of ``columns``. Runs one job: the count
    that sizes it."""
    distinct = keys.select(_hash(columns).alias("_kf_hash")).distinct()
    n = distinct.count()
    cell_bits = min(MOST_CELLS, max(0, math.ceil(math.log2(max(1, n) * BITS_PER_KEY / 64))))
    marked = distinct.select(_cell(cell_bits).alias("_kf_cell"), _mask(F.col("_kf_hash")).alias("_m"))
    return KeyFilter(marked.groupBy("_kf_cell").agg(F.bit_or("_m").alias("_kf_bits")), cell_bits, n)


@dataclass(frozen=True)
class AllowList:
    """Names to keep, counted once. Up to ``broadcast_max_rows`` they are sent to
    the tasks; beyond, the scan is filtered by ``filter`` before the exact join."""

    names: DataFrame
    filter: KeyFilter | None

    def keep(self, df: DataFrame, column: str = "bucket_name") -> DataFrame:
        names = self.names.withColumnRenamed("_name", column)
        if self.filter is None:
            return df.join(F.broadcast(names), column, "left_semi")
        return self.filter.apply(df, [column]).join(names, column, "left_semi")


#: Names of up to 1 KB each stay below 100 MB.
BROADCAST_MAX_NAMES = 100_000


def prepare_allow_list(names: DataFrame, column: str = "bucket_name", broadcast_max_rows: int = BROADCAST_MAX_NAMES) -> AllowList:
    """Look at the list once (one job, two if it is long)."""
    distinct = names.select(F.col(column).cast("string").alias("_name")).where("_name IS NOT NULL").distinct()
    if distinct.limit(broadcast_max_rows + 1).count() <= broadcast_max_rows:
        return AllowList(distinct, None)
    return AllowList(distinct, key_filter(distinct, ["_name"]))

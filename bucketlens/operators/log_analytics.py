"""Analytics over a parsed ``access_log`` DataFrame.

Every function takes DataFrames and parameters (never SQL text) and returns a
lazy DataFrame; the caller decides to show, write or cache it. Malformed rows
are always excluded from analytics (they are counted by ``malformed_summary``).

Scale notes. One bucket may hold a third of all rows, so nothing here puts a
whole bucket into one task: per-bucket totals are aggregated (map-side
combine) and joined back, and the running sum is built from per-(bucket, size)
partial sums with a bounded-fan-out prefix sum instead of one window per
bucket. Joins are left to adaptive execution, which broadcasts a side only
after measuring it and splits skewed partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .geo import PreparedGeo, enrich_geo
from .heavy_hitters import top_values
from .runtime_filter import AllowList, KeyFilter, key_filter


def exact_sum(name: str) -> Column:
    """Sum of a bigint column that cannot overflow."""
    return F.sum(F.col(name).cast("decimal(20,0)")).cast("decimal(38,0)")


def good_rows(log: DataFrame) -> DataFrame:
    return log.where(~F.col("is_malformed"))


def select_buckets(df: DataFrame, buckets: Iterable[str] | DataFrame | None) -> DataFrame:
    """Keep the given buckets; ``None`` keeps every bucket (no pass over the
    data to find them). A DataFrame with a ``bucket_name`` column is applied as
    a left-semi join, so the allow-list itself may be large; an ``AllowList``
    (``prepare_allow_list``) filters the scan first, so that a list too long for
    a broadcast does not make Spark shuffle the whole log."""
    if buckets is None:
        return df
    if isinstance(buckets, AllowList):
        return buckets.keep(df)
    if isinstance(buckets, DataFrame):
        return df.join(buckets.select("bucket_name").distinct(), "bucket_name", "left_semi")
    return df.where(F.col("bucket_name").isin(list(buckets)))


# --- A-1 / O-1 ---------------------------------------------------------------
def top_buckets_by_size(log: DataFrame, n: int | None = 5) -> DataFrame:
    """Buckets by total object size, largest first (ties by name)."""
    out = good_rows(log).groupBy("bucket_name").agg(exact_sum("object_size").alias("total_size"))
    out = out.orderBy(F.desc("total_size"), "bucket_name")
    return out if n is None else out.limit(n)


# --- W-1 / O-4 ---------------------------------------------------------------
@dataclass(frozen=True)
class TopSizes:
    """The n largest distinct sizes of every bucket: (bucket_name, object_size,
    rank). ``filter`` is None if they are few enough for a broadcast."""

    ranked: DataFrame
    n: int
    filter: KeyFilter | None


#: Ranked sizes that are sent to every task: bucket name, size and rank.
BROADCAST_MAX_SIZES = 200_000


def _ranked_sizes(sizes: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy("bucket_name").orderBy(F.desc("object_size"))
    return sizes.withColumn("rank", F.dense_rank().over(w)).where(F.col("rank") <= n)


def prepare_top_sizes(log: DataFrame, n: int = 5, buckets=None, broadcast_max_rows: int = BROADCAST_MAX_SIZES) -> TopSizes:
    """Find the sizes that ``top_objects_per_bucket`` keeps, by one job over the
    (bucket, size) summary. Up to ``broadcast_max_rows`` of them pass through the
    driver; more than that stay a DataFrame and get a bounded filter."""
    rows = select_buckets(good_rows(log), buckets).select("bucket_name", "object_size")
    ranked = _ranked_sizes(rows.distinct(), n)
    found = ranked.limit(broadcast_max_rows + 1).toArrow()
    if found.num_rows <= broadcast_max_rows:
        return TopSizes(log.sparkSession.createDataFrame(found, ranked.schema), n, None)
    return TopSizes(ranked, n, key_filter(ranked, ["bucket_name", "object_size"]))


def top_objects_per_bucket(log: DataFrame, n: int | None = 5, buckets=None, sizes: TopSizes | None = None) -> DataFrame:
    """Requests ranked per bucket by object size (``dense_rank``), rank ≤ n.

    With ``sizes`` (``prepare_top_sizes``, the same n and buckets) the log is
    scanned a second time and only rows of a ranked size leave the scan: they
    are looked up where they are, and no row of the log is shuffled. If there
    are too many ranked sizes for that, the scan is filtered by a bounded Bloom
    filter of them, and only what passes is aggregated as below.

    Without ``sizes`` the log is read once, into a count per (bucket, key, size) that is combined
    map-side. A dense rank depends on the distinct sizes of a bucket only: with
    ``n`` they are ranked by a window whose rank filter Spark applies before
    its shuffle too (at most n sizes per bucket and partition are shipped);
    without a limit the rank is a count of greater sizes by ``_prefix_sums``,
    so no window ever holds a bucket. The ranks are joined to the counts, and
    the rows are made again from them (``_repeat_rows``): a third of all
    requests on one bucket's largest object never meet in one task."""
    rows = select_buckets(good_rows(log), buckets).select("bucket_name", "key", "object_size")
    if sizes is not None and (n is None or n != sizes.n):
        raise ValueError("the sizes were prepared for another n")
    if sizes is not None:
        ranked = sizes.ranked.select(F.col("bucket_name").alias("_b"), F.col("object_size").alias("_s"), "rank")
        same = F.col("bucket_name").eqNullSafe(F.col("_b")) & F.col("object_size").eqNullSafe(F.col("_s"))
        if sizes.filter is None:
            return rows.join(F.broadcast(ranked), same).select("bucket_name", "key", "object_size", "rank")
        rows = sizes.filter.apply(rows, ["bucket_name", "object_size"])
        counts = rows.groupBy("bucket_name", "key", "object_size").agg(F.count(F.lit(1)).alias("_c"))
        found = counts.join(ranked, same).select("bucket_name", "key", "object_size", "rank", "_c")
        return _repeat_rows(found, "_c", ["bucket_name", "key", "object_size", "rank"])
    counts = rows.groupBy("bucket_name", "key", "object_size").agg(F.count(F.lit(1)).alias("_c"))
    # asking for the count (always positive) keeps this branch's first aggregate
    # the same as the other's, so its shuffle is reused and the log read once
    summary = counts.groupBy("bucket_name", "object_size").agg(F.sum("_c").alias("_c")).where("_c > 0")
    if n is None:
        ones = _prefix_sums(summary.withColumn("_c", F.lit(1).cast("bigint")), "bucket_name", "object_size", descending=True)
        ranked = ones.withColumn("rank", F.col("running_sum").cast("int")).drop("running_sum", "_c")
    else:
        ranked = _ranked_sizes(summary, n)
    ranked = ranked.select(F.col("bucket_name").alias("_b"), F.col("object_size").alias("_s"), "rank")
    same = F.col("bucket_name").eqNullSafe(F.col("_b")) & F.col("object_size").eqNullSafe(F.col("_s"))
    found = counts.join(ranked, same).select("bucket_name", "key", "object_size", "rank", "_c")
    return _repeat_rows(found, "_c", ["bucket_name", "key", "object_size", "rank"])


# --- A-3 / F-6 / O-2 ---------------------------------------------------------
def hits_per_object(log: DataFrame, buckets=None) -> DataFrame:
    """Requests and bytes per (bucket, key); keys `-` excluded."""
    rows = select_buckets(good_rows(log), buckets).where(F.col("key") != "-")
    out = rows.groupBy("bucket_name", "key").agg(
        F.count("key").alias("hits"), exact_sum("object_size").alias("bytes")
    )
    return out.orderBy("bucket_name", "key")


# --- A-2 / J-1 / O-5 ---------------------------------------------------------
def hits_per_ip(log: DataFrame, buckets=None, geo: DataFrame | PreparedGeo | None = None) -> DataFrame:
    """Requests per client address over all buckets, for the addresses that
    touched a selected bucket, most active first.

    One pass over the log: the count and a "touched a selected bucket" flag
    are aggregated together (the reference's `HAVING ip IN (subquery)`).
    An allow-list given as a DataFrame is applied to (address, bucket)
    summaries by a join. The geo lookup runs on the per-address result."""
    rows = good_rows(log).where(F.col("ip_address").isNotNull())
    if buckets is None:
        out = rows.groupBy("ip_address").agg(F.count("ip_address").alias("hits"))
    elif isinstance(buckets, DataFrame | AllowList):
        buckets = buckets.names.withColumnRenamed("_name", "bucket_name") if isinstance(buckets, AllowList) else buckets
        pairs = rows.groupBy("ip_address", "bucket_name").agg(F.count("ip_address").alias("_n"))
        chosen = buckets.select("bucket_name").distinct().withColumn("_sel", F.lit(True))
        flagged = pairs.join(chosen, "bucket_name", "left")
        out = (flagged.groupBy("ip_address")
               .agg(F.sum("_n").alias("hits"), F.max(F.coalesce(F.col("_sel"), F.lit(False))).alias("_touched"))
               .where("_touched").drop("_touched"))
    else:
        touched = F.max(F.col("bucket_name").isin(list(buckets))).alias("_touched")
        out = rows.groupBy("ip_address").agg(F.count("ip_address").alias("hits"), touched).where("_touched").drop("_touched")
    if geo is not None:
        out = enrich_geo(out, geo)
    return out.orderBy(F.desc("hits"), "ip_address")


def top_ips(log: DataFrame, n: int = 5, buckets=None, geo: DataFrame | PreparedGeo | None = None, sketch: bool = False) -> DataFrame:
    """The n most active addresses. ``sketch`` (for all buckets) finds them by
    ``heavy_hitters``: two scans and one bounded job when it is called, and no
    row per distinct address in a shuffle."""
    if not sketch:
        return hits_per_ip(log, buckets=buckets, geo=geo).limit(n)
    if buckets is not None:
        raise ValueError("the sketch counts all buckets")
    out = top_values(good_rows(log), "ip_address", n)
    return out if geo is None else enrich_geo(out, geo).orderBy(F.desc("hits"), "ip_address")


# --- A-4 / A-12 / P-3 --------------------------------------------------------
def distinct_buckets(log: DataFrame) -> DataFrame:
    return good_rows(log).select("bucket_name").distinct()


def total_bytes_sent(log: DataFrame) -> DataFrame:
    return good_rows(log).agg(exact_sum("bytes_sent").alias("total_bytes_sent"))


def malformed_summary(parsed: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Lines, good lines and malformed lines (optionally per source file)."""
    aggs = [
        F.count(F.lit(1)).alias("lines"),
        F.count_if(~F.col("is_malformed")).alias("good_lines"),
        F.count_if(F.col("is_malformed")).alias("malformed_lines"),
    ]
    return parsed.groupBy(*by).agg(*aggs) if by else parsed.agg(*aggs)


# --- W-2 ---------------------------------------------------------------------
# Fixed fan-out of the prefix sum: sizes are cut into 21-bit digits (two
# levels cover every non-negative bigint), so no window partition ever holds
# more than 2^21 rows, whatever the skew.
_SHIFTS = (21, 42)
# Rows regenerated from a count are produced in chunks of at most this many.
_CHUNK = 1 << 16


def _size_counts(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Distinct (group, value) with their row count: the map-side-combined
    summary every per-row share is computed from. NULLs are values of their
    own, as in a window."""
    return rows.groupBy(group, value).agg(F.count(F.lit(1)).alias("_c"))


def _repeat_rows(df: DataFrame, count_col: str, cols: list[str]) -> DataFrame:
    """Each row of ``df`` ``count_col`` times (only ``cols`` kept).

    A count is first cut into chunks of ≤ 2^16, the chunks are dealt out by a
    hash of row and chunk, and each chunk is expanded where it lands, so a
    (bucket, size) pair holding a third of all rows is regenerated by every
    task, not by one. The number of tasks is the session's shuffle partitions,
    stated, so that adaptive execution does not join tasks whose input is small
    but whose output is not."""
    c = F.col(count_col)
    n_chunks = F.floor((c + (_CHUNK - 1)) / _CHUNK).cast("bigint")
    chunks = df.select(*cols, c, F.explode(F.sequence(F.lit(0).cast("bigint"), n_chunks - 1)).alias("_chunk"))
    spread = chunks.repartition(shuffle_partitions(df.sparkSession), *[F.col(x) for x in cols], F.col("_chunk"))
    length = F.least(F.lit(_CHUNK).cast("bigint"), c - F.col("_chunk") * _CHUNK).cast("int")
    return spread.select(*cols, F.explode(F.array_repeat(F.lit(True), length)).alias("_one")).select(*cols)


# Stands for a NULL where blocks are made; sorts before every size, as NULLs do.
_NULL_SIZE = -(1 << 63)


def _prefix_sums(counts: DataFrame, group: str, value: str, descending: bool = False) -> DataFrame:
    """``(group, value, _c, running_sum)``: for each distinct (group, value)
    with ``_c`` rows, the sum of ``value`` over all rows of the group with a
    value ≤ it — the RANGE-frame running sum, without a per-group window. A
    NULL value adds nothing and sorts first. ``descending``: the number of rows
    with a value ≥ it instead (NULL last).

    A value's running sum is its running sum inside its 2^21-wide block, plus
    the sum of the earlier blocks inside its 2^42-wide block, plus the sum of
    the earlier 2^42-wide blocks of the group. Each term is one bounded window
    (≤ 2^21 rows a partition) over a summary, added with joins on block keys.
    """
    size = F.coalesce(F.col(value), F.lit(_NULL_SIZE))
    # ~v = -v - 1 turns the order round and cannot overflow
    order = F.bitwise_not(size) if descending else size
    weight = F.col("_c") if descending else F.coalesce(F.col(value), F.lit(0)).cast("decimal(20,0)") * F.col("_c")
    # keys of blocks are never null and say so: every branch then reads one
    # summary, which Spark computes once
    name = F.concat(F.when(F.col(group).isNull(), F.lit("0")).otherwise(F.lit("1")), F.coalesce(F.col(group), F.lit("")))
    g, b1, b2 = "_g", "_b1", "_b2"
    base = counts.select(group, value, "_c", weight.cast("decimal(38,0)").alias("_t"), order.alias("_o"), name.alias(g),
                         F.shiftright(order, _SHIFTS[0]).alias(b1), F.shiftright(order, _SHIFTS[1]).alias(b2))

    def running(parts: list[str], order: str, inclusive: bool) -> Column:
        w = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        total = F.sum("_t").over(w)
        return total if inclusive else total - F.col("_t")

    inside = base.withColumn("_in", running([g, b1], "_o", True))
    t1 = base.groupBy(g, b2, b1).agg(F.sum("_t").alias("_t"))
    ex1 = t1.select(g, b1, running([g, b2], b1, False).alias("_ex1"))
    t2 = base.groupBy(g, b2).agg(F.sum("_t").alias("_t"))
    ex2 = t2.select(g, b2, running([g], b2, False).alias("_ex2"))
    out = inside.join(ex1, [g, b1]).join(ex2, [g, b2])
    total = F.col("_in") + F.col("_ex1") + F.col("_ex2")
    return out.select(group, value, "_c", total.alias("running_sum"))


def running_percentage(log: DataFrame, buckets=None) -> DataFrame:
    """Running sum of object sizes per bucket in ascending size order (equal
    sizes share a value, like a RANGE frame) × 100 ÷ the row's own size; one
    output row per log row.

    This is the literal reference formula: it is not a share of the total and
    exceeds 100; a zero or NULL size gives NULL instead of an error, and a NULL
    bucket is a bucket. The log is read once and only (bucket, size) summaries
    are shuffled."""
    rows = select_buckets(good_rows(log), buckets).select("bucket_name", "object_size")
    running = _prefix_sums(_size_counts(rows, "bucket_name", "object_size"), "bucket_name", "object_size")
    pct = F.try_divide(F.col("running_sum").cast("double") * 100, F.col("object_size"))
    summary = running.select("bucket_name", "object_size", "_c", pct.alias("running_percentage"))
    return _repeat_rows(summary, "_c", ["bucket_name", "object_size", "running_percentage"])


# --- W-3 ---------------------------------------------------------------------
def percentage_of_bucket_total(log: DataFrame, buckets=None) -> DataFrame:
    """Each request's object size as a percentage of its bucket's total; one
    output row per log row.

    Totals come from the (bucket, size) summary, not from a window over a
    whole bucket, and the log is read once. A NULL size has a NULL share; a NULL
    bucket is a bucket."""
    rows = select_buckets(good_rows(log), buckets).select("bucket_name", "object_size")
    counts = _size_counts(rows, "bucket_name", "object_size")
    weight = F.col("object_size").cast("decimal(20,0)") * F.col("_c")
    totals = counts.groupBy(F.col("bucket_name").alias("_b")).agg(F.sum(weight).alias("_total"))
    share = F.try_divide(F.col("object_size").cast("double") * 100, F.col("_total").cast("double"))
    summary = counts.join(totals, F.col("bucket_name").eqNullSafe(F.col("_b"))).select("bucket_name", "object_size", "_c", share.alias("bucket_share"))
    return _repeat_rows(summary, "_c", ["bucket_name", "object_size", "bucket_share"])

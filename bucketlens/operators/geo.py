"""IP → location range join (the reference's geo database lookup, re-aimed as
a join against a ``geo_ranges(ip_start, ip_end, country, city, latitude,
longitude)`` table of inclusive IPv4 ranges).

A row is never multiplied: each address gets at most one range — the
containing range with the greatest start, then the smallest end, then the
smallest (country, city, latitude, longitude). Overlapping ranges are painted
into disjoint segments that carry exactly that winner (a sweep per /16 block
over the ranges table only), so both strategies below are exact on any input
and return the same columns and rows.

``prepare_geo(ranges)`` does the looking at the ranges table once: it counts
the /16-cut table and tests it for overlaps (two distributed aggregates), and
fixes the strategy. Enriching with what it returns starts no job. A plain
ranges DataFrame works as well: it is painted and looked up by ``bucketed``,
also without a job.

* ``broadcast``: the ranges, cut at /16 boundaries, are broadcast and every
  row of the input is looked up where it is (hash on the /16 block plus the
  range test): one scan, no shuffle of the big side. Used only if the counted
  cut table has at most ``broadcast_max_rows`` rows.
* ``bucketed``: an as-of lookup per /16 block over the *distinct* addresses,
  joined back. Addresses and range starts of a block are sorted together and
  each address takes the last segment that started at or before it. A block
  holds at most 2^16 distinct addresses, so no window partition is unbounded,
  however skewed the traffic; the ranges table may have any size. Rows without
  an address are dealt out by a hash of the row, not to one task; the rows of a
  hot address are split by adaptive execution (the join keeps its left side).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.network import PREFIX16_SHIFT, ipv4_to_long, prefix16
from ..session import ship_package

GEO_COLUMNS = ("country", "city", "latitude", "longitude")
# Cut ranges above this many rows are not broadcast (≈60 bytes a row).
BROADCAST_MAX_ROWS = 250_000
# Keys that rows without an address are dealt out by.
_SPREAD = 1 << 16
# "auto" and "broadcast" broadcast only if the size check passes (and are
# "bucketed" otherwise); "bucketed" never broadcasts the ranges.
METHODS = ("auto", "broadcast", "bucketed")


def cut_at_prefix16(geo: DataFrame) -> DataFrame:
    """One row per (range, /16 block it touches); ≤ ranges + 65,536 rows for
    disjoint ranges. ``_from``/``_to`` are the range's bounds inside the block."""
    valid = geo.where(F.col("ip_start") <= F.col("ip_end"))
    cut = valid.select(
        "ip_start", "ip_end", *GEO_COLUMNS,
        F.explode(F.sequence(prefix16(F.col("ip_start")), prefix16(F.col("ip_end")))).alias("_p"),
    )
    block_start = F.shiftleft(F.col("_p"), PREFIX16_SHIFT)
    block_end = block_start + ((1 << PREFIX16_SHIFT) - 1)
    return cut.withColumn("_from", F.greatest(F.col("ip_start"), block_start)).withColumn(
        "_to", F.least(F.col("ip_end"), block_end)
    )


# --- making ranges disjoint ----------------------------------------------------
def blocks_disjoint(geo: DataFrame) -> bool:
    """True if no two ranges overlap; one pass over the cut table, windowed
    per /16 block (any table size)."""
    cut = cut_at_prefix16(geo)
    w = Window.partitionBy("_p").orderBy("_from", "_to").rowsBetween(Window.unboundedPreceding, -1)
    overlap = F.max("_to").over(w) >= F.col("_from")
    return cut.select(overlap.alias("_o")).where("_o").limit(1).count() == 0


def _paint_block(pdf):
    """Sweep one /16 block: elementary intervals between range bounds, each
    owned by the active range with the greatest start, then the smallest end,
    then the smallest location; equal neighbours are merged."""
    import heapq

    import pandas as pd

    def rank(v):
        present = v is not None and v == v  # NULL / NaN sort first, as in Spark
        return (present, v if present else 0)

    rows = pdf.to_dict("records")
    order = sorted(range(len(rows)), key=lambda i: rows[i]["_from"])
    bounds = sorted({r["_from"] for r in rows} | {r["_to"] + 1 for r in rows})
    heap, out, j = [], [], 0
    for lo, nxt in zip(bounds, bounds[1:]):
        while j < len(order) and rows[order[j]]["_from"] <= lo:
            r = rows[order[j]]
            key = (-r["ip_start"], r["ip_end"], *[rank(r[c]) for c in GEO_COLUMNS])
            heapq.heappush(heap, (key, order[j]))
            j += 1
        while heap and rows[heap[0][1]]["_to"] < lo:
            heapq.heappop(heap)
        if not heap:
            continue
        i = heap[0][1]
        if out and out[-1][2] == i and out[-1][1] == lo - 1:
            out[-1][1] = nxt - 1
        else:
            out.append([lo, nxt - 1, i])
    cols = {"ip_start": [s for s, _, _ in out], "ip_end": [e for _, e, _ in out]}
    for c in GEO_COLUMNS:
        cols[c] = [rows[i][c] for _, _, i in out]
    return pd.DataFrame(cols, columns=["ip_start", "ip_end", *GEO_COLUMNS])


def disjoint_ranges(geo: DataFrame) -> DataFrame:
    """Overlapping ranges → disjoint segments (inside /16 blocks) carrying the
    winning range's location. Runs on the ranges table only, one group per /16
    block. Of the ranges that cover a whole block only the winner matters; it
    is chosen by an aggregate first (combined map-side), so a group holds one
    such range and those with an end inside the block."""
    cut = cut_at_prefix16(geo).select("_p", "_from", "_to", "ip_start", "ip_end", *GEO_COLUMNS)
    whole = F.col("_to") - F.col("_from") == (1 << PREFIX16_SHIFT) - 1
    # greatest start, then smallest end, then smallest location (NULLs first)
    order = F.struct((-F.col("ip_start")).alias("s"), "ip_end", *GEO_COLUMNS)
    best = cut.where(whole).groupBy("_p", "_from", "_to").agg(F.min(order).alias("_best"))
    best = best.select("_p", "_from", "_to", (-F.col("_best.s")).alias("ip_start"), F.col("_best.ip_end").alias("ip_end"),
                       *[F.col(f"_best.{c}").alias(c) for c in GEO_COLUMNS])
    parts = cut.where(~whole).unionByName(best)
    ship_package(geo.sparkSession)
    types = dict(geo.dtypes)
    schema = ", ".join(["ip_start bigint", "ip_end bigint"] + [f"{c} {types[c]}" for c in GEO_COLUMNS])
    return parts.groupBy("_p").applyInPandas(_paint_block, schema)


@dataclass(frozen=True)
class PreparedGeo:
    """Disjoint ranges cut at /16 boundaries, and the strategy to use."""

    cut: DataFrame
    method: str


def prepare_geo(geo: DataFrame, method: str = "auto", broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> PreparedGeo:
    """Look at the ranges once (see the module's notes)."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, got {method!r}")
    ranges = geo if blocks_disjoint(geo) else disjoint_ranges(geo)
    if method != "bucketed":
        blocks = prefix16(F.col("ip_end")) - prefix16(F.col("ip_start")) + 1
        rows = ranges.where(F.col("ip_start") <= F.col("ip_end")).agg(F.sum(blocks)).first()[0] or 0
        method = "broadcast" if rows <= broadcast_max_rows else "bucketed"
    return PreparedGeo(cut_at_prefix16(ranges), method)


def _prepared(geo: DataFrame | PreparedGeo) -> PreparedGeo:
    return geo if isinstance(geo, PreparedGeo) else PreparedGeo(cut_at_prefix16(disjoint_ranges(geo)), "bucketed")


# --- lookups -------------------------------------------------------------------
def _addresses(ips: DataFrame) -> DataFrame:
    num = ipv4_to_long(F.col("ip_address"))
    return ips.select("ip_address", num.alias("_ip")).where(F.col("_ip").isNotNull()).withColumn("_p", prefix16(F.col("_ip")))


def _join_broadcast(df: DataFrame, cut: DataFrame, how: str) -> DataFrame:
    """Look each row up against broadcast, disjoint ranges (≤ 1 match)."""
    num = ipv4_to_long(F.col("ip_address"))
    rows = df.withColumn("_ip", num).withColumn("_p", prefix16(F.col("_ip")))
    g = F.broadcast(cut.select(F.col("_p").alias("_gp"), "ip_start", "ip_end", *GEO_COLUMNS))
    cond = (rows["_p"] == g["_gp"]) & rows["_ip"].between(g["ip_start"], g["ip_end"])
    return rows.join(g, cond, how).select(*df.columns, *GEO_COLUMNS)


def _lookup_bucketed(ips: DataFrame, cut: DataFrame) -> DataFrame:
    a = _addresses(ips).select("_p", F.col("_ip").alias("_addr"), F.lit(1).alias("_kind"), "ip_address")
    r = cut.select("_p", F.col("_from").alias("_addr"), F.lit(0).alias("_kind"),
                   F.struct(F.col("ip_end"), *GEO_COLUMNS).alias("_range"))
    both = a.unionByName(r, allowMissingColumns=True)
    # a segment starting at an address sorts before it
    w = Window.partitionBy("_p").orderBy("_addr", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tagged = both.withColumn("_hit", F.last("_range", ignorenulls=True).over(w))
    found = tagged.where((F.col("_kind") == 1) & (F.col("_hit.ip_end") >= F.col("_addr")))
    return found.select("ip_address", *[F.col(f"_hit.{c}").alias(c) for c in GEO_COLUMNS])


def lookup_locations(ips: DataFrame, geo: DataFrame | PreparedGeo) -> DataFrame:
    """``(ip_address, country, city, latitude, longitude)``, one row for each
    distinct address inside some range."""
    geo = _prepared(geo)
    ips = ips.select("ip_address").where(F.col("ip_address").isNotNull()).distinct()
    return _join_broadcast(ips, geo.cut, "inner") if geo.method == "broadcast" else _lookup_bucketed(ips, geo.cut)


def enrich_geo(df: DataFrame, geo: DataFrame | PreparedGeo) -> DataFrame:
    """Every row of ``df``, its columns in their order, then country, city,
    latitude and longitude (by its ``ip_address``; NULLs without a location)."""
    geo = _prepared(geo)
    if geo.method == "broadcast":
        return _join_broadcast(df, geo.cut, "left")
    found = lookup_locations(df, geo).withColumnRenamed("ip_address", "_address")
    # no address looks like this, so these rows meet nothing, in many tasks
    spread = F.concat(F.lit("no address "), F.pmod(F.xxhash64(*df.columns), F.lit(_SPREAD)).cast("string"))
    keyed = df.withColumn("_key", F.coalesce("ip_address", spread))
    return keyed.join(found, keyed["_key"] == found["_address"], "left").select(*[keyed[c] for c in df.columns], *GEO_COLUMNS)

import random

from pyspark.sql import functions as F

from bucketlens.functions.network import ipv4_to_long
from bucketlens.operators.geo import GEO_COLUMNS, enrich_geo, lookup_locations, prepare_geo
from bucketlens.plans import fixtures as fx
from bucketlens.plans.explain import plan_text

GEO = "ip_start bigint, ip_end bigint, country string, city string, latitude double, longitude double"


def dotted(n):
    return ".".join(str((n >> s) & 255) for s in (24, 16, 8, 0))


def random_ranges(rnd, count):
    """Non-overlapping ranges, some spanning several /16 blocks."""
    points = sorted(rnd.sample(range(0, 1 << 32, 97), 2 * count))
    out = []
    for i in range(count):
        a, b = points[2 * i], points[2 * i + 1]
        out.append((a, b, f"C{i}", f"c{i}", float(i), float(-i)))
    return out


def test_ipv4_to_long(spark):
    df = spark.createDataFrame([(v,) for v in ["10.0.0.1", "255.255.255.255", "256.1.1.1", "-", None, "::1", "1.2.3"]],
                               "ip string")
    got = [r[0] for r in df.select(ipv4_to_long(F.col("ip"))).collect()]
    assert got == [167772161, 4294967295, None, None, None, None, None]


def test_fixture_geo_no_swap_and_unmatched(spark):
    ips = spark.createDataFrame([("10.0.0.7",), ("10.0.2.255",), ("10.0.3.1",)], "ip_address string")
    got = {r.ip_address: r for r in enrich_geo(ips, fx.geo_ranges(spark)).collect()}
    assert (got["10.0.0.7"].country, got["10.0.0.7"].latitude, got["10.0.0.7"].longitude) == ("A", 1.5, 2.5)
    assert got["10.0.2.255"].city == "c"
    assert got["10.0.3.1"].country is None


def test_strategies_agree_with_brute_force(spark):
    rnd = random.Random(3)
    ranges = random_ranges(rnd, 300)
    # a range covering many /16 blocks, and addresses at the edges
    ranges.append((5 << 24, (6 << 24) - 1, "BIG", "big", 9.0, 8.0)) if not any(
        a <= (6 << 24) and b >= (5 << 24) for a, b, *_ in ranges) else None
    addrs = [rnd.randrange(1 << 32) for _ in range(3000)] + [a for a, *_ in ranges] + [b for _, b, *_ in ranges]
    ips = spark.createDataFrame([(dotted(a),) for a in set(addrs)], "ip_address string")
    geo = spark.createDataFrame(ranges, GEO)
    expect = {}
    for a in set(addrs):
        hits = [r for r in ranges if r[0] <= a <= r[1]]
        if hits:
            expect[dotted(a)] = hits[0][2]
    for method in ("broadcast", "bucketed", "auto"):
        got = {r.ip_address: r.country for r in lookup_locations(ips, prepare_geo(geo, method=method)).collect()}
        assert got == expect, method


def test_nested_ranges_do_not_multiply_rows(spark):
    geo = spark.createDataFrame([(0, 1000, "outer", "o", 0.0, 0.0), (10, 20, "inner", "i", 1.0, 1.0),
                                 (10, 20, "dup", "d", 2.0, 2.0)], GEO)
    ips = spark.createDataFrame([(dotted(15),), (dotted(15),), (dotted(5),)], "ip_address string")
    for method in ("broadcast", "bucketed"):
        out = enrich_geo(ips, prepare_geo(geo, method=method)).collect()
        assert len(out) == 3
        assert {r.ip_address: r.country for r in out}[dotted(5)] == "outer"
        assert {r.country for r in out if r.ip_address == dotted(15)} <= {"inner", "dup"}


def test_broadcast_only_after_size_check(spark):
    ips = spark.createDataFrame([("10.0.0.1",)], "ip_address string")
    geo = fx.geo_ranges(spark)
    small = plan_text(lookup_locations(ips, prepare_geo(geo, method="auto")))
    big = plan_text(lookup_locations(ips, prepare_geo(geo, method="auto", broadcast_max_rows=1)))
    assert "BroadcastExchange" in small
    assert "Window" in big and "BroadcastNestedLoopJoin" not in big


def test_enrich_keeps_columns(spark):
    df = spark.createDataFrame([("r1", "10.0.1.3"), ("r2", None)], "request_id string, ip_address string")
    out = enrich_geo(df, fx.geo_ranges(spark))
    for method in ("broadcast", "bucketed"):
        out = enrich_geo(df, prepare_geo(fx.geo_ranges(spark), method))
        assert out.columns == ["request_id", "ip_address", *GEO_COLUMNS]
        assert out.count() == 2
    assert enrich_geo(df, fx.geo_ranges(spark)).columns == ["request_id", "ip_address", *GEO_COLUMNS]
    swapped = df.select("ip_address", "request_id")
    for method in ("broadcast", "bucketed"):
        assert enrich_geo(swapped, prepare_geo(fx.geo_ranges(spark), method)).columns[:2] == ["ip_address", "request_id"]


def test_disjoint_small_ranges_enrich_rows_in_place(spark):
    from conftest import SF001

    from bucketlens.operators.parse import parse_access_log

    log = parse_access_log(fx.raw_lines(spark, SF001))
    text = plan_text(enrich_geo(log, prepare_geo(fx.geo_ranges(spark))))
    assert text.split("\n\n")[0].count("Scan parquet") == 1  # the log is read and parsed once
    assert "SortMergeJoin" not in text and "BroadcastHashJoin LeftOuter" in text


def test_row_lookup_equals_distinct_lookup(spark):
    rnd = random.Random(5)
    ranges = random_ranges(rnd, 200)
    addrs = [rnd.randrange(1 << 32) for _ in range(500)]
    rows = [(f"r{i}", dotted(rnd.choice(addrs))) for i in range(3000)] + [("rn", None), ("rx", "-")]
    df = spark.createDataFrame(rows, "request_id string, ip_address string")
    geo = spark.createDataFrame(ranges, GEO)
    a = sorted(tuple(r) for r in enrich_geo(df, prepare_geo(geo, method="broadcast")).select("request_id", *GEO_COLUMNS).collect())
    b = sorted(tuple(r) for r in enrich_geo(df, prepare_geo(geo, method="bucketed")).select("request_id", *GEO_COLUMNS).collect())
    assert a == b and len(a) == len(rows)


def test_forced_broadcast_still_checks_size(spark):
    ips = spark.createDataFrame([("10.0.0.1",)], "ip_address string")
    text = plan_text(lookup_locations(ips, prepare_geo(fx.geo_ranges(spark), method="broadcast", broadcast_max_rows=2)))
    assert "Window" in text  # the bucketed as-of lookup, not a broadcast of an unchecked table


def test_overlapping_ranges_exact_for_both_strategies(spark):
    rnd = random.Random(21)
    ranges = []
    for i in range(250):
        a = rnd.randrange(0, 1 << 22)
        b = a + rnd.choice([0, 5, 300, 70000, 200000, 1 << 20])
        ranges.append((a, b, rnd.choice(["X", "Y", "Z"]), f"c{i}", float(i), float(-i)))
    ranges += [(100, 200, "T", "t1", 1.0, 1.0), (100, 200, "T", "t0", 1.0, 1.0), (150, 150, "P", "p", 0.0, 0.0)]
    addrs = {rnd.randrange(0, (1 << 22) + (1 << 20)) for _ in range(3000)}
    addrs |= {a for a, *_ in ranges} | {b for _, b, *_ in ranges} | {b + 1 for _, b, *_ in ranges}
    expect = {}
    for x in addrs:
        hits = [r for r in ranges if r[0] <= x <= r[1]]
        if hits:
            best = min(hits, key=lambda r: (-r[0], r[1], r[2], r[3], r[4], r[5]))
            expect[dotted(x)] = (best[2], best[3])
    ips = spark.createDataFrame([(dotted(x),) for x in addrs], "ip_address string")
    geo = spark.createDataFrame(ranges, GEO)
    for method in ("broadcast", "bucketed"):
        got = {r.ip_address: (r.country, r.city) for r in lookup_locations(ips, prepare_geo(geo, method=method)).collect()}
        assert got == expect, method
    rows = enrich_geo(ips.union(ips), prepare_geo(geo, "bucketed")).count()
    assert rows == 2 * len(addrs)


def test_wide_overlapping_ranges(spark):
    """Ranges that cover whole blocks meet as one row per block."""
    rnd = random.Random(8)
    ranges = [(rnd.randrange(0, 1 << 20), rnd.randrange(1 << 24, 1 << 25), f"W{i}", "w", float(i), 0.0) for i in range(40)]
    ranges += [(70000, 80000, "in", "i", 0.0, 0.0), (70000, 80000, None, None, None, None)]
    addrs = [rnd.randrange(0, 1 << 25) for _ in range(500)] + [70000, 80000, 75000]
    expect = {}
    for x in addrs:
        hits = [r for r in ranges if r[0] <= x <= r[1]]
        if hits:
            expect[dotted(x)] = min(hits, key=lambda r: (-r[0], r[1], r[2] is not None, r[2]))[2]
    ips = spark.createDataFrame([(dotted(x),) for x in set(addrs)], "ip_address string")
    geo = spark.createDataFrame(ranges, GEO)
    for prepared in (prepare_geo(geo, "broadcast"), prepare_geo(geo, "bucketed"), geo):
        assert {r.ip_address: r.country for r in lookup_locations(ips, prepared).collect()} == expect


def test_repeated_addresses_keep_their_rows(spark):
    df = spark.createDataFrame([("10.0.0.7",)] * 5 + [(None,)] * 4 + [("x",)], "ip_address string")
    for method in ("broadcast", "bucketed"):
        out = enrich_geo(df, prepare_geo(fx.geo_ranges(spark), method)).collect()
        assert len(out) == 10 and sum(r.country == "A" for r in out) == 5

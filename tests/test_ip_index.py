import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from bucketlens.operators import ip_index as ix
from bucketlens.plans.explain import plan_text

RANGES = "ip_start string, ip_end string, name string"
MAPPED = 0xFFFF << 32


def number(text):
    """What the library of Python says, with its stricter and laxer points aside."""
    try:
        a = ipaddress.ip_address(text)
    except ValueError:
        return None
    return MAPPED + int(a) if a.version == 4 else int(a)


VALID = ["1.2.3.4", "255.255.255.255", "0.0.0.0", "::", "::1", "2001:db8::ff00:42:8329", "2001:DB8:0:0:0:0:2:1", "1:2:3:4:5:6:7:8",
         "::ffff:10.0.0.1", "64:ff9b::192.0.2.33", "fe80::", "1::8", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "1:2:3:4:5:6:1.2.3.4", "::2:3:4:5:6:7:8"]
INVALID = ["", "-", "1.2.3", "1.2.3.256", "1.2.3.4.5", ":", ":::", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "12345::", "g::", "1:2:3:4:5:6:7:8::",
           "::1%eth0", "1.2.3.4::", "::1.2.3", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "::ffff:1.2.3.256", " ::1", "a name"]


def test_addresses_in_text(spark):
    df = spark.createDataFrame([(t,) for t in [*VALID, *INVALID]] + [(None,)], "t string")
    got = {r.t: r.b for r in df.select("t", ix.ip_bytes(F.col("t")).alias("b")).collect()}
    assert {t: int.from_bytes(got[t], "big") for t in VALID} == {t: number(t) for t in VALID}
    assert {got[t] for t in [*INVALID, None]} == {None}


@pytest.mark.parametrize("start,end", [(0, 2**128 - 1), (0, 0), (5, 5), (1, 2**128 - 2), (2**64 - 3, 2**64 + 9), (10, 9), (96, 127)])
def test_blocks_make_up_the_range(start, end):
    at = start
    blocks = list(ix.aligned_blocks(start, end))
    for length, first in blocks:
        assert first == at and first % (1 << 128 - length) == 0
        at += 1 << 128 - length
    assert at == max(end + 1, start) and len(blocks) <= 254


def winner(address, ranges):
    if address is None:
        return None
    inside = [(-a, b, n) for a, b, n in ranges if a is not None and b is not None and a <= address <= b]
    return min(inside, key=lambda r: (r[0], r[1], r[2] is not None, r[2] or ""))[2] if inside else None


def text(x):
    return str(ipaddress.ip_address(x - MAPPED)) if MAPPED <= x < MAPPED + 2**32 else str(ipaddress.IPv6Address(x))


@pytest.fixture
def nested():
    """Thousands of overlapping and nested ranges of both families, a third of
    them inside one /8, and addresses around their ends."""
    rnd = random.Random(9)
    ranges = []
    for i in range(2000):
        base = MAPPED + (10 << 24) if i % 3 == 0 else MAPPED if i % 3 == 1 else 0x20010DB8 << 96
        width = 24 if i % 3 == 0 else 32 if i % 3 == 1 else 90
        a = base + rnd.getrandbits(width) // 8
        size = 1 << rnd.randrange(0, width - 4)
        ranges.append((a, a + rnd.randrange(size), f"r{i}"))
    ranges += [(0, 2**128 - 1, "all"), (MAPPED, MAPPED + 2**32 - 1, "v4"), ranges[0][:2] + ("a first",), ranges[1][:2] + (None,)]
    edges = [x for a, b, _ in ranges[:600] for x in (a - 1, a, b, b + 1) if 0 <= x < 2**128]
    return ranges, [text(x) for x in rnd.sample(edges, 800)]


@pytest.mark.parametrize("limit", [10**6, 0])
def test_lookup_against_plain_python(spark, nested, limit):
    ranges, addresses = nested
    table = spark.createDataFrame([(text(a), text(b), n) for a, b, n in ranges], RANGES)
    index = ix.prepare_ip_index(table, ["name"], broadcast_max_rows=limit)
    assert index.small == (limit > 0)
    df = spark.createDataFrame([(i, a) for i, a in enumerate([*addresses, None, "-", "x"])], "i long, ip_address string")
    got = {r.i: r.name for r in ix.enrich_ips(df, index).collect()}
    assert got == {i: winner(number(a or ""), ranges) for i, a in enumerate([*addresses, None, "-", "x"])}
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")  # what Spark would broadcast by itself
    try:
        tree = plan_text(ix.lookup_ips(df, index))
    finally:
        spark.conf.set(name, before)
    assert ("BroadcastHashJoin" in tree) == index.small and "NestedLoop" not in tree and "Window" not in tree


def test_odd_ranges(spark):
    rows = [("1.0.0.9", "1.0.0.1", "backwards"), (None, "1.0.0.1", "no start"), ("x", "y", "no address"), ("1.0.0.0", "::1", "across, backwards"), ("::1", "1.0.0.0", "across")]
    index = ix.prepare_ip_index(spark.createDataFrame(rows, RANGES), ["name"])
    df = spark.createDataFrame([("1.0.0.0",), ("1.0.0.1",), ("::1",), ("::",)], "ip_address string")
    assert {r.ip_address: r.name for r in ix.enrich_ips(df, index).collect()} == {"1.0.0.0": "across", "1.0.0.1": None, "::1": "across", "::": None}
    none = ix.prepare_ip_index(spark.createDataFrame([], RANGES), ["name"])
    assert [r.name for r in ix.enrich_ips(df, none).collect()] == [None] * 4


def test_hot_address_and_hot_prefix(spark):
    index = ix.prepare_ip_index(spark.createDataFrame([("10.0.0.0", "10.255.255.255", "ten"), ("10.0.0.7", "10.0.0.7", "seven")], RANGES), ["name"], broadcast_max_rows=0)
    df = spark.range(30000).selectExpr("CASE WHEN id % 3 = 0 THEN '10.0.0.7' ELSE concat('10.1.', id % 200, '.', id % 250) END AS ip_address", "id")
    got = ix.enrich_ips(df, index).groupBy("name").count().collect()
    assert {r.name: r["count"] for r in got} == {"seven": 10000, "ten": 20000}


def test_overlapping_ranges_do_not_repeat_blocks(spark):
    """Ranges that share blocks: a block is kept once, for the winner."""
    rows = [("10.0.0.0", "10.0.255.255", f"wide {i}") for i in range(300)]
    rows += [(f"10.0.{i % 9}.0", f"10.0.{i % 9}.{i % 50}", f"r{i:04d}") for i in range(2000)]
    index = ix.prepare_ip_index(spark.createDataFrame(rows, RANGES).repartition(4), ["name"])
    every = index.blocks.count()
    assert every <= 4 * index.blocks.select("_len", "_hi", "_lo").distinct().count() < 2000
    df = spark.createDataFrame([("10.0.3.0",), ("10.0.3.40",), ("10.0.200.1",), ("10.1.0.0",)], "ip_address string")
    whole = [(number(a), number(b), n) for a, b, n in rows]
    assert {r.ip_address: r.name for r in ix.enrich_ips(df, index).collect()} == {r.ip_address: winner(number(r.ip_address), whole) for r in df.collect()}

"""Addresses of both families looked up in ranges that may nest and overlap.

Every address is a 128-bit number, kept as 16 bytes (IPv4 `a.b.c.d` as
`::ffff:a.b.c.d`). A range is cut into aligned blocks, each a prefix with a
length, at most 254 of them, usually a few. An address lies in a range exactly if
one of the range's blocks is the address cut to that block's length, so the
range join becomes an equality join: each distinct address is looked up once for
each block length that occurs. No window, no sweep and no order is needed, the
ranges may be any number and nest in any way, and a prefix that many addresses
share is a hot key of an ordinary join (adaptive execution splits it).

Of the containing ranges the most specific wins: the greatest start, then the
smallest end, then the smallest of the other columns.

``prepare_ip_index`` sorts the ranges, so that neighbours are cut together,
and gives each block to the winner among those that have it: where ranges
overlap or are equal, most blocks are not repeated in the index (the ones that
are cost only space). The blocks are written once to the session's scratch
folder and counted by length (at most 129 rows). Up to ``broadcast_max_rows``
they are sent to every task. Rows with a missing or invalid address get NULLs; ranges with a
missing bound or an end before the start hold nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.network import ipv4_to_long
from ..session import ship_package, stored
from .geo import BROADCAST_MAX_ROWS, GEO_COLUMNS

BITS = 128
_SPREAD = 1 << 16
#: Ranges that are cut together (bounds the work arrays: 254 blocks each at most).
CUT_TOGETHER = 1 << 15

_U = np.uint64


# --- addresses -------------------------------------------------------------------
def _hex32(number: Column) -> Column:
    return F.lpad(F.lower(F.hex(number)), 8, "0")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _v6_bytes(text: Column) -> Column:
    """Groups in lower case, at most one `::` → 16 bytes; NULL if malformed."""
    none = F.array().cast("array<string>")
    groups = lambda half: F.when(half.isNull() | (half == ""), none).otherwise(F.split(half, ":", -1))

    def of_sides(s: Column) -> Column:
        n = F.size(s["left"]) + F.size(s["right"])
        whole = ((s["parts"] == 1) & (n == 8)) | ((s["parts"] == 2) & (n <= 7))
        zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - n, F.lit(0)))
        every = F.concat(s["left"], zeros, s["right"])
        good = F.forall(every, lambda g: g.rlike("^[0-9a-f]{1,4}$"))
        return F.when(whole & good, F.unhex(F.array_join(F.transform(every, lambda g: F.lpad(g, 4, "0")), "")))

    def of_halves(h: Column) -> Column:
        sides = F.struct(groups(F.get(h, F.lit(0))).alias("left"), groups(F.get(h, F.lit(1))).alias("right"), F.size(h).alias("parts"))
        return _let(sides, of_sides)

    return _let(F.split(text, "::", -1), of_halves)


def _undotted(text: Column) -> Column:
    """A dotted tail stands for the last two groups."""
    def of_tail(tail: Column) -> Column:
        digits = _hex32(ipv4_to_long(tail))
        two = F.concat(F.substring(digits, 1, 4), F.lit(":"), F.substring(digits, 5, 4))
        return F.when(F.instr(tail, ".") > 0, F.concat(F.regexp_replace(text, "[0-9.]+$", ""), two)).otherwise(text)

    return _let(F.regexp_extract(text, ":([0-9.]+)$", 1), of_tail)


def ip_bytes(ip: Column) -> Column:
    """An IPv4 or IPv6 address in text → its 16 bytes; NULL for anything else."""
    v4 = _let(ipv4_to_long(ip), lambda n: F.when(n.isNotNull(), F.unhex(F.concat(F.lit("0" * 20 + "ffff"), _hex32(n)))))
    return F.when(F.instr(ip, ":") > 0, _let(F.lower(ip), lambda t: _let(_undotted(t), _v6_bytes))).otherwise(v4)


def _half(address: Column, first: int) -> Column:
    """Eight bytes as a signed 64-bit number."""
    return F.conv(F.hex(F.substring(address, first, 8)), 16, -10).cast("bigint")


def _cut(hi: Column, lo: Column, length: int) -> list[Column]:
    """The two halves cut to the first ``length`` bits."""
    mask = lambda bits: F.lit(-(1 << (64 - bits)) if bits else 0).cast("bigint")
    return [hi.bitwiseAND(mask(min(length, 64))), lo.bitwiseAND(mask(max(length - 64, 0)))]


# --- the index -------------------------------------------------------------------
def _bits(x: np.ndarray) -> np.ndarray:
    """The bit lengths of unsigned 64-bit numbers."""
    for by in (1, 2, 4, 8, 16, 32):
        x = x | x >> _U(by)
    return np.bitwise_count(x).astype(np.int64)


def _halves(numbers: Iterable[bytes]) -> list[np.ndarray]:
    """16-byte numbers as two arrays of 64 bits."""
    both = np.frombuffer(b"".join(numbers), ">u8").astype(np.uint64).reshape(-1, 2)
    return [both[:, 0].copy(), both[:, 1].copy()]


def _blocks(starts: Iterable[bytes], ends: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(range, length, first address in two halves) of the largest aligned blocks
    that make up each range. All ranges take a block in turn: the greatest that
    is aligned at their start and does not pass their end."""
    (hi, lo), (end_hi, end_lo) = _halves(starts), _halves(ends)
    at = np.arange(len(hi))
    out = []
    with np.errstate(over="ignore"):
        while True:
            left = (hi < end_hi) | ((hi == end_hi) & (lo <= end_lo))
            at, hi, lo, end_hi, end_lo = (x[left] for x in (at, hi, lo, end_hi, end_lo))
            if not len(at):
                break
            aligned = np.where(lo > 0, _bits(lo & (~lo + _U(1))) - 1, np.where(hi > 0, 63 + _bits(hi & (~hi + _U(1))), BITS))
            # addresses that are left, 0 for all 2^128
            few = end_lo - lo + _U(1)
            many = end_hi - hi - (end_lo < lo) + (few == 0)
            fitting = np.where((many == 0) & (few == 0), BITS, np.where(many > 0, 63 + _bits(many), _bits(few) - 1))
            size = np.minimum(aligned, fitting)
            out.append((at, BITS - size, hi, lo))
            shift = _U(1) << (size % 64).astype(np.uint64)
            next_lo = np.where(size < 64, lo + shift, lo)
            next_hi = hi + np.where(size < 64, next_lo < lo, np.where(size < BITS, shift, _U(0))).astype(np.uint64)
            more = (next_hi > hi) | ((next_hi == hi) & (next_lo > lo))  # past the last address there is none
            at, hi, lo, end_hi, end_lo = (x[more] for x in (at, next_hi, next_lo, end_hi, end_lo))
    if not out:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    at, length, hi, lo = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(at, kind="stable")
    return at[order], length[order], hi[order], lo[order]


def aligned_blocks(start: int, end: int) -> Iterator[tuple[int, int]]:
    """(length, first address) of the largest aligned blocks that make up a range."""
    _, length, hi, lo = _blocks([start.to_bytes(16, "big")], [end.to_bytes(16, "big")])
    for n, h, l in zip(length.tolist(), hi.tolist(), lo.tolist()):  # noqa: E741
        yield n, h << 64 | l


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= CUT_TOGETHER:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _cut_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of ranges that come in the order in which they win: of those
    cut together, only the first with a block keeps it."""
    for ranges in _together(batches):
        at, length, hi, lo = _blocks(ranges["ip_start"].to_pylist(), ranges["ip_end"].to_pylist())
        order = np.lexsort((at, lo, hi, length))
        key = np.stack([length.astype(np.uint64), hi, lo])[:, order]
        first = np.ones(len(order), bool)
        first[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
        keep = order[first]
        out = ranges.take(at[keep])
        for name, values in (("_len", length.astype(np.int32)), ("_hi", hi.view(np.int64)), ("_lo", lo.view(np.int64))):
            out = out.append_column(name, pa.array(values[keep]))
        yield from out.combine_chunks().to_batches()


@dataclass(frozen=True)
class IpIndex:
    """``blocks``: (ip_start, ip_end, columns…, _len, _hi, _lo); ``lengths``: the
    block lengths that occur."""

    blocks: DataFrame
    lengths: list[int]
    columns: list[str]
    small: bool


def prepare_ip_index(ranges: DataFrame, columns: Sequence[str] = GEO_COLUMNS, broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> IpIndex:
    """``ranges``: (ip_start, ip_end, *columns), the bounds (inclusive) as 16
    bytes or as text."""
    ship_package(ranges.sparkSession)
    bound = lambda c: F.col(c) if dict(ranges.dtypes)[c] == "binary" else ip_bytes(F.col(c))
    typed = ranges.select(bound("ip_start").alias("ip_start"), bound("ip_end").alias("ip_end"), *columns)
    valid = typed.where("ip_start <= ip_end AND length(ip_start) = 16 AND length(ip_end) = 16")
    # neighbours together and winners first, so that most ranges lose the blocks that others have too
    near = valid.repartitionByRange("ip_start", "ip_end").sortWithinPartitions(F.desc("ip_start"), "ip_end", *columns)
    schema = ", ".join(f"`{n}` {t}" for n, t in near.dtypes) + ", _len int, _hi bigint, _lo bigint"
    blocks = stored(near.mapInArrow(_cut_ranges, schema), "ip-index")
    counted = blocks.groupBy("_len").count().collect()  # at most 129 rows
    return IpIndex(blocks, sorted(r["_len"] for r in counted), list(columns), sum(r["count"] for r in counted) <= broadcast_max_rows)


def _ordered(address: Column, reverse: bool = False) -> list[Column]:
    """Two numbers that sort as the unsigned 128-bit address."""
    halves = [_half(address, f).bitwiseXOR(F.lit(-(1 << 63)).cast("bigint")) for f in (1, 9)]
    return [F.bitwise_not(h) if reverse else h for h in halves]


def lookup_ips(ips: DataFrame, index: IpIndex) -> DataFrame:
    """``(ip_address, ip_start, ip_end, *columns)``: one row for each distinct
    address inside some range, with the range that wins."""
    # no filter for NULLs, which meet no block: Spark would parse every row's address for it, before the distinct
    known = ips.select("ip_address").distinct().withColumn("_b", ip_bytes(F.col("ip_address")))
    halves = known.select("ip_address", _half(F.col("_b"), 1).alias("_ahi"), _half(F.col("_b"), 9).alias("_alo"))
    cuts = [F.struct(F.lit(n).alias("_len"), *[c.alias(a) for c, a in zip(_cut(F.col("_ahi"), F.col("_alo"), n), ("_hi", "_lo"))]) for n in index.lengths]
    kind = "array<struct<_len: int, _hi: bigint, _lo: bigint>>"
    each = halves.select("ip_address", F.inline(F.array(*cuts).cast(kind)))
    blocks = F.broadcast(index.blocks) if index.small else index.blocks
    hit = each.join(blocks, ["_len", "_hi", "_lo"])
    order = [c.alias(f"_o{i}") for i, c in enumerate([*_ordered(F.col("ip_start"), reverse=True), *_ordered(F.col("ip_end"))])]
    best = hit.groupBy("ip_address").agg(F.min(F.struct(*order, F.struct("ip_start", "ip_end", *index.columns).alias("_w")))["_w"].alias("_w"))
    return best.select("ip_address", *[F.col("_w").getField(c).alias(c) for c in ("ip_start", "ip_end", *index.columns)])


def enrich_ips(df: DataFrame, index: IpIndex) -> DataFrame:
    """Every row of ``df`` with the index's columns, by its ``ip_address``."""
    found = lookup_ips(df, index).select(F.col("ip_address").alias("_address"), *index.columns)
    # no address looks like this: rows without one meet nothing, in many tasks
    spread = F.concat(F.lit("no address "), F.pmod(F.xxhash64(*df.columns), F.lit(_SPREAD)).cast("string"))
    keyed = df.withColumn("_key", F.coalesce("ip_address", spread))
    return keyed.join(found, keyed["_key"] == found["_address"], "left").select(*[keyed[c] for c in df.columns], *[found[c] for c in index.columns])

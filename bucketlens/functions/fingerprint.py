"""Per-line hash pieces for order-insensitive content fingerprints.

An object's fingerprint is the multiset of its non-empty lines, reduced to
``count(*)`` plus exact integer sums of fixed-width hash pieces. Sums commute,
so Spark combines them map-side: no line list is ever collected, one huge
object is spread over many tasks, and line order, line ends (LF/CRLF) and
blank lines do not change the result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Each piece is 24 bits wide, so a bigint sum cannot overflow
# below 2^39 lines per object; 128 bits of hash per line in both modes.
PIECE_BITS = 24
PIECE_MASK = (1 << PIECE_BITS) - 1
MD5_HEX_PIECES = ((1, 6), (7, 6), (13, 6), (19, 6), (25, 6), (31, 2))
FAST_SEEDS = ("a", "b")


def md5_pieces(line: Column) -> list[Column]:
    """MD5 of the UTF-8 line (the digest the reference used), as six pieces."""
    h = F.md5(line)
    return [F.conv(F.substring(h, start, width), 16, 10).cast("bigint") for start, width in MD5_HEX_PIECES]


def fast_pieces(line: Column) -> list[Column]:
    """Two seeded 64-bit xxhash values, as six non-negative pieces."""
    out = []
    for seed in FAST_SEEDS:
        h = F.xxhash64(F.lit(seed), line)
        out += [
            F.shiftrightunsigned(h, 40),
            F.shiftright(h, 16).bitwiseAND(F.lit(PIECE_MASK)),
            h.bitwiseAND(F.lit((1 << 16) - 1)),
        ]
    return out


def pieces(line: Column, mode: str) -> list[Column]:
    if mode == "lines":
        return md5_pieces(line)
    if mode == "lines_fast":
        return fast_pieces(line)
    raise ValueError(f"unknown line fingerprint mode {mode!r}")

"""IPv4 address expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dotted-quad IPv4 text and the width of one /16 block.
IPV4_TEXT = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$"
PREFIX16_SHIFT = 16


def ipv4_to_long(ip: Column) -> Column:
    """`a.b.c.d` → a·2^24 + b·2^16 + c·2^8 + d as bigint; NULL for anything
    else (absent, `-`, IPv6, an octet above 255)."""
    octets = F.split(ip, r"\.")
    parts = [octets.getItem(i).cast("bigint") for i in range(4)]
    in_range = parts[0] <= 255
    for p in parts[1:]:
        in_range = in_range & (p <= 255)
    value = parts[0] * (1 << 24) + parts[1] * (1 << 16) + parts[2] * (1 << 8) + parts[3]
    return F.when(ip.rlike(IPV4_TEXT) & in_range, value)


def prefix16(ip_num: Column) -> Column:
    """The /16 block an address belongs to."""
    return F.shiftright(ip_num, PREFIX16_SHIFT)

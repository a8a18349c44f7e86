"""Column expressions that turn one access-log line into typed fields.

Everything here is a built-in Spark expression (regex, split, casts), so a
parse stays inside whole-stage codegen and Catalyst can prune the fields a
query does not use.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .reuse import once


@dataclass(frozen=True)
class FieldPattern:
    """One field of a log line: ``before (body) after``, optionally ``(body)?``."""

    name: str
    body: str
    before: str = ""
    after: str = ""
    optional: bool = False

    def render(self, capture: bool) -> str:
        group = f"({self.body})" if capture else f"(?:{self.body})"
        return f"{self.before}{group}{'?' if self.optional else ''}{self.after}"


# ---------------------------------------------------------------------------
# The server access-log line layout.
#
# Field order of one line (18 fields, one space between fields).
LOG_FIELDS = (
    "owner_name", "bucket_name", "event_time", "ip_address", "requester",
    "request_id", "operation", "key", "request_uri", "http_status",
    "error_code", "bytes_sent", "object_size", "total_time",
    "turn_around_time", "referrer", "user_agent", "version_id",
)
# Strict pattern, field by field. The whole line must match. The IPv4 address
# is optional but both spaces around it stay; the URI is exactly three tokens
# `\S+ .\S+ .\S+`; every other field is one `\S+` token; nothing may follow the
# version id. The time is `[...]` (taken without its brackets).
STRICT_FIELDS = (
    FieldPattern("owner_name", r"\S+"),
    FieldPattern("bucket_name", r"\S+"),
    FieldPattern("event_time", r"[^\]]+", before=r"\[", after=r"\]"),
    FieldPattern("ip_address", r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}", optional=True),
    FieldPattern("requester", r"\S+"),
    FieldPattern("request_id", r"\S+"),
    FieldPattern("operation", r"\S+"),
    FieldPattern("key", r"\S+"),
    FieldPattern("request_uri", r"\S+ .\S+ .\S+"),
    FieldPattern("http_status", r"\S+"),
    FieldPattern("error_code", r"\S+"),
    FieldPattern("bytes_sent", r"\S+"),
    FieldPattern("object_size", r"\S+"),
    FieldPattern("total_time", r"\S+"),
    FieldPattern("turn_around_time", r"\S+"),
    FieldPattern("referrer", r"\S+"),
    FieldPattern("user_agent", r"\S+"),
    FieldPattern("version_id", r"\S+"),
)
STRICT_TAIL = ""
# Tolerant pattern: quoted fields may hold spaces (but no quotes), the address
# may be empty or `-`, and extra fields after the version id are allowed. The
# address, the key and the status have a shape, so that a line with a field too
# few or an open quote is malformed instead of shifted by one.
QUOTED_OR_TOKEN = r'"[^"]*"|[^"\s]\S*'
ADDRESS = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}|[0-9A-Fa-f]*:[0-9A-Fa-f:.]+|-"
TOLERANT_FIELDS = (
    FieldPattern("owner_name", r"\S+"),
    FieldPattern("bucket_name", r"\S+"),
    FieldPattern("event_time", r"[^\]]*", before=r"\[", after=r"\]"),
    FieldPattern("ip_address", ADDRESS, optional=True),
    FieldPattern("requester", r'[^"\s]\S*'),
    FieldPattern("request_id", r'[^"\s]\S*'),
    FieldPattern("operation", r'[^"\s]\S*'),
    FieldPattern("key", r'[^"\s]\S*'),
    FieldPattern("request_uri", QUOTED_OR_TOKEN),
    FieldPattern("http_status", r"[0-9]{3}|-"),
    FieldPattern("error_code", r'[^"\s]\S*'),
    FieldPattern("bytes_sent", r'[^"\s]\S*'),
    FieldPattern("object_size", r'[^"\s]\S*'),
    FieldPattern("total_time", r'[^"\s]\S*'),
    FieldPattern("turn_around_time", r'[^"\s]\S*'),
    FieldPattern("referrer", QUOTED_OR_TOKEN),
    FieldPattern("user_agent", QUOTED_OR_TOKEN),
    FieldPattern("version_id", r'[^"\s]\S*'),
)
TOLERANT_TAIL = r"(?: [^\n]*)?"
# Positional mode: split on single spaces (trailing spaces make no tokens). Token 2 is `[dd/MMM/yyyy:HH:mm:ss`,
# token 3 the `+hhmm]` offset, tokens 9, 10 and 11 are joined without spaces
# into the URI, tokens after 20 are ignored; fewer than 21 tokens is malformed.
POSITIONAL_TOKENS = {
    "owner_name": 0, "bucket_name": 1, "ip_address": 4, "requester": 5,
    "request_id": 6, "operation": 7, "key": 8, "http_status": 12,
    "error_code": 13, "bytes_sent": 14, "object_size": 15, "total_time": 16,
    "turn_around_time": 17, "referrer": 18, "user_agent": 19, "version_id": 20,
}
POSITIONAL_TIME_TOKENS = (2, 3)
POSITIONAL_URI_TOKENS = (9, 10, 11)
POSITIONAL_MIN_TOKENS = 21
# Time inside the brackets, e.g. `06/Feb/2019:00:00:38 +0000`.
TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
# Integer tokens: optional sign and digits only (no `5.0`, no blanks).
INTEGER_TOKEN = r"^[+-]?[0-9]+$"
# Sizes that are absent or unreadable count as zero bytes.
ABSENT_SIZE = 0
# ---------------------------------------------------------------------------

MODES = ("strict", "tolerant", "positional")


def line_pattern(fields, tail: str = "", capture: int | None = None) -> str:
    """Whole-line pattern; ``capture=None`` captures every field, an index
    captures that field only (for engines limited to few groups)."""
    pieces = [f.render(capture is None or capture == i) for i, f in enumerate(fields)]
    return r"\A" + " ".join(pieces) + tail + r"\z"


def _split_fields(value: Column, fields, tail: str) -> Column:
    """One regex evaluation per line: rewrite a matching line into its fields
    joined by newlines, then split. A line read from text never holds a
    newline (one that does is refused up front), so the line matched exactly
    when the split gives one piece per field."""
    sep = "\n"
    pattern = line_pattern(fields, tail)
    replacement = sep.join(f"${i + 1}" for i in range(len(fields)))
    parts = F.split(F.regexp_replace(value, F.lit(pattern), F.lit(replacement)), sep)
    return F.when(F.instr(value, sep) == 0, parts)


def to_long(token: Column) -> Column:
    """Integer token → bigint; NULL if not an integer or out of range."""
    return F.when(token.rlike(INTEGER_TOKEN), token.try_cast("bigint"))


def to_int(token: Column) -> Column:
    return F.when(token.rlike(INTEGER_TOKEN), token.try_cast("int"))


EPOCH_NTZ = "1970-01-01 00:00:00"


def to_event_time(text: Column) -> Column:
    """`dd/MMM/yyyy:HH:mm:ss +hhmm` → UTC wall-clock ``timestamp_ntz``.

    The offset is honoured (24-hour clock, full day-of-month), the result does
    not depend on the session time zone, and bad input gives NULL."""
    instant = F.try_to_timestamp(text, F.lit(TIME_FORMAT))
    epoch = F.lit(EPOCH_NTZ).cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def _absent_to_null(token: Column, empty_only: bool) -> Column:
    if empty_only:
        return F.nullif(token, F.lit(""))
    return F.when(~token.isin("", "-"), token)


def typed_fields(raw: dict[str, Column], ok: Column, strict_ip: bool) -> list[Column]:
    """Raw field strings → the typed ``access_log`` columns (NULL when not ok)."""

    def keep(c: Column) -> Column:
        return F.when(ok, c)

    out = {
        "owner_name": keep(raw["owner_name"]),
        "bucket_name": keep(raw["bucket_name"]),
        "event_time": keep(to_event_time(raw["event_time"])),
        "ip_address": keep(_absent_to_null(raw["ip_address"], empty_only=strict_ip)),
        "requester": keep(raw["requester"]),
        "request_id": keep(raw["request_id"]),
        "operation": keep(raw["operation"]),
        "key": keep(raw["key"]),
        "request_uri": keep(raw["request_uri"]),
        "http_status": keep(to_int(raw["http_status"])),
        "error_code": keep(raw["error_code"]),
        "bytes_sent": keep(F.coalesce(to_long(raw["bytes_sent"]), F.lit(ABSENT_SIZE).cast("bigint"))),
        "object_size": keep(F.coalesce(to_long(raw["object_size"]), F.lit(ABSENT_SIZE).cast("bigint"))),
        "total_time": keep(to_long(raw["total_time"])),
        "turn_around_time": keep(to_long(raw["turn_around_time"])),
        "referrer": keep(raw["referrer"]),
        "user_agent": keep(raw["user_agent"]),
        "version_id": keep(raw["version_id"]),
    }
    return [out[n].alias(n) for n in LOG_FIELDS] + [(~ok).alias("is_malformed")]


FIELDS_COL = "_fields"


def split_stage(value: Column, mode: str) -> Column:
    """First step: the line's field strings as one array (NULL or the wrong
    length when the line does not match). It runs inside a generator of its
    own, so the regex is evaluated once per line."""
    if mode == "positional":
        # trailing separators make no tokens (a missing last field stays missing)
        return F.split(F.rtrim(value), " ", -1)
    fields, tail = (STRICT_FIELDS, STRICT_TAIL) if mode == "strict" else (TOLERANT_FIELDS, TOLERANT_TAIL)
    return _split_fields(value, fields, tail)


def _matched(arr: Column, mode: str) -> Column:
    if mode == "positional":
        ok = F.size(arr) >= POSITIONAL_MIN_TOKENS
    else:
        ok = F.size(arr) == len(STRICT_FIELDS if mode == "strict" else TOLERANT_FIELDS)
    return F.coalesce(arr.isNotNull() & ok, F.lit(False))


def typed_stage(mode: str) -> list[Column]:
    """Second step: array pieces → typed ``access_log`` columns."""
    return once(("typed_stage", mode), lambda: _typed_stage(mode))


def _typed_stage(mode: str) -> list[Column]:
    arr = F.col(FIELDS_COL)
    ok = _matched(arr, mode)

    def tok(i: int) -> Column:
        return F.get(arr, i)

    if mode != "positional":
        fields = STRICT_FIELDS if mode == "strict" else TOLERANT_FIELDS
        raw = {f.name: tok(i) for i, f in enumerate(fields)}
        return typed_fields(raw, ok, strict_ip=(mode == "strict"))

    raw = {name: tok(i) for name, i in POSITIONAL_TOKENS.items()}
    t_day, t_off = POSITIONAL_TIME_TOKENS
    day, off = tok(t_day), tok(t_off)
    # `[dd/MMM/yyyy:HH:mm:ss` + ` ` + `+hhmm]`, brackets off; the reference
    # dropped the offset, here it is put back so the instant is right.
    raw["event_time"] = F.concat(
        F.when(day.startswith("["), day.substr(F.lit(2), F.length(day) - 1)),
        F.lit(" "),
        F.when(off.endswith("]"), off.substr(F.lit(1), F.length(off) - 1)),
    )
    raw["request_uri"] = F.concat(*[tok(i) for i in POSITIONAL_URI_TOKENS])
    return typed_fields(raw, ok, strict_ip=False)

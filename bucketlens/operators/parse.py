"""Parsing operators: lines → typed access-log rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.logfields import FIELDS_COL, MODES, split_stage, typed_stage


def parse_access_log(lines: DataFrame, mode: str = "strict", value_col: str = "value", keep=None) -> DataFrame:
    """Parse one log line per row into the ``access_log`` schema.

    * ``strict``: the whole line must match the 18-field pattern; anything else
      is a malformed row (all fields NULL, ``is_malformed`` true) — counted, not
      dropped and not turned into sentinel values.
    * ``tolerant``: quoted fields may hold spaces, the address may be empty or
      `-`, extra trailing fields are ignored.
    * ``positional``: split on single spaces; fewer than 21 tokens is malformed.

    ``keep`` lists input columns to carry through (e.g. the source file).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    keep = list(keep or [])
    # The split runs inside a generator so that filters on parsed fields
    # (`NOT is_malformed`, `ip_address IS NOT NULL`, ...) stop above it:
    # pushed through a plain projection they would re-run the regex once per
    # filter. One regex evaluation per line, whatever the query.
    once = F.explode(F.array(split_stage(F.col(value_col), mode))).alias(FIELDS_COL)
    return lines.select(*keep, once).select(*keep, *typed_stage(mode))

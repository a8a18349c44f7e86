"""Plan inspection through the public ``DataFrame.explain`` output."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def uses_python(df: DataFrame) -> bool:
    """True if any Python UDF evaluation is in the plan."""
    text = plan_text(df)
    return any(op in text for op in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"))

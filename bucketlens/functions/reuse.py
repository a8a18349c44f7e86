"""Build a Column expression once per Spark context and reuse it.

Columns are immutable, unresolved expressions, so one built object can go
into any number of DataFrames. Building the parser's few hundred expression
nodes is a few hundred driver→JVM calls; doing it once per context keeps
query construction on the driver cheap.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

T = TypeVar("T")
_BUILT: dict[tuple, object] = {}


def once(key: tuple, build: Callable[[], T]) -> T:
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    token = id(sc._jsc) if sc is not None and sc._jsc is not None else None
    if any(t != token for t, _ in _BUILT):
        _BUILT.clear()  # a new context: expressions of the old one are dead
    k = (token, key)
    if k not in _BUILT:
        _BUILT[k] = build()
    return _BUILT[k]  # type: ignore[return-value]

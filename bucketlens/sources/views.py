"""Named relations: register DataFrames as temporary views for SQL users."""

from __future__ import annotations

from pyspark.sql import DataFrame


def register_views(**frames: DataFrame) -> None:
    """``register_views(access_log=log, object_inventory=inv)``; queries over
    them take values as bound parameters (``spark.sql(q, args={...})``),
    never spliced into the SQL text."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)

"""The parsed log as a bucketed, sorted table, and as SQL table functions.

Parsing is the larger part of every log query, and shuffling by a key the next.
``write_log_table`` pays both once: the good rows are dealt out by a hash of
``by`` into files that are sorted by it. Aggregates and joins on those columns
then need no exchange. The default, (bucket_name, key), spreads a bucket that
holds a third of all rows over all files; per-bucket results still combine inside
each file first and exchange one row a bucket and file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.log_analytics import good_rows
from ..session import shuffle_partitions

BY = ("bucket_name", "key")


def write_log_table(log: DataFrame, name: str, by: Sequence[str] = BY, files: int | None = None, path: str | None = None) -> DataFrame:
    """Write a parsed log as the table ``name`` (replaced if it exists), in
    ``files`` hash buckets of the columns ``by``, and return it. The rows are
    dealt out before the write, so that each bucket is one file."""
    spark = log.sparkSession
    n = files or shuffle_partitions(spark)
    rows = good_rows(log).repartition(n, *by).write.mode("overwrite").format("parquet")
    rows = rows.option("path", path) if path else rows
    rows.bucketBy(n, *by).sortBy(*by).saveAsTable(name)
    return spark.table(name)


#: Name of each function, its parameters, its result and its query over {log}.
TABLE_FUNCTIONS = {
    "top_buckets": (
        "n INT", "bucket_name STRING, total_size DECIMAL(38,0)",
        """SELECT bucket_name, total_size FROM (
  SELECT bucket_name, total_size, row_number() OVER (ORDER BY total_size DESC, bucket_name) AS place
  FROM (SELECT bucket_name, CAST(sum(CAST(object_size AS DECIMAL(20,0))) AS DECIMAL(38,0)) AS total_size
        FROM {log} WHERE NOT is_malformed GROUP BY bucket_name)) WHERE place <= top_buckets.n""",
    ),
    "bucket_objects": (
        "bucket STRING", "bucket_name STRING, key STRING, hits BIGINT, bytes DECIMAL(38,0)",
        """SELECT bucket_name, key, count(key) AS hits, CAST(sum(CAST(object_size AS DECIMAL(20,0))) AS DECIMAL(38,0)) AS bytes
  FROM {log} WHERE NOT is_malformed AND key <> '-' AND bucket_name = bucket_objects.bucket GROUP BY bucket_name, key""",
    ),
    "address_hits": (
        "touching STRING", "ip_address STRING, hits BIGINT",
        """SELECT ip_address, hits FROM (
  SELECT ip_address, count(ip_address) AS hits, max(chosen) AS touched
  FROM (SELECT ip_address, bucket_name = address_hits.touching AS chosen FROM {log} WHERE NOT is_malformed AND ip_address IS NOT NULL)
  GROUP BY ip_address) WHERE touched""",
    ),
}


def register_table_functions(spark: SparkSession, log: str = "access_log") -> list[str]:
    """Make the TABLE_FUNCTIONS over the view or table ``log`` callable from SQL
    (`SELECT * FROM top_buckets(5)`) in this session. They are SQL functions:
    their bodies become part of the calling query's plan, without Python."""
    for name, (parameters, result, body) in TABLE_FUNCTIONS.items():
        source = ".".join(f"`{part}`" for part in log.split("."))
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE({result}) RETURN {body.format(log=source)}")
    return list(TABLE_FUNCTIONS)

"""Skew experiments, with Spark's event log written to a scratch folder.

1. A third of the log rows in one bucket: the running percentage as a plain
   window per bucket and as ``log_analytics.running_percentage``.
2. A third of the log rows are requests for one key, the largest object of
   the hot bucket (so all of them are in the top-k result): per-bucket top-k
   as a rank filter over a window on the rows and as
   ``log_analytics.top_objects_per_bucket``.

For each stage it reports the largest number of records any single task read
from a shuffle, next to the total.

    python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    from bucketlens.operators import log_analytics as la
    from bucketlens.operators.parse import parse_access_log
    from bucketlens.plans import fixtures as fx

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logs_dir = tempfile.mkdtemp(prefix="bucketlens-eventlog-")
    spark = (
        SparkSession.builder.master("local[8]").appName("skew-check")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.adaptive.enabled", "true")
        .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logs_dir)
        .config("spark.eventLog.compress", "false")
        # keep the 8 shuffle partitions: coalescing tiny test data into one task would hide skew
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    log = parse_access_log(fx.raw_lines(spark, sf_dir))
    hot = F.when(F.abs(F.hash("request_id")) % 3 == 0, F.lit("hot")).otherwise(F.col("bucket_name"))
    log = log.withColumn("bucket_name", hot)

    big = F.abs(F.hash("request_id")) % 3 == 0
    hot_key = (parse_access_log(fx.raw_lines(spark, sf_dir))
               .withColumn("bucket_name", F.when(big, F.lit("hot")).otherwise(F.col("bucket_name")))
               .withColumn("key", F.when(big, F.lit("big")).otherwise(F.col("key")))
               .withColumn("object_size", F.when(big, F.lit(10**9).cast("bigint")).otherwise(F.col("object_size"))))

    def window_top(lg, n=3):
        w = Window.partitionBy("bucket_name").orderBy(F.desc("object_size"))
        rows = la.good_rows(lg).select("bucket_name", "key", "object_size")
        return rows.withColumn("rank", F.dense_rank().over(w)).where(F.col("rank") <= n)

    def plain(lg):
        w = Window.partitionBy("bucket_name").orderBy("object_size").rangeBetween(Window.unboundedPreceding, 0)
        rows = la.good_rows(lg)
        pct = F.try_divide(F.sum("object_size").over(w).cast("double") * 100, F.col("object_size"))
        return rows.select("bucket_name", "object_size", pct.alias("running_percentage"))

    sc = spark.sparkContext
    groups = (("plain window", plain(log)), ("running_percentage", la.running_percentage(log)),
              ("top-k window over rows", window_top(hot_key)), ("top_objects_per_bucket", la.top_objects_per_bucket(hot_key, n=3)))
    for name, df in groups:
        sc.setJobGroup(name, name)
        df.write.format("noop").mode("overwrite").save()
    sc.setJobGroup("report", "report")
    total_good = la.good_rows(log).count()
    hot_rows = la.good_rows(log).where("bucket_name = 'hot'").count()
    spark.stop()

    stage_group, task_records = {}, defaultdict(list)
    for path in glob.glob(os.path.join(logs_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or not os.path.basename(path).startswith("events_"):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    read = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    task_records[ev["Stage ID"]].append(read)
    print(f"good rows {total_good}, in the hot bucket {hot_rows} ({hot_rows / total_good:.0%})")
    for group, _ in groups:
        print(f"-- {group}: per stage, records read from shuffles (tasks, total, largest task, largest ÷ mean)")
        for s in sorted(s for s, g in stage_group.items() if g == group and sum(task_records.get(s, [])) > 0):
            recs = task_records[s]
            total, worst = sum(recs), max(recs)
            print(f"   stage {s:3d}: {len(recs):2d} tasks {total:7d} records, largest {worst:6d} "
                  f"({worst / total_good:.0%} of good rows), imbalance {worst / (total / len(recs)):.1f}")

if __name__ == "__main__":
    main()

import os
import tempfile

from conftest import SF0001

from bucketlens.operators.log_analytics import top_buckets_by_size
from bucketlens.operators.parse import parse_access_log
from bucketlens.plans import fixtures as fx
from bucketlens.streaming.logs import read_access_log_stream


def test_stream_equals_batch(spark):
    root = tempfile.mkdtemp(prefix="bucketlens-stream-")
    logs = os.path.join(root, "logs")
    fx.raw_lines(spark, SF0001).coalesce(3).write.text(logs)
    stream = read_access_log_stream(spark, logs, max_files_per_trigger=1)
    q = (top_buckets_by_size(stream, n=None).writeStream.outputMode("complete").format("memory")
         .queryName("bucket_sizes").option("checkpointLocation", os.path.join(root, "ckpt")).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted(tuple(r) for r in spark.sql("SELECT * FROM bucket_sizes").collect())
    batch = top_buckets_by_size(parse_access_log(spark.read.text(logs)), n=None)
    assert got == sorted(tuple(r) for r in batch.collect())
    assert len(got) == 50


def test_stream_malformed_per_file(spark):
    from bucketlens.operators.log_analytics import malformed_summary

    root = tempfile.mkdtemp(prefix="bucketlens-stream-")
    logs = os.path.join(root, "logs")
    os.makedirs(logs)
    from test_parse import line

    with open(os.path.join(logs, "one.log"), "w") as f:
        f.write(line() + "\nbroken\n")
    stream = read_access_log_stream(spark, logs, keep_source=True)
    q = (malformed_summary(stream, by=["source_file"]).writeStream.outputMode("complete").format("memory")
         .queryName("per_file").option("checkpointLocation", os.path.join(root, "ckpt")).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    rows = spark.sql("SELECT * FROM per_file").collect()
    assert [(os.path.basename(r.source_file), r.lines, r.good_lines, r.malformed_lines) for r in rows] == [("one.log", 2, 1, 1)]

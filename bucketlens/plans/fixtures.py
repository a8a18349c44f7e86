"""Inputs derived by Spark from the driver's tables (FIXTURES.md §3).

They let every registered query run over whole tables: the log lines grow
with ``events``, the object inventory and object contents with ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.reuse import once
from ..session import scratch_path
from ..sources.content import write_objects


# Schemas of the driver tables read here (TESTDATA.md). Given
# up front, a read skips schema inference from the file footer.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _when_mod(n: Column, m: int, then, otherwise) -> Column:
    return F.when(n % m == 0, then).otherwise(otherwise)


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One access-log line per event (`value`)."""
    return table(spark, sf_dir, "events").select(once(("raw_lines",), _raw_line))


def _raw_line() -> Column:
    eid, uid = F.col("event_id"), F.col("user_id")
    s = lambda c: c.cast("string")
    fields = [
        F.lit("own"),
        F.concat(F.lit("bkt-"), F.col("event_type"), F.lit("-"), s(uid % 10)),
        F.concat(F.lit("["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000]")),
        # left out altogether (NULL: one space less), empty (two spaces), or there
        F.when(eid % 37 == 0, F.lit(None)).when(eid % 11 == 0, F.lit("")).otherwise(
            F.concat(F.lit("10.0."), s(uid % 4), F.lit("."), s(uid))),
        F.concat(F.lit("arn:u"), s(uid)),
        F.concat(F.lit("R"), s(eid)),
        F.lit("REST.GET.OBJECT"),
        _when_mod(eid, 29, F.lit("-"), F.concat(F.lit("d/"), s(uid), F.lit(".txt"))),
        _when_mod(eid, 23, F.lit('"-"'), F.concat(F.lit('"GET /d/'), s(uid), F.lit(' HTTP/1.1"'))),
        F.when(F.col("event_type") == "error", F.lit("404 NoSuchKey")).otherwise(F.lit("200 -")),
        _when_mod(eid, 7, F.lit("-"), s(eid * 37 % 5000)),
        _when_mod(eid, 13, F.lit("-"), s(eid * 41 % 9000)),
        F.lit("12"),
        F.lit("-"),
        F.lit('"-"'),
        F.when(eid % 31 == 0, F.lit('"Moz "x" y"')).otherwise(_when_mod(eid, 17, F.lit('"Mozilla/5.0 (X11)"'), F.lit('"cli/1.0"'))),
        F.concat(F.lit("-"), F.when((eid % 19 == 0) | (eid % 37 == 0), F.lit(" hostid SigV4")).otherwise(F.lit(""))),
    ]
    return F.concat_ws(" ", *fields).alias("value")


def geo_ranges(spark: SparkSession) -> DataFrame:
    """Three /24 ranges, 10.0.0/24 … 10.0.2/24 (latitude ≠ longitude)."""
    rows = [
        (167772160, 167772415, "A", "a", 1.5, 2.5),
        (167772416, 167772671, "B", "b", 3.5, 4.5),
        (167772672, 167772927, "C", "c", 5.5, 6.5),
    ]
    schema = "ip_start bigint, ip_end bigint, country string, city string, latitude double, longitude double"
    return spark.createDataFrame(rows, schema)


def _file_key(docs: DataFrame) -> Column:
    suffix = (
        F.when(F.col("doc_id") % 4 == 0, ".txt")
        .when(F.col("doc_id") % 4 == 1, ".tar.gz")
        .when(F.col("doc_id") % 4 == 2, ".csv")
        .otherwise("")
    )
    return F.concat(F.lit("docs/"), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"), suffix)


def _files_of(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("source").alias("bucket_name"),
        _file_key(docs).alias("key"),
        F.octet_length("text").cast("bigint").alias("size"),
    )


def object_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(bucket_name, key, size)`: one file object per document."""
    return _files_of(table(spark, sf_dir, "documents"))


def object_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(bucket_name, key, size)`: one file per document plus directory markers."""
    docs = table(spark, sf_dir, "documents")
    files = _files_of(docs)
    dirs = docs.select(
        F.col("source").alias("bucket_name"),
        F.concat(F.lit("docs/"), F.col("lang"), F.lit("/")).alias("key"),
    ).distinct().withColumn("size", F.lit(0).cast("bigint"))
    return files.unionByName(dirs)


def object_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(bucket_name, key, content)`: the UTF-8 text of each file object."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("source").alias("bucket_name"), _file_key(docs).alias("key"), F.col("text").alias("content"))


def object_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(bucket_name, key, line)`: text split on `\\n`, one row per line."""
    texts = object_texts(spark, sf_dir)
    return texts.select("bucket_name", "key", F.explode(F.split("content", "\n", -1)).alias("line"))


# --- real files ------------------------------------------------------------------
_WRITTEN: dict[tuple, str] = {}


def _written(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """A folder of files derived from the tables, written once per application."""
    at = (spark.sparkContext.applicationId, sf_dir, name)
    if at not in _WRITTEN:
        path = scratch_path(spark, name)
        write(path)
        _WRITTEN[at] = path
    return _WRITTEN[at]


def log_folder(spark: SparkSession, sf_dir: str) -> str:
    """The access-log lines as gzip files in partition folders (`part=0` … `part=7`)."""
    def write(path: str) -> None:
        lines = raw_lines(spark, sf_dir).withColumn("part", F.crc32("value") % 8)
        lines.write.partitionBy("part").option("compression", "gzip").text(path)

    return _written(spark, sf_dir, "log-files", write)


def object_folder(spark: SparkSession, sf_dir: str) -> str:
    """Every document's text as one file, `bucket/key` (`.tgz` for `.tar.gz`: a
    text reader would decompress a name that ends in `.gz`)."""
    def write(path: str) -> None:
        plain = F.regexp_replace("key", r"[.]tar[.]gz$", ".tgz")
        write_objects(object_texts(spark, sf_dir).withColumn("key", plain), path)

    return _written(spark, sf_dir, "object-files", write)


# --- addresses of both families ----------------------------------------------------
def client_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(event_id, ip_address)` per event: IPv4, IPv6, IPv4 written as IPv6, and none."""
    uid, eid = F.col("user_id") % 65536, F.col("event_id")
    v4 = F.concat_ws(".", F.lit("10"), (uid % 4).cast("string"), F.floor(uid / 256).cast("string"), (uid % 256).cast("string"))
    v6 = F.concat(F.lit("2001:DB8:"), F.lower(F.hex(uid % 16)), F.lit("::"), F.lower(F.hex(uid)))
    ip = F.when(eid % 23 == 0, F.lit(None)).when(eid % 3 == 0, v6).when(eid % 7 == 0, F.concat(F.lit("::ffff:"), v4)).otherwise(v4)
    return table(spark, sf_dir, "events").select("event_id", ip.alias("ip_address"))


def client_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(ip_start, ip_end, name)`: one range a customer and one an order, nested
    and overlapping, of both families."""
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("name"))
    # the last 40 bits of a range's ends; a seventh of them are wide
    offset = F.expr("k * 104729 % 262144")
    width = F.expr("CASE WHEN k % 7 = 0 THEN 65536 ELSE k * 31 % 37 END")
    last = lambda n: F.lpad(F.lower(F.hex(n)), 10, "0")

    def family(df: DataFrame, head: Column) -> DataFrame:
        return df.select(F.unhex(F.concat(head, last(offset))).alias("ip_start"), F.unhex(F.concat(head, last(offset + width))).alias("ip_end"), "name")

    v6 = F.concat(F.lit("20010db8000"), F.lower(F.hex(F.expr("k % 16"))), F.lit("0" * 10))
    # ::ffff:10.x.y.z: the 40 bits are ff0a000000 and the offset
    v4 = lambda df: df.select(F.unhex(F.concat(F.lit("0" * 20 + "ffff"), F.substring(last(offset + 0x0A000000), 3, 8))).alias("ip_start"),
                              F.unhex(F.concat(F.lit("0" * 20 + "ffff"), F.substring(last(offset + width + 0x0A000000), 3, 8))).alias("ip_end"), "name")
    return v4(keys).unionByName(family(keys, v6)).unionByName(v4(orders)).unionByName(family(orders, v6))


def allowed_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(bucket_name)`: a long allow-list, five names a customer, few of which occur."""
    kinds = F.explode(F.split(F.lit("view,error,click,signup,purchase"), ","))
    rows = table(spark, sf_dir, "customer").where("c_custkey % 3 = 1").select("c_custkey", kinds.alias("kind"))
    return rows.select(F.concat(F.lit("bkt-"), F.col("kind"), F.lit("-"), F.col("c_custkey").cast("string")).alias("bucket_name"))

"""The registered queries: one callable ``(spark, sf_dir) → DataFrame`` per
operator of the inventory, each over whole derived tables (no row caps)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import duplicates as dup
from ..operators import geo as geo_ops
from ..operators import inventory as inv
from ..operators import ip_index
from ..operators import log_analytics as la
from ..operators.parse import parse_access_log
from ..operators.refinement import duplicate_files_refined
from ..operators.runtime_filter import prepare_allow_list
from ..sources import pieces
from ..sources.content import read_object_lines
from ..sources.inventory import read_inventory
from ..sources.listing import list_prefixes
from ..sources.log_table import register_table_functions
from ..sources.logs import read_access_logs
from ..sources.views import register_views
from . import fixtures as fx
from .params import (ALLOW_BROADCAST, BLOCK_BYTES, LOG_BUCKETS, ONE_BUCKET, PIECE_BYTES, PREFIX, PREFIX_BUCKET, SOME_BUCKETS, TOP_BUCKETS,
                     TOP_IPS, TOP_OBJECTS)

Query = Callable[[SparkSession, str], DataFrame]


def _log(spark: SparkSession, sf_dir: str, mode: str = "strict") -> DataFrame:
    return parse_access_log(fx.raw_lines(spark, sf_dir), mode=mode)


def _top_buckets_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-4: the parsed log registered as a view and queried with bound
    parameters (never spliced into the SQL text)."""
    register_views(access_log=_log(spark, sf_dir))
    return spark.sql(
        """SELECT bucket_name, CAST(sum(CAST(object_size AS DECIMAL(20,0))) AS DECIMAL(38,0)) AS total_size
           FROM access_log WHERE NOT is_malformed
           GROUP BY bucket_name ORDER BY total_size DESC, bucket_name LIMIT :n""",
        args={"n": TOP_BUCKETS},
    )


def _top_buckets_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U-3 / K-4: a SQL table function over the registered view."""
    register_views(access_log=_log(spark, sf_dir))
    register_table_functions(spark)
    return spark.sql("SELECT * FROM top_buckets(:n)", args={"n": TOP_BUCKETS})


def _geo_enrich(method: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return geo_ops.enrich_geo(_log(spark, sf_dir), geo_ops.prepare_geo(fx.geo_ranges(spark), method))

    return run


def _top_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W-1: the ranked sizes first, then a scan that keeps nothing else."""
    log = _log(spark, sf_dir)
    return la.top_objects_per_bucket(log, n=TOP_OBJECTS, sizes=la.prepare_top_sizes(log, TOP_OBJECTS))


def _hits_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-4 with a long list: the scan is filtered by the list's bounded filter."""
    allow = prepare_allow_list(fx.allowed_buckets(spark, sf_dir), broadcast_max_rows=ALLOW_BROADCAST)
    return la.hits_per_object(_log(spark, sf_dir), buckets=allow)


def _ip_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ip_index.prepare_ip_index(fx.client_ranges(spark, sf_dir), ["name"])
    return ip_index.enrich_ips(fx.client_addresses(spark, sf_dir), index)


def _log_files(mode: str) -> Query:
    """S-1 / S-2: the lines written as gzip files and read back as a log."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return read_access_logs(spark, fx.log_folder(spark, sf_dir), mode=mode).drop("part")

    return run


LOG_QUERIES: dict[str, Query] = {
    "parse_log_regex": lambda s, d: _log(s, d, "strict"),
    "parse_log_tolerant": lambda s, d: _log(s, d, "tolerant"),
    "parse_log_positional": lambda s, d: _log(s, d, "positional"),
    "malformed_summary": lambda s, d: la.malformed_summary(_log(s, d)),
    "distinct_buckets": lambda s, d: la.distinct_buckets(_log(s, d)),
    "total_bytes_sent": lambda s, d: la.total_bytes_sent(_log(s, d)),
    "top_buckets_by_size": lambda s, d: la.top_buckets_by_size(_log(s, d), n=TOP_BUCKETS),
    "top_buckets_by_size_sql": _top_buckets_sql,
    "top_objects_per_bucket": _top_objects,
    "top_objects_per_bucket_all": lambda s, d: la.top_objects_per_bucket(_log(s, d), n=None),
    "top_objects_per_bucket_selected": lambda s, d: la.top_objects_per_bucket(_log(s, d), n=TOP_OBJECTS, buckets=LOG_BUCKETS),
    "hits_per_object_selected": lambda s, d: la.hits_per_object(_log(s, d), buckets=LOG_BUCKETS),
    "running_percentage_selected": lambda s, d: la.running_percentage(_log(s, d), buckets=LOG_BUCKETS),
    "hits_per_object": lambda s, d: la.hits_per_object(_log(s, d)),
    "hits_per_ip": lambda s, d: la.hits_per_ip(_log(s, d), buckets=[ONE_BUCKET], geo=geo_ops.prepare_geo(fx.geo_ranges(s))),
    "top_ips": lambda s, d: la.top_ips(_log(s, d), n=TOP_IPS, geo=geo_ops.prepare_geo(fx.geo_ranges(s))),
    "running_percentage": lambda s, d: la.running_percentage(_log(s, d)),
    "percentage_of_bucket_total": lambda s, d: la.percentage_of_bucket_total(_log(s, d)),
    "geo_enrich": _geo_enrich("auto"),
    "geo_enrich_bucketed": _geo_enrich("bucketed"),
    "top_buckets_table_function": _top_buckets_function,
    "ip_enrich": _ip_enrich,
    "top_ips_sketch": lambda s, d: la.top_ips(_log(s, d), n=TOP_IPS, sketch=True),
    "hits_per_object_allowed": _hits_allowed,
    "log_files_strict": _log_files("strict"),
    "log_files_positional": _log_files("positional"),
}


def _inventory_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` read as an inventory report with its own column names."""
    return read_inventory(spark, f"{sf_dir.rstrip('/')}/documents.parquet", bucket_col="source", key_col="doc_id", size_col="n_chars")


def _line_query(op, mode: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(fx.object_files(spark, sf_dir), fx.object_lines(spark, sf_dir), mode=mode)

    return run


def _duplicates_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dup.duplicate_files_bytes(fx.object_files(spark, sf_dir), dup.md5_of_column(fx.object_texts(spark, sf_dir)))


def _tree_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    checksums = pieces.column_tree_checksums(fx.object_texts(spark, sf_dir), piece_bytes=PIECE_BYTES)
    return checksums(fx.object_files(spark, sf_dir))


def _listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-3: every document as a file, listed with its folders' markers."""
    return list_prefixes(spark, fx.object_folder(spark, sf_dir)).drop("path")


def _file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-8 / S-9: the files read back in one scan; a file without lines has 0."""
    root = fx.object_folder(spark, sf_dir)
    files = list_prefixes(spark, root).where("NOT is_directory")
    return dup.object_line_counts(read_object_lines(spark, root), objects=files)


def _file_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-9 over files: listed, told apart by size, ends, then all bytes by pieces.
    (The paths are P-12's, `root/bucket/key`.)"""
    root = fx.object_folder(spark, sf_dir)
    files = list_prefixes(spark, root).where("NOT is_directory").select("bucket_name", "key", "size")
    return duplicate_files_refined(
        files, pieces.end_probe(f"{root}/", block_bytes=BLOCK_BYTES), pieces.tree_checksums(f"{root}/", piece_bytes=PIECE_BYTES)
    ).drop("checksum")


OBJECT_QUERIES: dict[str, Query] = {
    "object_inventory": _inventory_table,
    "inventory_for_buckets": lambda s, d: inv.inventory_for_buckets(fx.object_inventory(s, d), SOME_BUCKETS),
    "classify_objects": lambda s, d: inv.classify_objects(fx.object_inventory(s, d), bucket=PREFIX_BUCKET),
    "classify_object_at_path": lambda s, d: inv.classify_objects(fx.object_inventory(s, d), path=PREFIX),
    "file_paths": lambda s, d: inv.file_paths(fx.object_inventory(s, d)),
    "file_paths_for_prefix": lambda s, d: inv.file_paths_for_prefix(fx.object_inventory(s, d), PREFIX_BUCKET, PREFIX),
    "object_line_counts": lambda s, d: dup.object_line_counts(fx.object_lines(s, d), objects=fx.object_files(s, d)),
    "directories_per_bucket": lambda s, d: inv.directories_per_bucket(fx.object_inventory(s, d)),
    "directories_per_bucket_json": lambda s, d: inv.directories_per_bucket_json(fx.object_inventory(s, d)),
    "directories_total": lambda s, d: inv.directories_total(fx.object_inventory(s, d)),
    "files_by_format": lambda s, d: inv.files_by_format(fx.object_inventory(s, d)),
    "files_by_bucket_format": lambda s, d: inv.files_by_bucket_format(fx.object_inventory(s, d)),
    "content_fingerprint": _line_query(dup.content_fingerprint, "lines"),
    # the fast checksum is no SQL function; its classes are
    "content_fingerprint_fast": lambda s, d: _line_query(dup.content_fingerprint, "lines_fast")(s, d).drop("checksum"),
    "duplicate_files": _line_query(dup.duplicate_files, "lines"),
    "checksum_groups": _line_query(dup.checksum_groups, "lines"),
    "duplicate_files_bytes": _duplicates_bytes,
    "object_tree_checksums": _tree_checksums,
    "object_listing": _listed_files,
    "file_line_counts": _file_lines,
    "file_duplicates_refined": _file_duplicates,
}


def queries() -> dict[str, Query]:
    return {**LOG_QUERIES, **OBJECT_QUERIES}

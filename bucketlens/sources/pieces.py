"""Checksums of objects of any size by pieces, so that one huge object is the
work of many tasks.

An object is cut into pieces of ``piece_bytes``. A leaf is the MD5 of a piece; a
node is the MD5 of the hexadecimal digests of up to ``FANOUT`` children, in
order. ``LEVELS`` levels of nodes stand above the leaves of every object, small
or large, so the digest depends on its bytes and the piece size only, not on how
the pieces were dealt to tasks. No task reads more than one piece at a time, and
no aggregate gathers more than FANOUT digests. With 4096³ pieces of 64 MB there is
room for any object. An empty object has one empty piece.

The sizes come with the objects (an inventory knows them). An object that is
shorter or longer than its size says is an error, not another checksum.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import object_uri
from ..session import ship_package, shuffle_partitions
from .content import READ_THREADS, _arrow_location

PIECE_BYTES = 64 << 20
FANOUT = 4096
LEVELS = 3
CHUNK_BYTES = 1 << 22
KEY = ["bucket_name", "key"]


def n_pieces(size: Column, piece_bytes: int) -> Column:
    return F.greatest(F.expr("1L"), F.floor((size + (piece_bytes - 1)) / piece_bytes).cast("bigint"))


def pieces_of(objects: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row a piece: the columns of ``objects`` (with ``size``) plus ``piece``,
    ``offset`` and ``length``."""
    last = n_pieces(F.col("size"), piece_bytes) - 1
    cut = objects.withColumn("piece", F.explode(F.sequence(F.expr("0L"), last)))
    offset = F.col("piece") * piece_bytes
    return cut.withColumns({"offset": offset, "length": F.least(F.lit(piece_bytes).cast("bigint"), F.col("size") - offset)})


def fold_pieces(leaves: DataFrame, key: list[str]) -> DataFrame:
    """(key, piece, digest) rows to (key, checksum)."""
    nodes = leaves.select(*key, "piece", "digest")
    for _ in range(LEVELS):
        children = F.array_sort(F.collect_list(F.struct("piece", "digest")))
        joined = F.array_join(F.transform(children, lambda c: c["digest"]), "")
        up = F.floor(F.col("piece") / FANOUT).cast("bigint")
        nodes = nodes.groupBy(*key, up.alias("up")).agg(F.md5(joined).alias("digest")).withColumnRenamed("up", "piece")
    return nodes.select(*key, F.col("digest").alias("checksum"))


def hash_range(path: str, offset: int, length: int, options: tuple = (), to_end: bool = False) -> tuple[str, int]:
    """MD5 of a range of a file and the bytes read. ``to_end``: the range must
    end where the file ends."""
    import hashlib

    fs, rel = _arrow_location(path, options)
    h, left = hashlib.md5(), length
    with fs.open_input_file(rel) as f:
        f.seek(offset)
        while left and (chunk := f.read(min(left, CHUNK_BYTES))):
            h.update(chunk)
            left -= len(chunk)
        if left or (to_end and f.size() != offset + length):
            raise OSError(f"not of the listed size: {path}")
    return h.hexdigest(), length


def _hash_batches(options: tuple):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(max_workers=READ_THREADS) as pool:
            for pdf in batches:
                ranges = zip(pdf["path"], pdf["offset"].tolist(), pdf["length"].tolist(), (pdf["offset"] + pdf["length"] == pdf["size"]).tolist())
                done = list(pool.map(lambda r: hash_range(r[0], r[1], r[2], options, r[3]), ranges))
                yield pdf.assign(digest=[d for d, _ in done], bytes_read=[n for _, n in done])

    return run


def hashed_pieces(pieces: DataFrame, partitions: int | None = None, filesystem: dict | None = None) -> DataFrame:
    """``pieces`` (path, size, offset, length, …) plus ``digest`` and
    ``bytes_read``, dealt out piece by piece."""
    ship_package(pieces.sparkSession)
    options = tuple(sorted((filesystem or {}).items()))
    dealt = pieces.repartition(partitions or shuffle_partitions(pieces.sparkSession), "path", "offset")
    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes) + ", digest string, bytes_read long"
    return dealt.mapInPandas(_hash_batches(options), schema)


def _placed(candidates: DataFrame, root: str | None, objects: DataFrame | None) -> DataFrame:
    """Candidates with their ``path``: below ``root``, or from a listing."""
    if root is not None:
        return candidates.withColumn("path", object_uri(root, F.col("bucket_name"), F.col("key")))
    return candidates.join(objects.select(*KEY, "path"), KEY)


def tree_checksums(root: str | None = None, objects: DataFrame | None = None, piece_bytes: int = PIECE_BYTES,
                   partitions: int | None = None, filesystem: dict | None = None):
    """A ``checksums`` function (see ``duplicates.byte_classes``) that hashes
    pieces: of the objects below ``root`` (`root + bucket/key`), or of listed
    ``objects`` with a ``path``."""

    def checksums(candidates: DataFrame) -> DataFrame:
        placed = _placed(candidates, root, objects).select(*KEY, "size", "path")
        leaves = hashed_pieces(pieces_of(placed, piece_bytes), partitions, filesystem)
        return fold_pieces(leaves, [*KEY, "size"])

    return checksums


def end_probe(root: str | None = None, objects: DataFrame | None = None, block_bytes: int = 1 << 16,
              partitions: int | None = None, filesystem: dict | None = None):
    """A ``probe`` function (see ``refinement``): a digest of the first and the
    last ``block_bytes`` of each file."""

    def probe(candidates: DataFrame) -> DataFrame:
        placed = _placed(candidates, root, objects).select(*KEY, "size", "path")
        block = F.least(F.col("size"), F.lit(block_bytes).cast("bigint"))
        ends = F.array(F.expr("0L"), F.col("size") - block)
        # an object of at most one block has one range
        ranges = placed.withColumns({"length": block, "offset": F.explode(F.array_distinct(ends))})
        read = hashed_pieces(ranges, partitions, filesystem)
        both = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("offset", "digest"))), lambda r: r["digest"]), "")
        return read.groupBy(*KEY, "size").agg(both.alias("probe"), F.sum("bytes_read").alias("bytes_read"))

    return probe


def column_tree_checksums(contents: DataFrame, column: str = "content", piece_bytes: int = PIECE_BYTES):
    """``tree_checksums`` for contents held in a table column."""

    def checksums(candidates: DataFrame) -> DataFrame:
        body = F.col(column).cast("binary")
        last = n_pieces(F.col("size"), piece_bytes) - 1
        digest = lambda i: F.md5(F.substring(body, (i * piece_bytes + 1).cast("int"), F.lit(piece_bytes)))
        rows = contents.join(candidates, KEY)
        leaves = rows.select(*KEY, "size", F.posexplode(F.transform(F.sequence(F.expr("0L"), last), digest)).alias("piece", "digest"))
        return fold_pieces(leaves.withColumn("piece", F.col("piece").cast("bigint")), [*KEY, "size"])

    return checksums


def column_end_probe(contents: DataFrame, column: str = "content", block_bytes: int = 1 << 16):
    """``end_probe`` for contents held in a table column."""

    def probe(candidates: DataFrame) -> DataFrame:
        body = F.col(column).cast("binary")
        block = F.least(F.col("size"), F.lit(block_bytes).cast("bigint")).cast("int")
        ends = F.concat(F.md5(F.substring(body, F.lit(1), block)), F.md5(F.substring(body, (F.col("size") - block + 1).cast("int"), block)))
        read = F.least(F.col("size"), F.lit(2 * block_bytes).cast("bigint"))
        return contents.join(candidates, KEY).select(*KEY, "size", ends.alias("probe"), read.alias("bytes_read"))

    return probe

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from bucketlens.operators import duplicates as dup
from bucketlens.operators.refinement import duplicate_files_refined, refined, refined_byte_classes
from bucketlens.plans.explain import plan_text
from bucketlens.sources import pieces as pc
from bucketlens.sources.content import inventory_checksums

LINES = "bucket_name string, key string, size long"


def md5(b):
    return hashlib.md5(b).hexdigest()


def tree(body, piece, fanout):
    nodes = [md5(body[i : i + piece]) for i in range(0, max(len(body), 1), piece)]
    for _ in range(pc.LEVELS):
        nodes = [md5("".join(nodes[i : i + fanout]).encode()) for i in range(0, len(nodes), fanout)]
    assert len(nodes) == 1
    return nodes[0]


@pytest.fixture
def files(spark, tmp_path):
    rnd = random.Random(4)
    big = bytes(rnd.randrange(256) for _ in range(5000))
    middle = bytearray(big)
    middle[2500] ^= 1  # the same size, first and last block
    bodies = {
        "a/big": big, "a/big copy": big, "b/middle": bytes(middle), "b/tail": big[:-1] + b"!" if big[-1:] != b"!" else big[:-1] + b"?",
        "a/small": b"xy", "b/small#1": b"xy", "b/other": b"zz", "a/empty": b"", "b/empty": b"", "b/alone": b"123456789",
    }
    for name, body in bodies.items():
        os.makedirs(os.path.dirname(tmp_path / name), exist_ok=True)
        (tmp_path / name).write_bytes(body)
    rows = [(*name.split("/"), len(body)) for name, body in bodies.items()]
    return f"file://{tmp_path}/", bodies, spark.createDataFrame(rows, LINES)


@pytest.mark.parametrize("tasks", [1, 7])
def test_tree_digest_does_not_depend_on_the_dealing(spark, files, monkeypatch, tasks):
    monkeypatch.setattr(pc, "FANOUT", 5)
    root, bodies, objects = files
    got = pc.tree_checksums(root, piece_bytes=100, partitions=tasks)(objects).collect()
    assert {f"{r.bucket_name}/{r.key}": r.checksum for r in got} == {n: tree(b, 100, 5) for n, b in bodies.items()}


def test_one_object_is_many_rows_of_bounded_size(spark):
    objects = spark.createDataFrame([("b", "huge", 5 << 40)], LINES).withColumn("path", F.lit("p"))
    cut = pc.pieces_of(objects)
    most, n, total, end = cut.agg(F.max("length"), F.count("*"), F.sum("length"), F.max(F.col("offset") + F.col("length"))).first()
    assert (most, n, total, end) == (pc.PIECE_BYTES, (5 << 40) // pc.PIECE_BYTES, 5 << 40, 5 << 40)
    # dealt out by piece, not by file
    spread = cut.repartition(8, "path", "offset").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) == 8 and max(r["count"] for r in spread) < 0.2 * n


def test_column_and_file_digests_agree(spark, files):
    root, bodies, objects = files
    rows = [(*name.split("/"), bytearray(body)) for name, body in bodies.items()]
    contents = spark.createDataFrame(rows, "bucket_name string, key string, content binary")
    by_file = pc.tree_checksums(root, piece_bytes=64)(objects)
    by_column = pc.column_tree_checksums(contents, piece_bytes=64)(objects)
    assert sorted(by_file.collect()) == sorted(by_column.collect())
    probes = [p(objects.where("size > 0")).select("bucket_name", "key", "bytes_read").collect() for p in (pc.end_probe(root, block_bytes=10),)]
    assert {f"{r.bucket_name}/{r.key}": r.bytes_read for r in probes[0]} == {n: min(20, len(b)) if len(b) > 10 else len(b) for n, b in bodies.items() if b}


@pytest.mark.parametrize("size", [3, 1])
def test_a_wrong_size_is_an_error(spark, files, size):
    root, _, _ = files
    objects = spark.createDataFrame([("a", "small", size)], LINES)
    with pytest.raises(Exception, match="not of the listed size"):
        pc.tree_checksums(root, piece_bytes=2)(objects).collect()


def classes(df):
    return sorted((r.bucket_name, r.key, r.class_id, r.n_copies) for r in df.collect())


def test_refinement_finds_the_same_classes(spark, files):
    root, bodies, objects = files
    probe, full = pc.end_probe(root, block_bytes=16), pc.tree_checksums(root, piece_bytes=1000)
    got = refined_byte_classes(objects, probe, full)
    assert classes(got) == classes(dup.byte_classes(objects, full))
    # told apart by the probe: alone, without a checksum
    assert {r.checksum for r in got.collect() if r.key in ("tail", "other")} == {None}
    pairs = [(r.bucket_name, r.key) for r in duplicate_files_refined(objects, probe, full).collect()]
    assert pairs == [("a", "big"), ("a", "big copy"), ("a", "empty"), ("b", "empty"), ("a", "small"), ("b", "small#1")]


def test_bytes_read_stay_within_the_bound(spark, files):
    """Counted by what the reads return, against two blocks for each size that
    occurs again and the whole of each object whose ends do."""
    root, bodies, objects = files
    block, read = 16, {"probe": 0, "full": 0}

    def probe(candidates):
        out = pc.end_probe(root, block_bytes=block)(candidates)
        read["probe"] += out.agg(F.sum("bytes_read")).first()[0]
        return out

    def full(candidates):
        leaves = pc.hashed_pieces(pc.pieces_of(candidates.withColumn("path", F.concat(F.lit(root), "bucket_name", F.lit("/"), "key")), 1000))
        read["full"] += leaves.agg(F.sum("bytes_read")).first()[0]
        return pc.fold_pieces(leaves, [*pc.KEY, "size"])

    refined_byte_classes(objects, probe, full).collect()
    tied = [b for b in bodies.values() if b and sum(len(b) == len(x) for x in bodies.values()) > 1]
    ends = lambda b: (len(b), b[:block], b[-block:])
    again = [b for b in tied if sum(ends(b) == ends(x) for x in tied) > 1]
    assert read["probe"] <= sum(min(len(b), 2 * block) for b in tied)
    assert read["full"] == sum(len(b) for b in again) < sum(len(b) for b in tied)


@pytest.mark.parametrize("checksums", [inventory_checksums, lambda root: pc.tree_checksums(root, piece_bytes=1000)])
def test_files_are_hashed_once(files, checksums):
    """The classes are an aggregate of the checksums joined back to them."""
    root, _, objects = files
    out = dup.duplicate_files_bytes(objects, checksums(root))
    assert out.count() == 6
    out.collect()
    tree = plan_text(out).split("\n\n")[0].split("Initial Plan")[0]
    assert tree.count("MapInPandas") == 1 and "ReusedExchange" in tree


def test_refinement_edge_cases(spark):
    objects = spark.createDataFrame([("b", "x", None), ("b", "y", None), ("b", "e", 0)], LINES)
    never = lambda c: c.select("*", F.raise_error(F.lit("read")).cast("string").alias("probe"))
    full = lambda c: c.withColumn("checksum", F.raise_error(F.lit("read")).cast("string"))
    assert classes(refined_byte_classes(objects, never, full))[0] == ("b", "e", "b/e", 1)
    assert refined(never, full)(objects.where("false")).count() == 0


def test_refinement_of_a_hot_class(spark):
    """A third of all objects are one text."""
    rows = [("b", f"k{i}", "same text" if i % 3 == 0 else f"text {i % 500:03d} {'x' * (i % 7)}") for i in range(3000)]
    contents = spark.createDataFrame(rows, "bucket_name string, key string, content string")
    objects = contents.select("bucket_name", "key", F.octet_length("content").cast("long").alias("size"))
    probe, full = pc.column_end_probe(contents, block_bytes=4), pc.column_tree_checksums(contents, piece_bytes=5)
    assert classes(refined_byte_classes(objects, probe, full)) == classes(dup.byte_classes(objects, full))

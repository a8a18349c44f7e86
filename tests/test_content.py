import gzip
import os
import random
import tempfile

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from bucketlens.operators import duplicates as dup
from bucketlens.plans import fixtures as fx
from bucketlens.plans.explain import plan_text
from bucketlens.sources.content import file_checksums, read_bucket_lines, read_object_lines
from bucketlens.sources.inventory import list_objects, split_bucket_key


def write_tree(files: dict[str, bytes]) -> str:
    root = tempfile.mkdtemp(prefix="bucketlens-objs-")
    for rel, data in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write(data)
    return root


def classes(df):
    """Set of frozensets of keys per class."""
    groups = {}
    for r in df.collect():
        groups.setdefault(r.class_id, set()).add(f"{r.bucket_name}/{r.key}")
    return {frozenset(v) for v in groups.values()}


def run_both(spark, files, inventory_rows=None):
    root = write_tree(files)
    listed = list_objects(spark, root)
    objects = listed if inventory_rows is None else spark.createDataFrame(inventory_rows, "bucket_name string, key string, size bigint")
    lines = read_object_lines(spark, root)
    by_lines = classes(dup.line_classes(objects, lines, "lines"))
    by_fast = classes(dup.line_classes(objects, lines, "lines_fast"))
    by_bytes = classes(dup.byte_classes(listed, file_checksums(listed)))
    return by_lines, by_fast, by_bytes


def test_line_order_line_ends_and_blank_lines(spark):
    files = {"b/x1.txt": b"x\ny\n", "b/x2.txt": b"y\r\nx", "b/x3.txt": b"x\n\ny\n"}
    by_lines, by_fast, by_bytes = run_both(spark, files)
    assert by_lines == by_fast == {frozenset({"b/x1.txt", "b/x2.txt", "b/x3.txt"})}
    # sizes 4, 4, 5: only the two 4-byte files are hashed, and they differ
    assert by_bytes == {frozenset({"b/x1.txt"}), frozenset({"b/x2.txt"}), frozenset({"b/x3.txt"})}


def test_gzip_equals_text_by_lines_not_by_bytes(spark):
    text = b"alpha\nbeta\ngamma\n"
    gz = gzip.compress(text)
    pad = b"q" * (len(gz) - len(text)) if len(gz) > len(text) else b""
    files = {"b/t.txt": text, "b/t.txt.gz": gz, "c/same_size.bin": b"z" * len(gz), "c/t2.txt": text + pad}
    by_lines, _, by_bytes = run_both(spark, files)
    assert frozenset({"b/t.txt", "b/t.txt.gz"}) in by_lines
    assert all(len(c) == 1 for c in by_bytes)


def test_zero_byte_and_blank_only_via_inventory(spark):
    files = {"b/blank.txt": b"\n\n", "b/real.txt": b"r\n"}
    inventory = [("b", "z1", 0), ("b", "z2", 0), ("b", "blank.txt", 2), ("b", "real.txt", 2)]
    root = write_tree(files)
    objects = spark.createDataFrame(inventory, "bucket_name string, key string, size bigint")
    lines = read_object_lines(spark, root)
    by_lines = classes(dup.line_classes(objects, lines, "lines"))
    assert frozenset({"b/z1", "b/z2", "b/blank.txt"}) in by_lines
    listed = list_objects(spark, root)
    paths = listed.select("bucket_name", "key", "path")
    objs = objects.join(paths, ["bucket_name", "key"], "left")
    by_bytes = classes(dup.byte_classes(objects, file_checksums(objs.where(F.col("path").isNotNull()))))
    assert frozenset({"b/z1", "b/z2"}) in by_bytes
    assert not any("b/blank.txt" in c and len(c) > 1 for c in by_bytes)


def test_listing_skips_hidden_and_empty_files(spark):
    root = write_tree({"b/_hidden.txt": b"h\n", "b/.dot.txt": b"d\n", "b/empty.txt": b"", "b/ok.txt": b"o\n"})
    keys = {r.key for r in list_objects(spark, root).collect()}
    assert keys == {"ok.txt"}  # the inventory table is the complete source


def test_permuting_lines_keeps_fingerprint(spark):
    rnd = random.Random(11)
    rows = []
    base = [f"line {i} {rnd.random()}" for i in range(200)]
    for k in range(5):
        shuffled = base[:]
        rnd.shuffle(shuffled)
        rows += [("b", f"k{k}", ln) for ln in shuffled]
    rows += [("b", "other", ln) for ln in base[:-1] + [base[0]]]  # same count, one line swapped
    lines = spark.createDataFrame(rows, "bucket_name string, key string, line string")
    objects = lines.select("bucket_name", "key").distinct()  # no sizes: what was read is known
    for mode in ("lines", "lines_fast"):
        got = classes(dup.line_classes(objects, lines, mode))
        assert frozenset({f"b/k{k}" for k in range(5)}) in got
        assert frozenset({"b/other"}) in got


def test_no_line_lists_are_collected(spark):
    objects = fx.object_inventory(spark, SF001)
    lines = fx.object_lines(spark, SF001)
    text = plan_text(dup.duplicate_files(objects.where(~F.col("key").endswith("/")), lines))
    assert "collect_list" not in text and "sort_array" not in text


def test_modes_agree_on_fixture(spark):
    files = objects = fx.object_inventory(spark, SF001).where(~F.col("key").endswith("/"))
    lines = fx.object_lines(spark, SF001)
    a = classes(dup.line_classes(objects, lines, "lines"))
    b = classes(dup.line_classes(objects, lines, "lines_fast"))
    assert a == b
    assert sum(1 for c in a if len(c) > 1) == 62
    dup_bytes = dup.byte_classes(files, dup.md5_of_column(fx.object_texts(spark, SF001)))
    assert sum(1 for c in classes(dup_bytes) if len(c) > 1) == 62


def test_object_line_counts(spark):
    root = write_tree({"b/a.txt": b"1\n\n3\n", "b/b.txt": b"x"})
    lines = read_object_lines(spark, root)
    got = {(r.key, r.n_lines) for r in dup.object_line_counts(lines).collect()}
    assert got == {("a.txt", 3), ("b.txt", 1)}


def test_unknown_mode(spark):
    df = spark.createDataFrame([("b", "k", "x")], "bucket_name string, key string, line string")
    with pytest.raises(ValueError):
        dup.line_classes(df.select("bucket_name", "key"), df, "words")


def test_bytes_from_inventory_and_root(spark):
    from bucketlens.sources.content import inventory_checksums

    files = {"b/one.bin": b"same bytes", "c/two.bin": b"same bytes", "c/three.bin": b"diff bytes", "c/big.bin": b"x" * 99}
    root = write_tree(files)
    inventory = spark.createDataFrame([("b", "one.bin", 10), ("c", "two.bin", 10), ("c", "three.bin", 10),
                                       ("c", "big.bin", 99), ("b", "z0", 0), ("c", "z1", 0)],
                                      "bucket_name string, key string, size bigint")
    got = classes(dup.byte_classes(inventory, inventory_checksums("file://" + root)))
    assert got == {frozenset({"b/one.bin", "c/two.bin"}), frozenset({"c/three.bin"}), frozenset({"c/big.bin"}),
                   frozenset({"b/z0", "c/z1"})}
    copies = dup.duplicate_files_bytes(inventory, inventory_checksums("file://" + root)).collect()
    assert [(r.class_id, r.n_copies) for r in copies] == [("b/one.bin", 2), ("b/one.bin", 2), ("b/z0", 2), ("b/z0", 2)]


def test_odd_file_names(spark):
    names = ["b/a b.txt", "b/p%20q.txt", "c/x#y.txt", "c/1+1.txt", "c/ü.txt"]
    root = write_tree({n: b"same\n" for n in names})
    listed = list_objects(spark, root)
    lines = read_object_lines(spark, root)
    assert {f"{r.bucket_name}/{r.key}" for r in lines.collect()} == set(names)
    by_lines = classes(dup.line_classes(listed, lines, "lines"))
    by_bytes = classes(dup.byte_classes(listed, file_checksums(listed)))
    assert by_lines == by_bytes == {frozenset(names)}


def pairs(df):
    return {(r.bucket_name, r.key) for r in df.collect()}


def test_layouts_name_bucket_and_key(spark, tmp_path, monkeypatch):
    root = write_tree({"b1/top.txt": b"1\n", "b1/logs/a.txt": b"2\n", "b2/x.txt": b"3\n"})
    want = {("b1", "top.txt"), ("b1", "logs/a.txt"), ("b2", "x.txt")}
    assert pairs(read_object_lines(spark, root)) == pairs(list_objects(spark, root)) == want
    assert pairs(read_object_lines(spark, "file://" + root + "/")) == want
    # each root is one bucket: a file at its top level is a key
    roots = {"one": root + "/b1", "two": f"file:{root}/b2"}
    assert pairs(read_object_lines(spark, roots)) == {("one", "top.txt"), ("one", "logs/a.txt"), ("two", "x.txt")}
    # Spark resolves a relative root against its working folder
    relative = os.path.relpath(root)
    assert pairs(read_object_lines(spark, relative)) == want


def test_bucket_is_the_authority(spark):
    paths = spark.createDataFrame([("s3a://mybucket/logs/a.txt",), ("s3a://mybucket/a.txt",), ("s3a://other/d/e f.txt",)], "p string")
    got = paths.select(*split_bucket_key(spark, F.col("p"), ["s3a://mybucket/", "s3a://other/"], "authority"))
    assert pairs(got) == {("mybucket", "logs/a.txt"), ("mybucket", "a.txt"), ("other", "d/e f.txt")}
    assert read_bucket_lines.__doc__


def test_path_outside_its_root_is_an_error(spark):
    root = write_tree({"loose.txt": b"1\n", "b/k.txt": b"2\n"})
    with pytest.raises(Exception, match="outside a bucket folder"):
        read_object_lines(spark, root).collect()
    elsewhere = spark.createDataFrame([("file:/else/where.txt",)], "p string")
    for place in (root, {"b": root}):
        with pytest.raises(Exception, match="not under"):
            elsewhere.select(*split_bucket_key(spark, F.col("p"), place)).collect()
    with pytest.raises(ValueError):
        split_bucket_key(spark, F.col("p"), [root])


def test_unread_objects_are_not_empty(spark):
    lines = spark.createDataFrame([("b", "k1", "x"), ("b", "k2", "x"), ("b", "blank", "")], "bucket_name string, key string, line string")
    rows = [("b", "k1", 1), ("b", "k2", 2), ("b", "blank", 1), ("b", "zero", 0), ("b", "unread", 9), ("b", "unknown", None)]
    objects = spark.createDataFrame(rows, "bucket_name string, key string, size bigint")
    for mode in ("lines", "lines_fast"):
        got = {r.key: (r.class_id, r.n_copies) for r in dup.line_classes(objects, lines, mode).collect()}
        assert got == {"k1": ("b/k1", 2), "k2": ("b/k1", 2), "blank": ("b/blank", 2), "zero": ("b/blank", 2),
                       "unread": (None, None), "unknown": (None, None)}
    assert {r.key for r in dup.duplicate_files(objects, lines).collect()} == {"k1", "k2", "blank", "zero"}


def test_checksum_does_not_depend_on_the_other_objects(spark):
    lines = spark.createDataFrame([("b", "k1", "x"), ("b", "k2", "x"), ("a", "k0", "x")], "bucket_name string, key string, line string")
    sizes = "bucket_name string, key string, size bigint"
    one = dup.content_fingerprint(spark.createDataFrame([("b", "k1", 1)], sizes), lines).collect()[0]
    more = dup.checksum_groups(spark.createDataFrame([("b", "k1", 1), ("b", "k2", 1), ("a", "k0", 1)], sizes), lines).collect()
    assert {r.checksum for r in more} == {one.checksum} and {r.class_id for r in more} == {"a/k0"} and one.class_id == "b/k1"
    assert [r.n_copies for r in more] == [3, 3, 3]


def test_unknown_size_and_repeated_keys_by_bytes(spark):
    sizes = "bucket_name string, key string, size bigint"
    contents = spark.createDataFrame([("b", "x", "aa"), ("b", "y", "aa")], "bucket_name string, key string, content string")
    objects = spark.createDataFrame([("b", "x", 2), ("b", "y", 2), ("b", "lost", None)], sizes)
    got = {r.key: (r.class_id, r.n_copies) for r in dup.byte_classes(objects, dup.md5_of_column(contents)).collect()}
    assert got == {"x": ("b/x", 2), "y": ("b/x", 2), "lost": (None, None)}
    twice = spark.createDataFrame([("b", "x", 2), ("b", "x", 2)], sizes)
    with pytest.raises(Exception, match="listed twice"):
        dup.byte_classes(twice, dup.md5_of_column(contents)).collect()


def test_latest_versions_of_an_inventory(spark, tmp_path):
    from bucketlens.sources.inventory import read_inventory

    rows = [("b", "k", 1, False, False), ("b", "k", 2, True, False), ("b", "gone", 0, True, True), ("b", "l", 5, True, None)]
    spark.createDataFrame(rows, "bucket string, key string, size bigint, is_latest boolean, is_delete_marker boolean").write.parquet(f"{tmp_path}/inv")
    got = read_inventory(spark, f"{tmp_path}/inv", bucket_col="bucket", latest_col="is_latest", delete_marker_col="is_delete_marker")
    assert {tuple(r) for r in got.collect()} == {("b", "k", 2), ("b", "l", 5)}

from bucketlens.operators import inventory as inv

INV = "bucket_name string, key string, size bigint"


def inventory(spark, rows):
    return spark.createDataFrame(rows, INV)


def test_file_formats(spark):
    df = inventory(spark, [("my.bucket", "noext", 1), ("b", "dir.v1/file", 1), ("b", "a.tar.gz", 1), ("b", "a.", 1),
                           ("b", "x/y.CSV", 1), ("b", "d/", 0)])
    got = {(r.format, r.n_files) for r in inv.files_by_format(df).collect()}
    assert got == {("(none)", 3), ("gz", 1), ("CSV", 1)}
    per_bucket = {(r.bucket_name, r.format): r.n_files for r in inv.files_by_bucket_format(df).collect()}
    assert per_bucket[("my.bucket", "(none)")] == 1


def test_classify_and_paths(spark):
    df = inventory(spark, [("b", "d/", 0), ("b", "d/f.txt", 3), ("c", "g.txt", 1)])
    kinds = {(r.key, r.kind, r.path) for r in inv.classify_objects(df, bucket="b").collect()}
    assert kinds == {("d/", "directory", "b/d/"), ("d/f.txt", "file", "b/d/f.txt")}
    one = inv.classify_objects(df, bucket="b", path="d/f.txt").collect()
    assert [(r.key, r.kind) for r in one] == [("d/f.txt", "file")]
    assert {r.path for r in inv.file_paths(df).collect()} == {"b/d/f.txt", "c/g.txt"}
    assert [r.key for r in inv.file_paths_for_prefix(df, "b", "d/").collect()] == ["d/f.txt"]
    assert {r.key for r in inv.file_paths_for_prefix(df, "b").collect()} == {"d/f.txt"}


def test_bucket_allow_list(spark):
    df = inventory(spark, [("a", "k", 1), ("b", "k", 1)])
    assert inv.inventory_for_buckets(df, []).count() == 2
    assert inv.inventory_for_buckets(df, None).count() == 2
    assert [r.bucket_name for r in inv.inventory_for_buckets(df, ["b"]).collect()] == ["b"]
    assert [r.bucket_name for r in inv.inventory_for_buckets(df, (x for x in ["b"])).collect()] == ["b"]


def test_directories(spark):
    df = inventory(spark, [("b", "d/", 0), ("b", "d/e/f.txt", 3), ("b", "x/y", 1), ("c", "top.txt", 1)])
    assert {(r.bucket_name, r.n_directories) for r in inv.directories_per_bucket(df).collect()} == {("b", 1)}
    assert inv.directories_total(df).collect()[0].n_directories == 1
    implied = {(r.bucket_name, r.key) for r in inv.directories(df, implied=True).collect()}
    assert implied == {("b", "d/"), ("b", "d/e/"), ("b", "x/")}
    empty = inventory(spark, [("c", "k", 1)])
    assert inv.directories_total(empty).collect()[0].n_directories == 0


def test_json_rows(spark):
    df = inventory(spark, [("b", "d/", 0), ("b", "e/", 0)])
    assert [r.json for r in inv.directories_per_bucket_json(df).collect()] == ['{"bucket_name":"b","n_directories":2}']

import os
import subprocess
import sys

import pytest

from bucketlens.operators import inventory as inv
from bucketlens.sources import listing as ls
from bucketlens.sources.content import read_object_lines, write_objects
from bucketlens.sources.inventory import list_objects

FILES = {
    "a/docs/x.txt": b"one\ntwo\n", "a/docs/empty": b"", "a/docs/_hidden": b"h", "a/docs/.dot": b"d", "a/docs/en/deep/y.csv": b"1,2",
    "a/top": b"t", "a/docs two/ü #%+.txt": b"odd", "b/only": b"1", "b/_logs/_SUCCESS": b"",
}


@pytest.fixture
def root(tmp_path):
    for name, body in FILES.items():
        os.makedirs(os.path.dirname(tmp_path / name), exist_ok=True)
        (tmp_path / name).write_bytes(body)
    os.makedirs(tmp_path / "a" / "nothing" / "here")
    os.makedirs(tmp_path / "empty bucket")
    return f"file://{tmp_path}"


def expected(prefix="", buckets=None):
    folders = {"a/nothing/", "a/nothing/here/"}
    for name in FILES:
        parts = name.split("/")
        folders |= {"/".join(parts[:i]) + "/" for i in range(2, len(parts))}
    rows = [(*n.split("/", 1), len(b), False) for n, b in FILES.items()] + [(*n.split("/", 1), 0, True) for n in folders]
    return sorted(r for r in rows if r[1].startswith(prefix) and (buckets is None or r[0] in buckets))


def found(df):
    return sorted((r.bucket_name, r.key, r.size, r.is_directory) for r in df.collect())


@pytest.mark.parametrize("depth", [0, 1, 2, 5])
def test_lists_everything_at_any_depth(spark, root, depth):
    df = ls.list_prefixes(spark, root, depth=depth)
    assert found(df) == expected()
    # Spark's own listing leaves these out
    seen = {r.key for r in list_objects(spark, root).collect()}
    assert not seen & {"docs/empty", "docs/_hidden", "docs/.dot", "nothing/", "_logs/_SUCCESS"}


def test_paths_open(spark, root):
    rows = ls.list_prefixes(spark, root).where("NOT is_directory").collect()
    assert {f"{r.bucket_name}/{r.key}": open(r.path.removeprefix("file://"), "rb").read() for r in rows} == FILES


@pytest.mark.parametrize("prefix", ["docs/", "docs", "docs/en/d", "t", "nothing/here/", "none"])
def test_prefix(spark, root, prefix):
    assert found(ls.list_prefixes(spark, root, prefix=prefix)) == expected(prefix)
    assert found(ls.list_prefixes(spark, root, buckets=["b", "gone"], prefix=prefix)) == expected(prefix, ["b"])


def test_prefixes_are_pruned_before_they_are_listed(root, monkeypatch):
    listed = []
    real = ls.entries
    monkeypatch.setattr(ls, "entries", lambda fs, folder: listed.append(folder.split("/test_")[-1].split("/", 1)[-1]) or real(fs, folder))
    reader = ls.ListingReader({"root": root, "buckets": '["a"]', "prefix": "docs/en/", "depth": "2", "client": "[]"})
    parts = reader.partitions()
    assert [(p.bucket, p.key, p.deep) for p in parts] == [("a", "", False), ("a", "docs/", False), ("a", "docs/en/", True)]
    rows = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert sorted(r["key"] for r in rows) == ["docs/en/", "docs/en/deep/", "docs/en/deep/y.csv"]
    assert not [x for x in listed if "two" in x or "nothing" in x or x.startswith("b")]


def test_one_partition_a_prefix(spark, root):
    assert ls.list_prefixes(spark, root, depth=1).rdd.getNumPartitions() == 3 + 3 + 1  # a, b, empty bucket; docs, docs two, nothing; _logs


def test_listing_is_an_inventory(spark, root):
    objects = ls.list_prefixes(spark, root).select("bucket_name", "key", "size")
    assert {r.bucket_name: r.n_directories for r in inv.directories_per_bucket(objects).collect()} == {"a": 6, "b": 1}
    assert {(r.format, r.n_files) for r in inv.files_by_format(objects).collect()} >= {("txt", 2), ("csv", 1)}


def test_written_objects_come_back(spark, tmp_path):
    rows = [("b1", "k/one.txt", bytearray(b"x\ny")), ("b1", "k/none", None), ("b 2", "ü #%+.txt", bytearray("é\n".encode()))]
    contents = spark.createDataFrame(rows, "bucket_name string, key string, content binary")
    root = f"file://{tmp_path}"
    assert write_objects(contents, root) == write_objects(contents, root) == 3
    assert [r[:3] for r in found(ls.list_prefixes(spark, root)) if not r[3]] == [("b 2", "ü #%+.txt", 3), ("b1", "k/none", 0), ("b1", "k/one.txt", 3)]
    assert sorted(tuple(r) for r in read_object_lines(spark, root).collect()) == [("b 2", "ü #%+.txt", "é"), ("b1", "k/one.txt", "x"), ("b1", "k/one.txt", "y")]


def test_works_from_another_folder(root, tmp_path):
    """The source's Python workers get the package from the session."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {repo!r})\n"
        "from bucketlens.session import local_session\n"
        "from bucketlens.sources.listing import list_prefixes\n"
        f"print('rows', list_prefixes(local_session(1, 1), {root!r}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert f"rows {len(expected())}" in done.stdout, done.stderr[-2000:]

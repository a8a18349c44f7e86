import hashlib


from llm_fixtures import SF001, shipped  # noqa: F401

from bucketlens.llm.common import scratch_path
from bucketlens.llm.queries import ORACLE_SQL
from bucketlens.llm.warc import Bundle, BundleWriter, make_record, op6_warc, parse_record, read_records, with_roles, write_bundles

SCHEMA = "page_id long, url string, html string"


def record(i):
    body = b"abc" * i * 50
    return make_record(str(i), f"http://x/{i}", body, hashlib.sha1(body).hexdigest(), len(body), None)


def test_frames_are_seekable(tmp_path):
    import zstandard

    uri = f"file://{tmp_path}/b.warc.zst"
    records = [record(i) for i in range(30)]
    writer = BundleWriter(uri, frame_bytes=2000)
    places = [writer.add(r) for r in records]
    writer.close()
    bundle = Bundle.open(uri)
    assert len(bundle.frames) > 5
    for i in (29, 0, 17):
        frame, offset = places[i]
        got = bundle.frame(frame)[offset : offset + len(records[i])]
        assert got == records[i] and parse_record(got)["page_id"] == str(i)
    # any Zstandard reader sees the plain archive: the seek table is skippable
    data = (tmp_path / "b.warc.zst").read_bytes()
    with zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True) as whole:
        assert whole.read() == b"".join(records)


def test_round_trip(spark):
    big = "é" * 600
    rows = [
        (1, "http://a/", big),
        (2, "http://b/", big),
        (2, "http://b/", big),
        (5, None, big),
        (3, "http://c/\r\nX: y", "short"),
        (4, "http://d/", "short"),
        (6, "http://e/", None),
        (2**60 + 1, "http://f/", "\r\n\r\n" * 300),
        (None, "http://g/", "z" * 2000),
        (None, "http://h/", "z" * 2000),
        (None, "http://i/", big),
    ]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    index = write_bundles(with_roles(pages), scratch_path(spark, "warc-test"), frame_bytes=1500, bundle_bytes=60)
    got = read_records(index, with_payload=True).collect()
    assert len(got) == len(rows) and index.select("bundle").distinct().count() > 3
    for r in got:
        body = {1: big, 2: big, 5: big, 3: "short", 4: "short", 6: "", 2**60 + 1: "\r\n\r\n" * 300}.get(r.page_id)
        if body is not None:
            assert (r.payload_bytes, r.payload_digest) == (len(body.encode()), hashlib.sha1(body.encode()).hexdigest())
        if r.record_type == "response":
            assert hashlib.sha1(r.payload).hexdigest() == r.payload_digest and r.refers_to is None
        else:
            assert r.payload is None and r.refers_to == 5
    kinds = sorted((r.page_id or 0, r.record_type) for r in got)
    assert kinds == sorted(
        [(1, "revisit"), (2, "revisit"), (2, "revisit"), (5, "response"), (3, "response"), (4, "response"), (6, "response")]
        + [(2**60 + 1, "response"), (0, "response"), (0, "response"), (0, "revisit")]
    )
    one = read_records(index.where("page_id = 3")).collect()
    assert [x.url for x in one] == ["http://c/%0D%0AX: y"]


def test_empty_and_oracle(spark):
    none = spark.createDataFrame([], SCHEMA + ", bundle string")
    assert read_records(write_bundles(with_roles(none), scratch_path(spark, "warc-test"))).count() == 0
    assert "op6_warc" in ORACLE_SQL and op6_warc(spark, SF001).count() == 250

import datetime as dt

import pytest
from conftest import SF001, lines_df
from pyspark.sql import functions as F

from bucketlens.operators.log_analytics import malformed_summary, total_bytes_sent
from bucketlens.operators.parse import parse_access_log
from bucketlens.plans import fixtures as fx


def line(time="06/Feb/2019:00:00:38 +0000", ip="10.0.1.5", key="d/1.txt", uri='"GET /d/1 HTTP/1.1"',
         status="200", err="-", sent="512", size="1024", agent='"cli/1.0"', version="-"):
    return " ".join(["own", "mybucket", f"[{time}]", ip, "arn:u1", "R1", "REST.GET.OBJECT", key, uri,
                     status, err, sent, size, "12", "-", '"-"', agent, version])


def parse(spark, lines, mode="strict"):
    return parse_access_log(lines_df(spark, lines), mode=mode).collect()


def test_well_formed_line(spark):
    (r,) = parse(spark, [line()])
    assert not r.is_malformed
    assert (r.owner_name, r.bucket_name, r.ip_address, r.key) == ("own", "mybucket", "10.0.1.5", "d/1.txt")
    assert r.request_uri == '"GET /d/1 HTTP/1.1"'  # quotes kept
    assert (r.http_status, r.error_code, r.bytes_sent, r.object_size, r.total_time) == (200, "-", 512, 1024, 12)
    assert r.turn_around_time is None and r.referrer == '"-"' and r.user_agent == '"cli/1.0"'
    assert r.event_time == dt.datetime(2019, 2, 6, 0, 0, 38)


@pytest.mark.parametrize("mode", ["strict", "tolerant", "positional"])
@pytest.mark.parametrize("text,expect", [
    ("06/Feb/2019:12:00:38 +0000", dt.datetime(2019, 2, 6, 12, 0, 38)),  # hour 12 is noon
    ("16/Feb/2019:00:00:00 +0000", dt.datetime(2019, 2, 16)),  # both day digits kept
    ("20/Feb/2019:23:59:59 +0000", dt.datetime(2019, 2, 20, 23, 59, 59)),
    ("30/Jan/2019:01:02:03 +0000", dt.datetime(2019, 1, 30, 1, 2, 3)),
    ("06/Feb/2019:12:00:38 +0530", dt.datetime(2019, 2, 6, 6, 30, 38)),  # offset honoured
    ("06/Feb/2019:12:00:38 -0100", dt.datetime(2019, 2, 6, 13, 0, 38)),
    ("31/Feb/2019:00:00:00 +0000", None),  # bad date → NULL, row kept
])
def test_event_time(spark, mode, text, expect):
    (r,) = parse(spark, [line(time=text)], mode)
    assert not r.is_malformed
    assert r.event_time == expect


def test_event_time_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        (r,) = parse(spark, [line(time="06/Feb/2019:12:00:38 +0530")])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.event_time == dt.datetime(2019, 2, 6, 6, 30, 38)


@pytest.mark.parametrize("token,expect", [("3000000000", 3000000000), ("-", 0), ("5.0", 0), ("+7", 7),
                                           ("99999999999999999999", 0)])
def test_sizes(spark, token, expect):
    (r,) = parse(spark, [line(sent=token, size=token)])
    assert (r.bytes_sent, r.object_size) == (expect, expect)


def test_empty_size_positional(spark):
    (r,) = parse(spark, [line(sent="", size="")], "positional")
    assert not r.is_malformed and (r.bytes_sent, r.object_size) == (0, 0)


def test_status_not_a_number(spark):
    for mode in ("strict", "positional"):
        (r,) = parse(spark, [line(status="-")], mode)
        assert not r.is_malformed and r.http_status is None


def test_ip_variants(spark):
    absent, dash, v6 = line(ip=""), line(ip="-"), line(ip="2001:db8::1")
    strict = parse(spark, [absent, dash, v6])
    assert [r.is_malformed for r in strict] == [False, True, True]
    assert strict[0].ip_address is None
    tolerant = parse(spark, [absent, dash, v6], "tolerant")
    assert [r.is_malformed for r in tolerant] == [False, False, False]
    assert [r.ip_address for r in tolerant] == [None, None, "2001:db8::1"]


def test_strict_rejects_tolerant_accepts(spark):
    cases = [line(agent='"Mozilla/5.0 (X11; Linux)"'), line(uri='"-"'), line(version="- hostid SigV4 TLSv1.2")]
    assert all(r.is_malformed for r in parse(spark, cases))
    tol = parse(spark, cases, "tolerant")
    assert not any(r.is_malformed for r in tol)
    assert tol[0].user_agent == '"Mozilla/5.0 (X11; Linux)"'
    assert tol[1].request_uri == '"-"' and tol[1].http_status == 200
    assert tol[2].version_id == "-"


def test_strict_shifted_match_is_kept(spark):
    # URI `"-"` with a multi-character error code plus two extra trailing
    # fields has the right token count: the strict layout matches, shifted.
    shifted = line(uri='"-"', status="404", err="NoSuchKey", sent="3380", size="7340", version="- hostid SigV4")
    (s,) = parse(spark, [shifted])
    assert not s.is_malformed
    assert s.request_uri == '"-" 404 NoSuchKey' and s.http_status == 3380 and s.error_code == "7340"
    (t,) = parse(spark, [shifted], "tolerant")
    assert (t.request_uri, t.http_status, t.error_code, t.bytes_sent) == ('"-"', 404, "NoSuchKey", 3380)


def test_positional_layout(spark):
    (r,) = parse(spark, [line()], "positional")
    assert r.request_uri == '"GET/d/1HTTP/1.1"'  # tokens 9..11 joined without spaces
    assert r.event_time == dt.datetime(2019, 2, 6, 0, 0, 38)
    short = parse(spark, ["own b [x +0000] 1.2.3.4 r"], "positional")
    assert short[0].is_malformed and short[0].bucket_name is None


def test_malformed_rows_are_null_not_sentinels(spark):
    (r,) = parse(spark, ["not a log line"])
    assert r.is_malformed
    assert all(getattr(r, c) is None for c in r.__fields__ if c != "is_malformed")


def test_lines_with_newline_are_malformed(spark):
    (r,) = parse(spark, [line().replace("arn:u1", "arn:\nu1")])
    assert r.is_malformed


def test_fixture_counts(spark):
    raw = fx.raw_lines(spark, SF001)
    strict = parse_access_log(raw, "strict")
    s = malformed_summary(strict).collect()[0]
    assert (s.lines, s.good_lines, s.malformed_lines) == (10000, 8039, 1961)
    assert total_bytes_sent(strict).collect()[0].total_bytes_sent == 17244463
    assert parse_access_log(raw, "tolerant").where("is_malformed").count() == 585
    assert parse_access_log(raw, "positional").where("NOT is_malformed").count() == 9602


def test_strict_good_is_subset_of_tolerant_good(spark):
    raw = fx.raw_lines(spark, SF001).withColumn("id", F.regexp_extract("value", r" R(\d+) ", 1))
    # the strict pattern takes an open quote for a token; tolerant refuses it
    raw = raw.where("value NOT LIKE '%\"x\"%'")
    s = parse_access_log(raw, "strict", keep=["id"]).where("NOT is_malformed").select("id")
    t = parse_access_log(raw, "tolerant", keep=["id"]).where("NOT is_malformed").select("id")
    assert s.subtract(t).count() == 0


def test_keep_carries_columns(spark):
    df = spark.createDataFrame([(line(), "f1")], "value string, source_file string")
    (r,) = parse_access_log(df, keep=["source_file"]).collect()
    assert r.source_file == "f1" and r.bucket_name == "mybucket"


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        parse_access_log(lines_df(spark, [line()]), mode="loose")


def test_positional_trailing_space_makes_no_token(spark):
    short = " ".join(line().split(" ")[:-1]) + " "  # version id missing, line ends in a space
    (r,) = parse(spark, [short], "positional")
    assert r.is_malformed
    (ok,) = parse(spark, [line() + "  "], "positional")
    assert not ok.is_malformed and ok.version_id == "-"


def test_tolerant_lines_are_right_or_malformed(spark):
    """Quotes inside quotes, an open quote, and a missing address never shift
    the fields that follow."""
    base = line()
    agent = next(t for t in ('"cli/1.0"', '"-"') if t in base)
    broken = [base.replace(agent, '"Moz "x" y"'), base.replace(agent, '"Moz')]
    for bad in broken:
        (r,) = parse(spark, [bad], "tolerant")
        assert r.is_malformed, bad
    (ok,) = parse(spark, [base], "tolerant")
    assert not ok.is_malformed
    address = f" {ok.ip_address} "
    (r,) = parse(spark, [base.replace(address, " ") + " extra1 extra2 extra3"], "tolerant")
    assert r.is_malformed
    (r,) = parse(spark, [base + " tail\u0085more\u2028end"], "tolerant")
    assert not r.is_malformed and r.version_id == ok.version_id

"""DuckDB SQL for every registered query (the correctness oracle).

The oracle shares no pattern, position or constant with the Spark code: plain
SQL over the driver's tables, with the same derived inputs (FIXTURES.md §3)
rebuilt in SQL and the line layouts written out by hand. DuckDB allows few
capture groups, so each field is extracted with a pattern that captures that
one field.
"""

from __future__ import annotations

from .params import LOG_BUCKETS, ONE_BUCKET, PIECE_BYTES, PREFIX, PREFIX_BUCKET, SOME_BUCKETS, TOP_BUCKETS, TOP_IPS, TOP_OBJECTS

# The 18 fields of a line, as (name, pattern); the address may be
# missing between its two spaces.
_T = "[^ \\t\\n\\f\\r\\x0B]"
_N = '[^" \\t\\n\\f\\r\\x0B]' + _T + "*"
_Q = '"[^"]*"|' + _N
_FIELDS = """owner_name bucket_name event_time ip_address requester request_id operation key request_uri http_status
error_code bytes_sent object_size total_time turn_around_time referrer user_agent version_id""".split()
_STRICT = {n: _T + "+" for n in _FIELDS} | {
    "event_time": "[^\\]]+",
    "ip_address": "[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}",
    "request_uri": f"{_T}+ .{_T}+ .{_T}+",
}
_TOLERANT = {n: _N for n in _FIELDS} | {
    "owner_name": _T + "+",
    "bucket_name": _T + "+",
    "event_time": "[^\\]]*",
    "ip_address": "[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}|[0-9A-Fa-f]*:[0-9A-Fa-f:.]+|-",
    "request_uri": _Q,
    "http_status": "[0-9][0-9][0-9]|-",
    "referrer": _Q,
    "user_agent": _Q,
}
_POSITIONS = {
    "owner_name": 1, "bucket_name": 2, "ip_address": 5, "requester": 6, "request_id": 7, "operation": 8, "key": 9,
    "http_status": 13, "error_code": 14, "bytes_sent": 15, "object_size": 16, "total_time": 17, "turn_around_time": 18,
    "referrer": 19, "user_agent": 20, "version_id": 21,
}


def _line(fields: dict[str, str], tail: str, capture: str | None) -> str:
    parts = []
    for name, body in fields.items():
        group = f"({body})" if name == capture else f"(?:{body})"
        if name == "event_time":
            group = f"\\[{group}\\]"
        if name == "ip_address":
            group = f"({body}|)" if name == capture else f"(?:{body}|)"
        parts.append(group)
    return "^" + " ".join(parts) + tail + "$"


RAW_LINES = """raw_lines AS (
  SELECT concat_ws(' ',
    'own',
    'bkt-' || event_type || '-' || CAST(user_id % 10 AS VARCHAR),
    '[' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000]',
    CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 11 = 0 THEN '' ELSE '10.0.' || CAST(user_id % 4 AS VARCHAR) || '.' || CAST(user_id AS VARCHAR) END,
    'arn:u' || CAST(user_id AS VARCHAR),
    'R' || CAST(event_id AS VARCHAR),
    'REST.GET.OBJECT',
    CASE WHEN event_id % 29 = 0 THEN '-' ELSE 'd/' || CAST(user_id AS VARCHAR) || '.txt' END,
    CASE WHEN event_id % 23 = 0 THEN '"-"' ELSE '"GET /d/' || CAST(user_id AS VARCHAR) || ' HTTP/1.1"' END,
    CASE WHEN event_type = 'error' THEN '404 NoSuchKey' ELSE '200 -' END,
    CASE WHEN event_id % 7 = 0 THEN '-' ELSE CAST(event_id * 37 % 5000 AS VARCHAR) END,
    CASE WHEN event_id % 13 = 0 THEN '-' ELSE CAST(event_id * 41 % 9000 AS VARCHAR) END,
    '12', '-', '"-"',
    CASE WHEN event_id % 31 = 0 THEN '"Moz "x" y"' WHEN event_id % 17 = 0 THEN '"Mozilla/5.0 (X11)"' ELSE '"cli/1.0"' END,
    '-' || CASE WHEN event_id % 19 = 0 OR event_id % 37 = 0 THEN ' hostid SigV4' ELSE '' END
  ) AS value
  FROM events
)"""

GEO_RANGES = """geo_ranges(ip_start, ip_end, country, city, latitude, longitude) AS (
  VALUES (167772160::BIGINT, 167772415::BIGINT, 'A', 'a', 1.5::DOUBLE, 2.5::DOUBLE),
         (167772416, 167772671, 'B', 'b', 3.5, 4.5),
         (167772672, 167772927, 'C', 'c', 5.5, 6.5)
)"""


def _long(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') THEN TRY_CAST({x} AS BIGINT) END"


def _int(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') THEN TRY_CAST({x} AS INTEGER) END"


def _time(x: str) -> str:
    return f"timezone('UTC', try_strptime({x}, '%d/%b/%Y:%H:%M:%S %z'))"


def _typed(raw: dict[str, str], ok: str, strict_ip: bool) -> str:
    ip = raw["ip_address"]
    ip_expr = f"NULLIF({ip}, '')" if strict_ip else f"CASE WHEN {ip} IN ('', '-') THEN NULL ELSE {ip} END"
    exprs = {
        "event_time": _time(raw["event_time"]),
        "ip_address": ip_expr,
        "http_status": _int(raw["http_status"]),
        "bytes_sent": f"COALESCE({_long(raw['bytes_sent'])}, 0)",
        "object_size": f"COALESCE({_long(raw['object_size'])}, 0)",
        "total_time": _long(raw["total_time"]),
        "turn_around_time": _long(raw["turn_around_time"]),
    }
    cols = [f"CASE WHEN {ok} THEN {exprs.get(n, raw[n])} END AS {n}" for n in _FIELDS]
    return ",\n    ".join(cols + [f"NOT ({ok}) AS is_malformed"])


def _regex_log(name: str, fields: dict[str, str], tail: str, strict_ip: bool) -> str:
    extracts = [f"regexp_extract(value, '{_line(fields, tail, f)}', 1) AS f_{f}" for f in fields]
    raw = {f: f"f_{f}" for f in fields}
    return f"""{name} AS (
  SELECT
    {_typed(raw, "ok", strict_ip)}
  FROM (
    SELECT regexp_matches(value, '{_line(fields, tail, None)}') AND strpos(value, chr(10)) = 0 AS ok,
      {", ".join(extracts)}
    FROM raw_lines
  )
)"""


def _positional_log(name: str) -> str:
    raw = {n: f"t[{i}]" for n, i in _POSITIONS.items()}
    raw["event_time"] = (
        "(CASE WHEN starts_with(t[3], '[') THEN substr(t[3], 2) END) || ' ' || "
        "(CASE WHEN ends_with(t[4], ']') THEN substr(t[4], 1, length(t[4]) - 1) END)"
    )
    raw["request_uri"] = "t[10] || t[11] || t[12]"
    return f"""{name} AS (
  SELECT
    {_typed(raw, "ok", strict_ip=False)}
  FROM (SELECT t, len(t) >= 21 AS ok FROM (SELECT string_split(rtrim(value, ' '), ' ') AS t FROM raw_lines))
)"""


LOG_STRICT = _regex_log("log_strict", _STRICT, "", strict_ip=True)
LOG_TOLERANT = _regex_log("log_tolerant", _TOLERANT, "(?: [^\\n]*)?", strict_ip=False)
LOG_POSITIONAL = _positional_log("log_positional")
GOOD = """good AS (SELECT * FROM log_strict WHERE NOT is_malformed)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_LOG = (RAW_LINES, LOG_STRICT, GOOD)


IP_NUM = """CASE WHEN regexp_full_match(ip_address, '\\d{1,3}\\.\\d{1,3}\\.\\d{1,3}\\.\\d{1,3}')
      AND CAST(split_part(ip_address, '.', 1) AS BIGINT) <= 255 AND CAST(split_part(ip_address, '.', 2) AS BIGINT) <= 255
      AND CAST(split_part(ip_address, '.', 3) AS BIGINT) <= 255 AND CAST(split_part(ip_address, '.', 4) AS BIGINT) <= 255
    THEN CAST(split_part(ip_address, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip_address, '.', 2) AS BIGINT) * 65536
       + CAST(split_part(ip_address, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip_address, '.', 4) AS BIGINT) END"""

LOCATED = f"""located AS (
  SELECT a.ip_address, g.country, g.city, g.latitude, g.longitude
  FROM (SELECT DISTINCT ip_address, {IP_NUM} AS ip_num FROM log_strict WHERE ip_address IS NOT NULL) a
  JOIN geo_ranges g ON a.ip_num BETWEEN g.ip_start AND g.ip_end
)"""

PER_IP = """per_ip AS (SELECT ip_address, count(ip_address) AS hits FROM good WHERE ip_address IS NOT NULL GROUP BY ip_address)"""

LOG_QUERIES = {
    "parse_log_regex": _with(RAW_LINES, LOG_STRICT) + "SELECT * FROM log_strict",
    "parse_log_tolerant": _with(RAW_LINES, LOG_TOLERANT) + "SELECT * FROM log_tolerant",
    "parse_log_positional": _with(RAW_LINES, LOG_POSITIONAL) + "SELECT * FROM log_positional",
    "malformed_summary": _with(RAW_LINES, LOG_STRICT)
    + "SELECT count(*) AS lines, count_if(NOT is_malformed) AS good_lines, count_if(is_malformed) AS malformed_lines FROM log_strict",
    "distinct_buckets": _with(*_LOG) + "SELECT DISTINCT bucket_name FROM good",
    "total_bytes_sent": _with(*_LOG) + "SELECT CAST(sum(bytes_sent) AS DECIMAL(38,0)) AS total_bytes_sent FROM good",
    "top_buckets_by_size": _with(*_LOG)
    + f"""SELECT bucket_name, CAST(sum(object_size) AS DECIMAL(38,0)) AS total_size FROM good
GROUP BY bucket_name ORDER BY total_size DESC, bucket_name LIMIT {TOP_BUCKETS}""",
    "top_buckets_by_size_sql": _with(*_LOG)
    + f"""SELECT bucket_name, CAST(sum(object_size) AS DECIMAL(38,0)) AS total_size FROM good
GROUP BY bucket_name ORDER BY total_size DESC, bucket_name LIMIT {TOP_BUCKETS}""",
    "top_objects_per_bucket": _with(*_LOG)
    + f"""SELECT * FROM (
  SELECT bucket_name, key, object_size,
         CAST(dense_rank() OVER (PARTITION BY bucket_name ORDER BY object_size DESC) AS INTEGER) AS rank
  FROM good) WHERE rank <= {TOP_OBJECTS}""",
    "hits_per_object": _with(*_LOG)
    + """SELECT bucket_name, key, count(key) AS hits, CAST(sum(object_size) AS DECIMAL(38,0)) AS bytes
FROM good WHERE key <> '-' GROUP BY bucket_name, key ORDER BY bucket_name, key""",
    "hits_per_ip": _with(*_LOG, GEO_RANGES, LOCATED, PER_IP)
    + f"""SELECT p.ip_address, p.hits, l.country, l.city, l.latitude, l.longitude
FROM per_ip p LEFT JOIN located l ON p.ip_address = l.ip_address
WHERE p.ip_address IN (SELECT ip_address FROM good WHERE bucket_name = '{ONE_BUCKET}')
ORDER BY p.hits DESC, p.ip_address""",
    "top_ips": _with(*_LOG, GEO_RANGES, LOCATED, PER_IP)
    + f"""SELECT p.ip_address, p.hits, l.country, l.city, l.latitude, l.longitude
FROM per_ip p LEFT JOIN located l ON p.ip_address = l.ip_address
ORDER BY p.hits DESC, p.ip_address LIMIT {TOP_IPS}""",
    "running_percentage": _with(*_LOG)
    + """SELECT bucket_name, object_size,
  CASE WHEN object_size = 0 THEN NULL ELSE CAST(sum(object_size) OVER (PARTITION BY bucket_name ORDER BY object_size
       RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) * 100 / object_size END AS running_percentage
FROM good""",
    "percentage_of_bucket_total": _with(*_LOG)
    + """SELECT bucket_name, object_size,
  CASE WHEN t = 0 THEN NULL ELSE CAST(object_size AS DOUBLE) * 100 / t END AS bucket_share
FROM (SELECT bucket_name, object_size, sum(object_size) OVER (PARTITION BY bucket_name) AS t FROM good)""",
    "geo_enrich": _with(RAW_LINES, LOG_STRICT, GEO_RANGES, LOCATED)
    + """SELECT s.*, l.country, l.city, l.latitude, l.longitude
FROM log_strict s LEFT JOIN located l ON s.ip_address = l.ip_address""",
}
_SELECTED = f"good AS (SELECT * FROM log_strict WHERE NOT is_malformed AND bucket_name IN {LOG_BUCKETS!r})"
for _name in ("top_objects_per_bucket", "hits_per_object", "running_percentage"):
    LOG_QUERIES[f"{_name}_selected"] = LOG_QUERIES[_name].replace(GOOD, _SELECTED)
LOG_QUERIES["top_objects_per_bucket_all"] = LOG_QUERIES["top_objects_per_bucket"].replace(f"WHERE rank <= {TOP_OBJECTS}", "")
LOG_QUERIES["geo_enrich_bucketed"] = LOG_QUERIES["geo_enrich"]
LOG_QUERIES["top_buckets_table_function"] = LOG_QUERIES["top_buckets_by_size"]
LOG_QUERIES["log_files_strict"] = LOG_QUERIES["parse_log_regex"]
LOG_QUERIES["log_files_positional"] = LOG_QUERIES["parse_log_positional"]
LOG_QUERIES["top_ips_sketch"] = _with(*_LOG, PER_IP) + f"SELECT ip_address, hits FROM per_ip ORDER BY hits DESC, ip_address LIMIT {TOP_IPS}"
_ALLOWED = """good AS (SELECT * FROM log_strict WHERE NOT is_malformed AND bucket_name IN (
  SELECT 'bkt-' || kind || '-' || CAST(c_custkey AS VARCHAR)
  FROM customer, (VALUES ('view'), ('error'), ('click'), ('signup'), ('purchase')) k(kind) WHERE c_custkey % 3 = 1))"""
LOG_QUERIES["hits_per_object_allowed"] = LOG_QUERIES["hits_per_object"].replace(GOOD, _ALLOWED)
# addresses as 128-bit numbers: 2001:db8:k:: is 536939960 * 2^96 + k * 2^80, ::ffff:a.b.c.d is 65535 * 2^32 + …
_V6 = "CAST(536939960 AS HUGEINT) * 79228162514264337593543950336 + CAST({0} % 16 AS HUGEINT) * 1208925819614629174706176"
LOG_QUERIES["ip_enrich"] = f"""WITH a AS (
  SELECT event_id,
    CASE WHEN event_id % 23 = 0 THEN NULL
         WHEN event_id % 3 = 0 THEN '2001:DB8:' || lower(to_hex(user_id % 16)) || '::' || lower(to_hex(user_id))
         ELSE CASE WHEN event_id % 7 = 0 THEN '::ffff:' ELSE '' END
           || '10.' || (user_id % 4) || '.' || (user_id // 256) || '.' || (user_id % 256) END AS ip_address,
    CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 3 = 0 THEN {_V6.format("user_id")} + user_id
         ELSE CAST(281470681743360 AS HUGEINT) + 167772160 + (user_id % 4) * 65536 + user_id END AS n
  FROM (SELECT event_id, user_id % 65536 AS user_id FROM events)),
r AS (
  SELECT k, name, k * 104729 % 262144 AS off, CASE WHEN k % 7 = 0 THEN 65536 ELSE k * 31 % 37 END AS width
  FROM (SELECT c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT o_orderkey, 'order ' || o_orderkey FROM orders)),
ranges AS (
  SELECT name, CAST(281470681743360 AS HUGEINT) + 167772160 + off AS s, CAST(281470681743360 AS HUGEINT) + 167772160 + off + width AS e FROM r
  UNION ALL SELECT name, {_V6.format("k")} + off, {_V6.format("k")} + off + width FROM r),
best AS (
  SELECT n, name FROM (SELECT DISTINCT n FROM a WHERE n IS NOT NULL) x JOIN ranges ON n BETWEEN s AND e
  QUALIFY row_number() OVER (PARTITION BY n ORDER BY s DESC, e, name) = 1)
SELECT event_id, ip_address, name FROM a LEFT JOIN best ON a.n = best.n"""



FILES = """files AS (
  SELECT source AS bucket_name,
         'docs/' || lang || '/' || CAST(doc_id AS VARCHAR)
           || CASE doc_id % 4 WHEN 0 THEN '.txt' WHEN 1 THEN '.tar.gz' WHEN 2 THEN '.csv' ELSE '' END AS key,
         CAST(strlen(text) AS BIGINT) AS size,
         text
  FROM documents
)"""
INVENTORY = """inventory AS (
  SELECT bucket_name, key, size FROM files
  UNION ALL
  SELECT DISTINCT source, 'docs/' || lang || '/', CAST(0 AS BIGINT) FROM documents
)"""
LINES = """lines AS (SELECT bucket_name, key, unnest(string_split(text, chr(10))) AS line FROM files)"""
_PIECES = ", ".join(
    f"CAST(sum(('0x' || substr(md5(line), {s}, {w}))::BIGINT) AS VARCHAR)" for s, w in ((1, 6), (7, 6), (13, 6), (19, 6), (25, 6), (31, 2))
)
LINE_CLASSES = f"""sig AS (
  SELECT bucket_name, key, md5(string_agg(line, chr(10) ORDER BY line)) AS h,
    md5(concat_ws(',', CAST(count(*) AS VARCHAR), {_PIECES})) AS checksum
  FROM lines WHERE line <> '' GROUP BY bucket_name, key
),
fp AS (
  SELECT f.bucket_name, f.key, f.bucket_name || '/' || f.key AS path, coalesce(s.h, '') AS h,
    coalesce(s.checksum, md5('0,0,0,0,0,0,0')) AS checksum
  FROM files f LEFT JOIN sig s ON f.bucket_name = s.bucket_name AND f.key = s.key
),
per_class AS (SELECT h, min(path) AS class_id, count(*) AS n_copies FROM fp GROUP BY h),
classes AS (SELECT fp.bucket_name, fp.key, fp.checksum, c.class_id, c.n_copies FROM fp JOIN per_class c ON fp.h = c.h)"""
BYTE_CLASSES = """cand AS (
  SELECT * FROM files WHERE size IN (SELECT size FROM files GROUP BY size HAVING count(*) > 1)
),
bfp AS (
  SELECT bucket_name, key, bucket_name || '/' || key AS path, size,
         CASE WHEN size = 0 THEN 'd41d8cd98f00b204e9800998ecf8427e' ELSE md5(text) END AS h
  FROM cand
),
bper AS (SELECT size, h, min(path) AS class_id, count(*) AS n_copies FROM bfp GROUP BY size, h),
bclasses AS (SELECT b.bucket_name, b.key, b.h AS checksum, c.class_id, c.n_copies FROM bfp b JOIN bper c ON b.size = c.size AND b.h = c.h)"""

_FMT = r"""CASE WHEN regexp_extract(key, '\.([^./]+)$', 1) = '' THEN '(none)' ELSE regexp_extract(key, '\.([^./]+)$', 1) END"""

OBJECT_QUERIES = {
    "object_inventory": """SELECT source AS bucket_name, CAST(doc_id AS VARCHAR) AS key, n_chars AS size FROM documents""",
    "inventory_for_buckets": _with(FILES, INVENTORY)
    + f"SELECT * FROM inventory WHERE bucket_name IN {SOME_BUCKETS!r}",
    "classify_objects": _with(FILES, INVENTORY)
    + f"""SELECT bucket_name, key, CASE WHEN ends_with(key, '/') THEN 'directory' ELSE 'file' END AS kind,
  bucket_name || '/' || key AS path FROM inventory WHERE bucket_name = '{PREFIX_BUCKET}'""",
    "classify_object_at_path": _with(FILES, INVENTORY)
    + f"""SELECT bucket_name, key, CASE WHEN ends_with(key, '/') THEN 'directory' ELSE 'file' END AS kind,
  bucket_name || '/' || key AS path FROM inventory WHERE key = '{PREFIX}'""",
    "file_paths": _with(FILES) + "SELECT bucket_name, key, bucket_name || '/' || key AS path FROM files",
    "file_paths_for_prefix": _with(FILES)
    + f"""SELECT bucket_name, key, bucket_name || '/' || key AS path FROM files
WHERE bucket_name = '{PREFIX_BUCKET}' AND starts_with(key, '{PREFIX}')""",
    "object_line_counts": _with(FILES, LINES)
    + "SELECT bucket_name, key, count(*) AS n_lines FROM lines GROUP BY bucket_name, key",
    "directories_per_bucket": _with(FILES, INVENTORY)
    + "SELECT bucket_name, count(key) AS n_directories FROM inventory WHERE ends_with(key, '/') GROUP BY bucket_name",
    "directories_per_bucket_json": _with(FILES, INVENTORY)
    + """SELECT CAST(json_object('bucket_name', bucket_name, 'n_directories', n) AS VARCHAR) AS json
FROM (SELECT bucket_name, count(key) AS n FROM inventory WHERE ends_with(key, '/') GROUP BY bucket_name)""",
    "directories_total": _with(FILES, INVENTORY)
    + "SELECT count(key) AS n_directories FROM inventory WHERE ends_with(key, '/')",
    "files_by_format": _with(FILES) + f"SELECT {_FMT} AS format, count(*) AS n_files FROM files GROUP BY 1",
    "files_by_bucket_format": _with(FILES)
    + f"SELECT bucket_name, {_FMT} AS format, count(*) AS n_files FROM files GROUP BY 1, 2",
    "content_fingerprint": _with(FILES, LINES, LINE_CLASSES) + "SELECT bucket_name, key, checksum, class_id FROM classes",
    "duplicate_files": _with(FILES, LINES, LINE_CLASSES)
    + """SELECT checksum, class_id, n_copies, bucket_name, key FROM classes WHERE n_copies > 1
ORDER BY n_copies DESC, class_id, bucket_name, key""",
    "checksum_groups": _with(FILES, LINES, LINE_CLASSES)
    + "SELECT checksum, class_id, n_copies, bucket_name, key FROM classes",
    "duplicate_files_bytes": _with(FILES, BYTE_CLASSES)
    + """SELECT checksum, class_id, n_copies, bucket_name, key FROM bclasses WHERE n_copies > 1
ORDER BY n_copies DESC, class_id, bucket_name, key""",
}
OBJECT_QUERIES["object_tree_checksums"] = _with(FILES) + f"""SELECT bucket_name, key, size, md5(md5(md5(string_agg(leaf, '' ORDER BY i)))) AS checksum
FROM (SELECT bucket_name, key, size, i, md5(unhex(substr(body, CAST({2 * PIECE_BYTES} * i + 1 AS BIGINT), {2 * PIECE_BYTES}))) AS leaf
  FROM (SELECT *, hex(encode(text)) AS body, unnest(range(0, greatest(1, (size + {PIECE_BYTES - 1}) // {PIECE_BYTES}))) AS i FROM files))
GROUP BY bucket_name, key, size"""
_PLAIN = FILES.replace("'.tar.gz'", "'.tgz'")
OBJECT_QUERIES["object_listing"] = _with(_PLAIN, INVENTORY) + """SELECT bucket_name, key, size, ends_with(key, '/') AS is_directory FROM inventory
UNION ALL SELECT DISTINCT bucket_name, 'docs/', 0, true FROM files"""
OBJECT_QUERIES["file_line_counts"] = _with(_PLAIN) + """SELECT bucket_name, key,
  CASE WHEN text = '' THEN 0 ELSE len(string_split(text, chr(10))) - CASE WHEN ends_with(text, chr(10)) THEN 1 ELSE 0 END END AS n_lines FROM files"""
OBJECT_QUERIES["file_duplicates_refined"] = _with(_PLAIN, BYTE_CLASSES) + "SELECT class_id, n_copies, bucket_name, key FROM bclasses WHERE n_copies > 1"
OBJECT_QUERIES["content_fingerprint_fast"] = _with(FILES, LINES, LINE_CLASSES) + "SELECT bucket_name, key, class_id FROM classes"


def oracle_sql() -> dict[str, str]:
    return {**LOG_QUERIES, **OBJECT_QUERIES}

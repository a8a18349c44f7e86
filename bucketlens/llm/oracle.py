"""DuckDB SQL for the queries that SQL can express, written from the contracts
(it shares no pattern or constant with the operators)."""

from __future__ import annotations

_RULES = """
  SELECT * FROM (VALUES ('allow','org/','org','/'), ('block','example.org/es/','example.org','/es/'),
    ('block','example.org/en/1','example.org','/en/1'), ('allow','com/fr/','com','/fr/'), ('block','com/de/','com','/de/'))
  AS r(verdict, rule, rhost, rpath)
"""

_PAGES = """
  SELECT page_id, html,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
"""


def _ranks(name: str, seeds: str, src: str, dst: str, rounds: int = 10) -> str:
    """CTEs: ``rounds`` rounds of personalised PageRank over hedges."""
    parts = [
        f"{name}_seed AS (SELECT host, {seeds} / (SELECT sum({seeds}) FROM ruled) AS seed FROM ruled WHERE {seeds} > 0)",
        f"""{name}_share AS (SELECT {src} AS s, {dst} AS d,
            weight / sum(weight) OVER (PARTITION BY {src}) AS share FROM hedges)""",
        f"{name}_0 AS (SELECT host, seed AS rank FROM {name}_seed)",
    ]
    for k in range(rounds):
        parts.append(
            f"""{name}_{k + 1} AS MATERIALIZED (SELECT host, sum(rank) AS rank FROM (
              SELECT host, 0.15 * seed AS rank FROM {name}_seed UNION ALL
              SELECT d, 0.85 * r.rank * e.share FROM {name}_{k} r JOIN {name}_share e ON r.host = e.s) GROUP BY host)"""
        )
    return ",\n".join(parts)


URL_FILTERS = f"""
WITH rules AS ({_RULES}), parts AS ({_PAGES}),
cut AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM parts),
p AS (SELECT page_id, html, coalesce(host, '') AS host, path FROM cut),
best AS (
  SELECT page_id, host, path, html, (SELECT arg_max(struct_pack(rule := rule, verdict := verdict), length(rule)) FROM rules
    WHERE (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath)) AS r FROM p),
ruled AS (SELECT host, count(*) FILTER (r.verdict = 'allow')::DOUBLE AS allowed, count(*) FILTER (r.verdict = 'block')::DOUBLE AS blocked
  FROM best WHERE r IS NOT NULL GROUP BY host),
links AS (SELECT host AS src, unnest(regexp_extract_all(html, '(?i)\\b(?:href|src)\\s*=\\s*["'']?((?:https?:)?//[^"''\\s<>]+)', 1)) AS link FROM p),
ends AS (SELECT src, lower(regexp_extract(link, '//([^/?#]*)', 1)) AS dst FROM links),
hedges AS (SELECT src, dst, count(*)::DOUBLE AS weight FROM ends WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
{_ranks("t", "allowed", "src", "dst")},
{_ranks("d", "blocked", "dst", "src")},
hosts AS (SELECT coalesce(t.host, d.host) AS host, coalesce(t.rank, 0) AS trust, coalesce(d.rank, 0) AS distrust
  FROM t_10 t FULL JOIN d_10 d ON t.host = d.host)
SELECT page_id, host, path, r.rule AS rule,
  coalesce(r.verdict, CASE WHEN round(distrust / (trust + distrust), 9) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
  round(coalesce(trust, 0), 6) AS trust, round(coalesce(distrust, 0), 6) AS distrust
FROM best LEFT JOIN hosts USING (host)
"""

LINE_DEDUP = """
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM split),
w AS (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n FROM l),
c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM w),
fwd AS (SELECT a.doc_id, a.i AS s, min(b.i) AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.n >= 50 GROUP BY 1, 2),
bwd AS (SELECT b.doc_id, max(a.i) AS s, b.i AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.n >= 50 GROUP BY b.doc_id, b.i),
runs AS (SELECT false AS back, * FROM fwd UNION ALL SELECT true, * FROM bwd),
named AS (SELECT back, r.doc_id, s, e, array_to_string(ls[s + 1 : e + 1], chr(10)) AS body, e - s AS m FROM runs r JOIN split USING (doc_id)),
later AS (SELECT *, row_number() OVER (PARTITION BY back, m, body ORDER BY doc_id, s) AS k FROM named),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS i FROM later WHERE k > 1),
isle AS (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS g FROM gone),
merged AS (SELECT doc_id, g, min(i) AS a, max(i) AS b FROM isle GROUP BY 1, 2),
shown AS (SELECT doc_id, string_agg(a::VARCHAR || '-' || b::VARCHAR, ',' ORDER BY a) AS deleted_runs, sum(b - a + 1) AS n_deleted FROM merged GROUP BY 1),
kept AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.i) AS body FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i WHERE g.i IS NULL GROUP BY 1)
SELECT s.doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(n_deleted, 0)::BIGINT AS n_deleted,
  coalesce(deleted_runs, '') AS deleted_runs, md5(coalesce(body, '')) AS text_md5
FROM split s LEFT JOIN shown USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest FROM p),
f AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last_page FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last_page THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last_page THEN last_page END AS refers_to
FROM f
"""

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
WITH it AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
ph AS (SELECT item_id, least(len(w), 10) AS m, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s, w FROM it WHERE len(w) > 0),
phrases AS (SELECT DISTINCT item_id, m, w[s : s + m - 1] AS body FROM ph),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, m, s, w[s : s + m - 1] AS body
  FROM (SELECT doc_id, m, w, unnest(range(1, len(w) - m + 2)) AS s FROM doc, (SELECT DISTINCT m FROM phrases))),
hit AS (SELECT doc_id, s, win.m, item_id FROM win JOIN phrases USING (m, body)),
words AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS i FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.own AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
QUALIFY rank <= 5
"""

COLLOCATIONS = """
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
ws AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
g AS (SELECT lang, w[i : i + m - 1] AS p, count(*) AS f
  FROM (SELECT lang, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM ws, (VALUES (1), (2), (3), (4)) t(m)) GROUP BY 1, 2),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE len(p) = 1 GROUP BY 1),
c AS (SELECT lang, p, f AS a FROM g WHERE len(p) > 1 AND f >= 30),
cuts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM c),
scored AS (SELECT cuts.lang, cuts.p, a, k, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score
  FROM cuts JOIN g x ON x.lang = cuts.lang AND x.p = cuts.p[1 : k] JOIN g y ON y.lang = cuts.lang AND y.p = cuts.p[k + 1 :]
  QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.p ORDER BY score, k) = 1),
parts AS (SELECT lang, p[i : i + m - 1] AS p, max(a) AS most
  FROM (SELECT lang, a, p, m, unnest(range(1, len(p) - m + 2)) AS i FROM c, (VALUES (2), (3)) t(m) WHERE m < len(p)) GROUP BY 1, 2),
kept AS (SELECT s.lang, array_to_string(s.p, ' ') AS phrase, a, l, r, score
  FROM scored s LEFT JOIN parts q ON q.lang = s.lang AND q.p = s.p WHERE most IS NULL OR 100 * most < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""

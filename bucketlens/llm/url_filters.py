"""URL filters: rules, then link-graph propagation over hosts (operator 3).

Rules (host + path prefix → allow or block) judge a url first; the longest one
that fits wins. For the rest, trust and distrust spread over the host graph:

* trust: personalised PageRank from the hosts of allowed pages, along links
  (who trusted hosts link to gains trust);
* distrust: the same on reversed links from the hosts of blocked pages (who
  links to blocked hosts gains distrust).

A host is blocked if its share of distrust, d / (d + t), passes the threshold;
a host that neither reaches is allowed. Edges are host pairs weighted by the
number of links, so the graph never holds a row per link; links inside a host
are no edges. Ranks stay in DataFrames, joined on the host, and are written to
the shared folder every few rounds to cut the lineage.

Null urls and urls without ``://`` have empty host and path; no rule fits them
and they are allowed. Links of a null html are none. Repeated rows are judged
once each, and count as often in the seeds and edge weights.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, stored, table

Rule = tuple[str, str]  # (verdict, host + path)

RULES: Sequence[Rule] = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
DAMPING = 0.85
ROUNDS = 10
THRESHOLD = 0.5

# Where a host ends, and links in markup that name a host.
_REST = r"^.*?://"
_LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?((?:https?:)?//[^"'\s<>]+)"""


def _rest(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring_index(F.regexp_replace(url, "(?s)" + _REST, ""), "#", 1))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; empty without ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: str, host: Column, path: Column) -> Column:
    own, slash, rest = rule.partition("/")
    same = (host == own) | F.endswith(host, F.lit("." + own))
    return same & F.startswith(path, F.lit(slash + rest))


def apply_rules(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``pages`` plus host, path, rule and rule_verdict (null if none fits)."""
    host, path = F.col("host"), F.col("path")
    rule = verdict = F.lit(None).cast("string")
    for name, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is tested first
        rule = F.when(_fits(text, host, path), F.lit(text)).otherwise(rule)
        verdict = F.when(_fits(text, host, path), F.lit(name)).otherwise(verdict)
    out = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    return out.withColumns({"rule": rule, "rule_verdict": verdict})


def host_edges(pages: DataFrame) -> DataFrame:
    """`(src, dst, weight)`: links from one host to another."""
    links = pages.select(
        host_of(F.col("url")).alias("src"),
        F.explode(F.regexp_extract_all(F.col("html"), F.lit(_LINK), F.lit(1))).alias("link"),
    )
    whole = F.when(F.startswith(F.col("link"), F.lit("//")), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))
    links = links.select("src", host_of(whole).alias("dst"))
    links = links.where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
    return links.groupBy("src", "dst").agg(F.count("*").alias("weight"))


def personalised_rank(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, cut_every: int = 5) -> DataFrame:
    """`(host, rank)` after ``rounds`` rounds from `(host, seed)`, where the
    seeds are scaled to sum 1: rank = (1 - damping) · seed + damping · Σ rank of
    the sources · share of their weight. Hosts no rank reaches have no row."""
    total = edges.groupBy("src").agg(F.sum("weight").alias("out"))
    share = stored(edges.join(total, "src").select("src", "dst", (F.col("weight") / F.col("out")).alias("share")), "host-shares")
    mass = seeds.agg(F.sum("seed").alias("mass"))
    start = seeds.crossJoin(F.broadcast(mass)).select("host", (F.col("seed") / F.col("mass")).alias("seed"))  # one row of totals
    start = stored(start, "host-seeds")
    rank = start.withColumnRenamed("seed", "rank")
    for k in range(rounds):
        moved = rank.join(share, rank.host == share.src).select(F.col("dst").alias("host"), (damping * F.col("rank") * F.col("share")).alias("rank"))
        given = start.select("host", ((1 - damping) * F.col("seed")).alias("rank"))
        rank = given.unionByName(moved).groupBy("host").agg(F.sum("rank").alias("rank"))
        if (k + 1) % cut_every == 0:
            rank = stored(rank, "host-ranks")
    return rank


def host_verdicts(judged: DataFrame, pages: DataFrame, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """`(host, trust, distrust, host_verdict)` for the hosts that rank reaches."""
    edges = stored(host_edges(pages), "host-edges")
    counts = judged.where("rule_verdict is not null").groupBy("host").agg(
        F.count_if(F.col("rule_verdict") == "allow").alias("allowed"), F.count_if(F.col("rule_verdict") == "block").alias("blocked")
    )
    counts = stored(counts, "host-rules")
    seeds = lambda c: counts.where(F.col(c) > 0).select("host", F.col(c).cast("double").alias("seed"))
    trust = personalised_rank(edges, seeds("allowed"), rounds=rounds).withColumnRenamed("rank", "trust")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    distrust = personalised_rank(back, seeds("blocked"), rounds=rounds).withColumnRenamed("rank", "distrust")
    both = trust.join(distrust, "host", "full").fillna(0.0, ["trust", "distrust"])
    # rounded, so that the order of floating-point sums never decides a verdict
    share = F.round(F.col("distrust") / (F.col("trust") + F.col("distrust")), 9)
    return both.withColumn("host_verdict", F.when(share > threshold, "block").otherwise("allow"))


def url_filter(pages: DataFrame, rules: Sequence[Rule] = RULES, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """`(page_id, host, path, rule, verdict, trust, distrust)` per page."""
    urls = pages.select("page_id", "url", "html")
    judged = apply_rules(urls.select("page_id", "url"), rules)
    hosts = host_verdicts(judged, urls, threshold, rounds)
    return judged.join(hosts, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", "host_verdict", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = url_filter(table(spark, sf_dir, "pages"))
    return out.withColumns({c: F.round(c, 6) for c in ("trust", "distrust")})

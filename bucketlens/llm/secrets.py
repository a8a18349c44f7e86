"""Secret scans: corpus-wide ownership frequency (operator 4).

1. One pass over the whole texts finds candidate spans: the base kinds
   (assign, access, hex) and the method's own kinds (private-key headers,
   vendor-prefixed tokens, signed web tokens, long mixed strings). Text stays
   where it is; only spans and the hash of each candidate value go on.
2. The hashes are aggregated over the corpus: distinct repositories and
   distinct owners per value. Rows of one value are first combined per
   (value, repository, owner), so a widely copied example never gathers in
   one task.
3. A value that few owners hold is live-looking; one that many owners or
   repositories hold is a copied example. Base spans stay in every case; a
   span of the method's own kinds is added only if its value is live-looking.

Null and empty texts have no spans. A null owner or repository counts as one
owner or repository of its own. Repeated rows of a table each get their result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

# The base kinds, in their order, with the least length of the
# part that counts. A match that is too short is dropped after the search.
BASE_KINDS = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
]
# The method's own kinds; "mixed" must also look random (see looks_random).
MORE_KINDS = [
    ("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 1),
    ("vendor", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})", 0, 1),
    ("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("mixed", r"[A-Za-z0-9+/_-]{32,}", 0, 32),
]
KIND_ORDER = [k[0] for k in BASE_KINDS + MORE_KINDS]

#: A value is live-looking if at most this many owners and repositories hold it.
MAX_OWNERS = 1
MAX_REPOSITORIES = 3

SPAN = "kind int, start int, end int, value string"
_COMPILED: list = []


def _patterns() -> list:
    if not _COMPILED:
        for kind, (name, pattern, group, least) in enumerate(BASE_KINDS + MORE_KINDS):
            flags = re.ASCII | (re.IGNORECASE if name == "assign" else 0)
            _COMPILED.append((kind, name, re.compile(pattern, flags), group, least))
    return _COMPILED


def looks_random(value: str) -> bool:
    """Mixed classes and at least 3.5 bits per character."""
    if not (re.search("[0-9]", value) and re.search("[A-Z]", value) and re.search("[a-z]", value)):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= 3.5


def find_spans(text: str | None) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, hash of the value); positions in code points, end
    exclusive. Matches of a kind are leftmost and do not overlap."""
    out = []
    for kind, name, pattern, group, least in _patterns() if text else ():
        for m in pattern.finditer(text):
            value = m.group(group)
            if len(value) < least or (name == "mixed" and not looks_random(value)):
                continue
            out.append((kind, m.start(), m.end(), hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest()))
    return out


def spans_of(text: Column) -> Column:
    """Column: the spans of a text as an array of structs (SPAN)."""

    @F.pandas_udf(f"array<struct<{SPAN.replace(' ', ':').replace(',:', ',')}>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("kind", "start", "end", "value")
        for batch in batches:
            yield pd.Series([[dict(zip(names, s)) for s in find_spans(t)] for t in batch], dtype=object)

    return spans(text)


def candidate_spans(docs: DataFrame, repository: str, owner: str, text: str = "text") -> DataFrame:
    """`(uid, doc_id, repository, owner, spans)`, stored: one row per document,
    ``uid`` different for every row, repeated ones too."""
    found = docs.select(
        "doc_id",
        F.col(repository).cast("string").alias("repository"),
        F.col(owner).cast("string").alias("owner"),
        spans_of(F.col(text)).alias("spans"),
    )
    rows = stored(found, "secret-spans")
    # the stored rows are fixed, so their ids are the same in every reading
    return stored(rows.withColumn("uid", F.monotonically_increasing_id()), "secret-spans-ids")


def ownership(found: DataFrame) -> DataFrame:
    """`(value, n_repositories, n_owners)` over the whole corpus."""
    each = found.select("repository", "owner", F.explode("spans").alias("s")).select("repository", "owner", F.col("s.value").alias("value"))
    each = each.fillna("\x00", ["repository", "owner"]).distinct()
    owners = each.select("value", "owner").distinct().groupBy("value").agg(F.count("*").alias("n_owners"))
    repositories = each.select("value", "repository").distinct().groupBy("value").agg(F.count("*").alias("n_repositories"))
    return owners.join(repositories, "value")


def scan(docs: DataFrame, repository: str, owner: str, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """`(doc_id, spans, n_live, n_copied)`: ``spans`` is an array of (start,
    kind, end, value, n_owners, n_repositories, live), base spans and the
    method's, by start and then kind; ``n_live`` and ``n_copied`` count all
    candidates of the document by verdict."""
    found = candidate_spans(docs, repository, owner)
    each = found.where(F.size("spans") > 0).select("uid", F.explode("spans").alias("s")).select("uid", "s.*")
    judged = each.join(ownership(found), "value").withColumn(
        "live", (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories)
    )
    span = F.struct("start", "kind", "end", "value", "n_owners", "n_repositories", "live")
    shown = F.when((F.col("kind") < len(BASE_KINDS)) | F.col("live"), span)
    per_row = judged.groupBy("uid").agg(
        F.array_sort(F.collect_list(shown)).alias("spans"),
        F.count_if("live").alias("n_live"),
        F.count_if(~F.col("live")).alias("n_copied"),
    )
    joined = found.select("uid", "doc_id").join(per_row, "uid", "left")
    none = F.array().cast(per_row.schema["spans"].dataType)
    return joined.select(
        "doc_id",
        F.coalesce("spans", none).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("bigint").alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).cast("bigint").alias("n_copied"),
    )


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KIND_ORDER])
    shown = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", shown)


def _count_of(kind: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document is a repository, its source the owner."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = scan(docs.withColumn("repository", F.col("doc_id")), "repository", "source")
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_KINDS))
    counts = [_count_of(k).alias(f"n_{name}") for k, (name, *_) in enumerate(BASE_KINDS)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        "n_live",
        "n_copied",
    )

"""N-gram Jaccard join: chosen-path similarity join (operator 1).

Documents are sets of ``shingle``-word shingles; two are linked if the Jaccard
similarity of their sets is at least ``threshold``.

1. Sets: one pass makes each document's set, its fingerprint and ``TOKENS``
   MinHash tokens (the embedding on which paths are chosen). Documents with one
   fingerprint have one set; only one stands for them from here on. A set that
   shares too few of its pairs of neighbouring tokens with any other set to be in
   a candidate pair walks no paths.
2. Chosen paths: in each run a set picks each of its tokens with probability
   1 / (threshold * TOKENS), decided by a hash of (run, path, token), so
   similar sets pick the same ones; every picked token is a branch. Branches
   that a set walks alone end. A bucket of at most ``limit`` sets, or at the
   greatest depth, is a leaf; a larger one is split again. A larger one in which
   few sets are outside the most frequent class so far is a leaf as well: only
   those few are compared, with all others, in slices of the bucket.
3. Leaves are compared by brute force on the tokens. A larger leaf (near copies
   that no token separates) is cut into blocks, and every pair of blocks is a
   group of its own, so no task holds a whole leaf and no pair of documents
   becomes a row: a group returns the edges of a spanning forest. From the
   second batch of runs on, leaves whose sets are already connected are left.
4. Batches of runs repeat until the next one is expected to bring less than
   1 - ``recall`` of the connections (by what the last one brought).
5. The connected candidates are compared exactly, on whole shingle sets, again
   by blocks; this gives the links of every set and the final classes
   (connected components of the links).

Shingles are 32-bit hashes of word n-grams (A-Z in lower case): of two sets of
n shingles about n²/2^32 unrelated pairs agree by accident, which moves a
similarity by less than 10^-6 at a thousand words.

A text of fewer words than a shingle is one shingle of all its words. Null
texts and texts without a word have no set: no links, a class of their own
(class_id is their doc_id). Equal sets are linked with similarity 1. Repeated
rows are copies of each other. A class is named by its least doc_id (a null
doc_id is passed over, unless the class has no other).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, stored, stored_and_seen, table
from .components import connected_components
from .tokens import combine, mix, words

SHINGLE = 5
THRESHOLD = 0.8
TOKENS = 64
LIMIT = 200
DEPTH = 3
BATCHES = (4, 12, 12, 12)
RECALL = 0.995
#: A pair is a candidate if its tokens agree this much less than the threshold
#: (three standard errors of the estimate from 64 tokens).
SLACK = 0.15

#: A bucket with at most this many times ``limit`` sets outside its most frequent
#: class is a leaf, and such a class is cut into slices of about that many times it.
OTHERS, SLICE = 2, 5

_U = np.uint64
_MULTIPLIERS = (mix(np.arange(1, TOKENS + 1, dtype=np.uint64)) | _U(1)).astype(np.uint32)
_OFFSETS = mix(np.arange(1001, 1001 + TOKENS, dtype=np.uint64)).astype(np.uint32)

SETS = "set_id long, n_shingles int, tokens binary"


def shingle_sets(texts, shingle: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct 32-bit shingles of each text."""
    own = words(texts)
    out = []
    keys, first = own.keys, own.first
    if len(keys) >= shingle:
        rolled = keys[: len(keys) - shingle + 1]
        for k in range(1, shingle):
            rolled = combine(rolled, keys[k : len(keys) - shingle + 1 + k])
    for i in range(len(first) - 1):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= shingle:
            values = rolled[a : b - shingle + 1]
        elif b > a:
            values = keys[a : a + 1]
            for k in range(a + 1, b):
                values = combine(values, keys[k : k + 1])
        else:
            values = np.zeros(0, np.uint64)
        out.append(np.unique((values >> _U(32)).astype(np.uint32)))
    return out


def min_tokens(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash tokens (sets × TOKENS); all sets must hold something."""
    flat = mix(np.concatenate(sets).astype(np.uint64)).astype(np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])))[:-1]
    out = np.empty((len(sets), TOKENS), np.uint32)
    for j in range(TOKENS):
        h = flat * _MULTIPLIERS[j] + _OFFSETS[j]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        out[:, j] = np.minimum.reduceat(h, starts)
    return out


def fingerprint(s: np.ndarray) -> int:
    """Signed 64-bit key of a set (equal sets only, up to accident)."""
    if not len(s):
        return 0
    h = mix(s.astype(np.uint64) + _U(0x9E3779B97F4A7C15))
    total, parity = h.sum(dtype=np.uint64, keepdims=True), np.bitwise_xor.reduce(h, keepdims=True)
    return int(combine(total + _U(len(s)), mix(parity)).astype(np.int64)[0])


def _sets_of(shingle: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in small_batches(batch, "text"):
                sets = shingle_sets(part["text"], shingle)
                full = [s for s in sets if len(s)]
                tokens = iter(min_tokens(full)) if full else iter(())
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"],
                        "text_id": part["text_id"],
                        "set_id": [fingerprint(s) if len(s) else None for s in sets],
                        "n_shingles": [len(s) for s in sets],
                        "tokens": [next(tokens).tobytes() if len(s) else None for s in sets],
                    }
                ).astype({"set_id": "Int64"})

    return run


def document_sets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """`(doc_id, text_id, set_id, n_shingles, tokens)` per document row,
    stored; set_id is null for a text without words."""
    # ids pass through Python as text: with nulls they would become floats
    own = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("text").alias("text_id"), "text")
    sets = own.mapInPandas(_sets_of(shingle), f"doc_id string, text_id long, {SETS}")
    return stored(sets.withColumn("doc_id", F.col("doc_id").cast("bigint")), "sets")


# -- chosen paths ------------------------------------------------------------


def _least_tokens(threshold: float) -> int:
    """The number of equal tokens that makes a pair a candidate."""
    return int(math.ceil((threshold - SLACK) * TOKENS))


def _token_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    place = mix(np.arange(TOKENS // 2, dtype=np.uint64) + _U(7777))
    for batch in batches:
        tokens = _token_matrix(batch["tokens"]).astype(np.uint64)
        keys = combine(np.broadcast_to(place, (len(tokens), TOKENS // 2)), tokens[:, 0::2] << _U(32) | tokens[:, 1::2])
        yield pd.DataFrame({"key": keys.astype(np.int64).ravel(), "set_id": np.repeat(batch["set_id"].to_numpy(), TOKENS // 2)})


def sharing_sets(sets: DataFrame, threshold: float) -> DataFrame:
    """The rows of ``sets`` that can be in a candidate pair, stored. Each token in
    which two sets differ breaks one of the TOKENS / 2 pairs of neighbouring
    tokens, so candidates have some pairs in common; a set with more pairs that
    no other set has is in no candidate pair."""
    common = _least_tokens(threshold) - TOKENS // 2
    if common <= 0:
        return sets
    pairs = sets.select("set_id", "tokens").mapInPandas(_token_pairs, "key long, set_id long")
    alone = pairs.groupBy("key").agg(F.count("*").alias("n"), F.min("set_id").alias("set_id")).where("n = 1")
    out = alone.groupBy("set_id").agg(F.count("*").alias("n")).where(F.col("n") > TOKENS // 2 - common)
    return stored(sets.join(out.select("set_id").hint("merge"), "set_id", "left_anti"), "sharing-sets")


def _branches(tokens: np.ndarray, path: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, new path) of every picked token: tokens is rows × TOKENS, path one
    per row."""
    place = mix(np.arange(TOKENS, dtype=np.uint64) + _U(77))
    h = combine(path[:, None], tokens.astype(np.uint64) ^ place[None, :])
    picked = h < _U(int(2.0**64 / (threshold * TOKENS)))
    row, column = np.nonzero(picked)
    return row, mix(h[row, column] + _U(1))


def _token_matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(-1, TOKENS)


def first_paths(sets: DataFrame, runs: range, threshold: float) -> DataFrame:
    """`(path, set_id)` after one step of each run."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens = _token_matrix(batch["tokens"])
            for r in runs:
                seed = mix(np.full(len(batch), 1_000_003 + r, np.uint64))
                row, path = _branches(tokens, seed, threshold)
                yield pd.DataFrame({"path": path.astype(np.int64), "set_id": batch["set_id"].to_numpy()[row]})

    return sets.select("set_id", "tokens").mapInPandas(run, "path long, set_id long")


def next_paths(rows: DataFrame, threshold: float) -> DataFrame:
    """`(path, set_id, class)` one step on from `(path, set_id, class, tokens)`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            row, path = _branches(_token_matrix(batch["tokens"]), batch["path"].to_numpy().astype(np.uint64), threshold)
            yield pd.DataFrame({"path": path.astype(np.int64), "set_id": batch["set_id"].to_numpy()[row], "class": batch["class"].to_numpy()[row]})

    return rows.select("path", "set_id", "class", "tokens").mapInPandas(run, "path long, set_id long, class long")


def bucket_sizes(rows: DataFrame, connected: bool) -> DataFrame:
    """`(path, n, main, others)` of the buckets with sets of more than one class:
    the number of sets, the most frequent class and the number of sets outside
    it (null if no classes are ``connected`` yet). The other buckets are done."""
    if not connected:
        sizes = rows.groupBy("path").agg(F.count("*").alias("n"), F.min("class").alias("c1"), F.max("class").alias("c2")).where("c1 != c2")
        return sizes.select("path", "n", F.lit(None).cast("long").alias("main"), F.lit(None).cast("long").alias("others"))
    own = rows.groupBy("path", "class").agg(F.count("*").alias("m"))
    sizes = own.groupBy("path").agg(F.sum("m").alias("n"), F.count("*").alias("classes"), F.max("m").alias("most"), F.max_by("class", "m").alias("main"))
    return sizes.where("classes > 1").select("path", "n", "main", (F.col("n") - F.col("most")).alias("others"))


def leaves(sets: DataFrame, runs: range, threshold: float, limit: int, depth: int, classes: DataFrame | None) -> DataFrame:
    """`(path, set_id, class, n, is_main, others)`: the members of all leaf buckets
    of the runs, from stored tables. Where few sets are outside a large bucket's most
    frequent class, others is their number and is_main says who is inside; else both
    are null. A member is joined to its bucket once a level."""
    rows = first_paths(sets, runs, threshold)
    if classes is not None:
        rows = rows.join(classes, "set_id", "left").select("path", "set_id", F.coalesce("component", "set_id").alias("class"))
    else:
        rows = rows.withColumn("class", F.col("set_id"))
    found = []
    for level in range(1, depth + 1):
        rows = stored(rows, "paths")
        few = (F.col("n") > limit) & (F.col("others") <= OTHERS * limit)
        placed = rows.join(bucket_sizes(rows, classes is not None).hint("merge"), "path")
        placed = placed.withColumns({"is_main": F.when(few, F.col("class") == F.col("main")), "others": F.when(few, F.col("others"))}).drop("main")
        is_leaf = F.lit(level == depth) | (F.col("n") <= limit) | F.col("others").isNotNull()
        placed, seen = stored_and_seen(placed.withColumn("is_leaf", is_leaf), "buckets", F.count_if(~F.col("is_leaf")).alias("large"))
        found.append(placed.where("is_leaf").drop("is_leaf"))
        if not seen["large"]:
            break
        large = placed.where("not is_leaf").select("path", "set_id", "class")
        rows = next_paths(large.join(sets.select("set_id", "tokens").hint("merge"), "set_id"), threshold)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


# -- brute force by blocks ---------------------------------------------------


def block_pairs(rows: DataFrame, group: str, size: str, limit: int) -> DataFrame:
    """Each row once for every pair of blocks that its block is in: columns
    ``b1`` and ``b2`` name the group's pair, ``block`` the row's own. A group of
    at most ``limit`` rows is one block (0, 0)."""
    blocks = F.ceil(F.col(size) / limit).cast("int")
    own = F.pmod(F.xxhash64("set_id", F.lit("block")), blocks).cast("int")
    rows = rows.withColumns({"_blocks": blocks, "block": own})
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    rows = rows.withColumns({"b1": F.least("block", "_other"), "b2": F.greatest("block", "_other")})
    return rows.drop("_blocks", "_other")


def slices(rows: DataFrame, limit: int) -> DataFrame:
    """Like ``block_pairs``, for buckets with few ``others``: each slice (b1 = b2)
    has a part of the main class and all others."""
    count = F.greatest(F.lit(1), F.ceil((F.col("n") - F.col("others")) / (SLICE * limit))).cast("int")
    own = F.pmod(F.xxhash64("set_id", F.lit("slice")), count).cast("int")
    rows = rows.withColumn("b1", F.explode(F.when(F.col("is_main"), F.array(own)).otherwise(F.sequence(F.lit(0), count - 1))))
    return rows.withColumns({"b2": F.col("b1"), "block": F.col("b1")})


def _groups(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """The runs of rows with one key, from batches sorted by it."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        values = batch[key].to_numpy()
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(batch)])):
            part = batch.iloc[a:b]
            if held and (i > 0 or (part[key].to_numpy()[0] != held[-1][key].to_numpy()[0]).any()):
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges (member, root) of a spanning forest of a link matrix."""
    n = len(linked)
    left = np.ones(n, bool)
    out = []
    for i in range(n):
        if not left[i]:
            continue
        left[i] = False
        reach = linked[i] & left
        while reach.any():
            found = np.flatnonzero(reach)
            left[found] = False
            out += [(int(j), i) for j in found]
            reach = linked[found].any(axis=0) & left
    return out


def _roots(linked: np.ndarray) -> np.ndarray:
    """The least member of each member's component."""
    root = np.arange(len(linked))
    for member, first in _forest(linked):
        root[member] = first
    return root


def _joining(linked: np.ndarray, block: np.ndarray) -> list[tuple[int, int]]:
    """Edges that span a group: all of a forest within one block; between two
    blocks only those that join components of the blocks, which the groups of
    the single blocks have spanned already."""
    if (block == block[0]).all():
        return _forest(linked)
    same = block[:, None] == block[None, :]
    root = _roots(linked & same)
    i, j = np.nonzero(linked & ~same)
    names, place = np.unique(root, return_inverse=True)
    joined = np.zeros((len(names), len(names)), bool)
    joined[place[i], place[j]] = True
    return [(int(names[a]), int(names[b])) for a, b in _forest(joined | joined.T)]


def _token_links(threshold: float):
    least = _least_tokens(threshold)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _groups(batches, ["path", "b1", "b2"]):
            classes, main = rows["class"].to_numpy(), int(rows["is_main"].sum())
            tokens = _token_matrix(rows["tokens"])
            linked = classes[:, None] == classes[None, :]  # connected already
            for i in range(len(classes) - main):
                linked[i, i + 1 :] |= (tokens[i + 1 :] == tokens[i]).sum(axis=1) >= least
            edges = [(a, b) for a, b in _joining(linked | linked.T, rows["block"].to_numpy()) if classes[a] != classes[b]]
            if edges:
                a, b = np.array(edges).T
                yield pd.DataFrame({"a": classes[a], "b": classes[b]})

    return run


def candidate_edges(found: DataFrame, sets: DataFrame, threshold: float, limit: int) -> DataFrame:
    """`(a, b)`: connections between the classes of each leaf's sets."""
    rows = block_pairs(found.where("others is null"), "path", "n", limit).unionByName(slices(found.where("others is not null"), limit))
    rows = rows.join(sets.select("set_id", "tokens").hint("merge"), "set_id")
    rows = rows.select("path", "b1", "b2", "block", "set_id", "class", F.coalesce("is_main", F.lit(False)).alias("is_main"), "tokens")
    rows = rows.repartition("path", "b1", "b2")
    # in one order everywhere: the groups of a bucket name the same roots
    rows = rows.sortWithinPartitions("path", "b1", "b2", "is_main", "class", "set_id")
    return rows.mapInPandas(_token_links(threshold), "a long, b long")


def candidate_classes(sets: DataFrame, threshold: float, limit: int, depth: int, batches, recall: float) -> DataFrame | None:
    """`(set_id, component)`: sets that chosen paths connect, from repeated
    batches of runs; None if no two sets are connected."""
    sets = sharing_sets(sets, threshold)
    classes, first, total = None, 0, 0
    for n_runs in batches:
        runs = range(first, first + n_runs)
        new = candidate_edges(leaves(sets, runs, threshold, limit, depth, classes), sets, threshold, limit)
        new, seen = stored_and_seen(new.distinct(), "candidate-edges", F.count("*").alias("n"))
        if seen["n"]:
            joined = connected_components(new).withColumnRenamed("node", "set_id")
            if classes is not None:
                # earlier classes are nodes now; their members follow them
                moved = joined.select(F.col("set_id").alias("component"), F.col("component").alias("_to"))
                moved = classes.join(moved, "component", "left").select("set_id", F.coalesce("_to", "component").alias("component"))
                joined = moved.unionByName(joined.join(classes, "set_id", "left_anti"))
            classes = stored(joined, "classes")
        total += seen["n"]
        # runs are independent: the next ones find at most this share again
        if first and seen["n"] <= (1 - recall) * max(1, total):
            break
        first += n_runs
    return classes


def _exact_links(threshold: float, shingle: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _groups(batches, ["component", "b1", "b2"]):
            ids = rows["set_id"].to_numpy()
            sets = shingle_sets(rows["text"], shingle)
            inter = _intersections(sets)
            sizes = np.array([len(s) for s in sets], float)
            linked = inter >= threshold * (sizes[:, None] + sizes[None, :] - inter) - 1e-9
            np.fill_diagonal(linked, False)
            block = rows["block"].to_numpy()
            root = np.arange(len(ids))
            for member, parent in _joining(linked, block):
                root[member] = parent
            if rows["b1"].iloc[0] != rows["b2"].iloc[0]:  # links inside a block are counted in its own group
                linked &= block[:, None] != block[None, :]
            n_sets, n_docs = linked.sum(axis=1), linked @ rows["copies"].to_numpy(float)
            says = (n_sets > 0) | (root != np.arange(len(ids)))
            yield pd.DataFrame(
                {"set_id": ids[says], "root": ids[root[says]], "n_sets": n_sets[says].astype(np.int64), "n_docs": n_docs[says].astype(np.int64)}
            )

    return run


#: Columns of the 0-1 matrix multiplied at once.
COLUMNS = 1 << 14


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    n = len(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((n, n), np.float32)
    for start in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, [start, start + COLUMNS])
        ones = np.zeros((n, COLUMNS), np.float32)
        ones[row[a:b], column[a:b] - start] = 1
        out += ones @ ones.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def exact_links(docs: DataFrame, members: DataFrame, threshold: float, shingle: int, limit: int) -> DataFrame:
    """`(set_id, root, n_sets, n_docs)` per set and block pair: the number of
    linked sets, the documents that have them, and a linked set (or itself)
    such that the roots span the links; stored. ``members``: `(set_id,
    component, copies, text_id)`."""
    sizes = members.groupBy("component").agg(F.count("*").alias("n"))
    # joined by shuffle at every size: what is a copy of what grows with the corpus
    texts = docs.select(F.xxhash64("text").alias("text_id"), "text").hint("merge")
    one = members.join(texts, "text_id").groupBy("set_id", "component", "copies").agg(F.min("text").alias("text"))
    rows = block_pairs(one.join(sizes, "component"), "component", "n", limit)
    rows = rows.select("component", "b1", "b2", "block", "set_id", "copies", "text")
    rows = rows.repartition("component", "b1", "b2").sortWithinPartitions("component", "b1", "b2", "set_id")
    return stored(rows.mapInPandas(_exact_links(threshold, shingle), "set_id long, root long, n_sets long, n_docs long"), "links")


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    limit: int = LIMIT,
    depth: int = DEPTH,
    batches=BATCHES,
    recall: float = RECALL,
) -> DataFrame:
    """`(doc_id, text_id, class_id, n_links, n_linked_texts, class_size,
    is_kept)` per document row. n_links: the other documents linked to it, copies
    included; n_linked_texts: the different sets linked to it. is_kept marks the
    rows of the document (doc_id, text_id) that stands for its class."""
    rows = document_sets(docs, shingle)
    sets = rows.where("set_id is not null").groupBy("set_id").agg(
        F.min("tokens").alias("tokens"), F.min("text_id").alias("text_id"), F.count("*").alias("copies")
    )
    sets = stored(sets, "distinct-sets")
    candidates = candidate_classes(sets.select("set_id", "tokens"), threshold, limit, depth, batches, recall)
    per_set = sets.select("set_id", "copies")
    if candidates is None:
        per_set = per_set.withColumns({"component": F.col("set_id"), "n_sets": F.lit(0).cast("bigint"), "n_docs": F.lit(0).cast("bigint")})
    else:
        members = stored(sets.drop("tokens").join(candidates.hint("merge"), "set_id"), "members")
        links = exact_links(docs, members, threshold, shingle, limit)
        counts = links.groupBy("set_id").agg(F.sum("n_sets").alias("n_sets"), F.sum("n_docs").alias("n_docs"))
        parts = connected_components(links.select(F.col("set_id").alias("a"), F.col("root").alias("b")))
        per_set = per_set.join(counts, "set_id", "left").join(parts.withColumnRenamed("node", "set_id"), "set_id", "left")
    own = F.coalesce("component", "set_id").alias("component")
    per_set = stored(per_set.select("set_id", own, "copies", F.coalesce("n_sets", F.lit(0)).alias("n_sets"), F.coalesce("n_docs", F.lit(0)).alias("n_docs")), "set-classes")
    placed = rows.where("set_id is not null").select("doc_id", "text_id", "set_id").join(per_set.hint("merge"), "set_id")
    # null ids sort after all others
    kept = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("text_id").alias("text_id")))
    classes = placed.groupBy("component").agg(kept.alias("kept"), F.count("*").alias("class_size"))
    joined = placed.join(classes.hint("merge"), "component")
    n_links = F.col("n_docs") + F.col("copies") - 1
    out = joined.select(
        "doc_id",
        "text_id",
        F.col("kept.doc_id").alias("class_id"),
        n_links.alias("n_links"),
        F.col("n_sets").alias("n_linked_texts"),
        "class_size",
        (F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("text_id") == F.col("kept.text_id"))).alias("is_kept"),
    )
    zero = F.lit(0).cast("bigint")
    alone = rows.where("set_id is null").select(
        "doc_id", "text_id", F.col("doc_id").alias("class_id"), zero.alias("n_links"), zero.alias("n_linked_texts"), F.lit(1).cast("bigint").alias("class_size"), F.lit(True).alias("is_kept")
    )
    return out.unionByName(alone)


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "n_links", "n_linked_texts", "class_size")

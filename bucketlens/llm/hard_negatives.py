"""Hard-negative mining by exact integer scores (operator 12).

For each anchor: its first ``n_positives`` other rows of the same label, and
for each of these the first ``n_negatives`` rows of another label whose score
lies in a window below the positive's. A score is the integer inner product of
floor(scale · x); higher scores come first, ties by the smaller id.

1. Usable rows are written once, with the largest squared norm seen on the way:
   by Cauchy and Schwarz no score passes it.
2. Residue number system: components go modulo several primes (largest below
   1024 first, as many as make their product exceed twice the bound). Centred
   residues are at most 510 in size, so 64 products add up to less than 2^24 and
   a float32 matrix product of 64 inner components is exact in any order of
   summation; longer vectors are cut into inner blocks. Chinese remaindering
   (mixed radix) gives the signed score.
3. Grid: rows are dealt by a hash into groups of at most about ``GROUP_ROWS``,
   anchors into blocks of about ``BLOCK_ANCHORS``. Each pair (block, group) is
   one cell, co-grouped on that key: no task holds more than a cell, and a cell
   is multiplied tile by tile. It returns each anchor's first few rows only.
4. Selection: a window per anchor merges the cells' positives; a second pass
   over the grid finds the negatives inside each positive's score window, and a
   window per (anchor, positive) merges those.

Defined cases. Rows with a null label, a null vector or any null, NaN or
infinite component take no part. A null id is no anchor and sorts after all
others. Vectors of different lengths are padded with zeros; an empty vector
scores 0. Rows are told apart by their place in the table, so repeated rows
(and repeated ids) each count, and the copies of an anchor are among its other
rows. Anchors without a positive, and positives without a negative, return no
row; neither does an empty table. Other columns are not read, so their names
cannot clash. Very long vectors only make more inner blocks. Scores beyond 64
bits are computed exactly but cannot be returned: they raise an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored, stored_and_seen, table

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: A negative's score as a percentage of the positive's (least, greatest).
WINDOW = (80, 100)
BLOCK_ANCHORS = 16_384
GROUP_ROWS = 65_536
#: Groups never get fewer rows than this, so that small tables make few cells.
LEAST_ROWS = 1_024
INNER = 64
TILE = 256

PRIME_LIMIT = 1024

POSITIVE_ROWS = "key long, anchor_id long, other_id long, score long"
NEGATIVE_ROWS = "key long, anchor_id long, place int, positive_id long, positive_score long, other_id long, score long"


def primes_for(bound: float) -> list[int]:
    """Largest primes first, at least two, with a product over 2 · bound + 1."""
    if not math.isfinite(bound):
        raise ArithmeticError("the components are too large for finite scores")
    found, product = [], 1
    for p in range(PRIME_LIMIT - 1, 1, -1):
        if len(found) >= 2 and product > 2 * int(bound) + 1:
            return found
        if all(p % q for q in range(2, math.isqrt(p) + 1)):
            found.append(p)
            product *= p
    raise ArithmeticError("the components are too large for the primes at hand")


def residues(q: np.ndarray, p: int) -> np.ndarray:
    """Centred residues of whole-numbered doubles (fmod is exact), as float32."""
    r = np.fmod(q, p)
    r = np.where(r > p // 2, r - p, r)
    return np.where(r < -(p // 2), r + p, r).astype(np.float32)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros((len(a), len(b)), np.int64)
    for j in range(0, a.shape[1], INNER):
        total += (a[:, j : j + INNER] @ b[:, j : j + INNER].T).astype(np.int64)
    return total


def reconstruct(digits: list[np.ndarray], primes: list[int], wide: bool) -> np.ndarray:
    """The signed numbers with these residues, by mixed radix. ``wide``: in
    Python integers instead of 64-bit ones."""
    x, m = digits[0] % primes[0], primes[0]
    x = x.astype(object) if wide else x
    for d, p in zip(digits[1:], primes[1:]):
        step = (d - x) % p * pow(m, -1, p) % p
        x = x + step * m
        m *= p
    return np.where(x > m // 2, x - m, x)


class Scorer:
    """Exact scores of anchors against rows, tile by tile."""

    def __init__(self, rows: np.ndarray, bound: float):
        self.primes = primes_for(bound)
        # the window test multiplies scores by 100
        self.wide = math.prod(self.primes) >= 2**62 // 100
        self.rows = [residues(rows, p) for p in self.primes]

    def __call__(self, anchors: np.ndarray) -> np.ndarray:
        digits = [_product(residues(anchors, p), r) for p, r in zip(self.primes, self.rows)]
        return reconstruct(digits, self.primes, self.wide)


def first_of(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the first k allowed scores of each row: greatest first,
    ties by the smaller column."""
    if not scores.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    take = allowed
    if scores.shape[1] > k:
        low = scores.min() - 1
        masked = np.where(allowed, scores, low)
        least = np.partition(masked, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        take = allowed & (masked >= least[:, None])
    i, j = np.nonzero(take)
    order = np.lexsort((j, -scores[i, j], i))
    i, j = i[order], j[order]
    start = np.searchsorted(i, i)  # of its own row's run
    near = np.arange(len(i)) - start < k
    return i[near], j[near]


def whole_components(column: pa.ChunkedArray, width: int, scale: int) -> np.ndarray:
    """floor(scale · x) of the vectors as a matrix of doubles, short ones padded."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), width))
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, at] = np.floor(scale * flat)
    return out


def _numbers(t: pa.Table, name: str) -> np.ndarray:
    return t[name].to_numpy().astype(np.int64)


def _ids(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    null = np.asarray(t["id"].is_null())
    return np.asarray(t["id"].fill_null(0)).astype(np.int64), null


def _cell(bound: float, width: int, scale: int):
    """Of one cell: the rows sorted by id, their scorer, and the anchors."""

    def open_cell(anchors: pa.Table, rows: pa.Table):
        ids, null = _ids(rows)
        order = np.lexsort((ids, null))
        rows = rows.take(pa.array(order))
        scorer = Scorer(whole_components(rows["vector"], width, scale), bound)
        return rows, ids[order], null[order], scorer, whole_components(anchors["vector"], width, scale)

    return open_cell


def _out(schema: pa.Schema, pieces: list[dict[str, np.ndarray]]) -> pa.Table:
    """Arrow rows of the pieces; an id stands in a masked array if it can be null."""
    if not pieces:
        return schema.empty_table()
    columns = {}
    for f in schema:
        parts = [p[f.name] for p in pieces]
        null = np.concatenate([np.ma.getmaskarray(p) for p in parts])
        values = np.concatenate([np.ma.getdata(p) for p in parts])
        columns[f.name] = pa.array(values.tolist() if values.dtype == object else values, f.type, mask=None if values.dtype == object else null)
    return pa.table(columns, schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def _positives_of(bound: float, width: int, scale: int, k: int):
    open_cell, schema = _cell(bound, width, scale), _schema(POSITIVE_ROWS)

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not len(anchors) or not len(rows):
            return schema.empty_table()
        rows, ids, null, scorer, vectors = open_cell(anchors, rows)
        keys, labels = _numbers(rows, "key"), _numbers(rows, "label")
        a_key, a_label, a_id = _numbers(anchors, "key"), _numbers(anchors, "label"), _ids(anchors)[0]
        pieces = []
        for at in range(0, len(vectors), TILE):
            tile = slice(at, at + TILE)
            scores = scorer(vectors[tile])
            itself = (a_key[tile, None] == keys) & (a_id[tile, None] == ids) & ~null
            i, j = first_of(scores, (a_label[tile, None] == labels) & ~itself, k)
            pieces.append({"key": a_key[tile][i], "anchor_id": a_id[tile][i], "other_id": np.ma.array(ids[j], mask=null[j]), "score": scores[i, j]})
        return _out(schema, pieces)

    return run


def _negatives_of(bound: float, width: int, scale: int, k: int, window: tuple[int, int]):
    open_cell, schema = _cell(bound, width, scale), _schema(NEGATIVE_ROWS)

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not len(anchors) or not len(rows):
            return schema.empty_table()
        rows, ids, null, scorer, vectors = open_cell(anchors, rows)
        labels = _numbers(rows, "label")
        a_key, a_label, a_id = _numbers(anchors, "key"), _numbers(anchors, "label"), _ids(anchors)[0]
        found = anchors["positives"].to_pylist()
        pieces = []
        for at in range(0, len(vectors), TILE):
            tile = slice(at, at + TILE)
            scores = scorer(vectors[tile])
            negative = a_label[tile, None] != labels
            for place in range(max(len(p) for p in found[tile])):
                own = [p[place] if place < len(p) else None for p in found[tile]]
                has = np.array([p is not None for p in own])
                top = np.array([p["score"] if p else 0 for p in own], scores.dtype)[:, None]
                inside = (100 * scores >= window[0] * top) & (100 * scores <= window[1] * top)
                i, j = first_of(scores, negative & inside & has[:, None], k)
                other = [own[x]["other_id"] for x in i]
                pieces.append(
                    {
                        "key": a_key[tile][i],
                        "anchor_id": a_id[tile][i],
                        "place": np.full(len(i), place, np.int32),
                        "positive_id": np.ma.array([x or 0 for x in other], np.int64, mask=[x is None for x in other]),
                        "positive_score": top[i, 0],
                        "other_id": np.ma.array(ids[j], mask=null[j]),
                        "score": scores[i, j],
                    }
                )
        return _out(schema, pieces)

    return run


def _best(rows: DataFrame, group: list[str], k: int) -> DataFrame:
    """The first k rows of each group, ``rank`` from 1."""
    order = W.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("other_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str | Column = "label",
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    scale: int = SCALE,
) -> DataFrame:
    """`(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)` for every row of ``rows`` where ``anchor`` holds. ``label``
    is a whole number (a name, or an expression over ``rows``)."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    label = F.col(label) if isinstance(label, str) else label
    used = rows.where(x.isNotNull() & ~bad & label.isNotNull()).select(
        F.col(id).cast("bigint").alias("id"), label.cast("bigint").alias("label"), x.alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor")
    )
    norm = F.aggregate("vector", F.lit(0.0), lambda s, v: s + F.pow(F.abs(v.cast("double")) * scale + 1, F.lit(2.0)))
    kept, seen = stored_and_seen(
        used,
        "vectors",
        F.count("*").alias("n"),
        F.count_if("anchor").alias("n_anchors"),
        F.max(norm).alias("bound"),
        F.max(F.size("vector")).alias("width"),
    )
    bound, width = (seen["bound"] or 0.0) * (1 + 1e-9) + 1, max(1, seen["width"] or 0)
    # a stored table's rows have a place, the same on every reading
    place = kept.metadataColumn("_metadata")
    kept = kept.withColumn("key", F.xxhash64(place["file_path"], place["row_index"]))
    per_group = max(LEAST_ROWS, min(GROUP_ROWS, seen["n"] // 64))
    groups, blocks = math.ceil(max(1, seen["n"]) / per_group), math.ceil(max(1, seen["n_anchors"]) / BLOCK_ANCHORS)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod("key", F.lit(n)).cast("int")
    columns = ["key", "id", "label", "vector"]
    right = kept.select(every(blocks).alias("block"), dealt(groups).alias("group"), *columns)
    right = right.toDF(*right.columns).groupBy("block", "group")  # columns of its own, not those of the anchors

    def over_grid(anchors: DataFrame, run, out: str, *more: str) -> DataFrame:
        left = anchors.select(dealt(blocks).alias("block"), every(groups).alias("group"), *columns, *more)
        return left.groupBy("block", "group").cogroup(right).applyInArrow(run, out)

    anchors = kept.where("anchor and id is not null")
    first = over_grid(anchors, _positives_of(bound, width, scale, n_positives), POSITIVE_ROWS)
    positives = _best(first, ["key", "anchor_id"], n_positives)
    lists = positives.groupBy("key", "anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "other_id", "score"))).alias("positives"))
    lists = stored(lists.withColumnRenamed("anchor_id", "id"), "positives")
    both = over_grid(anchors.join(lists, ["key", "id"]), _negatives_of(bound, width, scale, n_negatives, window), NEGATIVE_ROWS, "positives")
    best = _best(both, ["key", "anchor_id", "place"], n_negatives)
    return best.select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives(rows, F.col("vec_id") % 100 == 0, label=label)

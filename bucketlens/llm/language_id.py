"""Language identification: interpolated Kneser-Ney character models (operator 9).

Training: a bounded sample (``train_rows`` documents a language, those with the
least hash) is counted by Spark into character n-grams: raw counts at the
highest order, counts of distinct left extensions below. The counts become one
sorted array of 64-bit n-gram hashes per order, with the fully interpolated
log-probability in each language beside each entry, and one of contexts with
their back-off weights. Sizes are bounded by the sample, so the model is sent
to every task.

Prediction: one pass over the whole text finds the longest known n-gram ending
at each letter or space (a binary search of the hash arrays; back-off weights
where it is missing) and sums the log-probabilities for all languages. The
language with the lowest cross-entropy per character wins; equal ones go to the
first by name. A further sample (``check_rows`` a language, not used for the
counts) calibrates the rejection: a text whose cross-entropy lies above its
language's limit is not ``accepted``.

Only text goes into a prediction. Null texts and texts without a letter are
``und`` with score 0. Training skips null texts and null languages; without any
training row all predictions are ``und``. Repeated rows get equal results.
Whole texts are read, however long. The result is the column ``_language``; a
column of that name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import crc_mod, small_batches, stored, table

ORDER = 4
TRAIN_ROWS = 600
CHECK_ROWS = 200
SLICES = 256
#: Sampled ids up to this many are sent to every task; beyond it, they are
#: joined by shuffle, with the same result.
BROADCAST_ROWS = 200_000
#: Characters that one posterior may count as independent evidence.
EVIDENCE = 40
LIMIT_QUANTILE = 0.999
LIMIT_MARGIN = 0.15

_U = np.uint64
_B = _U(0x9E3779B97F4A7C15)
_PAD = 0  # stands before and after a text
_FOLD: list[np.ndarray] = []


def _fold_table() -> np.ndarray:
    """Code point → its lower-case letter, or a space for what is no letter."""
    if not _FOLD:
        out = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                out[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(out)
    return _FOLD[0]


def folded(texts) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points of all texts, runs of spaces as one and ORDER - 1
    pads before each text; and the bounds of the texts in them."""
    fold = _fold_table()
    parts, sizes = [], []
    for t in texts:
        p = fold[np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), np.uint32)]
        p = np.concatenate(([32], p, [32]))
        p = p[(p != 32) | np.concatenate(([True], p[:-1] != 32))]
        p = np.concatenate((np.full(ORDER - 1, _PAD), p)).astype(np.uint64)
        parts.append(p)
        sizes.append(len(p))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def _scatter(points: np.ndarray) -> np.ndarray:
    h = (points + _U(1)) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(31))


def gram_hashes(points: np.ndarray) -> list[np.ndarray]:
    """For k = 0 … ORDER: hash of the k points that end at each place."""
    value = _scatter(points) * _U(0x94D049BB133111EB)
    out, h, power = [np.zeros(len(points), np.uint64)], np.zeros(len(points), np.uint64), _U(1)
    with np.errstate(over="ignore"):
        for k in range(ORDER):
            shifted = np.zeros_like(value)
            shifted[k:] = value[: max(0, len(value) - k)]
            h = h + shifted * power
            power = power * _B
            out.append(h)
    return out


def hash_of(gram: str) -> int:
    points = np.frombuffer(gram.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return int(gram_hashes(points)[len(points)][-1]) if gram else 0


@dataclass
class Model:
    """languages; per order 1 … ORDER the sorted hashes of known n-grams with
    log-probabilities, and the sorted hashes of contexts with back-off weights
    (rows: entries, columns: languages). floor: log-probability of a character
    that no language knows. limits: the accepted cross-entropy."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    floor: np.ndarray
    limits: np.ndarray

    def scores(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy (texts × languages, nats a character), characters
        scored, and letters, of each text."""
        points, bounds = folded(texts)
        at = np.flatnonzero(points != _PAD)
        hashes = gram_hashes(points)
        total = np.zeros((len(at), len(self.languages)), np.float32)
        open_ = np.arange(len(at))
        for k in range(len(self.grams), 0, -1):
            keys, values = self.grams[k - 1]
            own = hashes[k][at[open_]]
            i = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            hit = keys[i] == own
            total[open_[hit]] += values[i[hit]]
            open_ = open_[~hit]
            if k > 1 and len(open_):
                keys, values = self.contexts[k - 1]
                own = hashes[k - 1][at[open_] - 1]
                i = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                hit = keys[i] == own
                total[open_[hit]] += values[i[hit]]
        total[open_] += self.floor
        first = np.searchsorted(at, bounds[:-1])
        n = np.searchsorted(at, bounds[1:]) - first
        sums = np.add.reduceat(total, first, axis=0, dtype=np.float64) if len(first) else total
        letters = np.add.reduceat((points[at] != 32).astype(np.int64), first) if len(first) else n
        return -sums / n[:, None], n, letters


def sampled(docs: DataFrame, train_rows: int, check_rows: int) -> DataFrame:
    """`(doc_id, lang, text, is_check)`: per language at most ``train_rows`` +
    ``check_rows`` documents of the training folds, by the hash of the id."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    known = known.where(crc_mod("doc_id", 4) != 2)
    most = train_rows + check_rows
    ids = known.select("lang", "doc_id", F.xxhash64(F.col("doc_id").cast("string")).alias("_h"))
    # first in slices of a language, so that no task sorts a whole language
    for slices in (SLICES, 1):
        order = W.partitionBy("lang", F.pmod("_h", F.lit(slices))).orderBy("_h", "doc_id")
        ids = ids.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= most)
    # every (train_rows + check_rows) / check_rows-th document is for the limits
    every = max(2, most // max(1, check_rows))
    ids = ids.select("lang", "doc_id", (F.col("_r") % every == 0).alias("is_check")).dropDuplicates(["lang", "doc_id"])
    # a bounded number of ids a language: with a usual number of languages they
    # go to the texts, which then need no shuffle
    ids = stored(ids, "sampled-ids")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    chosen = known.join(ids, ["lang", "doc_id"])
    return chosen.groupBy("lang", "doc_id", "is_check").agg(F.min("text").alias("text"))


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for part in small_batches(batch, "text"):
            for lang, rows in part.groupby("lang"):
                points, _ = folded(rows["text"])
                ends = np.flatnonzero(points != _PAD)
                windows = np.lib.stride_tricks.sliding_window_view(points.astype(np.uint32), ORDER)[ends - ORDER + 1]
                grams, n = np.unique(windows, axis=0, return_counts=True)
                names = [g.tobytes().decode("utf-32-le", "surrogatepass") for g in grams]
                yield pd.DataFrame({"lang": lang, "gram": names, "n": n})


def count_grams(sample: DataFrame) -> DataFrame:
    """`(lang, k, gram, n)`: raw counts at the highest order, distinct left
    extensions below it."""
    top = sample.select("lang", "text").mapInPandas(_count_grams, "lang string, gram string, n long")
    top = stored(top.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-grams")
    levels = [top.select("lang", F.lit(ORDER).alias("k"), "gram", "n")]
    for k in range(ORDER - 1, 0, -1):
        below = levels[-1].groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("n"))
        levels.append(below.select("lang", F.lit(k).alias("k"), "gram", "n"))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def build(counts: pd.DataFrame) -> Model:
    """Kneser-Ney with one discount per language and order, n1 / (n1 + 2 n2)."""
    languages = sorted(counts["lang"].unique())
    column = {name: i for i, name in enumerate(languages)}
    lower: dict[str, np.ndarray] = {}
    alphabet = counts.loc[counts["k"] == 1, "gram"].nunique() + 1
    uniform = np.full(len(languages), 1.0 / alphabet)
    floor = np.log(uniform)
    grams, contexts = [], []
    for k in range(1, ORDER + 1):
        level = counts[counts["k"] == k]
        names, row = np.unique(level["gram"].to_numpy(dtype=object), return_inverse=True)
        n = np.zeros((len(names), len(languages)))
        n[row, [column[x] for x in level["lang"]]] = level["n"].to_numpy()
        ones, twos = (n == 1).sum(0), (n == 2).sum(0)
        discount = np.clip(ones / np.maximum(1, ones + 2 * twos), 0.1, 0.9)
        heads, head = np.unique(np.array([g[:-1] for g in names], dtype=object), return_inverse=True)
        total, kinds = np.zeros((2, len(heads), len(languages)))
        np.add.at(total, head, n)
        np.add.at(kinds, head, n > 0)
        weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        below = np.array([lower[g[1:]] for g in names]) if k > 1 else uniform
        p = np.where(n > 0, (n - discount) / np.maximum(total[head], 1), 0.0) + weight[head] * below
        lower = dict(zip(names, p))
        order = np.argsort(keys := np.array([hash_of(g) for g in names], np.uint64))
        grams.append((keys[order], np.log(p)[order].astype(np.float32)))
        order = np.argsort(keys := np.array([hash_of(h) for h in heads], np.uint64))
        contexts.append((keys[order], np.log(weight)[order].astype(np.float32)))
        if k == 1:
            floor = np.log(uniform * weight[0])
    return Model(languages, grams, contexts, floor.astype(np.float32), np.full(len(languages), np.inf))


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS, check_rows: int = CHECK_ROWS) -> Model | None:
    """A model from the bounded sample; None if there is nothing to learn."""
    sample = stored(sampled(docs, train_rows, check_rows), "language-sample")
    counts = count_grams(sample.where("not is_check")).toPandas()  # bounded by the sample
    if counts.empty:
        return None
    model = build(counts)
    check = sample.where("is_check").select("lang", "text").mapInPandas(_entropies(model), "lang string, entropy double")
    quantile = check.groupBy("lang").agg(F.percentile("entropy", F.lit(LIMIT_QUANTILE)).alias("q")).toPandas()
    for lang, q in zip(quantile["lang"], quantile["q"]):
        if lang in model.languages:
            model.limits[model.languages.index(lang)] = q + LIMIT_MARGIN
    return model


def _entropies(model: Model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in small_batches(batch, "text"):
                entropy, _, letters = model.scores(part["text"])
                at = part["lang"].map({x: i for i, x in enumerate(model.languages)}).to_numpy(float)
                use = (letters > 0) & ~np.isnan(at)
                yield pd.DataFrame({"lang": part["lang"][use], "entropy": entropy[use, at[use].astype(int)]})

    return run


RESULT = "lang_pred string, score double, cross_entropy double, accepted boolean"


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` plus a struct ``_language`` (RESULT)."""
    if model is None:
        none = F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"), F.lit(False).alias("accepted"))
        return docs.withColumn("_language", none)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in batches:
            out = []
            for part in small_batches(pd.DataFrame({"text": batch}), "text"):
                entropy, n, letters = m.scores(part["text"])
                best = entropy.argmin(1)
                least = entropy.min(1)
                weight = np.exp((least[:, None] - entropy) * np.minimum(n, EVIDENCE)[:, None])
                known = letters > 0
                out.append(
                    pd.DataFrame(
                        {
                            "lang_pred": np.where(known, np.array(m.languages, object)[best], "und"),
                            "score": np.where(known, 1 / weight.sum(1), 0.0),
                            "cross_entropy": np.where(known, least, np.nan),
                            "accepted": known & (least <= m.limits[best]),
                        }
                    )
                )
            yield pd.concat(out, ignore_index=True) if out else pd.DataFrame(columns=[f.split()[0] for f in RESULT.split(", ")])

    return docs.withColumn("_language", language(F.col(text)))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = predict(docs.select("doc_id", "text"), train(docs))
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "_language.*")

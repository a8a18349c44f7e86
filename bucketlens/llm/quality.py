"""Quality rules: tokeniser fertility with rejection bands (operator 8).

Base counts per text (words, symbols, repeated lines, repeated 3-word windows)
decide ``base_failed``. The method then tokenises the whole text with a public
vocabulary and measures

* fertility: characters per token (a vocabulary that knows the language needs
  few tokens; junk, markup and shouting need many),
* byte-fallback share: tokens that are only part of a character,
* token entropy: bits per token of the text's own token distribution, over the
  most it could be for that many tokens (1: no token repeats).

Each has a rejection band per script (and per language where one is given).
A text is kept if it has not failed the base rule and lies inside the bands.
Null and empty texts have zero words: base_failed, not kept, null measures.
Rows are judged one by one, so repeated rows get equal results, and an empty
table an empty one. Whole texts are measured, however long. The result is the
column ``_quality``; a column of that name is replaced.
"""

from __future__ import annotations

import base64
import math
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, small_batches, table
from .tokens import combine, words

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"

# How the vocabulary splits a text before merging bytes.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Band:
    """Accepted range of each measure."""

    chars_per_token: tuple[float, float]
    max_byte_fallback: float
    min_entropy: float


#: By script of most letters; None: any other script, or no letter.
SCRIPT_BANDS: Mapping[str | None, Band] = {
    "latin": Band((2.05, 8.0), 0.10, 0.30),
    "greek": Band((0.9, 8.0), 0.45, 0.30),
    "cyrillic": Band((1.2, 8.0), 0.45, 0.30),
    "cjk": Band((0.5, 4.0), 0.75, 0.30),
    None: Band((0.3, 8.0), 0.90, 0.25),
}

#: Closer bands for languages of the Latin script: below the least fertility of
#: labelled good text in each (``labels.quality`` = 1) by a margin of a tenth.
LANGUAGE_BANDS: Mapping[str, Band] = {
    "de": Band((2.3, 8.0), 0.10, 0.30),
    "en": Band((2.15, 8.0), 0.10, 0.30),
    "es": Band((2.05, 8.0), 0.10, 0.30),
    "fr": Band((1.95, 8.0), 0.10, 0.30),
}

# First and last code point of the main blocks of each script.
SCRIPT_RANGES = [
    ("latin", 0x41, 0x5A),
    ("latin", 0x61, 0x7A),
    ("latin", 0xC0, 0x24F),
    ("greek", 0x370, 0x3FF),
    ("cyrillic", 0x400, 0x52F),
    ("cjk", 0x3040, 0x30FF),
    ("cjk", 0x3400, 0x9FFF),
    ("cjk", 0xAC00, 0xD7AF),
]

SCHEMA = """n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,
            n_tokens long, script string, chars_per_token double, byte_fallback double, token_entropy double"""


def base_counts(text: str | None, keys: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; ``keys``
    are the text's words (case kept)."""
    if not text:
        return 0, 0, 0, 0, 0
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    dup_lines = 0
    if "\n" in text:
        lines = Counter(line for line in text.split("\n") if line.strip(SPACES))
        dup_lines = sum(lines.values()) - len(lines)
    return len(keys), chars, symbols, dup_lines, repeated_words(keys)


def repeated_words(keys: np.ndarray) -> int:
    """Words inside a 3-word window that the text holds at least twice."""
    n = len(keys)
    if n < 4:
        return 0
    window = combine(combine(keys[:-2], keys[1:-1]), keys[2:])
    order = np.argsort(window)
    same = window[order][1:] == window[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    start = np.zeros(n - 2, bool)
    start[order[1:][same]] = True
    start[order[:-1][same]] = True
    for k in range(3):
        again[k : n - 2 + k] |= start
    return int(again.sum())


_SCRIPTS = sorted({name for name, _, _ in SCRIPT_RANGES})
_SCRIPT_OF = np.zeros(0x110000, np.uint8)
for _name, _first, _last in SCRIPT_RANGES:
    _SCRIPT_OF[_first : _last + 1] = 1 + _SCRIPTS.index(_name)


def script_of(text: str) -> str | None:
    """Script of most letters among the known ranges; of equals, the last by
    name."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.bincount(_SCRIPT_OF[points], minlength=1 + len(_SCRIPTS))[1:]
    best = len(counts) - 1 - int(np.argmax(counts[::-1]))
    return _SCRIPTS[best] if counts[best] else None


class Vocabulary:
    """A public byte-level vocabulary, loaded once per Python worker."""

    _loaded: dict[str, Vocabulary] = {}

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.partial = np.zeros(max(ranks.values()) + 1, bool)
        for token, rank in ranks.items():
            try:
                token.decode()
            except UnicodeDecodeError:
                self.partial[rank] = True

    @classmethod
    def at(cls, path: str) -> Vocabulary:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]


#: A text is encoded in stretches of about this many characters, cut before a
#: space (where the pieces of this vocabulary begin), which bounds the memory.
STRETCH = 1 << 18


def stretches(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > STRETCH:
        cut = text.rfind(" ", at + 1, at + STRETCH)
        cut = cut if cut > at else at + STRETCH
        yield text[at:cut]
        at = cut
    yield text[at:]


def measures(text: str | None, vocabulary: Vocabulary) -> tuple:
    """n_tokens, script, chars_per_token, byte_fallback, token_entropy."""
    if not text:
        return 0, None, None, None, None
    ids = np.concatenate([np.asarray(vocabulary.encode(x), np.int32) for x in stretches(text)])
    n = len(ids)
    fallback = float(vocabulary.partial[ids].sum()) / n
    if n < 2:
        return n, script_of(text), len(text) / n, fallback, None
    ids.sort()
    counts = np.diff(np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1], [True]))))
    share = counts / n
    entropy = -float((share * np.log2(share)).sum()) / math.log2(n)
    return n, script_of(text), len(text) / n, fallback, abs(entropy)


def measured(docs: DataFrame, vocabulary: str = VOCABULARY, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``_quality`` (SCHEMA)."""
    names = [f.split()[0] for f in SCHEMA.split(",")]

    @F.pandas_udf(SCHEMA)
    def quality(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocab = Vocabulary.at(vocabulary)
        for batch in batches:
            rows = []
            for part in small_batches(pd.DataFrame({"text": batch}), "text"):
                own = words(part["text"], lower=False)
                rows += [(*base_counts(t, own.of(i)), *measures(t, vocab)) for i, t in enumerate(part["text"])]
            out = pd.DataFrame(rows, columns=names)
            yield out.astype({c: "float64" for c in names[-3:]})

    return docs.withColumn("_quality", quality(F.col(text)))


def within_bands(bands: Mapping[str | None, Band], language_bands: Mapping[str, Band] | None, lang: str | None):
    """Column: the measures in ``_quality`` lie inside the band of the row's
    language if it has one, else of its script. A null measure is inside."""
    q = lambda name: F.col(f"_quality.{name}")

    def inside(band: Band):
        low, high = band.chars_per_token
        return (
            F.coalesce(q("chars_per_token").between(low, high), F.lit(True))
            & F.coalesce(q("byte_fallback") <= band.max_byte_fallback, F.lit(True))
            & F.coalesce(q("token_entropy") >= band.min_entropy, F.lit(True))
        )

    verdict = inside(bands[None])
    for script, band in bands.items():
        if script is not None:
            verdict = F.when(q("script") == script, inside(band)).otherwise(verdict)
    for name, band in (language_bands or {}).items():
        if lang is not None:
            verdict = F.when(F.col(lang) == name, inside(band)).otherwise(verdict)
    return verdict


def quality_rules(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    bands: Mapping[str | None, Band] = SCRIPT_BANDS,
    language_bands: Mapping[str, Band] | None = None,
    lang: str | None = None,
) -> DataFrame:
    """``docs`` plus a struct ``_quality``: the counts and measures, base_failed
    and kept. ``lang``: the column that picks a language band."""
    q = lambda name: F.col(f"_quality.{name}")
    failed = (q("n_words") < MIN_WORDS) | (100 * q("n_repeat_words") > MAX_REPEAT_PERCENT * q("n_words"))
    out = measured(docs, vocabulary).withColumn("_quality", F.col("_quality").withField("base_failed", failed))
    kept = ~F.col("_quality.base_failed") & within_bands(bands, language_bands, lang)
    return out.withColumn("_quality", F.col("_quality").withField("kept", kept))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = quality_rules(docs, language_bands=LANGUAGE_BANDS, lang="lang")
    return judged.select("doc_id", "_quality.*")

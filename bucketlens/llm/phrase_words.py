"""Words of whole texts as chunks that phrases are counted in (operator 13).

A chunk is one row: the distinct words of about ``CHUNK_BYTES`` of text in one
language, and one code a word occurrence, which says which distinct word it is
and whether a piece ends before it. Phrases never cross a piece, so texts of one
language can share a chunk. A word's key is a 64-bit hash of (language, word); a
second hash of the same bytes, drawn from another table, shows on the whole
vocabulary whether two words share a key (then another seed is taken).
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa

from .tokens import mix

# What ends a piece, and what else separates words.
PIECE_ENDS = ".,;:!?\x0a\x0b\x0c\x0d"
WORD_GAPS = "\x20\x09"

_CLASS = np.zeros(256, np.uint8)
_CLASS[[ord(c) for c in WORD_GAPS]] = 1
_CLASS[[ord(c) for c in PIECE_ENDS]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

CHUNK_BYTES = 2 << 20
#: Bytes hashed at once (bounds the 64-bit work arrays).
SEGMENT_BYTES = 1 << 19
#: Longer words are hashed one by one, by a cryptographic hash: the polynomial
#: hash modulo 2^64 has known collisions among long strings of two letters.
LONG_WORD = 512

_U = np.uint64

CHUNKS = "lang string, lang_key long, n long, keys binary, checks binary, counts binary, lengths binary, words binary, codes binary, clash boolean"
_CHUNK_SCHEMA = pa.schema(
    [("lang", pa.string()), ("lang_key", pa.int64()), ("n", pa.int64())]
    + [(c, pa.binary()) for c in ("keys", "checks", "counts", "lengths", "words", "codes")]
    + [("clash", pa.bool_())]
)


class Hasher:
    """Two 64-bit hashes of each word, drawn from ``seed``."""

    def __init__(self, seed: int):
        self.seed = seed
        rng = np.random.Generator(np.random.PCG64([13, seed]))
        self.tables = rng.integers(0, 2**63, (2, 256), dtype=np.uint64) * _U(2) + _U(1)
        bases = [int(b) | 1 for b in rng.integers(2**62, 2**63, 2)]
        self.up = [self._powers(b) for b in bases]
        self.down = [self._powers(pow(b, -1, 2**64)) for b in bases]

    @staticmethod
    def _powers(base: int) -> np.ndarray:
        p = np.full(SEGMENT_BYTES + LONG_WORD + 1, base, np.uint64)
        p[0] = 1
        return np.cumprod(p)

    def digest(self, body: bytes) -> tuple[int, int]:
        d = blake2b(body, digest_size=16, salt=self.seed.to_bytes(8, "little")).digest()
        return int.from_bytes(d[:8], "little"), int.from_bytes(d[8:], "little")

    def words(self, buffer: np.ndarray, start: np.ndarray, end: np.ndarray, lang: str) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of the words at [start, end) of ``buffer``."""
        out = np.empty((2, len(start)), np.uint64)
        length = end - start
        long = length > LONG_WORD
        i = 0
        while i < len(start):
            # as many words as fit a segment, at least one
            j = max(i + 1, int(np.searchsorted(end, start[i] + SEGMENT_BYTES, "right")))
            a, b = int(start[i]), int(end[j - 1])
            if b - a <= SEGMENT_BYTES + LONG_WORD:
                part = buffer[a:b]
                for k in range(2):
                    total = np.zeros(b - a + 1, np.uint64)
                    np.cumsum(self.tables[k][part] * self.up[k][: b - a], out=total[1:])
                    out[k, i:j] = (total[end[i:j] - a] - total[start[i:j] - a]) * self.down[k][start[i:j] - a] + length[i:j].astype(np.uint64)
            i = j
        for i in np.flatnonzero(long):
            out[:, i] = self.digest(buffer[start[i] : end[i]].tobytes())
        own = self.digest(lang.encode("utf-8", "surrogatepass"))
        return mix(out[0] ^ _U(own[0])), mix(out[1] ^ _U(own[1]))


def word_bounds(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and whether a piece ends before each."""
    kind = _CLASS[buffer]
    inside = kind == 0
    edge = np.diff(inside.view(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ends = np.flatnonzero(kind == 2)
    before = np.searchsorted(ends, start)
    return start, end, np.diff(before, prepend=-1) != 0


def chunk_row(buffer: np.ndarray, lang: str, hasher: Hasher) -> dict | None:
    buffer = _LOWER[buffer]
    start, end, fresh = word_bounds(buffer)
    if not len(start):
        return None
    keys, checks = hasher.words(buffer, start, end, lang)
    codes, distinct = pd.factorize(keys)
    first = np.empty(len(distinct), np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    text = buffer.tobytes()
    return {
        "lang": lang,
        "lang_key": int(np.array(hasher.digest(lang.encode("utf-8", "surrogatepass"))[:1], np.uint64).astype(np.int64)[0]),
        "n": len(codes),
        "keys": distinct.astype(np.uint64).tobytes(),
        "checks": checks[first].tobytes(),
        "counts": np.bincount(codes).astype(np.uint32).tobytes(),
        "lengths": (end[first] - start[first]).astype(np.uint32).tobytes(),
        "words": b"".join([text[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())]),
        # compressed in the row, so that what Spark holds and sends is small too
        "codes": pa.compress((codes.astype(np.uint32) << np.uint32(1) | fresh.astype(np.uint32)).tobytes(), "zstd", asbytes=True),
        "clash": bool((checks != checks[first][codes]).any()),
    }


def _cuts(buffer: np.ndarray) -> list[int]:
    """Cut points just after the end of a piece, about CHUNK_BYTES apart (a
    longer piece is not cut, and up to twice as much is one chunk)."""
    if len(buffer) <= 2 * CHUNK_BYTES:
        return [0, len(buffer)]
    ends = np.flatnonzero(_CLASS[buffer] == 2) + 1
    cuts = [0]
    while len(buffer) - cuts[-1] > CHUNK_BYTES:
        i = int(np.searchsorted(ends, cuts[-1] + CHUNK_BYTES, "right"))
        at = int(ends[i - 1]) if i and ends[i - 1] > cuts[-1] else (int(ends[i]) if i < len(ends) else len(buffer))
        cuts.append(at)
    return cuts if cuts[-1] == len(buffer) else [*cuts, len(buffer)]


def to_chunks(seed: int):
    """For ``mapInArrow`` over (lang, text as binary): rows of CHUNKS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(seed)
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            buffer = np.frombuffer(b"\n".join(held.pop(lang)), np.uint8)
            cuts = _cuts(buffer)
            for a, b in zip(cuts, cuts[1:]):
                row = chunk_row(buffer[a:b], lang, hasher)
                if row is not None:
                    yield pa.RecordBatch.from_pylist([row], _CHUNK_SCHEMA)

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                body = text.as_buffer()
                if body is None or not body.size:
                    continue
                held.setdefault(lang, []).append(body.to_pybytes())
                size[lang] = size.get(lang, 0) + body.size
                if size[lang] >= CHUNK_BYTES:
                    yield from flush(lang)
                    size[lang] = 0
            # many languages: what is held stays bounded
            while sum(size.values()) > 4 * CHUNK_BYTES:
                most = max(size, key=size.get)
                yield from flush(most)
                size[most] = 0
        for lang in list(held):
            yield from flush(lang)

    return run


def _array(binary, dtype) -> np.ndarray:
    return np.frombuffer(binary.as_buffer(), dtype)


def chunk_arrays(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, codes, fresh) of each chunk in a batch."""
    for n, keys, codes in zip(batch.column("n"), batch.column("keys"), batch.column("codes")):
        packed = np.frombuffer(pa.decompress(codes.as_buffer(), 4 * n.as_py(), "zstd"), np.uint32)
        yield _array(keys, np.uint64), (packed >> np.uint32(1)).astype(np.int64), (packed & np.uint32(1)).astype(bool)


VOCABULARY = "word long, lang long, f long, check long"


def vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word key, language key, occurrences, check) of each chunk's words."""
    names = ["word", "lang", "f", "check"]
    for batch in batches:
        for keys, checks, counts, lang in zip(*(batch.column(c) for c in ("keys", "checks", "counts", "lang_key"))):
            k = _array(keys, np.int64)
            parts = [k, np.full(len(k), lang.as_py(), np.int64), _array(counts, np.uint32).astype(np.int64), _array(checks, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(p) for p in parts], names=names)


SPELLED = "word long, spelling binary"


def spelled(bits: np.ndarray):
    """(word key, its bytes) of the words whose key is in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, lengths, words in zip(*(batch.column(c) for c in ("keys", "lengths", "words"))):
                k = _array(keys, np.uint64)
                end = np.cumsum(_array(lengths, np.uint32).astype(np.int64))
                hit = np.flatnonzero(in_bitmap(bits, k))
                body = words.as_buffer().to_pybytes()
                start = end - _array(lengths, np.uint32)
                found = [body[a:b] for a, b in zip(start[hit].tolist(), end[hit].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(k[hit].astype(np.int64)), pa.array(found, pa.binary())], names=["word", "spelling"])

    return run


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether a key's leading bits are set in the bitmap (64-bit words)."""
    at = keys >> _U(64 - (len(bits).bit_length() + 5))
    return (bits[(at >> _U(6)).astype(np.int64)] >> (at & _U(63))) & _U(1) == 1


def counted(keys: np.ndarray, codes: np.ndarray, at: np.ndarray, length: int) -> list[np.ndarray]:
    """The distinct phrases of ``length`` words that begin at the positions
    ``at``: one key array a word, and their counts."""
    ids = codes[at]
    for j in range(1, length):
        ids, distinct = pd.factorize(ids * len(keys) + codes[at + j])
    first = np.empty(len(distinct), np.int64)
    first[ids[::-1]] = at[::-1]
    return [*(keys[codes[first + j]].astype(np.int64) for j in range(length)), np.bincount(ids, minlength=len(distinct)).astype(np.int64)]


def _rows(columns: list[np.ndarray]) -> pa.RecordBatch:
    names = [f"w{j}" for j in range(1, len(columns))] + ["a"]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def phrase_rows(length: int) -> str:
    return ", ".join([*(f"w{j} long" for j in range(1, length + 1)), "a long"])


def pairs(bits: np.ndarray):
    """Counts of the pairs whose words are both in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, codes, fresh in chunk_arrays(batch):
                often = in_bitmap(bits, keys)[codes]
                at = np.flatnonzero(often[:-1] & often[1:] & ~fresh[1:])
                if len(at):
                    yield _rows(counted(keys, codes, at, 2))

    return run


class PhraseSet:
    """Phrases of one length, each with a state as the beginning and one as the
    end of a longer phrase: 0 no matter, 1 to be counted now, 2 counted before."""

    def __init__(self, columns: list[np.ndarray], begins: np.ndarray, ends: np.ndarray):
        self.length = len(columns)
        self.words = np.unique(np.concatenate(columns))
        own = [np.searchsorted(self.words, c) for c in columns]
        ids, self.levels = own[0].astype(np.int64), []
        for c in own[1:]:
            together = ids * len(self.words) + c
            self.levels.append(np.unique(together))
            ids = np.searchsorted(self.levels[-1], together)
        self.begins, self.ends = np.zeros(len(ids), np.int8), np.zeros(len(ids), np.int8)
        self.begins[ids], self.ends[ids] = begins, ends

    def find(self, keys: np.ndarray, codes: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where its phrases begin, and which they are."""
        near = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
        known = np.where(self.words[near] == keys, near, -1)[codes]
        at = np.flatnonzero(known[: len(known) - self.length + 1] >= 0) if len(known) >= self.length else np.zeros(0, np.int64)
        ids = known[at]
        for j, level in enumerate(self.levels, 1):
            ok = (known[at + j] >= 0) & ~fresh[at + j]
            at, ids = at[ok], ids[ok]
            together = ids * len(self.words) + known[at + j]
            ids = np.minimum(np.searchsorted(level, together), len(level) - 1)
            ok = level[ids] == together
            at, ids = at[ok], ids[ok]
        return at, ids


def longer_phrases(wanted: PhraseSet):
    """Counts of the phrases one word longer that begin or end with a wanted
    phrase of state 1, unless their beginning or end has state 2."""
    m = wanted.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, codes, fresh in chunk_arrays(batch):
                if len(codes) <= m:
                    continue
                at, ids = wanted.find(keys, codes, fresh)
                state = np.zeros(len(codes) + 1, np.int8)
                state[at] = wanted.begins[ids]
                state[at - 1] = np.maximum(state[at - 1], wanted.ends[ids])  # what is before the first word falls on the last place
                state = state[: len(codes) - m]
                for j in range(1, m + 1):
                    state = np.where(fresh[j : len(codes) - m + j], 0, state)
                at = np.flatnonzero(state == 1)
                if len(at):
                    yield _rows(counted(keys, codes, at, m + 1))

    return run


def same_phrases(wanted: PhraseSet):
    """Counts of the wanted phrases themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, codes, fresh in chunk_arrays(batch):
                at, _ = wanted.find(keys, codes, fresh)
                if len(at):
                    yield _rows(counted(keys, codes, at, wanted.length))

    return run

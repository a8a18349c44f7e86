"""Words of many texts at once as 64-bit keys, in numpy.

A word's key is a polynomial hash of its UTF-8 bytes (each byte through a table
of random 64-bit odd numbers), taken from one running sum over the batch, so no
Python string is made per word. The keys depend on the word only: the table is
drawn from a fixed seed. Two of n different words share a key with probability
about n²/2^65 (for ten million words: three in a million).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .common import SPACES

_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in SPACES]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_TABLE = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64

#: Longest stretch of bytes hashed at once (bounds the 64-bit work arrays).
CHUNK_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit keys (a bijection with well-spread bits)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def combine(a, b) -> np.ndarray:
    """Key of the pair (a, b); not symmetric."""
    return mix(np.asarray(a, np.uint64) * _U(0xD6E8FEB86659FD93) + np.asarray(b, np.uint64) + _U(0x632BE59BD9B4E019))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


_UP, _DOWN = _powers(CHUNK_BYTES + 1)


def _cuts(space: np.ndarray) -> list[int]:
    """Cut points at spaces, at most CHUNK_BYTES apart (a longer word is one
    chunk of its own)."""
    at, cuts, n = 0, [0], len(space)
    while n - at > CHUNK_BYTES:
        inside = np.flatnonzero(space[at : at + CHUNK_BYTES])
        if len(inside):
            at += int(inside[-1]) + 1
        else:
            after = np.flatnonzero(space[at + CHUNK_BYTES :])
            at = at + CHUNK_BYTES + int(after[0]) + 1 if len(after) else n
        cuts.append(at)
    if cuts[-1] < n:
        cuts.append(n)
    return cuts


@dataclass
class Words:
    """keys: one per word, in order. first: for each text the index of its
    first word, and one more for the end."""

    keys: np.ndarray
    first: np.ndarray

    def of(self, i: int) -> np.ndarray:
        return self.keys[self.first[i] : self.first[i + 1]]


def words(texts, lower: bool = True) -> Words:
    """Words of each text (None: no words); ``lower`` folds A-Z."""
    raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    bounds = np.concatenate(([0], np.cumsum([len(b) + 1 for b in raw]))).astype(np.int64)
    buffer = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    if lower:
        buffer = _LOWER[buffer]
    space = _SPACE[buffer]
    keys, starts = [], []
    cuts = _cuts(space)
    for a, b in zip(cuts, cuts[1:]):
        s = space[a:b]
        start = np.flatnonzero(~s & np.concatenate(([True], s[:-1])))
        end = np.flatnonzero(~s & np.concatenate((s[1:], [True]))) + 1
        up, down = (_UP, _DOWN) if b - a < len(_UP) else _powers(b - a + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[buffer[a:b]] * up[: b - a])))
        h = (total[end] - total[start]) * down[start]
        keys.append(mix(h + (end - start).astype(np.uint64)))
        starts.append(start + a)
    keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return Words(keys, np.searchsorted(starts, bounds).astype(np.int64))

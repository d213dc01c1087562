"""Sets of word shingles as sorted 64-bit hashes, and their MinHash signatures."""

from __future__ import annotations

import hashlib

import numpy as np
from xxhash import xxh3_64_intdigest

# Fixed odd multipliers, drawn once from a seeded generator; a shingle's hash mixes its words with them.
_DRAW = np.random.Generator(np.random.PCG64(20240531))
_WORD = _DRAW.integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
# Shingles whose permuted hashes are compared at once.
_STEP = 1024


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; bytes above ASCII are left as they are."""
    return text.lower().split()


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of ``size`` consecutive words; fewer words are one shingle, none are no shingle."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    length = min(size, len(words))
    total = np.full(len(words) - length + 1, length, np.uint64)
    for k in range(length):
        total += hashes[k : k + len(total)] * _WORD[k]
    return np.unique(_mixed(total))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``; different inputs stay different."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Signer:
    """Signatures of ``length`` coordinates: the least permuted hash of a set under each permutation."""

    def __init__(self, length: int):
        draw = np.random.Generator(np.random.PCG64(length))
        self.factor = (draw.integers(0, 2**63, length, np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
        self.term = draw.integers(0, 2**64, length, np.uint64, endpoint=False)[:, None]

    def sign(self, shingles: np.ndarray) -> np.ndarray:
        least = None
        for start in range(0, len(shingles), _STEP):
            part = (shingles[None, start : start + _STEP] * self.factor + self.term).min(axis=1)
            least = part if least is None else np.minimum(least, part)
        return least


def digest(shingles: np.ndarray) -> bytes:
    """128 bits of a set."""
    return hashlib.md5(shingles.tobytes(), usedforsecurity=False).digest()

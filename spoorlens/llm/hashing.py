"""Hashed word n-grams of a text, in whole arrays."""

from __future__ import annotations

import string

import numpy as np
import xxhash

# Letters are lower-cased before; ASCII punctuation ends a word.
_TABLE = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
_MIX = np.uint64(0x9E3779B97F4A7C15)


class WordIds(dict):
    """Word to a 64-bit number. Emptied when it has grown large; numbers stay the same."""

    MOST = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 0)
        return value


def tokens(text: str) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_TABLE).split()


def combine(parts: list[np.ndarray], kind: int) -> np.ndarray:
    """One number per row of several arrays; ``kind`` keeps sorts of features apart."""
    mixed = np.full(len(parts[0]), kind + 1, np.uint64)
    with np.errstate(over="ignore"):
        for part in parts:
            mixed = (mixed ^ part) * _MIX
            mixed ^= mixed >> np.uint64(29)
    return mixed


def buckets(values: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((values * _MIX) >> np.uint64(64 - bits)).astype(np.int64)


def ngrams(ids: np.ndarray, longest: int, skip: bool = False) -> list[np.ndarray]:
    """Numbers of the 1-grams to ``longest``-grams, each from its first word on, and of
    pairs with one word between them."""
    out = [combine([ids[i:len(ids) - n + 1 + i] for i in range(n)], n) for n in range(1, longest + 1) if len(ids) >= n]
    if skip and len(ids) >= 3:
        out.append(combine([ids[:-2], ids[2:]], 100))
    return out

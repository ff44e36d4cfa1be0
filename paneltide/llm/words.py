"""Vectorised word hashing for the operators that work on word shingles.

A word is a maximal run of word characters (letters, digits, underscore), lower-cased.
All texts of an Arrow batch are laid end to end as code points; one table lookup folds each
code point, and prefix sums of a polynomial hash give every word's 64-bit hash without a
Python loop over words.
"""

from __future__ import annotations

import sys
from functools import lru_cache
from typing import NamedTuple

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SEPARATOR = 32


class Words(NamedTuple):
    """Word hashes of all texts in order; ``first[i]:first[i + 1]`` are those of text i.
    ``start`` and ``end`` are code-point offsets within the own text."""

    hashes: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (two xor-shift-multiply rounds)."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _BASE
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=None)
def fold_table() -> np.ndarray:
    """Code point -> lower-cased code point, 0 where it is no word character.

    A letter whose lower case is longer than one character keeps its own code point."""
    table = np.zeros(sys.maxunicode + 1, dtype=np.uint32)
    for cp in range(sys.maxunicode + 1):
        c = chr(cp)
        if c.isalnum() or c == "_":
            low = c.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table


@lru_cache(maxsize=None)
def letter_table() -> np.ndarray:
    """As ``fold_table``, for letters alone; every other code point becomes a space."""
    table = np.full(sys.maxunicode + 1, _SEPARATOR, dtype=np.uint32)
    for cp in range(sys.maxunicode + 1):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            table[cp] = ord(low) if len(low) == 1 else cp
    return table


def code_points(texts) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, each followed by one space; where each text starts)."""
    parts = [("" if t is None else t) + " " for t in texts]
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    flat = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return flat, np.concatenate(([0], np.cumsum(lengths)))


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        factors = np.empty(size, np.uint64)
        with np.errstate(over="ignore"):
            _powers.clear()
            for b in (_BASE, inverse):
                factors[0], factors[1:] = 1, b
                _powers.append(np.cumprod(factors, dtype=np.uint64))
    return _powers[0], _powers[1]


def hash_words(texts) -> Words:
    """Words of the texts; a null text has none."""
    flat, begins = code_points(texts)
    folded = fold_table()[flat]
    inside = folded != 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    start, end = edge[0::2], edge[1::2]
    power, inverse = _power_tables(len(flat) + 1)
    with np.errstate(over="ignore"):
        terms = mix(folded) * power[: len(flat)]
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
        hashes = mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))
    first = np.searchsorted(start, begins)
    own = begins[np.searchsorted(begins, start, side="right") - 1]
    return Words(hashes, first, start - own, end - own)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for j in range(size):
            out = out * _BASE + hashes[j : j + n]
        return mix(out)

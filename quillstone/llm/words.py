"""Words and shingles of whole texts as 64-bit numbers, a slice of an Arrow batch at a time.

A word is a run of bytes outside 0x20 and 0x09-0x0D, with A-Z lower-cased. Its number is a polynomial over its bytes (mod 2**64),
read off one running sum over the slice and then mixed, so no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
#: Bytes of text worked on at a time; a longer text makes a slice of its own, and one of more than CUT bytes is worked on in parts.
SLICE, CUT = 1 << 19, 1 << 22
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_power = np.ones(1, U)
_inverse = np.ones(1, U)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _power, _inverse
    if len(_power) < n:
        n = max(n, SLICE + 1024)
        with np.errstate(over="ignore"):
            up, down = np.full(n, _BASE, U), np.full(n, pow(_BASE, -1, 1 << 64), U)
            up[0] = down[0] = 1
            _power, _inverse = np.cumprod(up), np.cumprod(down)
    return _power, _inverse


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, where each text starts and the last ends); null texts are empty."""
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    n = len(texts)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + SLICE, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


class Words:
    """The words of a slice: numbers, byte bounds, and the row of each (from 0 in the slice)."""

    def __init__(self, data: np.ndarray, at: np.ndarray, prefixes: tuple[int, ...] = ()):
        n, rows = len(data), len(at) - 1
        word = ~_SPACE[data]
        first = np.zeros(n + 1, bool)
        first[at] = True  # a text ends a word
        before = np.concatenate([[False], word])[:-1] if n else word
        after = np.concatenate([word, [False]])[1:] if n else word
        self.start = np.flatnonzero(word & (~before | first[:-1]))
        self.end = np.flatnonzero(word & (~after | first[1:])) + 1
        self.row = np.searchsorted(at, self.start, "right") - 1
        self.count = np.bincount(self.row, minlength=rows) if rows else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        power, self._inverse = _powers(n + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, U)
            np.cumsum((_LOWER[data].astype(U) + U(1)) * power[:n], out=sums[1:])
            self._sums = sums
            self.hash = self.upto(self.end)

    def upto(self, end: np.ndarray) -> np.ndarray:
        """Numbers of what lies between each word's start and end."""
        with np.errstate(over="ignore"):
            return mix((self._sums[end] - self._sums[self.start]) * self._inverse[self.start] + (end - self.start).astype(U) * U(0xD6E8FEB86659FD93))


def parts(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of a huge text's parts, each of about CUT bytes and, but for the last, ended by white space; so no word is cut."""
    lo, n = 0, len(data)
    while lo < n:
        hi = min(lo + CUT, n)
        if hi < n:
            blank = np.flatnonzero(_SPACE[data[lo:hi]])
            if len(blank):
                hi = lo + int(blank[-1]) + 1
            else:  # a word of more than CUT bytes stays whole
                while hi < n and not len(blank := np.flatnonzero(_SPACE[data[hi : hi + CUT]])):
                    hi = min(hi + CUT, n)
                hi = hi + int(blank[0]) + 1 if hi < n else n
        yield lo, hi
        lo = hi


def is_huge(data: np.ndarray, at: np.ndarray) -> bool:
    """Whether a slice is one text that is to be worked on in parts."""
    return len(at) == 2 and len(data) > CUT


@dataclass
class Hashed:
    """What of Words shingles need."""

    hash: np.ndarray
    count: np.ndarray
    first: np.ndarray


def hashed(data: np.ndarray, at: np.ndarray) -> Words | Hashed:
    """The words' numbers of a slice, in little memory even for a huge text."""
    if not is_huge(data, at):
        return Words(data, at)
    found = np.concatenate([Words(data[a:b], np.array([0, b - a])).hash for a, b in parts(data)])
    return Hashed(found, np.array([len(found)]), np.array([0, len(found)]))


def shingles(w: Words | Hashed, k: int = 5) -> Iterator[np.ndarray]:
    """For each row the sorted distinct numbers of its k-word shingles; fewer words make one shingle, none makes none."""
    with np.errstate(over="ignore"):
        m, factor = len(w.hash), [U(pow(0xC2B2AE3D27D4EB4F, i + 1, 1 << 64)) for i in range(k)]
        whole = np.zeros(max(0, m - k + 1), U)
        for i in range(k):
            whole += w.hash[i : i + len(whole)] * factor[i]
        whole = mix(whole)
        for r in range(len(w.count)):
            n, at = int(w.count[r]), int(w.first[r])
            if n >= k:
                yield np.unique(whole[at : at + n - k + 1])
            elif n:
                yield mix(np.array([sum(int(h) * int(f) for h, f in zip(w.hash[at : at + n], factor, strict=False)) + n & (1 << 64) - 1], U))
            else:
                yield np.zeros(0, U)

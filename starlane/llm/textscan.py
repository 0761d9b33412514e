"""Vectorised scanning of UTF-8 texts: words, word hashes, window hashes.

A chunk of texts is joined into one byte array (a newline after each text)
and scanned with numpy, so the cost per word is a few array operations and no
Python object is made per word.  Hashes are 64-bit: a polynomial over the
bytes (odd random base, modulo 2**64) followed by a mixing step.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))

# Byte classes.  Bytes of 0x80 and above belong to words in both.
SPACED = np.ones(256, dtype=bool)          # words [^\x20\x09-\x0D]+
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)          # words [0-9a-z and non-ASCII]+
ALNUM[0x80:] = True
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
LOWER = np.arange(256, dtype=np.uint8)     # lower-cases A-Z only
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche a uint64 array (multiply and xor-shift rounds)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


_POWERS: dict[str, np.ndarray] = {}


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        step[0] = 1
        have = _POWERS[name] = np.cumprod(step, dtype=np.uint64)
    return have[:n]


def span_hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``units[start:end]`` for every span (uint8 or uint32 units)."""
    prefix = np.zeros(len(units) + 1, dtype=np.uint64)
    np.cumsum((units.astype(np.uint64) + np.uint64(1)) * _powers("up", _BASE, len(units)), out=prefix[1:])
    inverse = _powers("down", _BASE_INV, len(units) + 1)
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


class Scan:
    """Words of a chunk of texts.

    ``doc`` is the text index of each word, ``first``/``count`` the first
    word and number of words of each text.
    """

    def __init__(self, texts: list[bytes], word_bytes: np.ndarray, lower: bool = False):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        self.raw = raw
        self.bytes = LOWER[raw] if lower else raw
        sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.begin = np.zeros(len(texts), dtype=np.int64)
        np.cumsum(sizes[:-1] + 1, out=self.begin[1:])
        self.end = self.begin + sizes
        inside = word_bytes[self.bytes].copy()
        inside[self.end] = False
        self.inside = inside
        edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
        self.starts = np.flatnonzero(edge == 1)
        self.ends = np.flatnonzero(edge == -1)
        self.doc = np.searchsorted(self.begin, self.starts, side="right") - 1
        self.count = np.bincount(self.doc, minlength=len(texts)).astype(np.int64)
        self.first = np.cumsum(self.count) - self.count
        self._hashes = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = span_hashes(self.bytes, self.starts, self.ends)
        return self._hashes

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of ``n`` words inside one text."""
        m = len(self.starts) - n + 1
        if m <= 0:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        at = np.flatnonzero(self.doc[:m] == self.doc[n - 1:])
        return at, window_hashes(self.hashes, n)[at]

    def per_text(self, values: np.ndarray, doc: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=values, minlength=len(self.begin)).astype(np.int64)


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Order-dependent hash of every ``n`` consecutive word hashes."""
    m = len(hashes) - n + 1
    total = np.zeros(max(m, 0), dtype=np.uint64)
    if m <= 0:
        return total
    for k in range(n):
        total = (total + hashes[k:k + m]) * np.uint64(0xA0761D6478BD642F)
    return mix(total + np.uint64(n))


def in_sorted(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Membership of ``values`` in a sorted array."""
    if not len(table):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return table[at] == values


def sorted_distinct(doc: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, value) pairs, sorted by doc then value."""
    order = np.lexsort((values, doc))
    doc, values = doc[order], values[order]
    keep = np.ones(len(doc), dtype=bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])
    return doc[keep], values[keep]

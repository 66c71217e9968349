"""Words of whole texts, and their 64-bit hashes, by array operations over UTF-8 bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tidelog.llm._shared import offsets, text_bytes

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _separators(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for a, b in ranges:
        table[a : b + 1] = True
    return table


#: Of words `[^\x20\x09-\x0D]+` and `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, after A-Z are lower-cased.
SPACES = _separators((0x20, 0x20), (0x09, 0x0D))
NOT_ALNUM = _separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

_BASE = 0x9E3779B97F4A7C15
_U = np.uint64
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and its inverse, modulo 2 ** 64, for i up to n."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, (1 << 18) + (1 << 16))
        _powers[:] = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, base, _U)
            p[0] = 1
            _powers.append(np.multiply.accumulate(p))
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits after which all bits depend on all (splitmix64's finaliser)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


@dataclass
class Words:
    data: np.ndarray  #: lower-cased bytes
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray  #: index of a word's text
    count: np.ndarray  #: words of each text
    first: np.ndarray  #: index of each text's first word, and their number


def words(column: pa.Array, separators: np.ndarray, fold: bool = True) -> Words:
    """fold: lower-case A-Z first."""
    off = offsets(column) - offsets(column)[0]
    data = _LOWER[text_bytes(column)] if fold else text_bytes(column)
    inside = ~separators[data]
    begin, last = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = off[1:] > off[:-1]
    begin[off[:-1][full]] = inside[off[:-1][full]]
    last[off[1:][full] - 1] = inside[off[1:][full] - 1]
    start, end = np.flatnonzero(begin), np.flatnonzero(last) + 1
    up, down = powers(len(data))
    value = data.astype(_U)
    value += _U(1)
    value *= up[: len(data)]
    total = np.zeros(len(data) + 1, _U)
    np.cumsum(value, out=total[1:])
    hashed = mix((total[end] - total[start]) * down[start])
    doc = np.searchsorted(off[:-1], start, "right") - 1
    count = np.bincount(doc, minlength=len(column)).astype(np.int64)
    return Words(data, start, end, hashed, doc, count, np.concatenate(([0], np.cumsum(count))))


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of k consecutive words, sorted in each text, and where each text's begin. A text of fewer words, but not none, has its whole sequence as one."""
    n = len(w.hash)
    rolled = np.zeros(n, _U)
    for j in range(k):
        rolled[: n - j] = rolled[: n - j] * _U(0xD6E8FEB86659FD93) + w.hash[j:] if j else w.hash
    rolled = mix(rolled)
    parts, size = [], np.zeros(len(w.count), np.int64)
    for i, (a, c) in enumerate(zip(w.first[:-1].tolist(), w.count.tolist(), strict=True)):
        if c >= k:
            found = np.unique(rolled[a : a + c - k + 1])
        elif c:
            whole = 0
            for h in w.hash[a : a + c].tolist():
                whole = (whole * 0xD6E8FEB86659FD93 + h) & ((1 << 64) - 1)
            found = mix(np.array([whole ^ (c << 56)], _U))
        else:
            continue
        parts.append(found)
        size[i] = len(found)
    return np.concatenate(parts) if parts else np.zeros(0, _U), np.concatenate(([0], np.cumsum(size)))

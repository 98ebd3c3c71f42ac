"""Vectorised word scanning and hashing over Arrow text buffers.

Everything works on slices of about ``SLICE_BYTES`` bytes, so a worker's memory does not depend on the
batch that Spark hands over; a single longer text makes a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2**64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit values (splitmix64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=_U)
    if n > 1:
        out[1:] = _U(base & (2**64 - 1))
        np.multiply.accumulate(out, out=out)
    return out


_POW: dict[str, np.ndarray] = {}


def _pow_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POW or len(_POW["p"]) < n:
        size = SLICE_BYTES + 1 if n <= SLICE_BYTES + 1 else n + n // 2  # a slice's bytes; beyond, a single long text
        _POW["p"] = _powers(_BASE, size)
        _POW["q"] = _powers(pow(_BASE, -1, 2**64), size)
    return _POW["p"], _POW["q"]


_BYTE = mix64(np.arange(1, 257, dtype=_U) * _MULT)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of consecutive rows of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("") if texts.null_count else texts
    n = len(texts)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    off = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, side="right")) - 1)
        b = min(b, n)
        yield a, b, raw[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def scan(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each maximal run of bytes other than ASCII white space, within its row."""
    if not len(raw):
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    word = ~_SPACE[raw]
    inner = off[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(off, start, side="right") - 1


def hash_words(raw: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word; with ``lower``, A-Z count as a-z."""
    if not len(start):
        return np.zeros(0, dtype=_U)
    p, q = _pow_tables(len(raw) + 1)
    total = np.zeros(len(raw) + 1, dtype=_U)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[raw] * p[: len(raw)], out=total[1:])
    return mix64((total[end] - total[start]) * q[start] + (end - start).astype(_U) * _MULT)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of k consecutive values (len(words) - k + 1 of them, or none)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    out = words[:n].copy()
    for t in range(1, k):
        out *= _MULT
        out ^= out >> _U(29)
        out += words[t : t + n]
    return mix64(out)


def sliding_argmin(x: np.ndarray, w: int) -> np.ndarray:
    """Index of the smallest of each w consecutive values, the leftmost on ties."""
    n = len(x) - w + 1
    best = np.arange(n)
    val = x[:n].copy()
    for t in range(1, w):
        y = x[t : t + n]
        less = y < val
        val[less] = y[less]
        best[less] = np.flatnonzero(less) + t
    return best


def take_rows(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indexes of the ranges start .. start + size, one range after the other."""
    if not len(size):
        return np.zeros(0, dtype=np.int64)
    size = size.astype(np.int64)
    return np.repeat(start - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(int(size.sum()))

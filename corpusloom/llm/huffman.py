"""Canonical, length-limited Huffman codes over integer ids, coded and decoded with arrays.

A block is a run of ``BLOCK`` ids. The bit at which each block begins is kept, so blocks decode independently of each
other: here all blocks of a segment advance together, one id each a step, through one table look-up.
"""

from __future__ import annotations

import heapq

import numpy as np

#: Longest code, and so the logarithm of the decoding table's size.
LIMIT = 20
#: Ids between two bit-offset checkpoints.
BLOCK = 512


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for ids that occur (package-merge); 0 for the others."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), dtype=np.uint8)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids don't fit codes of {limit} bits")
    if len(used) == 1:
        out[used] = 1
        return out
    if len(used) == 0:
        return out
    used = used[np.argsort(counts[used], kind="stable")]
    weight = counts[used].astype(np.int64)
    free = _tree_lengths(weight)
    if free.max() <= limit:
        out[used] = free
        return out
    # package-merge: each level keeps how many of its cheapest entries are packages
    level, is_pack = weight, [np.zeros(len(weight), dtype=bool)]
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.r_[weight, pairs]
        order = np.argsort(both, kind="stable")
        level = both[order]
        is_pack.append(order >= len(weight))
    length = np.zeros(len(weight), dtype=np.int64)
    n = 2 * len(weight) - 2
    for packs in reversed(is_pack):
        m = int(packs[:n].sum())
        length[: n - m] += 1
        n = 2 * m
    out[used] = length
    return out


def _tree_lengths(weight: np.ndarray) -> np.ndarray:
    """Unlimited Huffman code lengths of ascending weights."""
    n = len(weight)
    parent = np.zeros(2 * n - 1, dtype=np.int64)
    heap = [(int(w), i) for i, w in enumerate(weight)]
    heapq.heapify(heap)
    for made in range(n, 2 * n - 1):
        a, i = heapq.heappop(heap)
        b, j = heapq.heappop(heap)
        parent[i] = parent[j] = made
        heapq.heappush(heap, (a + b, made))
    depth = np.zeros(2 * n - 1, dtype=np.int64)
    for i in range(2 * n - 3, -1, -1):
        depth[i] = depth[parent[i]] + 1
    return depth[:n]


class Codebook:
    """Codes that follow from the lengths alone: by length, then by id."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(lengths)
        used = used[np.lexsort((used, lengths[used]))]
        self.codes = np.zeros(len(lengths), dtype=np.uint64)
        self.limit = int(lengths.max()) if len(used) else 1
        span = (1 << (self.limit - self.lengths[used])).astype(np.int64)
        start = np.r_[0, np.cumsum(span)[:-1]] if len(used) else span
        self.codes[used] = (start >> (self.limit - self.lengths[used])).astype(np.uint64)
        self.table = np.zeros(1 << self.limit, dtype=np.uint32)
        filled = np.repeat(used, span)
        self.table[: len(filled)] = filled
        self.step = self.lengths[self.table]

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, bytes]:
        """(bit at which each block begins, coded bits)."""
        size = self.lengths[ids]
        if len(ids) and not size.all():
            raise ValueError("an id without a code")
        end = np.cumsum(size)
        at = end - size
        total = int(end[-1]) if len(ids) else 0
        out = np.zeros(total // 8 + 8, dtype=np.uint8)
        for a in range(0, len(ids), 1 << 17):
            b = min(len(ids), a + (1 << 17))
            byte = at[a:b] >> 3
            word = self.codes[ids[a:b]] << (np.uint64(32) - (at[a:b] & 7).astype(np.uint64) - size[a:b].astype(np.uint64))
            low = int(byte[0])
            n = int(byte[-1]) - low + 4
            for k in range(4):  # codes don't overlap, so their bytes add up
                part = np.bincount(byte - low + k, weights=((word >> np.uint64(24 - 8 * k)) & np.uint64(255)).astype(np.float64), minlength=n)
                out[low : low + n] += part[:n].astype(np.uint8)
        return at[::BLOCK].astype(np.uint64), out[: (total + 7) // 8].tobytes()

    def decode(self, starts: np.ndarray, data: bytes, n: int) -> np.ndarray:
        """The n ids that ``encode`` coded."""
        raw = np.frombuffer(data + b"\0" * 8, dtype=np.uint8).astype(np.uint32)
        at = starts.astype(np.int64)
        out = np.zeros((BLOCK, len(at)), dtype=np.uint32)
        last = 8 * (len(raw) - 4)
        mask, keep = np.uint32((1 << self.limit) - 1), 32 - self.limit
        quad = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        for k in range(min(BLOCK, n)):
            window = (quad[at >> 3] >> (keep - (at & 7)).astype(np.uint32)) & mask
            out[k] = self.table[window]
            at = np.minimum(at + self.step[window], last)
        return out.T.reshape(-1)[:n]

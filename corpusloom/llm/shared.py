"""Which keys (hashes of text pieces) occur under more than one owner, without sending every key as a row.

The map side packs the keys of many owners into one binary row for each shard of the key space, 8 bytes a key
(48 bits of it, as a chance match only costs its reader a comparison), so the exchange is a fraction of exploded rows. A key that several owners of one pack hold is sent to its shard
once, with a mark; its other holders go, already known to be shared, to shards dealt by owner. A key that a
third of all owners hold therefore puts only one entry a pack into its shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import lean

#: Keys that a map task packs at a time; bounds its memory.
PACK = 1 << 19

_PACKED = "shard int, owners binary, holder binary, keys binary, ones int, known int"


def cut_keys(keys: np.ndarray) -> np.ndarray:
    """What ``shared_keys`` returns for these keys."""
    return (keys >> np.uint64(16)).astype(np.int64)


def _squeeze(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unsqueeze(data: pa.Buffer) -> np.ndarray:
    out = np.zeros((data.size // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


def _pack(shards: int, keys: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
    """keys and owner: aligned. Repeats of a key under one owner go. In a row come first the keys that one owner of the pack
    holds, then ``ones`` that several hold (with the first of them), then ``known`` other holders of such keys."""
    keys = keys >> np.uint64(16)
    order = np.lexsort((owner, keys))
    keys, owner = keys[order], owner[order]
    new_key = np.r_[True, keys[1:] != keys[:-1]]
    keep = new_key | np.r_[True, owner[1:] != owner[:-1]]
    keys, owner, new_key = keys[keep], owner[keep], new_key[keep]
    many = np.zeros(len(keys), dtype=bool)  # the first of several holders
    many[:-1] = new_key[:-1] & ~new_key[1:]
    mark = np.where(new_key, np.where(many, 1, 0), 2).astype(np.uint8)
    shard = np.where(new_key, keys, (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)) % np.uint64(shards)
    order = np.lexsort((mark, shard))
    keys, owner, mark, shard = keys[order], owner[order], mark[order], shard[order].astype(np.int64)
    at = np.searchsorted(shard, np.arange(shards + 1))
    out: list[list] = [[] for _ in range(6)]
    for s in range(shards):
        a, b = at[s], at[s + 1]
        if a < b:
            names, holder = np.unique(owner[a:b], return_inverse=True)
            for x, v in zip(out, (s, names.astype("<i8").tobytes(), holder.astype("<u2" if len(names) < 1 << 16 else "<u4").tobytes(), _squeeze(keys[a:b]), int((mark[a:b] == 1).sum()), int((mark[a:b] == 2).sum())), strict=True):
                x.append(v)
    kinds = (pa.int32(), *[pa.binary()] * 3, pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(out, kinds, strict=True)], names=["shard", "owners", "holder", "keys", "ones", "known"])


def shared_keys(rows: DataFrame, extract: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]], shards: int) -> DataFrame:
    """(owner long, key long) for each key that at least two owners hold.

    ``extract`` yields aligned (keys uint64, owner int64) arrays of a batch. Keys are returned as ``cut_keys`` has them.
    """

    def packed(batches):
        keys, owners, n = [], [], 0
        for batch in batches:
            for k, o in extract(batch):
                keys.append(k)
                owners.append(o)
                n += len(k)
                if n >= PACK:
                    yield _pack(shards, np.concatenate(keys), np.concatenate(owners))
                    keys, owners, n = [], [], 0
        if n:
            yield _pack(shards, np.concatenate(keys), np.concatenate(owners))

    def answer(keys, owner, mark):
        order = np.argsort(keys, kind="stable")
        keys, owner, mark = keys[order], owner[order], mark[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        low, high = np.minimum.reduceat(owner, first), np.maximum.reduceat(owner, first)
        hit = (low != high) | (np.maximum.reduceat(mark, first) > 0)
        hit = np.repeat(hit, np.diff(np.r_[first, len(keys)]))
        return keys[hit], owner[hit]

    def resolved(batches):
        keys, owners, marks = [], [], []

        def out(k, o):
            for a in range(0, len(k), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(o[a : a + 100_000]), pa.array(k[a : a + 100_000].astype(np.int64))], names=["owner", "key"])

        for batch in batches:
            for names, holder, key, ones, known in zip(*(batch.column(c) for c in ("owners", "holder", "keys", "ones", "known")), strict=True):
                k, names = _unsqueeze(key.as_buffer()), np.frombuffer(names.as_buffer(), dtype="<i8")
                o = names[np.frombuffer(holder.as_buffer(), dtype="<u2" if len(names) < 1 << 16 else "<u4")]
                n = len(k) - known.as_py()
                yield from out(k[n:], o[n:])
                keys.append(k[:n])
                owners.append(o[:n])
                marks.append((np.arange(n) >= n - ones.as_py()).astype(np.uint8))
        if keys and sum(map(len, keys)):
            yield from out(*answer(np.concatenate(keys), np.concatenate(owners), np.concatenate(marks)))

    return rows.mapInArrow(lean(packed), _PACKED).repartition(shards, F.col("shard")).select("owners", "holder", "keys", "ones", "known").mapInArrow(lean(resolved), "owner long, key long")


def shard_count(frame: DataFrame) -> int:
    """Shards of a key space: as many as Spark deals shuffles into."""
    return max(8, int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))

"""Exact nearest neighbours of a stated query set."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bytes of query vectors that tasks hold at a time.
BLOCK = 32 << 20
#: Queries and rows whose scores a task holds at a time.
TILE_QUERIES, TILE_ROWS = 256, 1024
#: Scores this much below a query's worst one so far can't round to it.
_SLACK = 1e-8
_FOUND = "query_id long, vec_id long, score double"


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Unit vectors."""
    values = np.array(column.flatten(), dtype=np.float64).reshape(len(column), -1)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


class _Best:
    """The ``k`` best rows so far of each query of a block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, groups: np.ndarray, k: int):
        self.ids, self.vectors, self.groups, self.k = ids, vectors, groups, k
        self.top_id, self.top = np.full((len(ids), k), np.iinfo(np.int64).max), np.full((len(ids), k), -np.inf)
        self.seen = 0

    def add(self, own: np.ndarray, vectors: np.ndarray, groups: np.ndarray) -> None:
        a = 0
        while a < len(own):
            b = min(a + max(32, min(self.seen, TILE_ROWS)), len(own))  # small at first: until there are bounds, all scores are sorted
            for q in range(0, len(self.ids), TILE_QUERIES):
                self._tile(slice(q, q + TILE_QUERIES), own[a:b], vectors[a:b], groups[a:b])
            self.seen += b - a
            a = b

    def _tile(self, part: slice, own: np.ndarray, vectors: np.ndarray, groups: np.ndarray) -> None:
        top, top_id = self.top[part], self.top_id[part]
        score = self.vectors[part] @ vectors.T
        at, row = np.nonzero((score >= top[:, -1:] - _SLACK) & (self.groups[part][:, None] != groups))
        value, ident = np.round(score[at, row], 9), own[row]
        better = (value > top[at, -1]) | ((value == top[at, -1]) & (ident < top_id[at, -1]))
        better &= ident != self.ids[part][at]
        if not better.any():
            return
        at, value, ident = at[better], value[better], ident[better]
        hit = np.unique(at)
        at = np.concatenate([np.repeat(hit, self.k), at])
        value, ident = np.concatenate([top[hit].ravel(), value]), np.concatenate([top_id[hit].ravel(), ident])
        order = np.lexsort((ident, -value, at))
        first = np.searchsorted(at[order], hit)[:, None] + np.arange(self.k)
        top[hit], top_id[hit] = value[order][first], ident[order][first]


def nearest(rows: DataFrame, queries: Column, k: int, id_col: str, vector_col: str, group_col: str) -> DataFrame:
    """(query_id, vec_id, score, rank): the ``k`` rows most alike by cosine, not of the query's own group.

    Ties at nine decimals go to the smaller id. Null vectors, zero vectors and those with null or non-finite parts take
    no part; a null group excludes nothing else than null groups. All vectors have one length. Queries go out in blocks
    of bounded size, a task scores them in tiles of bounded size, and hands on its ``k`` best of each query, so no pairs
    are shuffled.
    """
    spark = rows.sparkSession
    x = F.col("v")
    good = x.isNotNull() & (F.size(x) > 0) & ~F.exists(x, lambda y: y.isNull() | F.isnan(y) | (F.abs(y) == float("inf"))) & F.exists(x, lambda y: y != 0)
    able = rows.select(rows[id_col].cast("long").alias("i"), rows[vector_col].cast("array<double>").alias("v"), rows[group_col].cast("string").alias("g"), F.coalesce(queries, F.lit(False)).alias("q")).where(F.col("i").isNotNull() & good)
    asked = able.where("q").select("i", "v", "g")
    size = asked.agg(F.coalesce(F.sum(F.size("v")) * 8, F.lit(0)).alias("n")).first().n
    blocks = 1 + size // BLOCK
    every = spark.createDataFrame([], _FOUND)
    for b in range(blocks):
        got = asked.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == b).toArrow().combine_chunks()
        if not got.num_rows:
            continue
        groups = pc.dictionary_encode(got["g"].combine_chunks(), null_encoding="encode")
        shipped = spark.sparkContext.broadcast((np.array(got["i"]), _matrix(got["v"].combine_chunks()), np.array(groups.indices), groups.dictionary.to_pylist()))

        def best(batches, shipped=shipped):
            ids, vectors, groups, known = shipped.value
            found, code = _Best(ids, vectors, groups, k), {g: i for i, g in enumerate(known)}
            for batch in batches:
                own_groups = np.array([code.get(g, -1) for g in batch.column(2).to_pylist()], dtype=groups.dtype)
                found.add(np.array(batch.column(0)), _matrix(batch.column(1)), own_groups)
            kept = np.isfinite(found.top)
            yield pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(ids[:, None], kept.shape)[kept]), pa.array(found.top_id[kept]), pa.array(found.top[kept])], names=["query_id", "vec_id", "score"])

        every = every.unionByName(able.select("i", "v", "g").mapInArrow(best, _FOUND))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return every.withColumn("rank", rank).where(F.col("rank") <= k)

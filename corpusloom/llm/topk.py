"""Exact top-k by inner product, without random access (NRA).

Each block of candidates keeps one list a dimension, sorted by component. For a query the lists are read in step, from
the end that helps it most. A candidate seen in some lists has a lower bound (what it has so far, plus the worst that the
unread parts of the others can give) and an upper bound (plus the best). Reading stops when no candidate outside those
that can still be among the k, and none unseen, can reach the k-th lower bound; the few that are left are then resolved
exactly. Ties count as reaching, so equal scores are all resolved and the smaller id wins. A query takes the k-th score that it
has found to the next block of its task, so most later blocks end as soon as nothing in them can reach it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .frames import lean
from .workspace import written

K = 10
SCALE = 1024
#: Queries that one broadcast holds, whatever their number; all candidates are read once for each such block.
QUERY_BLOCK = 4096
#: Candidates whose lists are sorted and read together.
CANDIDATE_BLOCK = 4096


class SortedLists:
    """The lists of a block of candidates: integer vectors, in ascending order of id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.order = np.argsort(self.vectors, axis=0, kind="stable").T.copy()  # dimension, ascending
        self.sorted = np.take_along_axis(self.vectors.T, self.order, axis=1)
        self.most = np.maximum(np.abs(self.sorted[:, :1]), np.abs(self.sorted[:, -1:]))[:, 0].astype(np.float64)

    def search(self, query: np.ndarray, own: int, k: int, first_step: int = 256, floor: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores) of the k best other than those of id ``own``, ties to smaller ids; and entries read.

        Scores below ``floor`` may be left out. Scores that don't fit a long raise.
        """
        n, dims = self.vectors.shape
        used = np.flatnonzero(query)
        reach = float(self.most @ np.abs(query).astype(np.float64))
        if reach >= 2.0**63:
            raise OverflowError("inner products beyond 64 bits")
        if not len(used) or n <= 2 * k or reach >= 2.0**53:  # bounds are kept as doubles
            cand, read = np.arange(n), 0 if reach < 2.0**53 else n * len(used)
        else:
            cand, read = self._candidates(query, used, k + int((self.ids == own).sum()), first_step, -np.inf if floor is None else floor)
        cand = cand[self.ids[cand] != own]
        score = self.vectors[cand] @ query
        best = np.lexsort((self.ids[cand], -score))[:k]
        return self.ids[cand[best]], score[best], read

    def _candidates(self, query: np.ndarray, used: np.ndarray, k: int, step: int, floor: float) -> tuple[np.ndarray, int]:
        n = len(self.ids)
        q = query[used]
        up = q > 0
        ends = self.sorted[used]
        # the most and the least that an entry of each list can give, and the most that its unread entries can
        worst = np.where(up, ends[:, 0], ends[:, -1]) * q
        bound = np.where(up, ends[:, -1], ends[:, 0]) * q
        got = np.zeros(n, dtype=np.int64)
        unseen = np.ones((len(used), n))
        depth = np.zeros(len(used), dtype=np.int64)
        read = 0
        if bound.sum() < floor:
            return np.zeros(0, dtype=np.int64), read
        while True:
            # the lists with most left to lose are read further
            for d in np.argsort(worst - bound)[: max(8, len(used) // 3)]:
                a, b = depth[d], min(n, depth[d] + step)
                if a == b:
                    continue
                part = slice(n - b, n - a) if up[d] else slice(a, b)
                place = self.order[used[d], part]
                got[place] += ends[d, part] * q[d]
                unseen[d, place] = 0
                depth[d] = b
                read += b - a
                bound[d] = (ends[d, n - 1 - b] if up[d] else ends[d, b]) * q[d] if b < n else worst[d]
            lower, upper = np.stack([worst, bound]).astype(np.float64) @ unseen  # whole numbers below 2**53
            kth = max(floor, np.partition(got + lower, n - k)[n - k])
            left = np.flatnonzero(got + upper >= kth)
            # outsiders can't qualify: those left are the k, with ties, or none
            if len(left) <= k or (depth == n).all():
                return left, read
            step = min(n, step * 2)


def integers(vectors: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """(rows without null or non-finite components, floor(scale * x) of them). Rows of other lengths than the first's raise."""
    rows, out = [], []
    for i, v in enumerate(vectors):
        if not v.is_valid or v.values.null_count:
            continue
        x = np.floor(np.asarray(v.values, dtype=np.float64) * scale)
        if np.isfinite(np.asarray(v.values, dtype=np.float64)).all():
            if len(x) and np.abs(x).max() >= 2.0**63:
                raise OverflowError("components beyond 64 bits")
            rows.append(i)
            out.append(x.astype(np.int64))
    return np.array(rows, dtype=np.int64), np.stack(out) if out else np.zeros((0, 0), dtype=np.int64)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows for each query row, among all rows of other ids.

    Vectors that are null, or hold a null or non-finite component, and null ids take no part; an empty vector scores 0.
    Of rows that repeat an id, the candidates each count; of a query id with several vectors,
    the k best over all of them are given. Vectors of several lengths raise, and scores beyond a long. An empty table, or one
    without queries, gives no rows. Queries go out in blocks of bounded size; with several, each block's result is written to the
    shared folder before the next is sent. Other columns don't take part, whatever their names.
    """
    spark = vectors.sparkSession
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    queries = rows.where("q").select("id", "v").distinct()
    blocks = -(-queries.count() // query_block)
    found = []
    for b in range(max(1, blocks)):
        part = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b) if blocks > 1 else queries
        held = pa.Table.from_batches([pa.RecordBatch.from_pandas(part.toPandas())]) if blocks else None
        keep, grid = integers(held.column("v").combine_chunks(), scale) if held is not None else (np.zeros(0, dtype=np.int64), np.zeros((0, 0)))
        ids = np.asarray(held.column("id"))[keep] if held is not None else keep
        shipped = spark.sparkContext.broadcast((ids, grid))

        def run(batches, shipped=shipped):
            names, grid = shipped.value

            best = np.full((len(names), k), -np.inf)

            def search(ids, own):
                lists = SortedLists(ids, own)
                out = [[], [], []]
                for i, (name, query) in enumerate(zip(names, grid, strict=True)):
                    floor = best[i, 0]
                    got, score, _ = lists.search(query, name, k, floor=None if floor == -np.inf else int(floor))
                    best[i] = np.sort(np.r_[best[i], np.where(score < -(2**53), -np.inf, np.minimum(score, 2**53))])[-k:]
                    keep = score >= floor
                    got, score = got[keep], score[keep]
                    out[0].append(np.full(len(got), name))
                    out[1].append(got)
                    out[2].append(score)
                return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in out], names=["query_id", "vec_id", "score"])

            ids, own, n = [], [], 0
            for batch in batches:
                if not len(names):
                    continue
                keep, vectors = integers(batch.column(1), scale)
                if len(keep):
                    ids.append(np.asarray(batch.column(0))[keep])
                    own.append(vectors)
                    n += len(keep)
                if n >= CANDIDATE_BLOCK:
                    yield search(np.concatenate(ids), np.concatenate(own))
                    ids, own, n = [], [], 0
            if n:
                yield search(np.concatenate(ids), np.concatenate(own))

        got = rows.select("id", "v").mapInArrow(lean(run), "query_id long, vec_id long, score long")
        if blocks > 1:
            got = written(got, "top-k")
            shipped.unpersist()
        found.append(got)
    every = found[0]
    for other in found[1:]:
        every = every.union(other)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Nearest rows against brute force over several tiles, and the memory that scores take."""

import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from corpusloom.operators.nearest import nearest


def table(spark, n, step, copies=1):
    """n vectors of 8, each ``copies`` times, in five groups, of which one is null; every ``step``-th is a query."""
    draw = np.random.default_rng(3)
    v = np.repeat(draw.integers(-3, 4, (n // copies, 8)), copies, axis=0).astype(float)
    v[:, 0] += 10
    g = [None if x == 4 else f"g{x}" for x in draw.integers(0, 5, n)]
    ids = draw.permutation(n)
    rows = spark.createDataFrame([(int(i), x.tolist(), y) for i, x, y in zip(ids, v, g, strict=True)], "i long, v array<double>, g string")
    return rows, ids, v, g, F.col("i") % step == 0


def test_ties_groups_and_tiles(spark):
    rows, ids, v, g, asked = table(spark, 4000, 10, copies=4)
    got = {}
    for r in nearest(rows.repartition(3), asked, 6, "i", "v", "g").orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = {}
    for q in np.flatnonzero(ids % 10 == 0):
        score = np.round(unit @ unit[q], 9)
        able = [j for j in range(len(ids)) if g[j] != g[q] and j != q]
        want[int(ids[q])] = [(int(ids[j]), float(score[j])) for j in sorted(able, key=lambda j: (-score[j], ids[j]))[:6]]
    assert got == want and len(want) == 400


def test_few_rows(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0], "a"), (1, [1.0, 0.0], "b"), (2, [0.0, 1.0], "b"), (3, [1.0, 1.0], "a")], "i long, v array<double>, g string")
    assert [(r.query_id, r.vec_id, r.rank) for r in nearest(rows, F.col("i") == 0, 6, "i", "v", "g").orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 2)]


def test_scores_of_a_batch_are_not_held_at_once(spark, monkeypatch):
    """4,000 queries by 8,000 rows are 256 MB of scores."""
    rows, *_, asked = table(spark, 8000, 2)
    given, kind = [], type(rows)
    real = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, f, *a: given.append((self, f)) or real(self, f, *a))
    nearest(rows, asked, 6, "i", "v", "g")
    (frame, best), = given
    batches = frame.toArrow().combine_chunks().to_batches()
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in best(batches)) == 4000 * 6
        assert tracemalloc.get_traced_memory()[1] < 64 << 20
    finally:
        tracemalloc.stop()

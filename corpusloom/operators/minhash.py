"""Greedy MinHash deduplication."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cut import cut

PRIME = (1 << 61) - 1
WIDEST = (1 << 32) - 1


def bands_for(threshold: float, permutations: int) -> tuple[int, int]:
    """(bands, rows in each) with the least sum of wrong hits below the threshold and misses above it."""
    s = (np.arange(1000) + 0.5) / 1000
    low, best = s < threshold, (np.inf, 0, 0)
    for b in range(1, permutations + 1):
        for r in range(1, permutations // b + 1):
            hit = 1 - (1 - s**r) ** b
            best = min(best, (float(hit[low].sum() + (1 - hit)[~low].sum()), b, r))
    return best[1:]


def signatures(texts: list[str], permutations: int, seed: int = 1) -> np.ndarray:
    """A row for each text: the least value of its lower-cased words under each permutation."""
    draw = np.random.RandomState(seed)
    a, b = (np.array([[int(x)] for x in draw.randint(low, 1 << 28, permutations)], dtype=np.uint64) for low in (1, 0))
    out = np.full((len(texts), permutations), WIDEST, dtype=np.uint64)
    for i, text in enumerate(texts):
        words = list(set(text.lower().split()))
        for at in range(0, len(words), 4096):
            h = np.array([zlib.crc32(w.encode("utf-8", "replace")) for w in words[at : at + 4096]], dtype=np.uint64)
            out[i] = np.minimum(out[i], ((a * h + b) % np.uint64(PRIME) & np.uint64(WIDEST)).min(axis=1))
    return out


def minhash_dedup(rows: DataFrame, id_col: str, text_col: str, threshold: float = 0.85, permutations: int = 128) -> DataFrame:
    """The rows that stay when, in ascending order of id, a row goes if it shares a band with one that stays.

    Candidates aren't verified. Null counts as the empty text, and empty texts share every band. Ids are whole and not
    null; of rows with one id all stay or go. Rows of equal signatures collapse to their first. Then, each
    round, a row that is first in all its bands stays and takes the others of its bands out; rounds are as many as the
    longest chain of decisions that hang on each other.
    """
    bands, width = bands_for(threshold, permutations)

    def run(batches):
        for batch in batches:
            sign = signatures([t or "" for t in batch.column(1).to_pylist()], permutations)
            own = [x.tobytes() for x in sign.astype("<u4")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, type=pa.binary())], names=["id", "sign"])

    signed = rows.select(rows[id_col].cast("long").alias("id"), rows[text_col].alias("t")).mapInArrow(run, "id long, sign binary")
    first = signed.groupBy("sign").agg(F.min("id").alias("id"))
    part = F.array(*(F.xxhash64(F.lit(i), F.substring("sign", 4 * width * i + 1, 4 * width)) for i in range(bands)))
    left = cut(first.select("id", F.explode(part).alias("band")))
    stay = None
    while not left.isEmpty():
        lead = left.groupBy("band").agg(F.min("id").alias("lead"))
        new = left.join(lead, "band").groupBy("id").agg(F.bool_and(F.col("id") == F.col("lead")).alias("first")).where("first").select("id")
        new = cut(new)
        taken = left.join(new, "id", "left_semi").select("band").distinct()
        gone = left.join(taken, "band", "left_semi").select("id").distinct()
        left = cut(left.join(gone, "id", "left_anti"))
        stay = new if stay is None else stay.unionByName(new)
    return rows.limit(0) if stay is None else rows.join(stay.withColumnRenamed("id", "_stay"), rows[id_col].cast("long") == F.col("_stay"), "left_semi")

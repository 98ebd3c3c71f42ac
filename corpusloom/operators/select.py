"""Ranking, sampling and splitting. Draws order by a seeded hash, so they repeat anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ids import seeded
from .cut import cut


def numbered(rows: DataFrame, by: list[str], order: list[Column | str], place: str, count: str | None = None) -> DataFrame:
    """Rows with their place (from 1) in the order within each group of ``by``, nulls being a group, and the group's size as ``count``.

    Rows are dealt by ranges of (group, order), so a group that holds most rows, or all, is spread over many tasks. They are
    numbered where they lie, and a table of (range, group) says how many of a group lie in the ranges before. The dealt rows
    are written to the checkpoint folder: ranges are drawn from a sample, and a second draw could cut elsewhere. So give only
    the columns that are needed. Rows equal in group and order are numbered in any order.
    """
    groups = [F.col(x) for x in by]
    id_ = F.monotonically_increasing_id()
    dealt = cut(rows.repartitionByRange(*groups, *order).sortWithinPartitions(*groups, *order).withColumns({"_range": F.spark_partition_id(), "_at": id_}))
    names = [f"_g{i}" for i in range(len(by))]
    parts = dealt.groupBy(F.col("_range").alias("_r"), *(x.alias(n) for x, n in zip(groups, names, strict=True))).agg(F.min("_at").alias("_start"), F.count("*").alias("_n"))
    w = W.partitionBy(*names)
    before = F.coalesce(F.sum("_n").over(w.orderBy("_r").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("_r", *names, (before - F.col("_start") + 1).alias("_shift"), F.sum("_n").over(w).alias("_all"))
    on = F.col("_range") == F.col("_r")
    for x, n in zip(groups, names, strict=True):
        on &= x.eqNullSafe(F.col(n))
    extra = [F.col("_all").alias(count)] if count else []
    return dealt.join(parts, on).select(*rows.columns, (F.col("_at") + F.col("_shift")).alias(place), *extra)


def split_by_stratum(rows: DataFrame, stratum: str, key: str, ratio: float = 0.9, seed: int = 42, keep_one: bool = False) -> DataFrame:
    """Rows with ``split``: floor(n * ratio) of each stratum to train. keep_one: of two rows or more, one at least to validation."""
    n = F.col("_count")
    most = F.floor(n * ratio)
    most = F.when(n > 1, F.least(most, n - 1)).otherwise(most) if keep_one else most
    placed = numbered(rows, [stratum], [seeded(seed, F.col(key)), key], "_place", "_count")
    return placed.withColumn("split", F.when(F.col("_place") <= most, "train").otherwise("validation")).drop("_place", "_count")


def proportional_sample(rows: DataFrame, stratum: str, key: str, size: int, seed: int = 42) -> DataFrame:
    """Each stratum's share, at least 1, then the first ``size`` of all."""
    placed = numbered(rows, [stratum], [seeded(seed, F.col(key)), key], "_place", "_count").join(F.broadcast(rows.agg(F.count("*").alias("_total"))))  # one row
    share = F.greatest(F.lit(1), F.bround(F.col("_count") / F.col("_total") * size, 0))
    return placed.where(F.col("_place") <= share).orderBy(seeded(seed + 1, F.col(key)), key).limit(size).select(*rows.columns)


def stratified_draw(rows: DataFrame, score: list[Column], size: int, bins: int = 4) -> DataFrame:
    """Bins of equal index ranges over the rows in order of score; bins drawn in turn, best first."""
    whole = numbered(rows, [], score, "_place", "_count")
    binned = whole.withColumn("bin", F.floor((F.col("_place") - 1) * bins / F.col("_count"))).drop("_place", "_count")
    return numbered(binned, ["bin"], score[1:], "turn").orderBy("turn", "bin").limit(size).select(*rows.columns, "bin", "turn")


def round_robin(rows: DataFrame, bucket: list[str], key: str, size: int, seed: int = 42) -> DataFrame:
    """One row a bucket a round, buckets in order, rows of a bucket in a seeded order."""
    return numbered(rows, bucket, [seeded(seed, F.col(key)), key], "turn").orderBy("turn", *bucket).limit(size)


def holdout(rows: DataFrame, key: str, stratum: str, group: str, share: float = 0.1, seed: int = 42) -> DataFrame:
    """Rows with ``test``: max(1, floor(n * share)) of each stratum, but never the last row of a group.

    The first row of each group in seeded order is never drawn, so no group is emptied and no repair is needed.
    """
    order = [seeded(seed, F.col(key)), key]
    marked = numbered(rows, [group], order, "_place").withColumn("_free", F.col("_place") > 1).drop("_place")
    sizes = rows.groupBy(F.col(stratum).alias("_stratum")).agg(F.count("*").alias("_n"))
    placed = numbered(marked, [stratum, "_free"], order, "_place").join(sizes, F.col(stratum).eqNullSafe(F.col("_stratum")))
    test = F.col("_free") & (F.col("_place") <= F.greatest(F.lit(1), F.floor(F.col("_n") * share)))
    return placed.select(*rows.columns, test.alias("test"))


def density_score(span: Column, labels: Column, tokens: Column) -> Column:
    return F.when(tokens > 0, span * labels / F.when(tokens > 0, tokens) * 1000).otherwise(0.0)


def target_count(n: Column) -> Column:
    return F.when(n <= 100, n).otherwise(F.least(n, F.greatest(F.lit(100), F.floor(n * 0.25))))


def top_density(rows: DataFrame, density: Column, position: str, size: int) -> DataFrame:
    """The densest rows; ties in the order of their positions."""
    return rows.orderBy(density.desc(), position).limit(size)


def remainder_split(rows: DataFrame, stratum: str, key: str, share: float = 0.05, seed: int = 42) -> DataFrame:
    """What a holdout leaves, with ``split``: max(1, floor(n * share)) of each stratum to validation, the rest to train."""
    placed = numbered(rows, [stratum], [seeded(seed, F.col(key)), key], "_place", "_count")
    most = F.greatest(F.lit(1), F.floor(F.col("_count") * share))
    return placed.withColumn("split", F.when(F.col("_place") <= most, "validation").otherwise("train")).drop("_place", "_count")


def subsample(rows: DataFrame, key: str, size: int, seed: int = 42) -> DataFrame:
    """So many rows, the same wherever they are drawn."""
    return rows.orderBy(seeded(seed, F.col(key)), key).limit(size)

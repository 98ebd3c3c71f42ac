"""Keeping one row of many."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _one(rows: DataFrame, keys: list[Column], order: Column) -> DataFrame:
    """One row a key, by an aggregate that combines before the shuffle, so a hot key is no hot task."""
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    fields = F.struct(*(F.col(c) for c in rows.columns))
    best = rows.select(*named, fields.alias("_row"), order.alias("_pos")).groupBy(*(f"_k{i}" for i in range(len(keys)))).agg(F.min_by("_row", "_pos").alias("_row"))
    return best.select("_row.*")


def first_of(rows: DataFrame, key: Column, position: str) -> DataFrame:
    return _one(rows, [key], F.col(position))


def latest_of(rows: DataFrame, key: Column, position: str) -> DataFrame:
    """Log compaction: the last row of each key."""
    return _one(rows, [key], -F.col(position))


def surplus(rows: DataFrame, key: Column) -> DataFrame:
    """One row (duplicates): rows beyond the first of each key."""
    return rows.groupBy(key.alias("k")).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"))


def admit(rows: DataFrame, known: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Rows with ``reasons``, a list: empty (a key is null or empty), known, repeated (an earlier row was admitted); without any a row is admitted.

    Each key's first place is an aggregate, so a hot key is combined before it is shuffled. Rows equal in keys and position are all admitted.
    """
    names = [f"_a{i}" for i in range(len(keys))]
    own = [F.coalesce(F.col(k), F.lit("")).alias(a) for k, a in zip(keys, names, strict=True)]
    marked = rows.withColumns({a: c for a, c in zip(names, own, strict=True)}).join(known.select(*own).distinct().withColumn("_known", F.lit(True)), names, "left")
    empty, met = F.array_contains(F.array(*names), ""), F.col("_known").isNotNull()
    first = marked.where(~empty & ~met).groupBy(*names).agg(F.min(position).alias("_first"))
    reasons = F.array_compact(F.array(F.when(empty, "empty"), F.when(met, "known"), F.when(F.col(position) > F.col("_first"), "repeated")))
    return marked.join(first, names, "left").withColumn("reasons", reasons).drop(*names, "_known", "_first")


def first_n_per_slice(rows: DataFrame, slice_col: str, id_col: str, position: str, n: int = 12) -> DataFrame:
    """(slice, ids): each slice's first n distinct ids, in order."""
    first = rows.groupBy(slice_col, id_col).agg(F.min(position).alias("at"))
    ranked = first.withColumn("r", F.row_number().over(W.partitionBy(slice_col).orderBy("at", id_col))).where(F.col("r") <= n)
    return ranked.groupBy(slice_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("r", id_col))), lambda x: x[id_col]).alias("ids"))

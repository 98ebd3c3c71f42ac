"""Joins that keep one partner, fall back to another key, or must not miss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.text import or_empty, strip
from .dedup import _one


def must_match(left: DataFrame, right: DataFrame, keys: str | list[str], position: str) -> DataFrame:
    """Each left row with the first right row of its keys, strings stripped. A row without one, or with a null key, raises when it is read."""
    keys = [keys] if isinstance(keys, str) else keys
    kinds = {k: left.schema[k].dataType for k in keys}
    bare = {f"_m{i}": strip(F.col(k)) if kinds[k] == StringType() else F.col(k) for i, k in enumerate(keys)}
    solid = F.lit(True)
    for k in keys:
        solid &= F.col(k).isNotNull()
    # without null keys, and then without the right side's own spelling of them
    first = _one(right.where(solid).withColumns(bare), [F.col(x) for x in bare], F.col(position)).drop(*keys).withColumn("_hit", F.lit(True))
    joined = left.withColumns({x: F.when(solid, v) for x, v in bare.items()}).join(first, list(bare), "left")
    shown = F.concat_ws(", ", *(F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys))
    sure = F.when(F.col("_hit"), F.col(keys[0])).otherwise(F.raise_error(F.concat(F.lit("no match for "), shown)).cast(kinds[keys[0]]))
    return joined.withColumn(keys[0], sure).drop("_hit", *bare)


def accepted_pairs(pairs: Column, requested: Column, key: str = "key", question: str = "question") -> Column:
    """Of a batched answer's pairs, in order: those with a requested key not answered yet and a question not asked yet, once each.

    ``pairs`` are structs, ``requested`` keys. A dropped pair takes neither its key nor its question. Questions are equal if
    their letters, digits and underscores are, in lower case; empty ones repeat freely.
    """
    asked = lambda p: F.regexp_replace(F.lower(or_empty(p[question])), r"(?U)\W+", "")
    start = F.slice(pairs, 1, 0)

    def step(kept, p):
        again = (asked(p) != "") & F.exists(kept, lambda o: asked(o) == asked(p))
        fresh = F.array_contains(requested, p[key]) & ~F.exists(kept, lambda o: o[key] == p[key]) & ~again
        return F.when(fresh, F.concat(kept, F.array(p))).otherwise(kept)

    return F.aggregate(pairs, start, step)


def first_hit(rows: DataFrame, id_col: str, keys: list[Column], lookup: DataFrame, key: str, value: str, position: str) -> DataFrame:
    """(id, value, rank): what the first of ``keys`` that the lookup has gives, ranks from 1; both null without any.

    The lookup's first row of a key counts. Keys meet it in one shuffle, hits are reduced before the next.
    """
    asked = rows.select(id_col, F.posexplode(F.array(*keys)).alias("rank", key))
    known = lookup.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(value, position).alias(value))
    met = asked.join(known.withColumn("_hit", F.lit(True)), key, "left")
    rank = F.when(F.col("_hit"), F.col("rank") + 1)
    return met.groupBy(id_col).agg(F.min_by(value, rank).alias(value), F.min(rank).alias("rank"))


def matched_then_rest(rows: DataFrame, wanted: DataFrame, key: str, row_id: str, wanted_id: str) -> DataFrame:
    """(kind, id): the first row of each wanted key, then the wanted rows whose key no row has. Null keys match nothing."""
    keys = wanted.select(key).where(F.col(key).isNotNull()).distinct()
    inner = rows.join(keys, key, "left_semi").groupBy(key).agg(F.min(row_id).alias("id")).select(F.lit("matched").alias("kind"), "id")
    rest = wanted.join(rows.select(key).distinct(), key, "left_anti").select(F.lit("unmatched").alias("kind"), F.col(wanted_id).alias("id"))
    return inner.unionByName(rest)


def returned_or_fallback(requested: DataFrame, returned: DataFrame, key: str, position: str, value: str) -> DataFrame:
    """(key, value, fallback): each requested key with its first returned value; keys that nothing came back for fall back. Unknown keys go."""
    first = returned.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(value, position).alias(value)).withColumn("_hit", F.lit(True))
    return requested.select(key).distinct().join(first, key, "left").select(key, value, F.col("_hit").isNull().alias("fallback"))


def to_do(work: DataFrame, log: DataFrame, key: str, position: str, status: str, terminal: list[str]) -> DataFrame:
    """Work whose latest status in the log isn't one of ``terminal``; what the log doesn't know is to do."""
    done = log.groupBy(key).agg(F.max_by(status, position).alias(status)).where(F.col(status).isin(terminal))
    return work.join(done, key, "left_anti")


def attempts(work: DataFrame, log: DataFrame, key: str, done: Column, failed: Column, most: int) -> DataFrame:
    """(key, state): done, exhausted after ``most`` failures, or missing."""
    seen = log.groupBy(key).agg(F.max(F.coalesce(done, F.lit(False))).alias("_done"), F.sum(F.coalesce(failed, F.lit(False)).cast("long")).alias("_failed"))
    state = F.when(F.col("_done"), "done").when(F.col("_failed") >= most, "exhausted").otherwise("missing")
    return work.select(key).join(seen, key, "left").select(key, state.alias("state"))


def completions_to_do(work: DataFrame, done: DataFrame, failed: DataFrame, key: str, retry_failed: bool = False) -> DataFrame:
    """Work without an answer and, unless failures are tried again, without a failure."""
    seen = done.select(key) if retry_failed else done.select(key).union(failed.select(key))
    return work.join(seen, key, "left_anti")


def batches_to_do(work: DataFrame, summaries: DataFrame, batch: str, status: str = "status", finished: str = "completed") -> DataFrame:
    """Work of batches without a finished summary."""
    return work.join(summaries.where(F.col(status) == finished).select(batch), batch, "left_anti")

"""Manifests and reports over samples, records and evaluations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import revision_id, seeded, stable_id
from ..functions.text import join_within


def revisions(passages: DataFrame, url: str, passage: str, text: str, upstream: str) -> DataFrame:
    """(url, text, passages, revision): an address's passages joined by blank lines; an upstream id counts if there is exactly one."""
    g = passages.groupBy(F.col(url).alias("url")).agg(F.array_sort(F.collect_list(F.struct(F.col(passage).alias("p"), F.col(text).alias("t")))).alias("all"), F.min(upstream).alias("low"), F.max(upstream).alias("high"))
    joined = g.select("url", F.array_join(F.transform("all", lambda x: x["t"]), "\n\n").alias("text"), F.size("all").cast("long").alias("passages"), F.when(F.col("low") == F.col("high"), F.col("low")).alias("one"))
    return joined.select("url", "text", "passages", F.coalesce("one", revision_id(F.col("url"), F.col("text"))).alias("revision"))


def crawl_run(chunks: DataFrame, passages: DataFrame, index: str, started: str) -> DataFrame:
    """One row: the run's id and how many chunks and passages it had."""
    return chunks.agg(F.count("*").alias("raw_chunk_count")).join(F.broadcast(passages.agg(F.count("*").alias("passage_count")))).select(stable_id("crawlrun", F.lit(index), F.lit(started)).alias("crawl_run_id"), "raw_chunk_count", "passage_count")  # one row each


def gap_requests(gaps: DataFrame, chunks: DataFrame, questions: DataFrame, slice_col: str, key: str, per_call: int = 5, top: int = 20, most: int = 6000, styles: int = 3, seed: int = 42) -> DataFrame:
    """(slice, pairs_needed, num_records, retrieved, seed_styles) for each gap (slice, target, observed).

    The first ``top`` chunks by key, joined within ``most`` characters; ``styles`` questions in a seeded order. Both are kept
    by aggregates that hold no more than they give.
    """
    from .dedup import first_n_per_slice

    texts = first_n_per_slice(chunks.withColumn("_t", F.struct(key, "text")), slice_col, "_t", key, top).select(slice_col, F.transform("ids", lambda x: x["text"]).alias("texts"))
    asked = questions.withColumns({"_d": seeded(seed, F.col(key)), "_q": F.struct(seeded(seed, F.col(key)).alias("d"), F.concat(F.lit("- "), "question").alias("q"))})
    styled = first_n_per_slice(asked, slice_col, "_q", "_d", styles).select(slice_col, F.array_join(F.transform("ids", lambda x: x["q"]), "\n").alias("seed_styles"))
    need = F.greatest(F.lit(0), F.col("target") - F.col("observed")).cast("long")
    joined = gaps.join(texts, slice_col, "left").join(styled, slice_col, "left")
    return joined.select(slice_col, need.alias("pairs_needed"), F.greatest(F.lit(1), F.ceil(need / per_call)).cast("long").alias("num_records"), F.coalesce(join_within(F.col("texts"), most), F.lit("")).alias("retrieved"), F.coalesce("seed_styles", F.lit("")).alias("seed_styles"))


def dataset_role(synthetic: Column, grounded: Column, explicit: Column | None = None) -> Column:
    role = F.when((synthetic > 0) & (grounded > 0), "blended").when(synthetic > 0, "synthetic_gapfill").otherwise("source_entailed")
    return role if explicit is None else F.coalesce(F.nullif(explicit, F.lit("")), role)


def registry_metrics(registry: DataFrame, urls: DataFrame, url: str) -> DataFrame:
    """One row of counts: records (url, content_hash, etag, redirect_to), addresses matched and not (0 if there are no records)."""
    has = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) != "")
    records = registry.agg(F.count("*").alias("record_count"), has("content_hash").alias("content_hash_count"), has("etag").alias("etag_count"), has("redirect_to").alias("redirect_count"))
    met = urls.select(url).distinct().join(registry.select(url).distinct().withColumn("_hit", F.lit(1)), url, "left").agg(F.count("_hit").alias("matched_url_count"), F.count_if(F.col("_hit").isNull()).alias("_rest"))
    return records.join(F.broadcast(met)).withColumn("unmatched_url_count", F.when(F.col("record_count") == 0, 0).otherwise(F.col("_rest"))).drop("_rest")  # one row each


def completion_totals(done: DataFrame, errors: DataFrame, key: str, position: str, counts: list[str]) -> DataFrame:
    """One row: the latest answer of each key counts once; an error counts if its key has no answer. Sums of the counts, and think over completion."""
    last = done.groupBy(key).agg(*(F.max_by(c, position).alias(c) for c in counts))
    failed = errors.select(key).distinct().join(done.select(key), key, "left_anti").agg(F.count("*").alias("rows_failed"))
    sums = last.agg(F.count("*").alias("rows_completed"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts))
    ratio = F.when(F.col(counts[0]) > 0, F.col(counts[1]) / F.col(counts[0]))
    return sums.join(F.broadcast(failed)).withColumn("overhead_ratio", ratio)  # one row each


def retrieval_audit(rows: DataFrame, kept: str, best: str) -> DataFrame:
    """One row: mean of chunks kept, how many rows kept 0 to 5, share without any, and least, upper middle and greatest best score."""
    n = F.count("*")
    middle = F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{best}` DESC)").alias("middle_score")  # keeps a count for each distinct score
    return rows.agg(F.coalesce(F.avg(kept), F.lit(0.0)).alias("mean_kept"), *(F.count_if(F.col(kept) == k).alias(f"kept_{k}") for k in range(6)), F.when(n > 0, F.count_if(F.col(kept) == 0) / n * 100).otherwise(0.0).alias("empty_percent"), F.min(best).alias("least_score"), middle, F.max(best).alias("most_score"))


def composites(means: DataFrame, target: str, mode: str, score: str, failed: str, with_context: str, without: str) -> DataFrame:
    """(target, without, with_context, delta, status): mean over the axes that have a score, in both modes, and their difference."""
    of = lambda m: F.avg(F.when(F.col(mode) == m, F.col(score)))
    g = means.groupBy(target).agg(of(without).alias("without"), of(with_context).alias("with_context"), F.max(failed).alias("_failed"))
    return g.select(target, "without", "with_context", (F.col("with_context") - F.col("without")).alias("delta"), F.when(F.col("_failed") > 0, "incomplete").otherwise("complete").alias("status"))


def seed_run_metrics(seeds: DataFrame, source: str, prompt: str, completion: str) -> DataFrame:
    """(source, candidates, records, prompt_tokens, completion_tokens, total_tokens): candidates by source and what the model used."""
    used = F.col(prompt).isNotNull() | F.col(completion).isNotNull()
    total = F.coalesce(F.col(prompt), F.lit(0)) + F.coalesce(F.col(completion), F.lit(0))
    return seeds.groupBy(F.coalesce(source, F.lit("unknown")).alias("source")).agg(F.count("*").alias("candidates"), F.count_if(used).alias("records"), F.coalesce(F.sum(prompt), F.lit(0)).alias("prompt_tokens"), F.coalesce(F.sum(completion), F.lit(0)).alias("completion_tokens"), F.sum(total).alias("total_tokens"))


def estimated_tokens(records: Column, prompt_mean: Column, completion_mean: Column) -> Column:
    """struct(prompt, completion, total): means times records, rounded half to even."""
    whole = lambda m: F.bround(m * records, 0).cast("long")
    p, c = F.coalesce(prompt_mean, F.lit(0.0)), F.coalesce(completion_mean, F.lit(0.0))
    return F.struct(whole(p).alias("prompt"), whole(c).alias("completion"), whole(p + c).alias("total"))


def plan_totals(requests: DataFrame, gap: str) -> DataFrame:
    """One row: distinct gaps, seed records, records and pairs asked for."""
    return requests.agg(F.countDistinct(gap).alias("gaps_requested"), F.count("*").alias("seed_records"), F.coalesce(F.sum("num_records"), F.lit(0)).alias("records_requested"), F.coalesce(F.sum("pairs_needed"), F.lit(0)).alias("pairs_requested"))


def composition(rows: DataFrame, ids: list[str], synthetic: Column) -> DataFrame:
    """One row: rows, distinct values of each id column (empty ones not counted), synthetic rows and their share (0 without rows).

    The ids themselves stay rows of a table: ``rows.select(id).distinct()``.
    """
    made, n = F.count_if(synthetic), F.count("*")
    counts = [F.countDistinct(F.nullif(F.col(x).cast("string"), F.lit(""))).alias(f"{x}_count") for x in ids]
    return rows.agg(n.alias("rows"), *counts, made.alias("synthetic"), F.when(n > 0, F.bround(made / n, 6)).otherwise(0.0).alias("synthetic_ratio"))


def value_counts(rows: DataFrame, columns: list[str], lists: list[str]) -> DataFrame:
    """(field, value, n): rows of each value; null and empty values, and empty lists, count as unknown."""
    one = [F.struct(F.lit(x).alias("field"), F.array(F.col(x).cast("string")).alias("v")) for x in columns]
    many = [F.struct(F.lit(x).alias("field"), F.col(x).cast("array<string>").alias("v")) for x in lists]
    fields = rows.select(F.explode(F.array(*one, *many)).alias("f"))
    return fields.select("f.field", F.explode_outer("f.v").alias("value")).groupBy("field", F.coalesce(F.nullif("value", F.lit("")), F.lit("unknown")).alias("value")).agg(F.count("*").alias("n"))


def curation_metrics(rows: DataFrame, accepted: Column, reason: Column) -> DataFrame:
    """(kind, reason, n, share): accepted rows, and rejected ones by reason (null and empty: unknown), as shares of all rows. Null isn't accepted."""
    ok = F.coalesce(accepted, F.lit(False))
    why = F.coalesce(F.nullif(reason, F.lit("")), F.lit("unknown"))
    g = rows.groupBy(F.when(ok, "accepted").otherwise("rejected").alias("kind"), F.when(ok, "").otherwise(why).alias("reason")).agg(F.count("*").alias("n"))
    return g.join(F.broadcast(rows.agg(F.count("*").alias("_all")))).withColumn("share", F.bround(F.col("n") / F.col("_all"), 6)).drop("_all")  # one row


def rejections(rows: DataFrame, accepted: Column, reason: Column, *kept: str) -> DataFrame:
    """The kept columns of rejected rows, and why they were (null if nothing says)."""
    return rows.where(~F.coalesce(accepted, F.lit(False))).select(*kept, reason.alias("rejection_reason"))


def _passes(criteria: list[str]) -> Column:
    every = F.lit(True)
    for x in criteria:
        every &= F.coalesce(F.col(x), F.lit(False))
    return every


def gate_report(rows: DataFrame, criteria: list[str], threshold: float = 0.9) -> DataFrame:
    """One row: rows that meet each criterion and all of them, the rounded rate, and whether the unrounded rate reaches the threshold (0 without rows)."""
    n, every = F.count("*"), F.count_if(_passes(criteria))
    rate = F.when(n > 0, every / n).otherwise(0.0)
    return rows.agg(n.alias("rows"), *(F.count_if(F.col(x)).alias(f"{x}_count") for x in criteria), every.alias("all_count"), F.bround(rate, 3).alias("pass_rate"), (rate >= threshold).alias("passed"))


def gate_failures(rows: DataFrame, criteria: list[str]) -> DataFrame:
    """The rows that miss a criterion; null is a miss."""
    return rows.where(~_passes(criteria))


def unresolved(errors: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """Errors whose key has no score; those without a key stay."""
    return errors.join(scores.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def score_summary(scores: DataFrame, errors: DataFrame, key: str, position: str, axes: list[str], counts: list[str]) -> DataFrame:
    """One row over the latest score of each key: rows, means without 0 and null, sums of counts, and errors left.

    A failed key counts once, each error without a key by itself. Scores without a key aren't among the latest.
    """
    last = scores.where(F.col(key).isNotNull()).groupBy(key).agg(*(F.max_by(x, position).alias(x) for x in dict.fromkeys([*axes, *counts])))
    done = last.agg(F.count("*").alias("rows_scored"), *(F.avg(F.when(F.col(x) != 0, F.col(x))).alias(f"mean_{x}") for x in axes), *(F.coalesce(F.sum(x), F.lit(0)).alias(f"total_{x}") for x in counts))
    left = unresolved(errors, scores, key).agg((F.countDistinct(key) + F.count_if(F.col(key).isNull())).alias("rows_failed"))
    raw = scores.agg(F.count("*").alias("rows_scored_raw"))
    tried = errors.agg(F.count("*").alias("error_attempts"))
    return done.join(F.broadcast(left)).join(F.broadcast(raw)).join(F.broadcast(tried)).withColumn("duplicates", F.col("rows_scored_raw") - F.col("rows_scored"))  # one row each


def pairwise_summary(rows: DataFrame, winner: str, agreement: str, counts: list[str]) -> DataFrame:
    """(kind, name, n, rate): rows compared; wins of left, right and tie, which any other winner is; agreements (null and empty: unknown); sums of counts.

    One pass over the rows, which aren't made distinct; rates are of the rows compared, null for sums.
    """
    side = F.when(F.col(winner).isin("left", "right"), F.col(winner)).otherwise("tie")
    g = rows.groupBy(side.alias("side"), F.coalesce(F.nullif(agreement, F.lit("")), F.lit("unknown")).alias("agreement")).agg(F.count("*").alias("n"), *(F.sum(x).cast("long").alias(f"_{i}") for i, x in enumerate(counts)))
    item = lambda kind, name, n: F.struct(F.lit(kind).alias("kind"), name.alias("name"), n.alias("n"))
    sides = [item("wins", F.lit(x), F.when(F.col("side") == x, F.col("n")).otherwise(0)) for x in ("left", "right", "tie")]
    sums = [item("tokens", F.lit(x), F.col(f"_{i}")) for i, x in enumerate(counts)]
    long = g.select(F.explode(F.array(item("rows", F.lit("compared"), F.col("n")), *sides, item("agreement", F.col("agreement"), F.col("n")), *sums)).alias("x")).groupBy("x.kind", "x.name").agg(F.coalesce(F.sum("x.n"), F.lit(0)).alias("n"))
    total = rows.agg(F.count("*").alias("_all"))
    return long.join(F.broadcast(total)).withColumn("rate", F.when(F.col("kind") != "tokens", F.col("n") / F.col("_all"))).drop("_all")  # one row


def weighted_means(rows: DataFrame, metric: str, mean: str, counts: list[str]) -> DataFrame:
    """(metric, mean, count): means weighted by the first of ``counts`` that isn't null or 0, 1 at least; rows without a mean go."""
    n = F.greatest(F.lit(1), F.coalesce(*(F.nullif(F.col(x).cast("long"), F.lit(0)) for x in counts), F.lit(1))).alias("_n")
    g = rows.where(F.col(mean).isNotNull()).select(F.col(metric).alias("metric"), F.col(mean).alias("_m"), n).groupBy("metric")
    return g.agg((F.sum(F.col("_m") * F.col("_n")) / F.sum("_n")).alias("mean"), F.sum("_n").alias("count"))

"""Filter, deduplicate, split and count, as one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import strip, word_count
from ..sources.tables import table


def flagship_reduction_summary(spark: SparkSession, folder: str) -> DataFrame:
    """How many documents each step of a curation removes: too short, duplicate, out of 8..1200 words.

    The share of other characters (F6) and the split (K10) are not among the steps.
    """
    docs = table(spark, folder, "documents").select("doc_id", "lang", word_count(F.col("text")).alias("words"), F.md5(F.lower(strip(F.col("text")))).alias("key"))
    noisy = F.col("words") < 60
    first = F.row_number().over(W.partitionBy("key", noisy).orderBy("doc_id")) == 1
    flags = docs.withColumns({"a": ~noisy, "b": ~noisy & first}).withColumn("c", F.col("b") & F.col("words").between(8, 1200))
    counts = flags.agg(F.count("*").alias("input"), *(F.count_if(F.col(x)).alias(x) for x in "abc"))
    steps = F.array(*(F.struct(F.lit(i).alias("step"), F.lit(n).alias("name"), F.col(x).alias("before"), F.col(y).alias("after")) for i, (n, x, y) in enumerate((("noise", "input", "a"), ("exact_dedup", "a", "b"), ("word_count", "b", "c")))))
    rows = counts.select("input", F.explode(steps).alias("s")).select("input", "s.*")
    removed = F.col("before") - F.col("after")
    share = lambda d: F.when(d > 0, F.bround(removed / d * 100, 4)).otherwise(0.0)
    return rows.select("step", "name", "before", "after", removed.alias("removed"), share(F.col("before")).alias("pct_of_step"), share(F.col("input")).alias("pct_of_input"))


QUERIES = {"flagship_reduction_summary": flagship_reduction_summary}

ORACLE_SQL = {
    "flagship_reduction_summary": r"""
WITH d AS (SELECT doc_id, len(regexp_extract_all(coalesce(text,''), '[^ \t\n\x0B\f\r]+')) AS words,
  md5(lower(regexp_replace(coalesce(text,''), '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g'))) AS key FROM documents),
f AS (SELECT *, words >= 60 AS a, words >= 60 AND row_number() OVER (PARTITION BY key, words < 60 ORDER BY doc_id) = 1 AS b FROM d),
c AS (SELECT count(*) AS input, count(*) FILTER (a) AS a, count(*) FILTER (b) AS b, count(*) FILTER (b AND words BETWEEN 8 AND 1200) AS c FROM f),
s AS (SELECT 0 AS step, 'noise' AS name, input, input AS before, a AS after FROM c UNION ALL SELECT 1, 'exact_dedup', input, a, b FROM c UNION ALL SELECT 2, 'word_count', input, b, c FROM c)
SELECT step, name, before, after, before - after AS removed,
  CASE WHEN before > 0 THEN round_even((before - after) / before * 100, 4) ELSE 0.0 END AS pct_of_step,
  CASE WHEN input > 0 THEN round_even((before - after) / input * 100, 4) ELSE 0.0 END AS pct_of_input FROM s""",
}

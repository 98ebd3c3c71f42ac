"""Chat rendering of logged conversations, less those that a longer one continues.

Some logs write a conversation anew after every turn, so most of their rows are beginnings of later ones. A turn's hash
covers its place, role and text; a conversation's first n turns are named by the bitwise xor of their hashes, twice over
(128 bits), which a running window gives without gathering turns. A conversation whose whole name is the name of a proper
beginning of another one goes, by an anti-join; of equal conversations the smallest id stays. All of it is DataFrame
functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def prefix_names(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(id, place, role, body, h1, h2): each turn with its place from 1 and the name of the conversation up to it."""
    rows = turns.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("body"))
    order = W.partitionBy("id").orderBy(F.asc_nulls_last("turn"), "role", "body")
    placed = rows.withColumn("place", F.row_number().over(order))
    own = placed.withColumns({"a": F.xxhash64(F.lit(1), "place", "role", "body"), "b": F.xxhash64(F.lit(2), "body", "role", "place")})
    upto = W.partitionBy("id").orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    return own.select("id", "place", "role", "body", F.bit_xor("a").over(upto).alias("h1"), F.bit_xor("b").over(upto).alias("h2"))


def maximal_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, n_turns, n_equal, rendered) of each conversation that is no beginning of a longer one.

    n_equal counts the conversations equal to it, itself included. Rendered: ``<|im_start|>role``, a line break, the text,
    ``<|im_end|>`` and a line break for each turn. Rows without an id take no part. Null roles and texts count as empty.
    Turns are taken in order of turn, then role, then text, null turns last, so repeated rows are turns of their own.
    An empty table gives an empty one.
    """
    names = prefix_names(turns, id_col, turn_col, role_col, text_col)
    last = names.groupBy("id").agg(F.max(F.struct("place", "h1", "h2")).alias("x")).select("id", F.col("x.place").alias("n"), F.col("x.h1").alias("h1"), F.col("x.h2").alias("h2"))
    whole = last.groupBy("n", "h1", "h2").agg(F.min("id").alias("id"), F.count("*").alias("n_equal"))
    # names of proper beginnings: those of every place that some conversation goes beyond
    size = last.select(F.col("id").alias("lid"), F.col("n").alias("ln"))
    begun = names.join(size, F.col("id") == F.col("lid")).where("place < ln").groupBy("place", "h1", "h2").agg(F.count("*").alias("longer")).select(F.col("place").alias("n"), "h1", "h2")
    kept = whole.join(begun, ["n", "h1", "h2"], "left_anti").select(F.col("id").alias("kid"), F.col("n").alias("n_turns"), "n_equal")
    line = F.concat(F.lit(OPEN), "role", F.lit("\n"), "body", F.lit(CLOSE + "\n"))
    told = names.join(kept, F.col("id") == F.col("kid")).select("id", "n_turns", "n_equal", F.struct("place", line.alias("line")).alias("t"))
    joined = told.groupBy("id").agg(F.first("n_turns").alias("n_turns"), F.first("n_equal").alias("n_equal"), F.array_join(F.transform(F.array_sort(F.collect_list("t")), lambda t: t["line"]), "").alias("rendered"))
    return joined.select(F.col("id").alias(id_col), F.col("n_turns").cast("long").alias("n_turns"), "n_equal", "rendered")


ORACLE_SQL = r"""
WITH t AS (SELECT conv_id, coalesce(role,'') AS role, coalesce(text,'') AS body,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, coalesce(role,''), coalesce(text,'')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, count(*) AS n_turns, list({'r': role, 'b': body} ORDER BY place) AS turns,
    string_agg('<|im_start|>' || role || chr(10) || body || '<|im_end|>' || chr(10), '' ORDER BY place) AS rendered FROM t GROUP BY conv_id),
p AS (SELECT DISTINCT turns[1:i] AS head FROM (SELECT turns, unnest(range(1, n_turns)) AS i FROM c)),
w AS (SELECT turns, min(conv_id) AS conv_id, any_value(n_turns) AS n_turns, count(*) AS n_equal, any_value(rendered) AS rendered FROM c GROUP BY turns)
SELECT conv_id, n_turns, n_equal, rendered FROM w WHERE turns NOT IN (SELECT head FROM p)"""

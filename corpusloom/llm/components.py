"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .workspace import remove_folder, new_folder

ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b) but the roots, of any one type with an order: root is the smallest node of its component.

    Each round writes its edges to the shared folder, so lineage stays short and no executor's disk matters. A node's
    neighbours are never gathered: only their minimum is, and it is joined back to the edges.
    """
    spark = edges.sparkSession
    kind = T.StructType([T.StructField(c, edges.schema["a"].dataType) for c in "ab"])
    path = new_folder(spark, "edges")
    edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().write.parquet(path)
    before = None
    for _ in range(ROUNDS):
        now = spark.read.schema(kind).parquet(path)
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        after = new_folder(spark, "edges")
        small.write.parquet(after)
        remove_folder(spark, path)
        path = after
        sums = spark.read.schema(kind).parquet(path).agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if sums == before:
            return spark.read.schema(kind).parquet(path).toDF("node", "root")
        before = sums
    raise RuntimeError("components did not settle")

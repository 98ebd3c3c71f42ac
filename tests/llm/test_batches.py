"""The pipeline's stages have texts handed to workers in batches of bounded size."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm.frames import BATCH_BYTES

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def largest(rows):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["b"])

    return rows.mapInArrow(sizes, "b long").agg(F.max("b")).first()[0]


@pytest.mark.parametrize("given", [None, "64k"])
def test_texts_go_out_in_small_batches(spark, given):
    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 1000).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(5000).cast("long").alias("n_chars"))
    spark.conf.unset(KEY)
    try:
        if given:
            spark.conf.set(KEY, given)
        else:
            assert largest(docs) > 2 * BATCH_BYTES
        dict(corpus_pipeline.STAGES)["substring_dedup"](spark, docs, "")
        assert largest(docs) < (1 << 17 if given else 1.1 * BATCH_BYTES)
    finally:
        spark.conf.unset(KEY)

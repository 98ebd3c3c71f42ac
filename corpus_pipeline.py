"""From raw documents to token ids: five stages, each over all that the stage before it kept."""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import queries as q
from corpusloom.llm.bpe import encode_documents
from corpusloom.llm.decontaminate import match_benchmark
from corpusloom.llm.frames import small_batches
from corpusloom.llm.jaccard_join import keep_one_of_each
from corpusloom.llm.substring_dedup import substring_dedup
from corpusloom.llm.toxicity import THRESHOLD, score_toxicity, train
from corpusloom.llm.workspace import new_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose toxicity score is at least 0.7."""
    model = train(docs, q.table(spark, sf_dir, "labels"), q.toxicity_training())
    scored, name = score_toxicity(docs, model)
    return scored.where(F.col(name) < THRESHOLD).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones: the one with the smallest id."""
    return keep_one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without words that an earlier document already has in a window of 13; texts that lose none stay as they are."""
    cut, name = substring_dedup(docs)
    got = F.col(name)
    columns = [F.when(got.n_removed > 0, got.kept).otherwise(F.col(c)).alias(c) if c == "text" else F.when(got.n_removed > 0, F.length(got.kept).cast("long")).otherwise(F.col(c)).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return cut.select(*columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a window of a benchmark item."""
    matched, name = match_benchmark(docs, q.table(spark, sf_dir, "benchmark"))
    return matched.where(F.col(name).n_hit == 0).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the decoded text."""
    coded = encode_documents(docs, public_tokenizers.path(q.VOCABULARY), remembered=1 << 18)  # workers still hold memory of the stages before
    return coded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def _bounded(stage):
    """The stage with texts handed to workers in small batches: these hold memory of the stages before."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("toxicity", _bounded(drop_toxic)),
    ("jaccard_join", _bounded(drop_near_copies)),
    ("substring_dedup", _bounded(cut_repeats)),
    ("decontamination", _bounded(drop_contaminated)),
    ("bpe", _bounded(encode)),
]

#: SQL can't say these stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = q.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""The registered queries of this subpackage, and their SQL where SQL can say them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat
from .bpe import encode_documents
from .decontaminate import match_benchmark
from .jaccard_join import jaccard_groups
from .lattice_lm import score_documents
from .licences import scan_licences
from .substring_dedup import substring_dedup
from .token_files import checksums, read_token_files, write_token_files
from .topk import top_k
from .toxicity import THRESHOLD, score_toxicity, train
from .workspace import new_folder

VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got, name = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", f"{name}.n_words", f"{name}.n_removed", F.sha2(F.col(name).kept, 256).alias("kept_sha256"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    got, name = match_benchmark(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    m = F.col(name)
    return got.select("doc_id", m.n_words.alias("n_words"), m.n_hit.alias("n_hit"), F.size(m["items"]).cast("long").alias("n_items"), F.sha2(F.array_join(m["items"], ","), 256).alias("items_sha256"), (m.n_hit > 0).alias("contaminated"))


def _hashed(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string")), F.lit(0))


def op3_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _hashed() % 7 == 2
    got = score_documents(table(spark, sf_dir, "documents"), ~held_out, public_tokenizers.path(PIECES))
    return got.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "lattice_score")


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"), links=True).select("doc_id", "n_shingles", "component_id", "n_links")


def toxicity_training():
    return _hashed() % 3 != 1


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got, name = score_toxicity(docs, train(docs, table(spark, sf_dir, "labels"), toxicity_training()))
    score = F.col(name)
    return got.select("doc_id", (_hashed() % 3 == 1).alias("held_out"), score.alias("score"), F.when(score >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(VOCABULARY), END_ID)
    return checksums(read_token_files(spark, folder))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return coded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.maximal_conversations(table(spark, sf_dir, "conversations"))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    got, name = scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = F.col(name).found
    return got.select("doc_id", F.col(name).n_paragraphs.alias("n_paragraphs"), F.size(found).cast("long").alias("n_licences"), F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: x["family"]))), ",").alias("families"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_lattice_lm": op3_lattice_lm,
    "op4_top_k": op4_top_k,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_toxicity": op6_toxicity,
    "op7_token_files": op7_token_files,
    "op8_bpe": op8_bpe,
    "op9_chat": op9_chat,
    "op10_licences": op10_licences,
}

ORACLE_SQL: dict[str, str] = {
    "op4_top_k": """
WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([z[1] * z[2] FOR z IN list_zip(q.e, c.e)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op9_chat": chat.ORACLE_SQL,
}

"""Each pipeline stage against brute force on what its predecessor kept."""

import os
import sys

sys.path.insert(0, os.path.dirname(__file__))

import corpus_pipeline  # noqa: E402
from test_corpus_cleaning import brute_dedup, brute_match  # noqa: E402
from test_jaccard import brute  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {"input": [tuple(r) for r in docs.select("doc_id", "text").collect()]}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert docs.columns == columns
            kept[name] = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    clean = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
    left = {i for i, _ in kept["toxicity"]}
    assert len(clean & left) >= 0.97 * len(clean) and len(toxic & left) <= len(toxic)
    assert {i for i, _ in kept["jaccard_join"]} == {i for i, n, low in brute(kept["toxicity"]) if i == low}
    texts = dict(kept["jaccard_join"])
    assert sorted(kept["substring_dedup"]) == sorted((i, k if gone else texts[i]) for i, _, gone, k in brute_dedup(kept["jaccard_join"]))
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert {i for i, _ in kept["decontamination"]} == {i for i, _, hit, _ in brute_match(kept["substring_dedup"], items) if not hit}
    assert docs.count() == len(kept["decontamination"])


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []

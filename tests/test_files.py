"""Sources and sinks over small files."""

import hashlib
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from corpusloom.operators.match import must_match
from corpusloom.sources import files as S
from corpusloom.streaming.upserts import latest_by_key, windowed_counts

ROW = "a long, b string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_jsonl(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1, "b": "x"}\n\n{"a": 2}\n')
    assert rows(S.read_jsonl(spark, str(tmp_path / "x.jsonl"), ROW)) == [(1, "x"), (2, None)]
    assert S.read_jsonl(spark, str(tmp_path / "none.jsonl"), ROW).count() == 0


def test_records(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.jsonl").write_text('{"a": 1, "b": "x"}\n')
    (tmp_path / "y.json").write_text('[{"a": 2}, {"a": 3}]')
    (tmp_path / "z.json").write_text('{"rows": [{"a": 4,\n "b": "q"}]}')
    got = S.read_records(spark, str(tmp_path), ROW)
    assert rows(got.select("a", "b")) == [(1, "x"), (2, None), (3, None), (4, "q")]
    assert [r.path.rsplit("/", 1)[1] for r in got.orderBy("path", "a").collect()] == ["x.jsonl", "y.json", "y.json", "z.json"]


def test_results_by_priority(spark, tmp_path):
    (tmp_path / "r.csv").write_text('a,b\n7,"x, ""y"""\n')
    assert rows(S.read_results(spark, str(tmp_path), ROW)) == [(7, 'x, "y"')]
    (tmp_path / "r.jsonl").write_text('{"a": 8}\n')
    assert rows(S.read_results(spark, str(tmp_path), ROW)) == [(8, None)]
    assert S.read_results(spark, str(tmp_path / "none"), ROW).count() == 0


def test_parquet_of_two_shapes(spark, tmp_path):
    spark.range(1).selectExpr("id AS a").write.parquet(str(tmp_path / "dataset" / "p1.parquet"))
    spark.range(1).selectExpr("id AS a", "'x' AS b").write.parquet(str(tmp_path / "dataset" / "p2.parquet"))
    assert rows(S.read_results(spark, str(tmp_path), ROW).select("a", "b")) == [(0, "x"), (0, None)]


def test_sitemap(spark, tmp_path):
    (tmp_path / "s.xml").write_text("<urlset><url><loc> http://x/a </loc><lastmod>2024-01-01</lastmod></url><url><loc>http://x/b</loc></url></urlset>")
    (tmp_path / "i.xml").write_text("<sitemapindex><sitemap><loc>http://x/s.xml</loc></sitemap></sitemapindex>")
    assert rows(S.read_sitemap(spark, str(tmp_path / "s.xml"))) == [("http://x/a", "2024-01-01"), ("http://x/b", None)]
    assert rows(S.read_sitemap_index(spark, str(tmp_path / "i.xml"))) == [("http://x/s.xml",)]


def test_markdown_rows(spark, tmp_path):
    (tmp_path / "m.md").write_text("| name | n |\n|-|-|\n| run-a | 1 |\n| run-a | 1 |\n| other | 2 |\n| run-b | 3 |\ntext\n")
    assert rows(S.read_markdown_rows(spark, str(tmp_path / "m.md"), "run-", ["name", "n"])) == [("run-a", "1"), ("run-b", "3")]


def test_manifest(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    (tmp_path / "y.txt").write_text("z")
    got = {r.path.rsplit("/", 1)[1]: (r.bytes, r.sha256, r.rows) for r in S.file_manifest(spark, str(tmp_path)).collect()}
    assert got["x.jsonl"] == (19, hashlib.sha256(b'{"a": 1}\n\n{"a": 2}\n').hexdigest(), 2)
    assert got["y.txt"] == (1, hashlib.sha256(b"z").hexdigest(), None)


def test_run_columns(spark):
    df = spark.createDataFrame([("file:/r/set/b8/tuned/r16/run1/responses.jsonl",)], "p string")
    assert rows(df.select(*S.run_columns(F.col("p")))) == [("set", "b8", "tuned", "r16", "run1")]


def test_sse(spark):
    chunk = lambda t, i="", m="": "data: " + json.dumps({"id": i, "model": m, "choices": [{"delta": {"content": t}}]})
    body = "\n".join([": ping", chunk("Hel", "x1", "m"), "", chunk("lo"), 'data: {"choices": []}', "data: [DONE]"])
    got = spark.createDataFrame([(body,), ("",)], "b string").select(S.sse_response(F.col("b")).alias("r")).collect()
    assert tuple(got[0].r) == ("Hello", "x1", "m")
    assert tuple(got[1].r) == ("", None, None)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["x", "y"], None)], "n long, l array<string>, z string")
    S.write_csv(df, str(tmp_path / "c"), ["l", "n"])
    assert rows(spark.read.option("escape", '"').csv(str(tmp_path / "c"), header=True)) == [('["x","y"]', "1")]
    with pytest.raises(AnalysisException):
        S.write_csv(df, str(tmp_path / "c"), ["l", "n"])
    S.write_jsonl(df, str(tmp_path / "j"))
    S.write_jsonl(df, str(tmp_path / "j"), overwrite=True)
    assert [r.value for r in spark.read.text(str(tmp_path / "j")).collect()] == ['{"l":["x","y"],"n":1,"z":null}']
    S.write_runs(df, str(tmp_path / "p"), ["n"])
    assert rows(spark.read.parquet(str(tmp_path / "p")).select("n")) == [(1,)]


def test_a_miss_raises(spark):
    left, right = spark.createDataFrame([(1,), (2,)], "k long"), spark.createDataFrame([(1, "x", 0)], "k long, v string, pos long")
    with pytest.raises(Exception, match="no match for 2"):
        must_match(left, right, "k", "pos").collect()


def test_stream_of_files(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.sql("SELECT 1L AS k, 1L AS pos, 'a' AS v, timestamp'2024-01-01 00:00:01' AS ts UNION ALL SELECT 1L, 2L, 'b', timestamp'2024-01-01 00:00:02' UNION ALL SELECT 2L, 1L, 'c', timestamp'2024-01-01 00:01:02'").write.parquet(source)
    stream = spark.readStream.schema("k long, pos long, v string, ts timestamp").parquet(source)
    latest = latest_by_key(stream, "k", "pos").writeStream.format("memory").queryName("latest").outputMode("complete").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    counts = windowed_counts(stream, "ts", "k", "1 minute", "10 minutes").writeStream.format("memory").queryName("counts").outputMode("complete").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    latest.awaitTermination(60), counts.awaitTermination(60)
    assert rows(spark.table("latest").select("k", "v")) == [(1, "b"), (2, "c")]
    assert rows(spark.table("counts").select("k", "n")) == [(1, 2), (2, 1)]

"""Reports, admissions and batched answers against plain loops, with nulls, ties and empty tables."""

import json
import re
import struct

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.text import doc_kind, url_parts
from corpusloom.operators import match as M
from corpusloom.operators import rollups as U
from corpusloom.operators.dedup import admit
from corpusloom.operators.filters import is_noise
from corpusloom.sources import files as S


def test_reasons_add_up(spark):
    known = spark.createDataFrame([("a", "b"), ("", "b")], "q string, a string")
    given = [(1, "a", "b"), (2, "x", "y"), (3, "x", "y"), (4, None, "b"), (5, "", ""), (6, "a", "b"), (7, "x", "z")]
    got = {r.i: r.reasons for r in admit(spark.createDataFrame(given, "i int, q string, a string"), known, ["q", "a"], "i").collect()}
    assert got == {1: ["known"], 2: [], 3: ["repeated"], 4: ["empty", "known"], 5: ["empty"], 6: ["known"], 7: []}


def test_batched_answers_in_order(spark):
    asked = [1, 2, 3, 4]
    answers = [(1, "Why so?"), (9, "New?"), (1, "Other?"), (2, "why SO"), (2, "Und Ü?"), (3, ""), (4, "--"), (3, "late")]
    want, keys, seen = [], set(), set()
    for k, q in answers:
        n = re.sub(r"\W+", "", q.lower())
        if k in asked and k not in keys and not (n and n in seen):
            want.append((k, q))
            keys.add(k)
            seen.add(n)
    rows = spark.createDataFrame([(answers, asked), ([], asked)], "p array<struct<key:int,question:string>>, r array<int>")
    got = [[tuple(x) for x in r.kept] for r in rows.select(M.accepted_pairs(F.col("p"), F.col("r")).alias("kept")).collect()]
    assert got == [want, []]


def test_two_keys_must_match(spark):
    left = spark.createDataFrame([(" a ", "b"), ("c", "d")], "p string, q string")
    right = spark.createDataFrame([("a", "b\n", 2, "late"), ("a", "b", 1, "first"), ("c", "d", 3, "x")], "p string, q string, pos int, v string")
    got = sorted((r.p, r.q, r.v) for r in M.must_match(left, right, ["p", "q"], "pos").collect())
    assert got == [(" a ", "b", "first"), ("c", "d", "x")]
    with pytest.raises(Exception, match="no match for c, null"):
        M.must_match(spark.createDataFrame([("c", None)], "p string, q string"), right, ["p", "q"], "pos").collect()


def test_gate_uses_the_unrounded_rate(spark):
    rows = spark.range(10_000).select("id", (F.col("id") > 1000).alias("a"), F.when(F.col("id") != 5000, True).alias("b"))
    got = U.gate_report(rows, ["a", "b"]).first()
    assert (got.rows, got.a_count, got.b_count, got.all_count, got.pass_rate, got.passed) == (10_000, 8999, 9999, 8998, 0.9, False)
    assert U.gate_failures(rows, ["a", "b"]).count() == 1002
    none = U.gate_report(rows.limit(0), ["a", "b"]).first()
    assert (none.rows, none.pass_rate, none.passed) == (0, 0.0, False)


def test_scores_and_errors_without_keys(spark):
    scores = spark.createDataFrame([(1, 1, 4, 10), (1, 2, 0, 20), (2, 3, 5, None), (None, 4, 1, 1)], "k int, pos int, s int, t int")
    errors = spark.createDataFrame([(1,), (3,), (3,), (None,), (None,)], "k int")
    got = U.score_summary(scores, errors, "k", "pos", ["s"], ["t"]).first().asDict()
    assert got == {"rows_scored": 2, "mean_s": 5.0, "total_t": 20, "rows_failed": 3, "rows_scored_raw": 4, "error_attempts": 5, "duplicates": 2}


def test_pairwise_names_every_winner(spark):
    rows = spark.createDataFrame([("left", "agree", 3), (None, "", 4), ("odd", None, None)], "w string, a string, t int")
    got = {(r.kind, r.name): (r.n, r.rate) for r in U.pairwise_summary(rows, "w", "a", ["t"]).collect()}
    third = pytest.approx(1 / 3)
    assert got == {("rows", "compared"): (3, 1.0), ("wins", "left"): (1, third), ("wins", "right"): (0, 0.0), ("wins", "tie"): (2, pytest.approx(2 / 3)), ("agreement", "agree"): (1, third), ("agreement", "unknown"): (2, pytest.approx(2 / 3)), ("tokens", "t"): (7, None)}


def test_weights_fall_back(spark):
    rows = spark.createDataFrame([("m", 1.0, 2, 9), ("m", 4.0, 0, 3), ("m", 2.0, None, 0), ("m", None, 7, 7)], "metric string, mean double, n int, s int")
    got = U.weighted_means(rows, "metric", "mean", ["n", "s"]).first()
    assert (got["count"], got["mean"]) == (6, pytest.approx((2 + 12 + 2) / 6))


def test_kinds_and_prefixes(spark):
    rows = spark.createDataFrame([("http://x/a.PPTX#b", None, None, None), ("http://x/a", "Video", None, None), ("", None, "audio_transcript", None), (None, None, None, "dense_caption"), ("http://x/pdf", "web", "", "")], "u string, m string, s string, k string")
    assert [r.k for r in rows.select(doc_kind(F.col("u"), F.col("s"), F.col("m"), F.col("k")).alias("k")).collect()] == ["pdf", "pdf", "pdf", "pdf", "html"]
    urls = spark.createDataFrame([("http://x/docs/a/1.2/p",), ("http://x/docs",), ("http://x/docsy/b",)], "u string")
    assert [tuple(r.p) for r in urls.select(url_parts(F.col("u"), "/docs/").alias("p")).collect()] == [("a", "1.2", "p"), ("", "", ""), ("docsy", "", "b")]


def test_tensor_headers(spark, tmp_path):
    def put(name, header, cut=0):
        raw = json.dumps(header).encode()
        (tmp_path / name).write_bytes(struct.pack("<Q", len(raw)) + raw[: len(raw) - cut])
        return str(tmp_path / name)

    tensor = lambda shape, kind="F16": {"dtype": kind, "shape": shape, "data_offsets": [0, 0]}
    good = put("good", {"__metadata__": {"a": "b"}, "x.lora_A": tensor([2, 3]), "x.lora_B": tensor([3, 2])})
    more = put("more", {"x.lora_A": tensor([2]), "x.lora_B": tensor([2], "F32"), "bias": tensor([])})
    half, cut = put("half", {"x.lora_A": tensor([1])}), put("cut", {"x.lora_A": tensor([1])}, 3)
    (tmp_path / "short").write_bytes(b"abc")
    paths = [good, more, half, cut, str(tmp_path / "short"), str(tmp_path / "gone"), "file://" + good]
    got = {r.path: r for r in S.adapter_status(S.tensor_headers(spark.createDataFrame([(p,) for p in paths], "path string"))).collect()}
    assert [got[p].status for p in paths] == ["ok", "warn", "error", "error", "error", "error", "ok"]
    assert (got[good].tensors, got[good].elements, got[good].dtypes, got[more].dtypes) == (2, 12, {"F16": 2}, {"F16": 2, "F32": 1})
    assert got[more].elements == 5 and got[more].warnings == ["1 other tensors"] and got[half].errors == ["not both adapter factors"]


def test_noise_by_each_rule(spark):
    words = "word " * 70
    given = [
        (words, "", False),
        ("short", "", True),
        (words, "http://x/Third-Party/a", True),
        ("  MIT License\n" + words, "", True),
        (words + "THIS software is provided\n\"as-is", "", True),
        (words + "this software is provided for free", "", False),
        (words + "creativecommonsXorg/licenses", "", False),
        (words + "mozilla PUBLIC license", "", True),
        ("\r".join(["- [a](b) " + "w " * 12] * 6), None, True),
        ("\u2028".join(["- [a](b) " + "w " * 12] * 5), None, False),
        ("```" + words + "``` end", None, True),
        ("```" + words, None, False),
        (None, None, True),
        (words * 5000, None, False),
    ]
    rows = spark.createDataFrame([(i, t, u) for i, (t, u, _) in enumerate(given)], "i int, t string, u string")
    got = {r.i: r.n for r in rows.select("i", is_noise(F.col("t"), F.col("u")).alias("n")).collect()}
    assert [got[i] for i in range(len(given))] == [want for _, _, want in given]

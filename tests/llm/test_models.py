"""LM scores, toxicity, top-k, chat and licences."""

import math
import random
import re
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import lattice_lm
from corpusloom.llm.chat import maximal_conversations
from corpusloom.llm.lattice_lm import Lattice, score_documents
from corpusloom.llm.licences import TEMPLATES, LicenceModel, scan_licences
from corpusloom.llm.queries import ORACLE_SQL, QUERIES
from corpusloom.llm.topk import SortedLists, top_k
from corpusloom.llm.toxicity import LabelModel, score_toxicity, train

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def test_forward_sums_all_segmentations():
    pieces = {"▁a": -1.0, "▁ab": -2.0, "a": -1.5, "b": -2.5, "ba": -2.0, "▁": -3.0, **{f"<0x{b:02X}>": -9.0 for b in range(256)}}
    lattice = Lattice(pieces)

    def ways(word, first=True):
        if not word and not first:
            return 1.0
        total = math.exp(-3.0) * ways(word, False) if first else 0.0
        for n in range(1, len(word) + 1):
            s = pieces.get(("▁" if first else "") + word[:n])
            total += math.exp(s) * ways(word[n:], False) if s is not None else 0.0
        if not first and word[:1] not in pieces:
            total += math.exp(-9.0 * len(word[0].encode())) * ways(word[1:], False)
        return total

    for word in ("a", "ab", "aba", "abéba", "ba", "zz"):
        assert lattice.log_probability(word) == pytest.approx(math.log(ways(word)))
    counts = {}
    lattice.expect("aba", 2.0, counts)
    assert sum(len(p.replace("▁", "")) * c for p, c in counts.items()) == pytest.approx(6.0)


def test_spelt_words_add_up_to_one():
    raw = {"▁a": 3.0, "▁": 1.0, "a": 2.0, "b": 1.0, "ab": 1.0}
    total = sum(raw.values())
    lattice = Lattice({p: math.log(c / total) for p, c in raw.items()} | {f"<0x{b:02X}>": -500.0 for b in range(256)})
    words = [""]
    mass = math.exp(lattice.log_probability("")) if lattice.arcs("")[0] else 0.0
    for _ in range(11):
        words = [w + c for w in words for c in "ab"]
        mass += sum(math.exp(lattice.log_probability(w)) for w in words)
    assert 0.97 < mass <= 1.0


def lm_rows():
    rng = random.Random(4)
    vocab = ["The", "the", "of", "thndha", "éa,", "日本"] + ["w%d" % i for i in range(60)]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    return rows + [(90, None), (91, ""), (92, "zq" * 3000), (5, rows[5][1]), (5, "other"), (None, "null id the")]


def plain_spelling(pieces, word, memo={}):  # noqa: B006
    """The probability of a word: the sum over all ways to spell it."""
    word = word if isinstance(word, str) else word.decode()

    def rest(w):
        if not w:
            return 1.0
        if w not in memo:
            total = sum(math.exp(pieces[w[:j]]) * rest(w[j:]) for j in range(1, len(w) + 1) if w[:j] in pieces and "▁" not in w[:j])
            if w[0] not in pieces:
                total += math.exp(sum(pieces[f"<0x{b:02X}>"] for b in w[0].encode())) * rest(w[1:])
            memo[w] = total
        return memo[w]

    return sum(math.exp(pieces["▁" + word[:j]]) * rest(word[j:]) for j in range(len(word) + 1) if "▁" + word[:j] in pieces)


@pytest.mark.parametrize("head", [4, 1 << 17])
def test_lm_counts_equal_brute_force(spark, head):
    rows = lm_rows()
    docs = spark.createDataFrame([(i, t, 0.0) for i, t in rows], "doc_id long, text string, score double").repartition(3)
    got = score_documents(docs, F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % 7 != 2, PIECES, head_words=head, rounds=0).collect()
    fold = lambda i: crc32(b"%d" % i) % 7 if i is not None else 0
    toks = [(i, [*WORD.findall(lower(t or "")), None]) for i, t in rows]
    count = Counter(w for i, ws in toks if fold(i) != 2 for w in ws)
    n, v = sum(count.values()), len(count)
    want = sorted(((i is None, i or 0, len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in toks))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    ends, pieces = sum(fold(i) != 2 for i, _ in toks), lattice_lm.read_pieces(PIECES)
    scores, lattices = [], []
    for _, ws in (x for x in toks if x[0] != 92):  # by the definition, each word's segmentations summed by plain recursion
        spelt = [plain_spelling(pieces, w) for w in ws[:-1]]
        p = [(max(count[w] - 0.5, 0.0) + 0.5 * v * s) / n for w, s in zip(ws[:-1], spelt, strict=True)]
        scores.append(sum(map(math.log10, p)) + math.log10((ends - 0.5) / n))
        e = (ends + 0.5) / (n + 1)
        lattices.append(sum(math.log10(s * (1 - e)) for s in spelt) + math.log10(e))
    for want, name in ((scores, "score"), (lattices, "lattice_score")):
        assert np.allclose(sorted(r[name] for r in got if r.doc_id != 92), sorted(want), rtol=1e-9)
    test_lm_counts_equal_brute_force.scores = getattr(test_lm_counts_equal_brute_force, "scores", []) + [sorted(round(r.score, 6) for r in got)]
    assert all(s == test_lm_counts_equal_brute_force.scores[0] for s in test_lm_counts_equal_brute_force.scores)


def test_lm_of_nothing(spark):
    assert score_documents(spark.createDataFrame([], "doc_id long, text string"), F.lit(True), PIECES).collect() == []
    got = score_documents(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), F.lit(False), PIECES).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(3, 0, 0, 0.0)]


def test_lm_learns_pieces_from_all_words(spark):
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("abcdeilmnorstu") for _ in range(rng.randint(2, 7))) for _ in range(45_000)})
    assert len(words) > 22_000
    texts = [(i, " ".join(words[i::50])) for i in range(50)]
    probe = ["zzyzx", "thndha", "stone"]
    docs = spark.createDataFrame([*texts, *((100 + i, w) for i, w in enumerate(probe))], "doc_id long, text string").repartition(4)
    score = {r.doc_id: r.score for r in score_documents(docs, F.col("doc_id") < 100, PIECES, rounds=4).where("doc_id >= 100").collect()}
    pieces = lattice_lm.read_pieces(PIECES)
    for _ in range(4):
        lattice, counts = Lattice(pieces), {}
        for w in words:
            lattice.expect(w, 1.0, counts)
        pieces = lattice_lm.reestimated(pieces, counts)
    model = lattice_lm.Model(pieces, len(words) + 50, len(words) + 1, 50)
    for i, w in enumerate(probe):
        assert score[100 + i] == pytest.approx(model.score(w.encode(), int(w in set(words)))[0] + model.end_score, abs=1e-6)


def test_lm_prefers_held_out_text_to_shuffled_letters(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    fold = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    held = [(r.doc_id, r.text) for r in docs.where(~fold).collect()]
    rng = random.Random(0)
    mixed = [(-1 - i, " ".join("".join(rng.sample(w, len(w))) for w in t.split())) for i, t in held]
    got = score_documents(docs.union(spark.createDataFrame(mixed, docs.schema)), F.col("doc_id").isNotNull() & (F.col("doc_id") >= 0) & fold, PIECES).collect()
    score = {r.doc_id: r.score for r in got}
    assert sum(score[i] > score[-1 - i] for i, t in held if len(t.split()) > 3) > 0.99 * sum(len(t.split()) > 3 for _, t in held)
    assert lattice_lm.DISCOUNT < 1


def brute_topk(ids, vectors, k=10):
    out = []
    for i, q in zip(ids, vectors, strict=True):
        if i % 100 == 0:
            s = sorted((-int(np.dot(q, v)), j) for j, v in zip(ids, vectors, strict=True) if j != i)
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s[:k])]
    return sorted(out)


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(600)]
    rows += [(600, rows[0][1]), (601, rows[0][1]), (700, [0.0] * 8), (701, None), (702, [None] + [1.0] * 7), (703, [math.nan] * 8), (704, [math.inf] + [1.0] * 7)]
    docs = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int").repartition(3)
    clean = [(i, np.floor(1024 * np.array(v, dtype=np.float32).astype(float)).astype(int)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all()]
    for block in (4096, 3):
        got = top_k(docs, F.col("vec_id") % 100 == 0, query_block=block)
        assert sorted(map(tuple, got.collect())) == brute_topk(*zip(*clean, strict=True))
    assert top_k(docs.limit(0), F.lit(True)).collect() == []


def test_lists_stop_early_where_scores_differ():
    rng = np.random.default_rng(0)
    grid = (rng.normal(size=(4000, 4)) * 100).astype(np.int64)
    grid[7] = [900, 900, 900, 900]
    ids, score, read = SortedLists(np.arange(4000), grid).search(np.array([5, 3, 0, 1]), -1, 1, first_step=16)
    assert ids.tolist() == [7] and score[0] == 8100 and read < 4000


def test_lists_with_large_scores():
    rng = np.random.default_rng(3)
    for scale in (1e3, 3e5, 1e6, 3e6):
        grid = (rng.normal(size=(300, 6)) * scale).astype(np.int64) * 30
        lists = SortedLists(np.arange(300), grid)
        ids, score, _ = lists.search(grid[0], 0, 5, first_step=16)
        want = sorted(((-sum(int(a) * int(b) for a, b in zip(grid[0], v, strict=True)), i) for i, v in enumerate(grid) if i))[:5]
        assert [(-s, i) for i, s in zip(ids.tolist(), score.tolist(), strict=True)] == want
        floor = int(score[2])
        assert lists.search(grid[0], 0, 5, first_step=16, floor=floor)[0].tolist()[:3] == ids.tolist()[:3]
    with pytest.raises(OverflowError):
        SortedLists(np.arange(300), np.full((300, 6), 2**40)).search(np.full(6, 2**40), 0, 5)


def test_label_model_weighs_voters():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.2
    votes = np.zeros((4000, 5))
    for j, (hit, miss) in enumerate(((0.6, 0.02), (0.5, 0.02), (0.4, 0.4))):
        votes[:, j] = np.where(y, rng.random(4000) < hit, rng.random(4000) < miss)
    votes[:, 3] = votes[:, 0]
    votes[:, 4] = ~votes[:, :4].any(axis=1)
    model = LabelModel(0.2).fit(votes)
    assert model.rate[0][0] > 0.4 and model.rate[1][0] < 0.1
    assert model.group[0] == model.group[3] != model.group[1] and model.correlation[0, 3] > 0.9


def test_toxicity_on_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    got = QUERIES["op6_toxicity"](spark, d).where("held_out").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").select("toxic", "predicted", "score").collect()
    bad = [r for r in got if r.toxic == 1]
    assert sum(r.predicted for r in bad) / len(bad) > 0.85
    assert sum(r.predicted for r in got if r.toxic == 0) <= 0.005 * len(got)


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, None), (None, 1)], [(1, 0), (1, 1), (2, 0)]])
def test_toxicity_with_odd_input(spark, labels):
    docs = spark.createDataFrame([(1, "you idiot", 0.5), (2, None, 0.5), (2, "", None), (None, "fine " * 5000, 1.0)], "doc_id long, text string, toxicity double")
    got, name = score_toxicity(docs, train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True)))
    assert name == "toxicity_" and all(0 <= r[name] <= 1 for r in got.collect()) and got.count() == 4


def test_chat_equals_sql(spark):
    rng = random.Random(6)
    talks = [[(rng.choice(["user", "assistant"]), rng.choice("abc")) for _ in range(rng.randint(1, 5))] for _ in range(60)]
    rows = [(i, t, r, x) for i, talk in enumerate(talks) for t, (r, x) in enumerate(talk)]
    rows += [(100, 0, None, None), (100, 1, "user", ""), (101, 0, "", ""), (102, None, "user", "x"), (102, 0, "user", "y"), (102, 0, "user", "y"), (None, 0, "user", "lost")]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, place string").repartition(4)
    con = duckdb.connect()
    con.register("conversations", frame.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    want = sorted(con.sql(f"SELECT conv_id, n_turns, n_equal, rendered FROM ({ORACLE_SQL['op9_chat']})").fetchall())
    assert sorted(map(tuple, maximal_conversations(frame).collect())) == want
    assert maximal_conversations(frame.limit(0)).collect() == []
    assert len(want) < 60


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql_gives_the_same(spark, name):
    con = duckdb.connect()
    for t in ("embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.sql(ORACLE_SQL[name]).select(*columns).fetchall()
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want) and want


def test_licences_in_text(spark):
    model = LicenceModel()
    for family, texts in TEMPLATES.items():
        for t in texts:
            assert model.classify(f"xu vobe {t}. ter".encode())[0] == family, t
    for line in ("the license of the version", "a permission to use this form", "notice all rights", "thndha ertion of the"):
        assert model.classify(line.encode())[0] == "none", line
    docs = spark.createDataFrame([(1, "abc\n\nLicensed under the Apache License, Version 2.0.\n", 1), (2, None, 1), (3, "", 1), (None, "words " * 20000, 1)], "doc_id long, text string, licences int")
    got, name = scan_licences(docs, model=model)
    rows = {r.doc_id: r[name] for r in got.collect()}
    assert [(x.paragraph, x.family) for x in rows[1].found] == [(2, "apache")] and rows[1].n_paragraphs == 2
    assert rows[2].n_paragraphs == rows[3].n_paragraphs == 0 and not rows[None].found
    assert scan_licences(docs.limit(0), model=model)[0].collect() == []


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction"
BSD = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n 1. Redistributions of source code must retain the above copyright\n    notice, this list of conditions and the following disclaimer."
GPL = " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version."


@pytest.mark.parametrize("around", ["{}", "xu vobe\n\n{}\n\nter mo", "xu vobe ter\n{}\nter mo li"])
def test_licences_across_lines(around):
    model = LicenceModel()
    lgpl = GPL.replace("GNU General", "GNU Lesser General")
    for text, family in ((MIT, "mit"), (BSD, "bsd"), (GPL, "gpl"), (lgpl, "lgpl")):
        assert {f for _, f, _ in model.scan(around.format(text).encode())[1]} == {family}, text
    for text in ("the license\nof the\nversion", "under the terms of\nthe public, and\nsoftware source"):
        assert model.scan(around.format(text).encode())[1] == []


def test_licences_of_two_families():
    model = LicenceModel()
    both = b"Released under the MIT License, or Licensed under the Apache License, Version 2.0, as you like."
    assert [(i, f) for i, f, _ in model.scan(b"xu\n\n" + both)[1]] == [(2, "apache"), (2, "mit")]
    texts = {"mit": MIT, "bsd": BSD, "gpl": GPL}
    n, found = model.scan("\n\n".join(texts.values()).encode())
    assert n == 3 and [f for _, f, _ in found] == list(texts)


def test_licences_one_line_as_before():
    model = LicenceModel()
    for family, ts in TEMPLATES.items():
        for t in ts:
            assert [f for _, f, _ in model.scan(f"xu vobe {t}. ter".encode())[1]] == [family], t

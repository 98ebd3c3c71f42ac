"""The Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest

from corpusloom.llm.components import components
from corpusloom.llm import jaccard_join
from corpusloom.llm.jaccard_join import connect, jaccard_groups, keep_one_of_each, reach

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingle_set(text):
    w = WORD.findall(lower(text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    ids = [2**63 - 1 if i is None else i for i, _ in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    low = {}
    for i in range(len(rows)):
        low[root(i)] = min(low.get(root(i), 2**63 - 1), ids[i])
    return [(rows[i][0], len(sets[i]), None if low[root(i)] == 2**63 - 1 else low[root(i)]) for i in range(len(rows))]


def corpus(seed, n=150):
    rng = random.Random(seed)
    vocab = ["W%d" % i for i in range(400)]
    line = " ".join(rng.choice(vocab) for _ in range(30))
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.6:
            words = rng.choice(rows[-20:])[1].split()
            for _ in range(rng.randint(0, 4)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocab)
            text = " ".join(words)
            text = text.lower() if rng.random() < 0.3 else text
        else:
            text = " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 3, 5, 30, 120])))
            text = text + " " + line if kind > 0.8 else text
        rows.append((i * 7 % 1000, text))
    return rows + [(2000, None), (2001, ""), (2002, " \n"), (None, rows[5][1]), (None, "only here by null id"), (14, rows[9][1]), (14, rows[2][1])]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0))


@pytest.mark.parametrize(("seed", "block"), [(0, 1 << 17), (1, 300)])
def test_components_equal_all_pairs(spark, seed, block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block)
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, g int").repartition(4)
    got = jaccard_groups(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert order(map(tuple, got)) == order(brute(rows))


def test_keeps_one_of_each(spark):
    rows = corpus(2, 80)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, _keep_id int")
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    known = [r for r in brute(rows) if r[0] is not None and r[0] < 2000 and r[0] != 14]
    assert {r.doc_id for r in kept.collect()} & {r[0] for r in known} == {r[0] for r in known if r[0] == r[2] or not r[1]}


def test_empty_table(spark):
    assert jaccard_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_connect_finds_what_all_links_connect():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**60, 60).astype(np.uint64)
    sets = []
    for _ in range(120):
        s = base.copy()
        s[rng.choice(60, rng.integers(0, 14), replace=False)] = rng.integers(0, 2**60)
        sets.append(np.unique(s))
    up = list(range(120))

    def root(x, up):
        while up[x] != x:
            x = up[x]
        return x

    def close(links):
        up = list(range(120))
        for a, b in links:
            up[root(a, up)] = root(b, up)
        first = {}
        return [first.setdefault(root(i, up), i) for i in range(120)]

    every = [(i, j) for i in range(120) for j in range(i) if 4 * len(np.intersect1d(sets[i], sets[j])) >= 3 * len(np.union1d(sets[i], sets[j]))]
    assert close(connect(sets, np.zeros(120, dtype=int), False)) == close(every) and up


@pytest.mark.parametrize(("seed", "bases", "most"), [(0, 1, 14), (1, 3, 9), (2, 1, 40), (3, 25, 3)])
def test_reach_counts_all_links(seed, bases, most):
    rng = np.random.default_rng(seed)
    base = [rng.integers(0, 2**60, rng.integers(30, 70)).astype(np.uint64) for _ in range(bases)]
    extra = rng.integers(0, 2**60, 12).astype(np.uint64)
    sets = []
    for _ in range(130):
        s = base[rng.integers(bases)]
        s = s[rng.random(len(s)) > rng.integers(0, most) / 100]
        sets.append(np.unique(np.r_[s, rng.choice(extra, rng.integers(0, 6))]))
    copies, block = rng.integers(1, 4, 130), rng.integers(0, 2, 130)
    alike = np.array([[i != j and 4 * len(np.intersect1d(a, b)) >= 3 * len(np.union1d(a, b)) for j, b in enumerate(sets)] for i, a in enumerate(sets)])
    assert (reach(sets, block, False, copies) == alike @ copies).all() and alike.any()
    assert (reach(sets, block, True, copies) == (alike & (block[:, None] != block)) @ copies).all()


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = dict(map(tuple, components(edges).collect()))
    assert all(got[i] == 0 for i in range(1, 51)) and got[101] == 100
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_query_on_test_data(spark):
    from corpusloom.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(rows)
    sets = [shingle_set(t) for _, t in rows]
    links = [sum(i != j and bool(a and b) and 4 * len(a & b) >= 3 * len(a | b) for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    got = QUERIES["op5_jaccard_join"](spark, d).collect()
    assert order((r.doc_id, r.n_shingles, r.component_id) for r in got) == order(want)
    assert sorted((r.doc_id, r.n_links) for r in got) == sorted((i, n) for (i, _), n in zip(rows, links, strict=True))
    assert any(r[0] != r[2] for r in want)


@pytest.mark.parametrize(("seed", "block"), [(0, 1 << 17), (1, 300)])
def test_links_equal_all_pairs(spark, seed, block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block)
    rows = corpus(seed)
    sets = [shingle_set(t) for _, t in rows]
    want = [(i, len(a), sum(x != y and bool(a and b) and 4 * len(a & b) >= 3 * len(a | b) for y, b in enumerate(sets))) for x, ((i, _), a) in enumerate(zip(rows, sets, strict=True))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(jaccard_join, "COUNT_SHINGLES", block)
    got = jaccard_groups(docs, links=True).select("doc_id", "n_shingles", "n_links").collect()
    assert order(map(tuple, got)) == order(want)
    assert max(x[2] for x in want) > 2


def test_keeps_all_without_words(spark):
    rows = [(None, None, "a"), (None, None, "b"), (3, " \n", "a"), (3, " \n", "b"), (4, "", "a"), (5, "one", "a"), (5, "one", "b")]
    kept = keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted((r.doc_id or 0, r.source) for r in kept if r.doc_id != 5) == [(0, "a"), (0, "b"), (3, "a"), (3, "b"), (4, "a")]
    assert sum(r.doc_id == 5 for r in kept) == 1

"""Substring dedup and decontamination against brute force."""

import hashlib
import random
import re

import pytest

from corpusloom.llm.decontaminate import Matcher, match_benchmark
from corpusloom.llm.substring_dedup import SuffixAutomaton, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_dedup(rows, window=13):
    last = 2**63 - 1
    first = {}
    docs = [(last if i is None else i, WORD.findall(t or "")) for i, t in rows]
    for i, words in docs:
        for j in range(len(words) - window + 1):
            w = tuple(words[j : j + window])
            first[w] = min(first.get(w, i), i)
    out = []
    for (i, words), (given, _) in zip(docs, rows, strict=True):
        gone = set()
        for j in range(len(words) - window + 1):
            if first[tuple(words[j : j + window])] < i:
                gone.update(range(j, j + window))
        kept = " ".join(w for j, w in enumerate(words) if j not in gone)
        out.append((given, len(words), len(gone), kept))
    return out


def corpus(seed=0, n=120):
    rng = random.Random(seed)
    vocab = ["w%d" % i for i in range(12)] + ["Éa", "b,", "x\x1cy"]
    passages = [[rng.choice(vocab) for _ in range(rng.randint(8, 60))] for _ in range(12)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(vocab) for _ in range(rng.randint(1, 40))]
        rows.append((i, rng.choice([" ", "\n", "  \t"]).join(words)))
    long = ("same line again " * 3000).strip()
    return rows + [(500, None), (501, ""), (502, " \n "), (3, rows[3][1]), (3, rows[9][1]), (None, rows[4][1]), (None, rows[4][1]), (503, long), (504, long + " end")]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def test_dedup_equals_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", i) for i, t in rows], "doc_id long, text string, _k string, dedup long").repartition(5)
    got, name = substring_dedup(docs)
    assert name == "dedup_" and got.columns == [*docs.columns, name]
    found = [(r[0], r[name].n_words, r[name].n_removed, r[name].kept) for r in got.collect()]
    assert order(found) == order(brute_dedup(rows))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(2, "a b"), (1, "a b")]])
def test_dedup_of_little(spark, rows):
    got, name = substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert order([(r.doc_id, r[name].n_words, r[name].n_removed, r[name].kept) for r in got.collect()]) == order(brute_dedup(rows))


def test_automaton_finds_first_owner():
    rng = random.Random(3)
    auto, texts = SuffixAutomaton(), []
    for owner in range(40):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 30))]
        known = [next((o for o, t in texts if any(t[k : k + 4] == words[i : i + 4] for k in range(len(t) - 3))), None) for i in range(len(words) - 3)]
        assert auto.first_owners(words, 4) == known
        auto.add(words, owner)
        texts.append((owner, words))


def test_dedup_query_on_test_data(spark):
    from corpusloom.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in brute_dedup(rows)]
    assert order([tuple(r) for r in QUERIES["op1_substring_dedup"](spark, d).collect()]) == order(want)


def brute_match(docs, items, window=10):
    pats = {}
    for name, text in items:
        words = PLAIN.findall(lower(text or ""))
        size = min(window, len(words))
        for j in range(len(words) - size + 1 if size else 0):
            pats.setdefault(tuple(words[j : j + size]), set()).add("" if name is None else str(name))
    sizes = {len(p) for p in pats}
    out = []
    for i, text in docs:
        words = PLAIN.findall(lower(text or ""))
        hit, names = set(), set()
        for size in sizes:
            for j in range(len(words) - size + 1):
                if found := pats.get(tuple(words[j : j + size])):
                    hit.update(range(j, j + size))
                    names |= found
        out.append((i, len(words), len(hit), sorted(names)))
    return out


@pytest.mark.parametrize("shard_bytes", [1 << 20, 300])
def test_matches_equal_brute_force(spark, shard_bytes):
    rng = random.Random(5)
    vocab = ["a", "B", "c3", "É", "dé"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(30)]
    items = [x for x in items if len(x[1].split()) not in (1,)] + [(7, items[7][1]), (None, "q r s t"), (99, None), (100, "!!"), (11, "zz")]
    docs = [(i, rng.choice([" ", "-", ",\n"]).join(rng.choice(vocab) for _ in range(rng.randint(0, 200)))) for i in range(60)]
    docs += [(70, None), (71, ""), (None, "Q! r?S T zz"), (72, " ".join(x[1] for x in items if x[1]) * 20)]
    got, name = match_benchmark(spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, benchmark_match int"), spark.createDataFrame(items, "item_id long, text string"), shard_bytes=shard_bytes)
    found = [(r.doc_id, r[name].n_words, r[name].n_hit, r[name]["items"]) for r in got.collect()]
    assert order(found) == order(brute_match(docs, items))
    for r in got.collect():
        assert sum(s.end - s.start for s in r[name].spans) == r[name].n_hit


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert match_benchmark(docs, items)[0].collect() == []
    got, name = match_benchmark(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), items)
    assert got.collect()[0][name].n_hit == 0


def test_shift_table_finds_overlaps():
    m = Matcher([("0", b"a a a"), ("1", b"a b a"), ("2", b"a")], 3)
    words = b"a a a a b a".split()
    assert sorted(s for s in m.find(words)[0] if s[1] - s[0] == 3) == [(0, 3), (1, 4), (3, 6)]
    assert m.find(words)[1] == {"0", "1", "2"} and m.find(b"b a b".split())[1] == {"2"}


def test_match_query_on_test_data(spark):
    from corpusloom.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{d}/{t}.parquet").select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    want = [(i, n, h, len(x), hashlib.sha256(",".join(x).encode()).hexdigest(), h > 0) for i, n, h, x in brute_match(docs, items)]
    assert order([tuple(r) for r in QUERIES["op2_decontamination"](spark, d).collect()]) == order(want)
    assert any(w[5] for w in want)

"""Greedy MinHash against a plain loop over the same signatures."""

from corpusloom.operators.minhash import bands_for, minhash_dedup, signatures


def looped(docs, threshold=0.85, permutations=128):
    bands, width = bands_for(threshold, permutations)
    seen, kept = set(), set()
    for i, text in sorted(docs):
        sign = signatures([text or ""], permutations)[0]
        own = {(b, sign[b * width : (b + 1) * width].tobytes()) for b in range(bands)}
        if not own & seen:
            kept.add(i)
            seen |= own
    return kept


def test_equals_a_loop(spark):
    words = [f"w{i}" for i in range(200)]
    docs = [(i, " ".join(words[2 * i : 2 * i + 60])) for i in range(60)]  # a chain of neighbours
    docs += [(100, None), (101, ""), (102, " "), (103, docs[0][1].upper()), (104, "alone")]
    got = {r.i for r in minhash_dedup(spark.createDataFrame(docs, "i long, t string"), "i", "t").collect()}
    assert got == looped(docs)
    assert 101 not in got and 103 not in got and {100, 104} <= got


def test_empty_table(spark):
    assert minhash_dedup(spark.createDataFrame([], "i long, t string"), "i", "t").count() == 0

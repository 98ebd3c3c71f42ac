"""Places in groups against a plain loop, with one group that holds most rows, null groups, ties and an empty table."""

from collections import Counter

from pyspark.sql import functions as F

from corpusloom.operators import select as S
from corpusloom.operators.filters import top_gram_share


def test_places_over_many_ranges(spark):
    given = [(i, None if i % 10 == 0 else "hot" if i % 10 < 8 else f"g{i % 7}", (i * 7919) % 1013) for i in range(3000)]
    rows = spark.createDataFrame(given, "id int, g string, v int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = S.numbered(rows, ["g"], [F.desc("v"), F.col("id")], "place", "n")
        assert got.select("id").distinct().count() == 3000
        plan = got.rdd.getNumPartitions()
        got = {r.id: (r.place, r.n) for r in got.collect()}
        whole = {r.id: r.place for r in S.numbered(rows, [], ["id"], "place").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert plan > 1
    size, place, want = Counter(g for _, g, _ in given), Counter(), {}
    for i, g, _v in sorted(given, key=lambda r: (-r[2], r[0])):
        place[g] += 1
        want[i] = (place[g], size[g])
    assert got == want
    assert whole == {i: i + 1 for i in range(3000)}


def test_ties_and_nothing(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1)], "g string, v int")
    assert sorted(r.p for r in S.numbered(rows, ["g"], ["v"], "p").collect()) == [1, 2, 3]
    assert S.numbered(rows.limit(0), ["g"], ["v"], "p", "n").collect() == []


def test_top_gram_in_the_row(spark):
    rows = spark.createDataFrame([(1, "a b c a b c a b"), (2, "a b"), (3, None), (4, "X x x x"), (5, "p q r"), (6, " w " * 20_000)], "i int, t string")
    assert {r.id: round(r.share, 6) for r in top_gram_share(rows, "i", "t").collect()} == {1: round(2 / 6, 6), 4: 1.0, 5: 1.0, 6: 1.0}

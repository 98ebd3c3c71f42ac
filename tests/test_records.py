"""Remote calls with stubs, and rows that must raise."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.operators import records as R
from corpusloom.operators import remote as X


def test_ask_retries_and_gives_up(spark):
    def make():
        calls = {}

        def client(prompt, endpoint):
            calls[prompt] = calls.get(prompt, 0) + 1
            if prompt == "never" or (prompt == "second" and calls[prompt] < 2):
                raise ValueError("busy")
            return None if prompt == "mute" else f"{prompt}@{endpoint}"

        return client

    rows = spark.createDataFrame([(1, "a"), (2, "second"), (3, "never"), (4, "mute"), (5, None)], "id int, prompt string").coalesce(1)
    got = {r.id: (r.response, r.response_error) for r in X.ask(rows, "prompt", make, ["x", "y"], pause=0.0, apart=0.0).collect()}
    assert got[1] == ("a@x", None) and got[2] == ("second@x", None)
    assert got[3] == (None, "busy") and got[4] == (None, "no answer") and got[5] == (None, None)


def test_left_out_keys_are_asked_alone(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    batched = spark.createDataFrame([(1, "a"), (2, None), (9, "z")], "k int, v string")
    got = X.batched_or_single(rows, "k", batched, lambda rest: rest.withColumn("v", F.lit("alone")), "v")
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, "alone"), (3, "alone")]


def test_rows_that_must_be_filled(spark):
    rows = spark.createDataFrame([("q", " ")], "p string, c string")
    assert R.sft_rows(rows, F.col("p"), F.col("c"), F.lit(None)).count() == 1
    with pytest.raises(PySparkException, match="empty completion"):
        R.sft_rows(rows, F.col("p"), F.col("c"), F.lit(None), strict=True).collect()
    with pytest.raises(ValueError):
        R.batches(rows, 0, "p")


def test_first_field_with_a_list_counts(spark):
    records = ['{"pairs": [], "response": [{"question": "q", "answer": "a"}]}', '{"response": "no", "generated": "[{\\"question\\": \\"q\\", \\"answer\\": \\"a\\"}]"}', '{"question": "q"}', None]
    got = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "i int, r string").select("i", R.extract_pairs(F.col("r")).alias("p")).collect()
    assert {r.i: [tuple(x) for x in r.p] for r in got} == {0: [], 1: [("q", "a")], 2: [], 3: []}

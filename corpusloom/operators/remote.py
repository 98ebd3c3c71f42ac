"""Remote calls as columns: a client is made in each task, so tests and offline runs put a function in its place."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import judge_object, strip_think

#: Takes a prompt and the endpoint to ask, gives an answer; None or an exception is a failure.
Client = Callable[[str, str], str | None]


def ask(rows: DataFrame, prompt: str, make: Callable[[], Client], endpoints: list[str], attempts: int = 3, pause: float = 5.0, apart: float = 0.5, name: str = "response") -> DataFrame:
    """Rows with the answer to their prompts, null after ``attempts`` failures, and ``<name>_error``, the last one's message.

    Endpoints take turns, calls of a task are ``apart`` seconds at least, and the n-th failure waits n times ``pause``.
    A null prompt isn't asked.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.StringType()), T.StructField(f"{name}_error", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, turn, last = make(), 0, 0.0
        for frame in frames:
            answers, errors = [], []
            for text in frame[prompt]:
                answer = error = None
                for n in range(attempts if text is not None else 0):
                    time.sleep(max(0.0, last + apart - time.monotonic()))
                    last = time.monotonic()
                    try:
                        answer = client(text, endpoints[turn % len(endpoints)])
                        error = None if answer is not None else "no answer"
                    except Exception as e:  # noqa: BLE001 - whatever a client raises is a failed call
                        error = str(e)
                    turn += 1
                    if answer is not None:
                        break
                    if n + 1 < attempts:
                        time.sleep(pause * (n + 1))
                answers.append(answer)
                errors.append(error)
            yield frame.assign(**{name: pd.Series(answers, index=frame.index, dtype=object), f"{name}_error": pd.Series(errors, index=frame.index, dtype=object)})

    return rows.mapInPandas(run, schema)


def generation_status(response: Column, pairs: Column) -> Column:
    """llm_empty, parse_failed (no list of pairs), no_pairs, or generated."""
    return F.when(F.coalesce(strip_think(response), F.lit("")) == "", "llm_empty").when(pairs.isNull(), "parse_failed").when(F.size(pairs) == 0, "no_pairs").otherwise("generated")


def batched_or_single(rows: DataFrame, key: str, batched: DataFrame, ask_single: Callable[[DataFrame], DataFrame], value: str) -> DataFrame:
    """(key, value): what a batched call returned for each key; keys that it left out are asked one by one."""
    known = batched.where(F.col(value).isNotNull()).groupBy(key).agg(F.first(value).alias(value))
    rest = ask_single(rows.join(known, key, "left_anti"))
    return rows.select(key).join(known, key).select(key, value).unionByName(rest.select(key, value))


def judged(rows: DataFrame, response: str, *yes: str, name: str = "verdict") -> DataFrame:
    """Rows with a boolean column for each criterion that the judge's answer names, ``all_passed`` and ``reason``; false where the answer doesn't parse."""
    got = rows.withColumn(name, judge_object(F.col(response)))
    says = {y: F.coalesce(F.lower(F.get_json_object(name, f"$.{y}")) == "true", F.lit(False)) for y in yes}
    every = F.lit(True)
    for c in says.values():
        every &= c
    return got.withColumns(says | {"all_passed": every, "reason": F.get_json_object(name, "$.reason")}).drop(name)

"""Identifiers from hashes."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def canonical_json(text: pd.Series) -> pd.Series:
    """JSON text with sorted keys, no spaces and ASCII escapes; null stays null."""
    return text.map(lambda t: None if t is None else json.dumps(json.loads(t), sort_keys=True, separators=(",", ":"), ensure_ascii=True))


def sha256_text(c: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(c, 256))


def sha256_json(c: Column) -> Column:
    return sha256_text(canonical_json(c))


def stable_id(prefix: str, *parts: Column) -> Column:
    """prefix_ and 24 hex digits of the hash of the parts as a JSON list; order counts."""
    listed = F.to_json(F.array(*(p.cast("string") for p in parts)))
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(canonical_json(listed), 256), 1, 24))


def json_parts(*parts: Column) -> list[Column]:
    """Each part as canonical JSON: texts, numbers, lists and structs; null as ``null``."""
    alone = (F.to_json(F.array(p), {"ignoreNullFields": "false"}) for p in parts)
    return [F.substring(t := canonical_json(x), F.lit(2), F.length(t) - 2) for x in alone]


def typed_id(prefix: str, *parts: Column) -> Column:
    """Like ``stable_id``, with parts of any type kept as they are."""
    listed = F.concat(F.lit("["), F.concat_ws(",", *json_parts(*parts)), F.lit("]"))
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(listed, 256), 1, 24))


def revision_id(url: Column, text: Column) -> Column:
    """A revision of an address: its text's hash."""
    return stable_id("srcrev", url, sha256_text(text))


def chunk_id(revision: Column, passage: Column, text: Column) -> Column:
    return stable_id("chunk", revision, passage, sha256_text(text))


def sample_id(stage: Column, url: Column, question: Column, answer: Column, entailment: Column, qa_type: Column, instr_type: Column, target: Column) -> Column:
    return stable_id("sample", stage, url, question, answer, entailment, qa_type, instr_type, target)


def entailment_id(revision: Column, passage: Column, index: Column, claim: Column, premises: Column) -> Column:
    return typed_id("ent", revision, passage, index, claim, premises)


def work_id(index: Column, sample: Column, stage: Column, passage: Column, url: Column, question: Column, answer: Column) -> Column:
    """A row's key for resuming; its position is part of it."""
    return typed_id("stage2qa", index, sample, stage, passage, url, question, answer)


def golden_id(corpus: Column, index: Column, prompt: Column, completion: Column) -> Column:
    """Of a sorted JSON object with a space behind each colon and comma."""
    fields = {"completion": completion, "corpus": corpus, "prompt": prompt, "source_index": index}
    cells = [F.concat(F.lit(f'"{name}": '), text) for name, text in zip(fields, json_parts(*fields.values()), strict=True)]
    return F.concat(F.lit("golden_"), F.substring(F.sha2(F.concat(F.lit("{"), F.concat_ws(", ", *cells), F.lit("}")), 256), 1, 24))


def version_id(name: Column, role: Column, inputs: Column, split: Column, hashes: Column, metrics: Column) -> Column:
    """A dataset version's id; when it was made is no part of it."""
    return typed_id("dsv", name, role, inputs, split, hashes, metrics)


def normalised_hash(c: Column) -> Column:
    """``sha256:`` and 64 lower-case hex digits, or null."""
    found = F.regexp_extract(F.lower(c), r"^(?:sha256:)?([0-9a-f]{64})$", 1)
    return F.when(found != "", F.concat(F.lit("sha256:"), found))


def pair_uid(passage: Column, question: Column) -> Column:
    return F.substring(F.sha1(F.concat(passage.cast("string"), F.lit("||"), question)), 1, 16)


def shard_index(c: Column, shards: int) -> Column:
    return (F.conv(F.substring(F.sha2(c.cast("string"), 256), 1, 16), 16, 10).cast("decimal(20,0)") % shards).cast("int")


def shard_label(index: Column, shards: int) -> Column:
    return F.format_string(f"shard-%05d-of-{shards:05d}", index)


def seeded(seed: int, *keys: Column) -> Column:
    """Sort key of a seeded draw, the same in any engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(k.cast("string") for k in keys)))

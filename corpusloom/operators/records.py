"""Row projections: from raw hits and generated records to samples, decisions and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ids import seeded, stable_id
from ..functions.text import or_empty, sft_text, strip, strip_fences, strip_think, token_estimate

_PAIRS = "array<struct<question:string,answer:string>>"
_NO_LIST = "array<string>"


def filled(c: Column) -> Column:
    """The text, or null if it is empty."""
    return F.nullif(c, F.lit(""))


def flatten_hits(hits: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id, url, chunk_index, text, doc_type, family, name, source_system, source_kind, modality) of index hits; those without address or text go."""
    at = lambda *paths: F.coalesce(*(filled(F.get_json_object(json_col, f"$.{p}")) for p in paths))
    meta, content, source = "metadata", "metadata.content_metadata", "metadata.source"
    origin = (f"{meta}.provenance", f"{content}.provenance")
    area = F.coalesce(at(f"{meta}.domain_area", f"{content}.domain_area", f"{meta}.product_family", f"{content}.product_family"), F.lit("unknown"))
    rows = hits.select(
        F.col(id_col).alias("id"),
        at(f"{content}.content_url", f"{content}.canonical_uri", *(f"{o}.canonical_uri" for o in origin), f"{source}.source_name").alias("url"),
        F.coalesce(at(f"{content}.chunk_index").try_cast("long"), F.lit(0)).alias("chunk_index"),
        strip(F.get_json_object(json_col, "$.text")).alias("text"),
        F.coalesce(at(f"{content}.document_type"), F.lit("text")).alias("doc_type"),
        area.alias("family"),
        F.coalesce(at(f"{meta}.domain_slice", f"{content}.domain_slice", f"{meta}.product_name", f"{content}.product_name"), area).alias("name"),
        *(at(f"{content}.{x}", f"{source}.{x}", *(f"{o}.{x}" for o in origin)).alias(x) for x in ("source_system", "source_kind", "modality")),
    )
    return rows.where(F.col("url").isNotNull() & (F.col("text") != ""))


def premises(rows: DataFrame, entailments: str) -> DataFrame:
    """A row for each premise of each entailment struct(conclusion, premises), with both positions from 0."""
    others = [c for c in rows.columns if c != entailments]
    each = rows.select(*others, F.posexplode(entailments).alias("entailment_index", "_e"))
    return each.select(*others, "entailment_index", F.col("_e.conclusion").alias("conclusion"), F.posexplode("_e.premises").alias("premise_index", "premise"))


def batches(rows: DataFrame, size: int, order: str, *by: str) -> DataFrame:
    """Rows with ``batch``: runs of ``size`` in the given order, within each key."""
    if size < 1:
        raise ValueError("a batch holds at least one row")
    return rows.withColumn("batch", F.floor((F.row_number().over(W.partitionBy(*by).orderBy(order)) - 1) / size))


def sft_rows(rows: DataFrame, prompt: Column, completion: Column, system: Column, strict: bool = False) -> DataFrame:
    """(prompt, completion, system); with ``strict`` a row with an empty side raises when it is read."""
    sure = lambda c, name: F.when(strip(c) != "", c).otherwise(F.raise_error(F.lit(f"empty {name}")).cast("string")) if strict else c
    return rows.select(sure(prompt, "prompt").alias("prompt"), sure(completion, "completion").alias("completion"), system.alias("system"))


def first_list(*lists: Column) -> Column:
    """The first list that isn't empty, else an empty one."""
    return F.coalesce(*(F.when(F.size(x) > 0, x) for x in lists), F.array().cast(_NO_LIST))


def as_list(text: Column, parse: bool = False) -> Column:
    """A text alone in a list, an empty list for none. ``parse``: JSON lists become lists of their filled items."""
    alone = F.when(or_empty(text) != "", F.array(text)).otherwise(F.array().cast(_NO_LIST))
    listed = F.filter(F.from_json(text, _NO_LIST), lambda x: x.isNotNull() & (x != ""))
    return F.when(strip(text).startswith("["), F.coalesce(listed, alone)).otherwise(alone) if parse else alone


def yes_score(c: Column) -> Column:
    return F.when(c, 1.0).when(~c, 0.0)


#: Types of questions and instructions that name a task.
QA_TASKS, INSTRUCTION_TASKS = ("bridging", "contrastive"), ("summary", "listicle", "procedural")
SYNTHETIC_STAGE = "1.5"


def dataset_samples(rows: DataFrame, sample: Column, system: Column | None = None) -> DataFrame:
    """Question-answer rows (stage, question, answer, qa_type, instr_type, family, target_family, entailment_id, grounded, source_systems) as samples."""
    made = F.col("stage") == SYNTHETIC_STAGE
    task = F.when(F.col("qa_type").isin(*QA_TASKS), F.col("qa_type")).when(F.col("instr_type").isin(*INSTRUCTION_TASKS), F.col("instr_type")).otherwise("qa")
    ids = F.when(or_empty(F.col("entailment_id")) != "", F.array("entailment_id")).otherwise(F.array().cast(_NO_LIST))
    gap = F.when(made, stable_id("gap", F.coalesce(filled(F.col("target_family")), F.col("family"))))
    lineage = F.struct(ids.alias("entailment_ids"), F.coalesce("source_systems", F.array().cast(_NO_LIST)).alias("source_systems"), gap.alias("gap_id"))
    return rows.withColumns({
        "sample_id": sample,
        "origin": F.when(made, "synthetic_gapfill").otherwise("source_entailed"),
        "task_type": task,
        "prompt": F.col("question"),
        "completion": F.col("answer"),
        "system": F.lit(None).cast("string") if system is None else system,
        "lineage": lineage,
        "grounding_score": yes_score(F.col("grounded")),
    })


def curator_records(samples: DataFrame) -> DataFrame:
    """Samples as the curator reads them; one without an id raises when it is read. Lists come from the lineage, else from the metadata."""
    known = F.when(or_empty(F.col("sample_id")) != "", F.col("sample_id")).otherwise(F.raise_error(F.lit("a sample without an id")).cast("string"))
    text = strip(sft_text(strip(F.col("prompt")), strip(F.col("completion"))))
    return samples.select(known.alias("id"), text.alias("text"), "prompt", "completion", "origin", "task_type", first_list(F.col("lineage.source_systems"), F.col("metadata.source_systems")).alias("source_systems"))


def token_counts(prompt: Column, completion: Column, total: Column, raw: Column, cleaned: Column, always_least: bool = False) -> Column:
    """struct of counts and shares of an answer; a missing count of the answer is estimated. Shares are null where it is 0.

    ``always_least`` bounds the cleaned count by its estimate even where nothing was stripped.
    """
    zero = F.lit(0).cast("long")
    count = F.coalesce(F.nullif(completion, zero), token_estimate(raw))
    least = F.least(count, token_estimate(cleaned))
    clean = least if always_least else F.when(or_empty(raw) != or_empty(cleaned), least).otherwise(count)
    asked = F.coalesce(prompt, zero)
    share = lambda x: F.when(count > 0, x / count)
    return F.struct(asked.alias("prompt_tokens"), count.alias("completion_tokens"), clean.alias("cleaned_tokens"), (count - clean).alias("think_tokens"), F.coalesce(F.nullif(total, zero), asked + count).alias("total_tokens"), share(clean).alias("cleaned_share"), share(count - clean).alias("overhead_share"))


def seed_urls(*lists: Column) -> Column:
    """The addresses of all lists once each, in the order of their first place."""
    return F.array_distinct(F.filter(F.concat(*(F.coalesce(x, F.array().cast(_NO_LIST)) for x in lists)), lambda x: or_empty(x) != ""))


def metric_rows(row: DataFrame) -> DataFrame:
    """(name, value double): the columns of a report."""
    return row.unpivot([], [F.col(c).cast("double").alias(c) for c in row.columns], "name", "value")


def without_nulls(**fields: Column) -> Column:
    """A map of the fields that aren't null."""
    pairs = [x for name, c in fields.items() for x in (F.lit(name), c.cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def decisions(rows: DataFrame, status: Column, refined: Column, surface: str, error: Column | None = None) -> DataFrame:
    """Rows with a judge's verdict (grounded, answer_fidelity, no_hallucination, repairable, reason) as decisions: those accepted or refined are admitted."""
    return rows.withColumns({
        "qa_status": status,
        "qa_admitted": status.isin("accepted", "refined"),
        "qa_refined": F.coalesce(refined, F.lit(False)),
        "qa_execution_surface": F.lit(surface),
        "qa_error": F.lit(None).cast("string") if error is None else error,
    })


def validation_sample(rows: DataFrame, key: str, size: int = 100, seed: int = 42) -> DataFrame:
    """So many rows in a seeded order, with their places from 0 (``size`` is what the report takes, so one task numbers them)."""
    drawn = rows.withColumn("_draw", seeded(seed, F.col(key))).orderBy("_draw", key).limit(size)
    return drawn.withColumn("ordinal", F.row_number().over(W.orderBy("_draw", key)) - 1).drop("_draw")


def restored(rows: DataFrame, position: str) -> DataFrame:
    """Rows in the order that they came in before they were worked on in parallel."""
    return rows.orderBy(position)


def _parsed(text: Column) -> tuple[Column, Column]:
    """(the pairs of a JSON text, or null; whether it is one that holds a list of pairs)."""
    bare = strip_fences(strip_think(text))
    inner = F.when(F.from_json(bare, "struct<pairs:string>")["pairs"].startswith("["), F.get_json_object(bare, "$.pairs"))
    widest = F.regexp_extract(bare, r"(?s)\{.*\}", 0)
    listed = F.coalesce(F.when(bare.startswith("["), bare), inner, F.when(F.get_json_object(widest, "$.pairs").startswith("["), F.get_json_object(widest, "$.pairs")))
    return F.from_json(listed, _PAIRS), listed.isNotNull()


def extract_pairs(record: Column) -> Column:
    """The question-answer pairs of a generated record (JSON): of the first field that holds a list of them, else the record's own.

    Think tags go; pairs with an empty side don't count.
    """
    lists = [F.when((got := _parsed(F.get_json_object(record, f"$.{name}")))[1], got[0]) for name in ("pairs", "qa_pairs_json", "generated_content", "generated", "response")]
    dotted = F.get_json_object(record, "$['qa_pairs_json.pairs']")
    own = [F.when((or_empty(q := F.get_json_object(record, f"$.{a}")) != "") & (or_empty(r := F.get_json_object(record, f"$.{b}")) != ""), F.array(F.struct(q.alias("question"), r.alias("answer")))) for a, b in (("question", "answer"), ("prompt", "completion"))]
    found = F.coalesce(*lists, *own, F.from_json(dotted, _PAIRS), F.array().cast(_PAIRS))
    clean = F.transform(found, lambda p: F.struct(strip_think(p["question"]).alias("question"), strip_think(p["answer"]).alias("answer")))
    return F.filter(clean, lambda p: (p["question"] != "") & (p["answer"] != ""))


def generated_rows(records: DataFrame, requests: DataFrame, record_col: str, gap_col: str, job: str, most: int = 5000) -> DataFrame:
    """A row for each pair of each record, with its request's slice and texts, cut to ``most`` characters.

    ``requests``: (gap, family, retrieved_chunks). A record whose gap has no request keeps its gap's name as its family.
    """
    met = records.join(requests.select(F.col(gap_col).alias("_gap"), "family", "retrieved_chunks"), F.col(gap_col) == F.col("_gap"), "left")
    each = met.select(F.col(gap_col).cast("string").alias("gap_id"), "family", "retrieved_chunks", F.posexplode(extract_pairs(F.col(record_col))).alias("pair_index", "pair"))
    family = F.coalesce("family", "gap_id")
    sample = stable_id("sample", F.lit("gapfill"), F.lit(job), F.col("gap_id"), F.col("pair_index"), F.col("pair.question"), F.col("pair.answer"))
    return each.select("gap_id", "pair_index", F.concat(F.lit("gapfill#"), "gap_id").alias("passage_id"), family.alias("family"), F.lit(SYNTHETIC_STAGE).alias("stage"), sample.alias("sample_id"), F.col("pair.question").alias("question"), F.col("pair.answer").alias("answer"), F.substring(or_empty(F.col("retrieved_chunks")), 1, most).alias("context"))

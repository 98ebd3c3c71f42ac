"""Text expressions. White space is ASCII unless a function says otherwise; null texts count as empty."""

from __future__ import annotations

import json
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[ \t\n\x0B\f\r]"
#: Patterns are the same in Spark's and DuckDB's regular expressions.
WORDS = r"[^ \t\n\x0B\f\r]+"


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def word_count(c: Column) -> Column:
    """Words between white space; the counter that stands in for a tokenizer where none is given."""
    return F.regexp_count(or_empty(c), F.lit(WORDS)).cast("long")


def token_estimate(c: Column) -> Column:
    """A quarter of the characters, rounded half to even, at least 1; 0 for an empty text."""
    n = F.length(or_empty(c))
    return F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), F.bround(n / 4, 0).cast("long"))).cast("long")


def strip(c: Column) -> Column:
    return F.btrim(or_empty(c), F.lit(" \t\n\x0b\f\r"))


def squeeze(c: Column) -> Column:
    """Every run of white space becomes one space, none at the ends."""
    return F.trim(F.regexp_replace(or_empty(c), f"{SPACE}+", " "))


def prompt_key(c: Column) -> Column:
    return F.lower(squeeze(c))


def question_key(c: Column) -> Column:
    """Lower case, letters, digits and underscores only."""
    return F.regexp_replace(F.lower(or_empty(c)), r"[^a-z0-9_]+", "")


def strip_fences(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(or_empty(c), r"(?m)^```(?:json)?\s*", ""), r"(?m)\s*```$", ""))


def strip_think(c: Column) -> Column:
    """Balanced reasoning blocks go, then all up to a lone closing tag, then all from a lone opening tag."""
    for pattern in (r"(?is)<think>.*?</think>\s*", r"(?is)^.*?</think>\s*", r"(?is)<think>.*$"):
        c = F.regexp_replace(or_empty(c), pattern, "")
    return strip(c)


def strip_think_exact(c: Column) -> Column:
    """The client's variant: case matters, white space stays, an open tag too."""
    for pattern in (r"(?s)<think>.*?</think>", r"(?s)^.*?</think>"):
        c = F.regexp_replace(or_empty(c), pattern, "")
    return strip(c)


def json_object(c: Column) -> Column:
    """The text as JSON without its fences, else its widest braces, else null; as a variant."""
    bare = strip_fences(c)
    return F.coalesce(F.try_parse_json(bare), F.try_parse_json(F.regexp_extract(bare, r"(?s)\{.*\}", 0)))


def excerpt(c: Column, limit: int = 800) -> Column:
    text = squeeze(c)
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.substring(text, 1, limit - 3), F.lit("...")))


def length_bin(prompt: Column, completion: Column) -> Column:
    n = F.length(or_empty(prompt)) + F.length(or_empty(completion))
    return F.when(n < 500, "short").when(n < 1200, "medium").otherwise("long")


#: The axes in order, and the words that name each.
AXES = (
    ("troubleshooting", "error|fail|fails|troubleshoot|issue|resolve|fix"),
    ("deployment", "kubernetes|helm|deploy|deployment|pod|pvc|service|container"),
    ("api", "endpoint|api|request|response|openai|grpc|http"),
    ("runtime-profiles", "profile|gpu|vram|fp8|bf16|lora|tensor parallel|throughput"),
    ("security", "secret|key|token|license|terms|authentication|authorization"),
    ("observability", "metric|prometheus|grafana|status|logging|trace"),
)
DEFAULT_AXIS = "grounded-qa-variation"


def coverage_axis(text: Column) -> Column:
    lower = F.lower(or_empty(text))
    return F.coalesce(*(F.when(lower.rlike(rf"\b({words})\b"), axis) for axis, words in AXES), F.lit(DEFAULT_AXIS))


def slug(c: Column) -> Column:
    c = F.regexp_replace(F.regexp_replace(or_empty(c), "/", "-"), r"[^A-Za-z0-9._+-]+", "-")
    c = F.lower(F.regexp_replace(F.regexp_replace(c, "-+", "-"), "^-+|-+$", ""))
    return F.when(c == "", "unknown").otherwise(c)


def metric_name(c: Column) -> Column:
    c = F.lower(F.regexp_replace(F.regexp_replace(or_empty(c), r"[^A-Za-z0-9]+", "_"), "^_+|_+$", ""))
    return F.when(c == "", "unknown").otherwise(c)


#: Fixed value: how a version is written.
VERSION = r"^(latest|stable|dev|main|nightly|v?[0-9]+([.][0-9]+)+([a-zA-Z0-9.-]*)?|[0-9]{4}-[0-9]{2}-[0-9]{2})$"


def url_parts(url: Column, prefix: str = "") -> Column:
    """struct(area, version, page): the first segment that looks like a version parts the path, without ``prefix`` if whole segments of it lead."""
    path = F.regexp_replace(F.regexp_replace(or_empty(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", ""), r"[?#].*$", "")
    path, lead = F.btrim(path, F.lit("/")), prefix.strip("/")
    if lead:
        path = F.when(path == lead, "").when(path.startswith(lead + "/"), F.substr(path, F.lit(len(lead) + 2))).otherwise(path)
    parts = F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(path, "/"))
    n = F.size(parts)
    at = F.coalesce(F.array_min(F.filter(F.transform(parts, lambda x, i: F.when(x.rlike(VERSION), i + 1)), lambda x: x.isNotNull())), F.lit(0))
    join = lambda a: F.array_join(a, "/")
    area = F.when(at > 0, join(F.slice(parts, F.lit(1), F.greatest(at - 1, F.lit(0))))).when(n <= 1, join(parts)).otherwise(join(F.slice(parts, F.lit(1), F.greatest(n - 1, F.lit(0)))))
    version = F.when(at > 0, F.try_element_at(parts, F.when(at > 0, at).otherwise(1))).otherwise("")
    page = F.when(at > 0, join(F.slice(parts, at + 1, F.greatest(n - at, F.lit(0))))).when(n > 1, F.try_element_at(parts, F.lit(-1))).otherwise("")
    return F.struct(area.alias("area"), version.alias("version"), page.alias("page"))


def url_variants(url: Column) -> Column:
    """The address as it is, without its fragment, and each without a slash at its end; in that order, once each."""
    bare = F.regexp_replace(url, "#.*$", "")
    cut = lambda c: F.regexp_replace(c, "/+$", "")
    return F.array_distinct(F.filter(F.array(url, bare, cut(url), cut(bare)), lambda x: x != ""))


def canonical_url(url: Column) -> Column:
    return F.substring_index(strip(url), "#", 1)


# fixed values: what is kept by the chunk, as text that isn't a web page
CHUNK_MODALITIES = ["document", "image", "audio", "video"]
CHUNK_SYSTEMS = ["document_capture", "image_dense_caption", "audio_transcript", "video_summary"]
CHUNK_KINDS = ["downloaded_asset", "dense_caption", "video_summary_text"]
CHUNK_ENDINGS = [".pdf", ".docx", ".pptx", ".doc", ".ppt"]


def doc_kind(url: Column, system: Column | None = None, modality: Column | None = None, kind: Column | None = None) -> Column:
    """pdf (kept by the chunk) by modality, source system, source kind or the address's ending, whatever the case; else html."""
    path = F.lower(F.regexp_replace(or_empty(url), r"[?#].*$", ""))
    by_chunk = F.lit(False)
    for ending in CHUNK_ENDINGS:
        by_chunk |= path.endswith(ending)
    for value, known in ((modality, CHUNK_MODALITIES), (system, CHUNK_SYSTEMS), (kind, CHUNK_KINDS)):
        if value is not None:
            by_chunk |= F.lower(or_empty(value)).isin(known)
    return F.when(by_chunk, "pdf").otherwise("html")


def split_prompt(prompt: Column) -> Column:
    """struct(context, question) at the last ``Question:`` line; without one both are the whole text."""
    marker = r"(?s)^(.*)\nQuestion:(.*)$"
    has = or_empty(prompt).rlike(marker)
    part = lambda i: F.when(has, strip(F.regexp_extract(prompt, marker, i))).otherwise(or_empty(prompt))
    return F.struct(part(1).alias("context"), part(2).alias("question"))


NO_CONTEXT = "(no relevant context found)"


def context_block(chunks: Column) -> Column:
    """``[i] url``, a line break and the text of each chunk struct(url, text), parted by a rule."""
    lines = F.transform(chunks, lambda c, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), c["url"], F.lit("\n"), c["text"]))
    return F.when(F.size(chunks) == 0, NO_CONTEXT).otherwise(F.array_join(lines, "\n\n---\n\n"))


def sft_text(question: Column, answer: Column) -> Column:
    return F.concat(F.lit("Question: "), or_empty(question), F.lit("\nAnswer: "), or_empty(answer))


def clamp_score(c: Column) -> Column:
    return F.least(F.lit(5), F.greatest(F.lit(1), F.coalesce(c.try_cast("int"), F.lit(0))))


def winner(c: Column) -> Column:
    w = F.upper(strip(c))
    return F.when(w.isin("A", "B"), w).otherwise("TIE")


def winner_side(w: Column, swapped: Column) -> Column:
    return F.when(w == "TIE", "tie").when((w == "A") != swapped, "left").otherwise("right")


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def finite(c: Column) -> Column:
    x = c.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


#: Colours of the scores 1 to 5.
SCORE_COLOURS = ((213, 94, 0), (230, 159, 0), (240, 228, 66), (0, 158, 115), (0, 114, 178))


def score_colour(score: Column) -> Column:
    s = F.least(F.lit(5.0), F.greatest(F.lit(1.0), score))
    low = F.least(F.floor(s), F.lit(4)).cast("int")
    t = s - low
    def channel(k: int) -> Column:
        a, b = (F.element_at(F.array(*(F.lit(c[k]) for c in SCORE_COLOURS)), low + d) for d in (0, 1))
        return F.bround(a + (b - a) * t, 0).cast("int").cast("string")
    return F.concat(F.lit("rgb("), F.concat_ws(",", channel(0), channel(1), channel(2)), F.lit(")"))


def _first_json(text: str | None, widest: bool) -> str | None:
    """The object in a judge's answer, as JSON text, or None."""
    if text is None:
        return None
    decoder, start = json.JSONDecoder(), text.find("{")
    tries = [lambda: json.loads(text)]
    if start >= 0:
        tries += [lambda: json.loads(text[start : text.rindex("}") + 1])] if widest else [lambda: decoder.raw_decode(text[start:])[0], lambda: json.loads(text[start : text.index("}", start) + 1])]
    for parse in tries:
        try:
            found = parse()
        except ValueError:
            continue
        return json.dumps(found, separators=(",", ":")) if isinstance(found, dict) else None
    return None


def judge_object(answer: Column, widest: bool = False) -> Column:
    """The JSON object of a judge's answer, think tags and fences off; null where none parses or the value is no object.

    The pairwise judge's form takes the first object, with any text behind it; ``widest`` takes all from the first brace to the last.
    """
    return F.pandas_udf(lambda t: t.map(lambda x: _first_json(x, widest)), "string")(strip_fences(strip_think(answer)))


#: Fixed value: names of adapters.
ADAPTER = r"^lora-(.+)-llama-(\d+(?:\.\d+)?-\d+b)-r(\d+)$"


def model_parts(model: Column) -> Column:
    """struct(target_type, corpus, base, target, rank, rank_slug) of a model's name; folders before it don't count."""
    name = F.element_at(F.split(model, "/"), -1)
    part = lambda i: F.regexp_extract(name, ADAPTER, i)
    lora = name.rlike(ADAPTER)
    plain = F.when(name.startswith("llama-") & name.endswith("-instruct"), F.regexp_replace(name, "-instruct$", "")).otherwise(name)
    return F.struct(
        F.when(lora, "lora").otherwise("base").alias("target_type"),
        F.when(lora, slug(part(1))).alias("corpus"),
        F.when(lora, F.concat(F.lit("llama-"), slug(part(2)))).otherwise(slug(plain)).alias("base"),
        F.when(lora, F.concat(F.lit("lora-"), slug(part(1)))).otherwise("base").alias("target"),
        F.when(lora, part(3).try_cast("int")).alias("rank"),
        F.when(lora, F.concat(F.lit("r"), part(3).try_cast("int").cast("string"))).otherwise("base").alias("rank_slug"),
    )


def join_within(texts: Column, most: int, between: str = "\n\n---\n\n") -> Column:
    """The stripped texts up to ``most`` characters, the last one cut; what stands between them isn't counted."""
    none = F.struct(F.lit(0).alias("n"), F.array().cast("array<string>").alias("kept"))

    def add(held: Column, text: Column) -> Column:
        part = F.substring(strip(text), F.lit(1), F.greatest(F.lit(0), F.lit(most) - held["n"]))
        return F.struct((held["n"] + F.length(part)).alias("n"), F.when(part != "", F.concat(held["kept"], F.array(part))).otherwise(held["kept"]).alias("kept"))

    return F.aggregate(texts, none, add, lambda held: F.array_join(held["kept"], between))


def first_words(text: Column, most: int) -> Column:
    """The text up to the end of so many words; stands in for a tokenizer's cut."""
    return F.regexp_extract(text, rf"^(?:{SPACE}*{WORDS}){{0,{most}}}", 0)


def neighbourhood(seed: Column, neighbours: Column, most: int, cut=first_words) -> Column:
    """The seed and its neighbours as lettered passages, cut to ``most`` tokens by ``cut``."""
    others = F.transform(neighbours, lambda t, i: F.concat(F.lit("Passage "), F.char(F.lit(66) + i), F.lit(":\n\n"), strip(t)))
    whole = F.array_join(F.concat(F.array(F.concat(F.lit("Passage A (seed):\n\n"), seed)), others), "\n\n")
    return F.when(word_count(whole) <= most, whole).otherwise(cut(whole, most)) if cut is first_words else cut(whole, most)


def heading_path(path: Column, text: Column, *fallbacks: Column) -> Column:
    """A list of headings; else ``a > b`` as a list; else the first filled fallback alone; else an empty list."""
    filled = lambda xs: F.filter(F.transform(xs, strip), lambda x: x != "")
    alone = [F.when(strip(c) != "", F.array(strip(c))) for c in fallbacks]
    return F.coalesce(filled(path), F.when(strip(text) != "", filled(F.split(text, ">"))), *alone, F.array().cast("array<string>"))


#: Keys whose values are secret, in lower case.
SECRET_KEYS = ("api_key", "authorization", "token", "access_token")


def _redacted(value):
    if isinstance(value, dict):
        return {k: "<redacted>" if k.lower() in SECRET_KEYS else _redacted(v) for k, v in value.items()}
    return [_redacted(v) for v in value] if isinstance(value, list) else value


def redact(text: Column) -> Column:
    """JSON text, sorted and without spaces, with secret values replaced at any depth."""
    return F.pandas_udf(lambda t: t.map(lambda x: None if x is None else json.dumps(_redacted(json.loads(x)), sort_keys=True, separators=(",", ":"))), "string")(text)


def fill(template: str, **columns: Column) -> Column:
    """A template with ``{name}`` for columns and doubled braces for braces; an unknown name raises."""
    cells = []
    for text, name, _, _ in string.Formatter().parse(template):
        if text:
            cells.append(F.lit(text))
        if name is not None:
            cells.append(or_empty(columns[name].cast("string")))
    return F.concat(*cells) if cells else F.lit("")


def usage(text: Column, blank_is_null: bool = False) -> Column:
    """struct(prompt_tokens, completion_tokens, total_tokens) of JSON text, whose counts may stand in a nested object.

    Missing counts are 0, a missing total is the sum. ``blank_is_null``: null where all are 0, as for logs.
    """
    inner = F.coalesce(*(F.when(F.get_json_object(text, f"$.{k}").startswith("{"), F.get_json_object(text, f"$.{k}")) for k in ("usage", "token_usage", "usage_metadata")), text)
    count = lambda *names: F.coalesce(*(F.nullif(F.get_json_object(inner, f"$.{n}").try_cast("long"), F.lit(0).cast("long")) for n in names), F.lit(0).cast("long"))
    prompt, completion = count("prompt_tokens", "input_tokens"), count("completion_tokens", "output_tokens")
    total = F.coalesce(F.nullif(count("total_tokens"), F.lit(0).cast("long")), prompt + completion)
    found = F.struct(prompt.alias("prompt_tokens"), completion.alias("completion_tokens"), total.alias("total_tokens"))
    return F.when((prompt != 0) | (completion != 0) | (total != 0), found) if blank_is_null else found

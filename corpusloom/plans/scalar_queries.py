"""Text, identifier and filter queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids as I
from ..functions import text as T
from ..operators import filters as P
from ..sources.tables import table

QUERIES, ORACLE_SQL = {}, {}


def query(name, source, key, columns, sql_columns):
    """One projection of a table and the same in SQL."""
    QUERIES[name] = lambda spark, folder: table(spark, folder, source).select(key, *(c().alias(n) for n, c in columns.items()))
    ORACLE_SQL[name] = f"SELECT {key}, {', '.join(f'{sql_columns[n]} AS {n}' for n in columns)} FROM {source}"


c = F.col
SP = r"[ \t\n\x0B\f\r]"
STRIP = rf"regexp_replace(coalesce(text,''), '^{SP}+|{SP}+$', '', 'g')"
SQUEEZE = rf"trim(regexp_replace(coalesce(text,''), '{SP}+', ' ', 'g'))"
WORDS = r"len(regexp_extract_all({}, '[^ \t\n\x0B\f\r]+'))"
NOISE_URL = "acknowledgement|acknowledge|third-party|thirdparty|open-source|opensource|legal|license-notice"

query("t1_word_tokens", "documents", "doc_id", {"tokens": lambda: T.word_count(c("text"))}, {"tokens": WORDS.format("coalesce(text,'')")})
query("t2_token_estimate", "documents", "doc_id", {"tokens": lambda: T.token_estimate(c("text"))}, {"tokens": "CASE WHEN length(coalesce(text,'')) = 0 THEN 0 ELSE greatest(1, CAST(round_even(length(text)/4, 0) AS BIGINT)) END"})
FENCED = "'```json' || chr(10) || coalesce(text,'') || chr(10) || '```'"
query("t3_strip_fences", "documents", "doc_id", {"bare": lambda: T.strip_fences(F.concat(F.lit("```json\n"), c("text"), F.lit("\n```")))}, {"bare": rf"regexp_replace(regexp_replace(regexp_replace({FENCED}, '(?m)^```(?:json)?\s*', '', 'g'), '(?m)\s*```$', '', 'g'), '^{SP}+|{SP}+$', '', 'g')"})
THOUGHT = "'pre</think> <THINK>' || coalesce(role,'') || chr(10) || '</think>  ' || coalesce(text,'') || '<think>open'"
query("t4_strip_think", "conversations", "conv_id, turn".split(", ")[0], {"turn_": lambda: c("turn"), "bare": lambda: T.strip_think(F.concat(F.lit("pre</think> <THINK>"), c("role"), F.lit("\n</think>  "), c("text"), F.lit("<think>open")))}, {"turn_": "turn", "bare": rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace({THOUGHT}, '(?is)<think>.*?</think>\s*', '', 'g'), '(?is)^.*?</think>\s*', '', 'g'), '(?is)<think>.*$', '', 'g'), '^{SP}+|{SP}+$', '', 'g')"})
CLIENT = "'<think>' || coalesce(role,'') || '</think> ' || coalesce(text,'')"
query("t4b_strip_think_exact", "conversations", "conv_id", {"turn_": lambda: c("turn"), "bare": lambda: T.strip_think_exact(F.concat(F.lit("<think>"), c("role"), F.lit("</think> "), c("text")))}, {"turn_": "turn", "bare": rf"regexp_replace(regexp_replace(regexp_replace({CLIENT}, '(?s)<think>.*?</think>', '', 'g'), '(?s)^.*?</think>', '', 'g'), '^{SP}+|{SP}+$', '', 'g')"})
query("t6_squeeze", "documents", "doc_id", {"text_": lambda: T.squeeze(c("text"))}, {"text_": SQUEEZE})
query("t7_prompt_key", "benchmark", "item_id", {"prompt_key": lambda: T.prompt_key(c("text"))}, {"prompt_key": f"lower({SQUEEZE})"})
query("t8_question_key", "benchmark", "item_id", {"question_key": lambda: T.question_key(c("text"))}, {"question_key": "regexp_replace(lower(coalesce(text,'')), '[^a-z0-9_]+', '', 'g')"})
query("t9_excerpt", "documents", "doc_id", {"excerpt": lambda: T.excerpt(c("text"))}, {"excerpt": f"CASE WHEN length({SQUEEZE}) <= 800 THEN {SQUEEZE} ELSE {SQUEEZE}[1:797] || '...' END"})
query("t10_length_bin", "documents", "doc_id", {"bin": lambda: T.length_bin(c("text"), c("source"))}, {"bin": "CASE WHEN length(coalesce(text,'')) + length(coalesce(source,'')) < 500 THEN 'short' WHEN length(coalesce(text,'')) + length(coalesce(source,'')) < 1200 THEN 'medium' ELSE 'long' END"})
query("t11_coverage_axis", "pages", "page_id", {"axis": lambda: T.coverage_axis(c("html"))}, {"axis": "CASE " + " ".join(rf"WHEN regexp_matches(lower(coalesce(html,'')), '\b({w})\b') THEN '{a}'" for a, w in T.AXES) + f" ELSE '{T.DEFAULT_AXIS}' END"})
query("t12_slug", "pages", "page_id", {"slug": lambda: T.slug(c("url"))}, {"slug": "coalesce(nullif(lower(regexp_replace(regexp_replace(regexp_replace(replace(coalesce(url,''), '/', '-'), '[^A-Za-z0-9._+-]+', '-', 'g'), '-+', '-', 'g'), '^-+|-+$', '', 'g')), ''), 'unknown')"})
query("t13_metric_name", "pages", "page_id", {"metric": lambda: T.metric_name(c("url")), "raw_metric": lambda: F.regexp_replace("url", "[^A-Za-z0-9]", "_")}, {"metric": "coalesce(nullif(lower(regexp_replace(regexp_replace(coalesce(url,''), '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')), ''), 'unknown')", "raw_metric": "regexp_replace(url, '[^A-Za-z0-9]', '_', 'g')"})
PATH = "regexp_replace(regexp_replace(regexp_replace(coalesce(url,''), '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*', ''), '[?#].*$', ''), '^/+|/+$', '', 'g')"
QUERIES["t15_url_parts"] = lambda spark, folder: table(spark, folder, "pages").select("page_id", T.url_parts(c("url")).alias("p")).select("page_id", "p.*")
ORACLE_SQL["t15_url_parts"] = f"""
WITH a AS (SELECT page_id, CASE WHEN {PATH} = '' THEN [] ELSE string_split({PATH}, '/') END AS p FROM pages),
b AS (SELECT *, coalesce(list_min([i FOR i IN range(1, len(p) + 1) IF regexp_matches(p[i], '{T.VERSION}')]), 0) AS i, len(p) AS n FROM a)
SELECT page_id, CASE WHEN i > 0 THEN array_to_string(p[1:i-1], '/') WHEN n <= 1 THEN array_to_string(p, '/') ELSE array_to_string(p[1:n-1], '/') END AS area,
  CASE WHEN i > 0 THEN p[i] ELSE '' END AS version, CASE WHEN i > 0 THEN array_to_string(p[i+1:n], '/') WHEN n > 1 THEN p[n] ELSE '' END AS page FROM b"""
query("t16_url_variants", "pages", "page_id", {"variants": lambda: F.array_join(T.url_variants(c("url")), " ")}, {"variants": "array_to_string([v FOR v, i IN [url, regexp_replace(url,'#.*$',''), regexp_replace(url,'/+$',''), regexp_replace(regexp_replace(url,'#.*$',''),'/+$','')] IF v <> '' AND list_position([url, regexp_replace(url,'#.*$',''), regexp_replace(url,'/+$',''), regexp_replace(regexp_replace(url,'#.*$',''),'/+$','')], v) = i], ' ')"})
query("t17_canonical_url", "pages", "page_id", {"canonical": lambda: T.canonical_url(c("url"))}, {"canonical": rf"split_part(regexp_replace(url, '^{SP}+|{SP}+$', '', 'g'), '#', 1)"})
SYSTEM = "CASE page_id % 5 WHEN 0 THEN 'Video_Summary' WHEN 1 THEN 'web' END"
query("t18_doc_kind", "pages", "page_id", {"kind": lambda: T.doc_kind(F.concat(c("url"), F.when(c("page_id") % 3 == 0, ".DOCX?x").otherwise("")), F.expr(SYSTEM))}, {"kind": rf"CASE WHEN lower(coalesce({SYSTEM}, '')) = 'video_summary' OR regexp_matches(lower(regexp_replace(url || CASE WHEN page_id % 3 = 0 THEN '.DOCX?x' ELSE '' END, '[?#].*$', '')), '[.](pdf|docx?|pptx?)$') THEN 'pdf' ELSE 'html' END"})
BAKED = "text || chr(10) || 'Question: a' || chr(10) || 'Question: ' || source"
QUERIES["t19_split_prompt"] = lambda spark, folder: table(spark, folder, "documents").select("doc_id", T.split_prompt(F.concat(c("text"), F.lit("\nQuestion: a\nQuestion: "), c("source"))).alias("p")).select("doc_id", "p.*")
ORACLE_SQL["t19_split_prompt"] = rf"SELECT doc_id, regexp_replace(regexp_extract({BAKED}, '(?s)^(.*)\nQuestion:(.*)$', 1), '^{SP}+|{SP}+$', '', 'g') AS context, regexp_replace(regexp_extract({BAKED}, '(?s)^(.*)\nQuestion:(.*)$', 2), '^{SP}+|{SP}+$', '', 'g') AS question FROM documents"
query("t23_sft_text", "benchmark", "item_id", {"sft": lambda: T.sft_text(c("item_id").cast("string"), c("text"))}, {"sft": "'Question: ' || item_id || chr(10) || 'Answer: ' || coalesce(text,'')"})
query("t27_clamp_score", "events", "event_id", {"score": lambda: T.clamp_score(F.floor(c("value")).cast("string"))}, {"score": "least(5, greatest(1, coalesce(TRY_CAST(CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS INTEGER), 0)))"})
query("t28_winner", "events", "event_id", {"side": lambda: T.winner_side(T.winner(F.substring("event_type", 1, 1)), c("event_id") % 2 == 0)}, {"side": "CASE WHEN upper(event_type[1:1]) NOT IN ('A','B') THEN 'tie' WHEN (upper(event_type[1:1]) = 'A') <> (event_id % 2 = 0) THEN 'left' ELSE 'right' END"})
query("t29_sigmoid", "events", "event_id", {"p": lambda: F.round(T.sigmoid(c("value") / 100), 9)}, {"p": "round(1/(1+exp(-(value/100))), 9)"})
query("t30_finite", "events", "event_id", {"metric": lambda: T.finite(c("value").cast("string")), "cut": lambda: F.substring("props", 1, 500)}, {"metric": "CASE WHEN isfinite(value) THEN value END", "cut": "props[1:500]"})
QUERIES["t31_score_colour"] = lambda spark, folder: table(spark, folder, "labels").select("doc_id", T.score_colour(c("quality") * 2.25 + 1.5).alias("colour"))
_mix = lambda k: "CAST(CAST(round_even(list_extract([" + ",".join(str(x[k]) for x in T.SCORE_COLOURS) + "], l) + (list_extract([" + ",".join(str(x[k]) for x in T.SCORE_COLOURS) + "], l + 1) - list_extract([" + ",".join(str(x[k]) for x in T.SCORE_COLOURS) + "], l)) * (s - l), 0) AS INTEGER) AS VARCHAR)"
ORACLE_SQL["t31_score_colour"] = f"WITH a AS (SELECT doc_id, CAST(least(5.0, greatest(1.0, quality * 2.25 + 1.5)) AS DOUBLE) AS s FROM labels), b AS (SELECT doc_id, s, least(CAST(floor(s) AS INTEGER), 4) AS l FROM a) SELECT doc_id, 'rgb(' || {_mix(0)} || ',' || {_mix(1)} || ',' || {_mix(2)} || ')' AS colour FROM b WHERE s IS NOT NULL UNION ALL SELECT doc_id, NULL FROM labels WHERE quality IS NULL"

query("h2_text_hash", "documents", "doc_id", {"hash": lambda: I.sha256_text(c("text"))}, {"hash": "'sha256:' || sha256(text)"})
query("h3_stable_id", "documents", "doc_id", {"id": lambda: I.stable_id("doc", c("doc_id"), c("source"), c("lang"))}, {"id": """'doc_' || sha256('["' || doc_id || '","' || source || '","' || lang || '"]')[1:24]"""})
query("h4_hash_form", "documents", "doc_id", {"hash": lambda: I.normalised_hash(F.upper(F.when(c("doc_id") % 2 == 0, F.sha2("text", 256)).otherwise(F.concat(F.lit("sha256:"), F.sha2("text", 256))))), "none": lambda: I.normalised_hash(c("source"))}, {"hash": "'sha256:' || sha256(text)", "none": "CAST(NULL AS VARCHAR)"})
query("h8_pair_uid", "documents", "doc_id", {"uid": lambda: I.pair_uid(c("doc_id"), c("text"))}, {"uid": "sha1(doc_id || '||' || text)[1:16]"})
query("h10_shard", "documents", "doc_id", {"shard": lambda: I.shard_index(c("doc_id"), 8), "label": lambda: I.shard_label(I.shard_index(c("doc_id"), 8), 8)}, {"shard": "CAST(CAST(('0x' || sha256(CAST(doc_id AS VARCHAR))[1:16]) AS UBIGINT) % 8 AS INTEGER)", "label": "'shard-' || lpad(CAST(CAST(('0x' || sha256(CAST(doc_id AS VARCHAR))[1:16]) AS UBIGINT) % 8 AS VARCHAR), 5, '0') || '-of-00008'"})

_noise_sql = rf"""{WORDS.format(STRIP)} < 60 OR regexp_matches(lower(coalesce(source,'')), '{NOISE_URL}') OR regexp_matches(lower({STRIP}), '^({'|'.join(p.replace('(', chr(92) + '(').replace(')', chr(92) + ')') for p in P.LICENCE_PREFIXES)})')
 OR regexp_matches({STRIP}, '{P.LICENCE_TEXT.replace("'", "''")}')
 OR (len(regexp_split_to_array({STRIP}, '{P.LINE_END}')) > 5 AND len([x FOR x IN regexp_split_to_array({STRIP}, '{P.LINE_END}') IF regexp_matches(x, '^\s*- \[')]) / len(regexp_split_to_array({STRIP}, '{P.LINE_END}')) > 0.6)
 OR (length({STRIP}) > 0 AND coalesce(list_sum([length(x) FOR x IN regexp_extract_all({STRIP}, '(?s)```.*?```')]), 0) / greatest(length({STRIP}), 1) > 0.85)"""
query("f1_noise", "documents", "doc_id", {"noise": lambda: P.is_noise(c("text"), c("source"))}, {"noise": _noise_sql})
query("f3_f4_answer_filters", "documents", "doc_id", {"long_enough": lambda: P.long_enough(c("text"), c("source")), "in_question": lambda: P.answer_in_question(c("text"), F.substring("text", 3, 20))}, {"long_enough": f"{WORDS.format('coalesce(text,{0}{0})').format(chr(39))} >= 12 AND {WORDS.format('coalesce(source,{0}{0})').format(chr(39))} >= 8", "in_question": "regexp_replace(lower(coalesce(text[3:22],'')), '[^a-z0-9_]+', '', 'g') <> '' AND contains(regexp_replace(lower(coalesce(text,'')), '[^a-z0-9_]+', '', 'g'), regexp_replace(lower(coalesce(text[3:22],'')), '[^a-z0-9_]+', '', 'g'))"})
query("f6_f7_quality_shares", "documents", "doc_id", {"other": lambda: F.round(P.other_character_share(c("text")), 9), "unended": lambda: F.round(P.unended_share(c("text")), 9)}, {"other": "CASE WHEN length(coalesce(text,'')) > 0 THEN round(length(regexp_replace(text, '[A-Za-z0-9 \\t\\n\\r]', '', 'g')) / length(text), 9) ELSE 0.0 END".replace("\\\\", "\\"), "unended": "coalesce(round(len([x FOR x IN string_split(coalesce(text,''), chr(10)) IF trim(x) <> '' AND NOT regexp_matches(x, '[.!?\"''][ \\t\\r]*$')]) / nullif(len([x FOR x IN string_split(coalesce(text,''), chr(10)) IF trim(x) <> '']), 0), 9), 0.0)"})


def f8_top_gram(spark, folder):
    return P.top_gram_share(table(spark, folder, "documents"), "doc_id", "text").select(c("id").alias("doc_id"), F.round("share", 9).alias("share"))


QUERIES["f8_top_gram"] = f8_top_gram
ORACLE_SQL["f8_top_gram"] = rf"""
WITH w AS (SELECT doc_id, string_split(lower({SQUEEZE}), ' ') AS w FROM documents),
g AS (SELECT doc_id, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
n AS (SELECT doc_id, g, count(*) AS n FROM g GROUP BY ALL) SELECT doc_id, round(max(n) / sum(n), 9) AS share FROM n GROUP BY doc_id"""


def f9_score_and_part(spark, folder):
    scored = P.score_and_part(table(spark, folder, "documents").select("doc_id", "text"), "text", {"word_count": (8, 1200), "other_characters": (0.0, 0.35)})
    return scored.select("doc_id", "word_count", F.round("other_characters", 9).alias("other_characters"), "retained")


QUERIES["f9_score_and_part"] = f9_score_and_part
_other = "CASE WHEN length(coalesce(text,'')) > 0 THEN length(regexp_replace(text, '[A-Za-z0-9 \\t\\n\\r]', '', 'g')) / length(text) ELSE 0.0 END"
ORACLE_SQL["f9_score_and_part"] = f"SELECT doc_id, {WORDS.format(chr(116) + 'ext')} AS word_count, round({_other}, 9) AS other_characters, {WORDS.format('text')} BETWEEN 8 AND 1200 AND {_other} BETWEEN 0.0 AND 0.35 AS retained FROM documents"
query("f13_path_contains", "pages", "page_id", {"inside": lambda: F.contains(F.regexp_replace("url", "^[a-z]+://[^/]*", ""), F.lit("a"))}, {"inside": "contains(regexp_replace(url, '^[a-z]+://[^/]*', ''), 'a')"})
query("k4_density_score", "events", "event_id", {"density": lambda: F.round((lambda t: F.when(t > 0, c("value") * 3 / F.when(t > 0, t) * 1000).otherwise(0.0))(c("user_id") % 50), 6)}, {"density": "CASE WHEN user_id % 50 > 0 THEN round(value * 3 / (user_id % 50) * 1000, 6) ELSE 0.0 END"})

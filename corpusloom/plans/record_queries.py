"""Identifiers, records, manifests and evaluation rollups over the driver's tables.

The tables have no such records, so each query first gives columns the parts that a record would have.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids as I
from ..functions import text as T
from ..operators import match as M
from ..operators import records as R
from ..operators import remote as X
from ..operators import rollups as A
from ..operators import select as S
from ..sources.tables import table
from .table_queries import PAIRS, pairs

QUERIES, ORACLE_SQL = {}, {}
c = F.col
SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
BARE = f"trim({{}}, {SPACES})"


def query(name, sql):
    def put(f):
        QUERIES[name] = f
        ORACLE_SQL[name] = sql
        return f

    return put


def sql_id(prefix, body):
    return f"'{prefix}_' || substr(sha256({body}), 1, 24)"


REVISION = sql_id("srcrev", """'["https://p/' || page_id || '","sha256:' || sha256(html) || '"]'""")


CHUNK = sql_id("chunk", """'["' || rev || '","' || page_id || '","sha256:' || sha256(html) || '"]'""")


@query("h5_revision_ids", f"SELECT page_id, rev, {CHUNK} AS chunk FROM (SELECT *, {REVISION} AS rev FROM pages)")
def h5(spark, folder):
    pages = table(spark, folder, "pages").withColumn("rev", I.revision_id(F.concat(F.lit("https://p/"), c("page_id").cast("string")), c("html")))
    return pages.select("page_id", "rev", I.chunk_id(c("rev"), c("page_id"), c("html")).alias("chunk"))


@query("h6_sample_ids", "SELECT o_orderkey, " + sql_id("sample", """'["1a","u","' || o_orderpriority || '","' || o_orderstatus || '",null,null,null,null]'""") + " AS sample, " + sql_id("ent", """'["r","' || o_custkey || '",' || o_orderkey || ',"' || o_orderstatus || '",["' || o_orderpriority || '","x"]]'""") + " AS entailment FROM orders")
def h6(spark, folder):
    none = F.lit(None).cast("string")
    sample = I.sample_id(F.lit("1a"), F.lit("u"), c("o_orderpriority"), c("o_orderstatus"), none, none, none, none)
    entailment = I.entailment_id(F.lit("r"), c("o_custkey").cast("string"), c("o_orderkey"), c("o_orderstatus"), F.array("o_orderpriority", F.lit("x")))
    return table(spark, folder, "orders").select("o_orderkey", sample.alias("sample"), entailment.alias("entailment"))


@query("h7_work_ids", "SELECT o_orderkey, " + sql_id("stage2qa", """'[' || o_orderkey || ',"s","1a","p","u","' || o_orderpriority || '",null]'""") + " AS work FROM orders")
def h7(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", I.work_id(c("o_orderkey"), F.lit("s"), F.lit("1a"), F.lit("p"), F.lit("u"), c("o_orderpriority"), F.lit(None).cast("string")).alias("work"))


@query("h9_golden_ids", "SELECT o_orderkey, " + sql_id("golden", """'{"completion": "' || o_orderpriority || '", "corpus": "c1", "prompt": null, "source_index": ' || o_orderkey || '}'""") + " AS golden FROM orders")
def h9(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", I.golden_id(F.lit("c1"), c("o_orderkey"), F.lit(None).cast("string"), c("o_orderpriority")).alias("golden"))


@query("h11_version_id", "SELECT " + sql_id("dsv", """'["docs","blended",{"gap":null,"ids":["a"]},{"train":' || n || '},{},{"rows":' || n || '}]'""") + " AS version FROM (SELECT count(*) AS n FROM documents)")
def h11(spark, folder):
    n = table(spark, folder, "documents").agg(F.count("*").alias("n"))
    inputs = F.struct(F.array(F.lit("a")).alias("ids"), F.lit(None).cast("string").alias("gap"))
    return n.select(I.version_id(F.lit("docs"), F.lit("blended"), inputs, F.struct(c("n").alias("train")), F.create_map().cast("map<string,string>"), F.struct(c("n").alias("rows"))).alias("version"))


@query("t5_json_object", "SELECT event_id, CASE WHEN event_id % 3 < 2 THEN CAST(props::JSON ->> '$.k' AS INTEGER) END AS k FROM events")
def t5(spark, folder):
    answer = F.when(c("event_id") % 3 == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(c("event_id") % 3 == 1, F.concat(F.lit("So: "), "props", F.lit(" done"))).otherwise("none")
    return table(spark, folder, "events").select("event_id", F.try_variant_get(T.json_object(answer), "$.k", "int").alias("k"))


@query("t5b_judge_object", "SELECT event_id, CASE WHEN event_id % 3 < 2 THEN replace(props, ' ', '') END AS found FROM events")
def t5b(spark, folder):
    answer = F.when(c("event_id") % 3 == 0, F.concat(F.lit("<think>hm {</think>Sure: "), "props", F.lit(" and {"))).when(c("event_id") % 3 == 1, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).otherwise("[1]")
    return table(spark, folder, "events").select("event_id", T.judge_object(answer).alias("found"))


MODEL = "CASE WHEN s_suppkey % 2 = 0 THEN 'org/lora-My Corpus-llama-3.' || s_suppkey || '-8b-r' || s_nationkey ELSE 'llama-3.1-8b-instruct' END"


@query("t14_model_parts", "SELECT s_suppkey, CASE WHEN e THEN 'lora' ELSE 'base' END AS target_type, CASE WHEN e THEN 'my-corpus' END AS corpus, CASE WHEN e THEN 'llama-3.' || s_suppkey || '-8b' ELSE 'llama-3.1-8b' END AS base, CASE WHEN e THEN 'lora-my-corpus' ELSE 'base' END AS target, CASE WHEN e THEN s_nationkey END AS rank, CASE WHEN e THEN 'r' || s_nationkey ELSE 'base' END AS rank_slug FROM (SELECT *, s_suppkey % 2 = 0 AS e FROM supplier)")
def t14(spark, folder):
    return table(spark, folder, "supplier").select("s_suppkey", T.model_parts(F.expr(MODEL)).alias("m")).select("s_suppkey", "m.*")


@query("t20_context_block", "SELECT conv_id, string_agg('[' || turn0 + 1 || '] ' || role || chr(10) || coalesce(text,''), chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY turn) AS block FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn0 FROM conversations) GROUP BY conv_id")
def t20(spark, folder):
    g = table(spark, folder, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", c("role").alias("url"), F.coalesce("text", F.lit("")).alias("text")))).alias("t"))
    return g.select("conv_id", T.context_block(c("t")).alias("block"))


@query("t21_join_within", f"SELECT conv_id, coalesce(string_agg(part, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY turn) FILTER (part <> ''), '') AS joined FROM (SELECT conv_id, turn, substr(t, 1, CAST(greatest(0, 300 - coalesce(sum(length(t)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS BIGINT)) AS part FROM (SELECT conv_id, turn, {BARE.format('text')} AS t FROM conversations)) GROUP BY conv_id")
def t21(spark, folder):
    g = table(spark, folder, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    return g.select("conv_id", T.join_within(F.transform("t", lambda x: x["text"]), 300).alias("joined"))


@query("t22_neighbourhood", r"SELECT conv_id, CASE WHEN len(regexp_extract_all(w, '[^ \t\n\x0B\f\r]+')) <= 60 THEN w ELSE regexp_extract(w, '^(?:[ \t\n\x0B\f\r]*[^ \t\n\x0B\f\r]+){0,60}', 0) END AS context FROM (SELECT conv_id, 'Passage A (seed):' || chr(10) || chr(10) || string_agg(CASE WHEN r = 1 THEN text ELSE 'Passage ' || chr(CAST(64 + r AS INTEGER)) || ':' || chr(10) || chr(10) || " + BARE.format("text") + r" END, chr(10) || chr(10) ORDER BY r) AS w FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations) GROUP BY conv_id)")
def t22(spark, folder):
    g = table(spark, folder, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    texts = F.transform("t", lambda x: x["text"])
    return g.select("conv_id", T.neighbourhood(F.element_at(texts, 1), F.slice(texts, F.lit(2), F.size(texts)), 60).alias("context"))


@query("t24_heading_path", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN replace(p_type, ' ', '|') WHEN 1 THEN p_name ELSE p_brand END AS path FROM part")
def t24(spark, folder):
    k = c("p_partkey") % 3
    path = T.heading_path(F.lit(None).cast("array<string>"), F.when(k == 0, F.concat(F.regexp_replace("p_type", " ", " > "), F.lit(" > "))), F.when(k == 1, c("p_name")), c("p_brand"))
    return table(spark, folder, "part").select("p_partkey", F.array_join(path, "|").alias("path"))


@query("t25_redact", """SELECT event_id, '{"a":[{"Token":"<redacted>"}],"b":' || replace(props, ' ', '') || ',"token":"<redacted>"}' AS safe FROM events""")
def t25(spark, folder):
    raw = F.concat(F.lit('{"token": "x", "b": '), "props", F.lit(', "a": [{"Token": {"y": 1}}]}'))
    return table(spark, folder, "events").select("event_id", T.redact(raw).alias("safe"))


@query("t26_fill", "SELECT r_regionkey, 'Ask ' || r_regionkey || ' about ' || r_name || ': {x}' AS prompt FROM region")
def t26(spark, folder):
    return table(spark, folder, "region").select("r_regionkey", T.fill("Ask {n} about {topic}: {{x}}", n=c("r_regionkey"), topic=c("r_name")).alias("prompt"))


@query("t32_usage", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN user_id ELSE 0 END AS prompt_tokens, CASE WHEN event_id % 2 = 0 THEN 5 ELSE 0 END AS completion_tokens, CASE WHEN event_id % 2 = 0 THEN user_id + 5 ELSE 0 END AS total_tokens, event_id % 2 <> 0 AS blank FROM events")
def t32(spark, folder):
    raw = F.when(c("event_id") % 2 == 0, F.concat(F.lit('{"token_usage": {"input_tokens": '), c("user_id").cast("string"), F.lit(', "completion_tokens": 5}}'))).otherwise('{"usage": {}}')
    e = table(spark, folder, "events").select("event_id", T.usage(raw).alias("u"), T.usage(raw, blank_is_null=True).isNull().alias("blank"))
    return e.select("event_id", "u.*", "blank")


@query("p1_flatten_hits", f"SELECT page_id AS id, url, CAST(page_id % 4 AS BIGINT) AS chunk_index, {BARE.format('html')} AS text, 'text' AS doc_type, CASE WHEN page_id % 2 = 0 THEN 'f' ELSE 'unknown' END AS family, CASE WHEN page_id % 2 = 0 THEN 'f' ELSE 'unknown' END AS name, CASE WHEN page_id % 3 = 0 THEN 'crawl' END AS source_system FROM pages WHERE {BARE.format('html')} <> ''")
def p1(spark, folder):
    k = c("page_id")
    content = F.struct(F.when(k % 2 == 0, "").otherwise(c("url")).alias("content_url"), c("url").alias("canonical_uri"), (k % 4).alias("chunk_index"))
    hit = F.struct(c("html").alias("text"), F.struct(content.alias("content_metadata"), F.struct(F.when(k % 3 == 0, "crawl").alias("source_system")).alias("source"), F.when(k % 2 == 0, "f").alias("product_family")).alias("metadata"))
    hits = table(spark, folder, "pages").select("page_id", F.to_json(hit).alias("hit"))
    return R.flatten_hits(hits, "page_id", "hit").select("id", "url", "chunk_index", "text", "doc_type", "family", "name", "source_system")


@query("p2_premises", "SELECT conv_id, CAST(e AS INTEGER) AS entailment_index, role AS conclusion, p AS premise_index, CASE p WHEN 0 THEN role ELSE role || '!' END AS premise FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS e FROM conversations), (VALUES (0), (1)) v(p)")
def p2(spark, folder):
    e = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: F.struct(x["role"].alias("conclusion"), F.array(x["role"], F.concat(x["role"], F.lit("!"))).alias("premises")))
    return R.premises(table(spark, folder, "conversations").groupBy("conv_id").agg(e.alias("entailments")), "entailments")


@query("p3_batches", "SELECT o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 3 AS batch FROM orders")
def p3(spark, folder):
    return R.batches(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), 3, "o_orderkey", "o_custkey").select("o_orderkey", "batch")


@query("p4_sft_rows", f"SELECT question AS prompt, answer AS completion, 'be brief' AS system FROM {PAIRS}")
def p4(spark, folder):
    return R.sft_rows(pairs(spark, folder), c("question"), c("answer"), F.lit("be brief"), strict=True)


def samples(spark, folder):
    k = c("conv_id")
    stage = F.element_at(F.array(F.lit("1a"), F.lit("1.5"), F.lit("2")), (k % 3 + 1).cast("int"))
    rows = pairs(spark, folder).withColumns({"stage": stage, "qa_type": F.when(k % 4 == 0, "bridging"), "instr_type": F.when(k % 4 < 2, "summary"), "family": F.concat(F.lit("f"), (k % 2).cast("string")), "target_family": F.when(k % 5 == 0, "t").otherwise(""), "entailment_id": F.when(k % 3 == 0, "e1"), "grounded": F.when(k % 3 > 0, k % 2 == 0), "source_systems": F.when(k % 2 == 0, F.array(F.lit("crawl")))})
    return R.dataset_samples(rows, F.concat_ws("-", "conv_id", "turn"))


GAP = sql_id("gap", """'["' || CASE WHEN conv_id % 5 = 0 THEN 't' ELSE 'f' || conv_id % 2 END || '"]'""")


@query("p5_samples", f"SELECT conv_id, turn, conv_id || '-' || turn AS sample_id, CASE WHEN conv_id % 3 = 1 THEN 'synthetic_gapfill' ELSE 'source_entailed' END AS origin, CASE WHEN conv_id % 4 = 0 THEN 'bridging' WHEN conv_id % 4 = 1 THEN 'summary' ELSE 'qa' END AS task_type, question AS prompt, answer AS completion, CASE WHEN conv_id % 3 = 0 THEN 'e1' ELSE '' END AS entailments, CASE WHEN conv_id % 3 = 1 THEN {GAP} END AS gap_id, CASE WHEN conv_id % 3 > 0 THEN CASE WHEN conv_id % 2 = 0 THEN 1.0 ELSE 0.0 END END AS grounding_score FROM {PAIRS}")
def p5(spark, folder):
    return samples(spark, folder).select("conv_id", "turn", "sample_id", "origin", "task_type", "prompt", "completion", F.array_join("lineage.entailment_ids", ",").alias("entailments"), c("lineage.gap_id").alias("gap_id"), "grounding_score")


@query("p6_curator_records", f"SELECT conv_id || '-' || turn AS id, {BARE.format(chr(39) + 'Question: ' + chr(39) + ' || ' + BARE.format('question') + ' || chr(10) || ' + chr(39) + 'Answer: ' + chr(39) + ' || ' + BARE.format('answer'))} AS text, CASE WHEN conv_id % 2 = 0 THEN 'crawl' ELSE 'meta' END AS systems FROM {PAIRS}")
def p6(spark, folder):
    rows = samples(spark, folder).withColumn("metadata", F.struct(F.array(F.lit("meta")).alias("source_systems")))
    return R.curator_records(rows).select("id", "text", F.array_join("source_systems", ",").alias("systems"))


EST = "CAST(round_even({}/4, 0) AS BIGINT)"


@query("p7_token_counts", f"WITH d AS (SELECT doc_id, length(text) + 18 AS n, greatest(CASE WHEN length(b) > 0 THEN 1 ELSE 0 END, {EST.format('length(b)')}) AS clean FROM (SELECT *, {BARE.format('text')} AS b FROM documents)) SELECT doc_id, 7 AS prompt_tokens, {EST.format('n')} AS completion_tokens, least(clean, {EST.format('n')}) AS cleaned_tokens, {EST.format('n')} - least(clean, {EST.format('n')}) AS think_tokens, 7 + {EST.format('n')} AS total_tokens, least(clean, {EST.format('n')}) / {EST.format('n')} AS cleaned_share FROM d")
def p7(spark, folder):
    raw, none = F.concat(F.lit("<think>abc</think>"), "text"), F.lit(None).cast("long")
    got = R.token_counts(F.lit(7).cast("long"), none, none, raw, T.strip_think(raw))
    return table(spark, folder, "documents").select("doc_id", got.alias("t")).select("doc_id", *(f"t.{x}" for x in ("prompt_tokens", "completion_tokens", "cleaned_tokens", "think_tokens", "total_tokens", "cleaned_share")))


@query("p8_as_list", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'x,' || event_type WHEN 1 THEN event_type ELSE '' END AS parsed, CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 1 ELSE 0 END AS plain FROM events")
def p8(spark, folder):
    raw = F.when(c("event_id") % 3 == 0, F.concat(F.lit('["x","",null,"'), "event_type", F.lit('"]'))).when(c("event_id") % 3 == 1, c("event_type"))
    return table(spark, folder, "events").select("event_id", F.array_join(R.as_list(raw, parse=True), ",").alias("parsed"), F.size(R.as_list(raw)).alias("plain"))


@query("p9_first_list", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE '' END AS got FROM events")
def p9(spark, folder):
    empty = F.array().cast("array<string>")
    k = c("event_id") % 3
    return table(spark, folder, "events").select("event_id", F.array_join(R.first_list(F.when(k == 0, F.array(F.lit("a"))).when(k == 1, empty), F.when(k == 2, empty).otherwise(F.array(F.lit("b")))), ",").alias("got"))


@query("p10_seed_urls", "SELECT s_suppkey, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') AS urls FROM (SELECT s_suppkey, ['u' || s_suppkey % 5, 'u' || s_nationkey % 5, 'u' || s_nationkey % 5, 'u0'] AS l FROM supplier)")
def p10(spark, folder):
    u = lambda x: F.concat(F.lit("u"), (c(x) % 5).cast("string"))
    return table(spark, folder, "supplier").select("s_suppkey", F.array_join(R.seed_urls(F.array(u("s_suppkey"), u("s_nationkey")), F.array(u("s_nationkey"), F.lit(""), F.lit("u0"))), ",").alias("urls"))


@query("p11_metric_rows", "SELECT 'documents' AS name, CAST(count(*) AS DOUBLE) AS value FROM documents UNION ALL SELECT 'characters', CAST(sum(n_chars) AS DOUBLE) FROM documents UNION ALL SELECT 'languages', CAST(count(DISTINCT lang) AS DOUBLE) FROM documents")
def p11(spark, folder):
    return R.metric_rows(table(spark, folder, "documents").agg(F.count("*").alias("documents"), F.sum("n_chars").alias("characters"), F.countDistinct("lang").alias("languages")))


@query("p12_provenance", f"SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'stored' ELSE {REVISION} END AS revision FROM pages")
def p12(spark, folder):
    own = I.revision_id(F.concat(F.lit("https://p/"), c("page_id").cast("string")), c("html"))
    return table(spark, folder, "pages").select("page_id", F.coalesce(F.when(c("page_id") % 2 == 0, "stored"), own).alias("revision"))


@query("p13_without_nulls", "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'etag,name' ELSE 'name' END AS keys FROM supplier")
def p13(spark, folder):
    got = R.without_nulls(name=c("s_name"), etag=F.when(c("s_suppkey") % 2 == 0, "e"), gone=F.lit(None))
    return table(spark, folder, "supplier").select("s_suppkey", F.array_join(F.array_sort(F.map_keys(got)), ",").alias("keys"))


@query("p14_decisions", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'accepted' WHEN 1 THEN 'refined' ELSE 'dropped' END AS qa_status, event_id % 3 < 2 AS qa_admitted, event_id % 3 = 1 AS qa_refined, 'batch' AS qa_execution_surface FROM events")
def p14(spark, folder):
    status = F.element_at(F.array(F.lit("accepted"), F.lit("refined"), F.lit("dropped")), (c("event_id") % 3 + 1).cast("int"))
    return R.decisions(table(spark, folder, "events"), status, c("event_id") % 3 == 1, "batch").select("event_id", "qa_status", "qa_admitted", "qa_refined", "qa_execution_surface")


@query("p15_validation_sample", "SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) - 1 AS ordinal FROM labels QUALIFY ordinal < 100")
def p15(spark, folder):
    return R.validation_sample(table(spark, folder, "labels").select("doc_id"), "doc_id")


@query("p16_restored", "SELECT doc_id, n_chars FROM documents ORDER BY doc_id")
def p16(spark, folder):
    return R.restored(table(spark, folder, "documents").select("doc_id", "n_chars").orderBy("n_chars"), "doc_id")


@query("a2_revisions", "SELECT 'https://c/' || conv_id AS url, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text, count(*) AS passages, CASE WHEN count(DISTINCT up) = 1 THEN min(up) ELSE " + sql_id("srcrev", """'["https://c/' || conv_id || '","sha256:' || sha256(string_agg(text, chr(10) || chr(10) ORDER BY turn)) || '"]'""") + " END AS revision FROM (SELECT *, CASE WHEN conv_id % 2 = 0 THEN role ELSE 'up' || conv_id END AS up FROM conversations) GROUP BY conv_id")
def a2(spark, folder):
    t = table(spark, folder, "conversations").withColumns({"url": F.concat(F.lit("https://c/"), c("conv_id").cast("string")), "up": F.when(c("conv_id") % 2 == 0, c("role")).otherwise(F.concat(F.lit("up"), c("conv_id").cast("string")))})
    return A.revisions(t, "url", "turn", "text", "up")


@query("a3_crawl_run", "SELECT " + sql_id("crawlrun", """'["idx","2026-01-01T00:00:00Z"]'""") + " AS crawl_run_id, (SELECT count(*) FROM pages) AS raw_chunk_count, (SELECT count(*) FROM documents) AS passage_count")
def a3(spark, folder):
    return A.crawl_run(table(spark, folder, "pages"), table(spark, folder, "documents"), "idx", "2026-01-01T00:00:00Z")


REQUESTS = f"""(SELECT source, n AS pairs_needed, greatest(1, CAST(ceil(n / 5) AS BIGINT)) AS num_records, retrieved, seed_styles FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)
 JOIN (SELECT source, coalesce(string_agg(part, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY doc_id) FILTER (part <> ''), '') AS retrieved FROM (SELECT source, doc_id, substr(t, 1, CAST(greatest(0, 500 - coalesce(sum(length(t)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS BIGINT)) AS part
   FROM (SELECT source, doc_id, {BARE.format("coalesce(text,'')")} AS t, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r <= 3) GROUP BY source) USING (source)
 JOIN (SELECT source, string_agg('- q' || doc_id, chr(10) ORDER BY r) AS seed_styles FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY md5('42|' || doc_id)) AS r FROM documents) WHERE r <= 3 GROUP BY source) USING (source))"""


def requests(spark, folder):
    docs = table(spark, folder, "documents")
    gaps = docs.groupBy("source").agg((F.count("*") * 2).alias("target"), F.count("*").alias("observed"))
    asked = docs.select("source", "doc_id", F.concat(F.lit("q"), c("doc_id").cast("string")).alias("question"))
    return A.gap_requests(gaps, docs.select("source", "doc_id", "text"), asked, "source", "doc_id", top=3, most=500)


@query("a6_gap_requests", f"SELECT * FROM {REQUESTS}")
def a6(spark, folder):
    return requests(spark, folder)


@query("a29_plan_totals", f"SELECT count(DISTINCT source) AS gaps_requested, count(*) AS seed_records, sum(num_records)::BIGINT AS records_requested, sum(pairs_needed)::BIGINT AS pairs_requested FROM {REQUESTS}")
def a29(spark, folder):
    return A.plan_totals(requests(spark, folder), "source")


def generated(spark, folder):
    """Records of three kinds: a list of pairs, an object in a fenced text, and one pair of its own."""
    pair = F.struct(F.concat(F.lit("<think>x</think> "), "question").alias("question"), "answer")
    both = F.array(pair, F.struct(F.lit("").alias("question"), c("answer")))
    fenced = F.concat(F.lit("Here:\n```json\n"), F.to_json(F.struct(both.alias("pairs"))), F.lit("\n```"))
    kinds = [F.to_json(F.struct(both.alias("pairs"))), F.to_json(F.struct(fenced.alias("response"))), F.to_json(F.struct(c("question").alias("prompt"), c("answer").alias("completion")))]
    k = c("conv_id") % 3
    return pairs(spark, folder).withColumn("record", F.when(k == 0, kinds[0]).when(k == 1, kinds[1]).otherwise(kinds[2]))


@query("a7_extract_pairs", f"SELECT conv_id, turn, {BARE.format('question')} AS question, {BARE.format('answer')} AS answer FROM {PAIRS} WHERE {BARE.format('question')} <> '' AND {BARE.format('answer')} <> ''")
def a7(spark, folder):
    return generated(spark, folder).select("conv_id", "turn", F.explode(R.extract_pairs(c("record"))).alias("p")).select("conv_id", "turn", "p.*")


@query("a8_generated_rows", f"SELECT CAST(conv_id AS VARCHAR) AS gap_id, 'gapfill#' || conv_id AS passage_id, CASE WHEN conv_id % 2 = 0 THEN 'f' || conv_id ELSE CAST(conv_id AS VARCHAR) END AS family, 0 AS pair_index, {BARE.format('question')} AS question, CASE WHEN conv_id % 2 = 0 THEN repeat('c', 50) ELSE '' END AS context FROM {PAIRS} WHERE {BARE.format('question')} <> '' AND {BARE.format('answer')} <> ''")
def a8(spark, folder):
    asked = table(spark, folder, "conversations").where("conv_id % 2 = 0").select("conv_id").distinct().select("conv_id", F.concat(F.lit("f"), c("conv_id").cast("string")).alias("family"), F.lit("c" * 60).alias("retrieved_chunks"))
    return R.generated_rows(generated(spark, folder), asked, "record", "conv_id", "job", most=50).select("gap_id", "passage_id", "family", "pair_index", "question", "context")


@query("a11_dataset_role", "SELECT source, CASE WHEN s > 0 AND g > 0 THEN 'blended' WHEN s > 0 THEN 'synthetic_gapfill' ELSE 'source_entailed' END AS role FROM (SELECT source, count(*) FILTER (lang = 'de') AS s, count(*) FILTER (lang = 'en') AS g FROM documents GROUP BY source)")
def a11(spark, folder):
    g = table(spark, folder, "documents").groupBy("source").agg(F.count_if(c("lang") == "de").alias("s"), F.count_if(c("lang") == "en").alias("g"))
    return g.select("source", A.dataset_role(c("s"), c("g"), F.lit("")).alias("role"))


@query("a14_registry_metrics", "SELECT count(*) AS record_count, count(*) AS content_hash_count, count(*) FILTER (page_id % 4 = 0) AS etag_count, 0::BIGINT AS redirect_count, count(DISTINCT url) AS matched_url_count, (SELECT count(DISTINCT url) FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 2 = 0)) AS unmatched_url_count FROM pages WHERE page_id % 2 = 0")
def a14(spark, folder):
    pages = table(spark, folder, "pages")
    registry = pages.where("page_id % 2 = 0").select("url", F.sha2("html", 256).alias("content_hash"), F.when(c("page_id") % 4 == 0, "e").alias("etag"), F.lit("").alias("redirect_to"))
    return A.registry_metrics(registry, pages, "url")


@query("a21_completion_totals", "WITH l AS (SELECT user_id, arg_max(event_id, event_id) AS completion_tokens, arg_max(event_id % 7, event_id) AS think_tokens FROM events WHERE event_type <> 'error' GROUP BY user_id) SELECT count(*) AS rows_completed, sum(completion_tokens)::BIGINT AS completion_tokens, sum(think_tokens)::BIGINT AS think_tokens, (SELECT count(DISTINCT user_id) FROM events WHERE event_type = 'error' AND user_id NOT IN (SELECT user_id FROM l)) AS rows_failed, sum(think_tokens) / sum(completion_tokens) AS overhead_ratio FROM l")
def a21(spark, folder):
    e = table(spark, folder, "events")
    done = e.where("event_type <> 'error'").select("user_id", "event_id", c("event_id").alias("completion_tokens"), (c("event_id") % 7).alias("think_tokens"))
    return A.completion_totals(done, e.where("event_type = 'error'"), "user_id", "event_id", ["completion_tokens", "think_tokens"])


@query("a22_retrieval_audit", "WITH o AS (SELECT l_orderkey, count(*) FILTER (l_quantity > 25) AS kept, max(l_discount) AS best FROM lineitem GROUP BY l_orderkey) SELECT avg(kept) AS mean_kept, " + ", ".join(f"count(*) FILTER (kept = {k}) AS kept_{k}" for k in range(6)) + ", count(*) FILTER (kept = 0) / count(*) * 100 AS empty_percent, min(best) AS least_score, list(best ORDER BY best)[count(*) // 2 + 1] AS middle_score, max(best) AS most_score FROM o")
def a22(spark, folder):
    o = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.count_if(c("l_quantity") > 25).alias("kept"), F.max("l_discount").alias("best"))
    return A.retrieval_audit(o, "kept", "best")


MEANS = "SELECT l_returnflag AS target, l_linestatus AS mode, l_linenumber AS axis, avg(l_quantity) AS score, count(*) FILTER (l_quantity > 49) AS failed FROM lineitem GROUP BY ALL"


@query("a24_composites", f"SELECT target, round(w, 6) AS without, round(h, 6) AS with_context, round(h - w, 6) AS delta, CASE WHEN f > 0 THEN 'incomplete' ELSE 'complete' END AS status FROM (SELECT target, avg(score) FILTER (mode = 'F') AS w, avg(score) FILTER (mode = 'O') AS h, max(failed) AS f FROM ({MEANS}) GROUP BY target)")
def a24(spark, folder):
    means = table(spark, folder, "lineitem").groupBy(c("l_returnflag").alias("target"), c("l_linestatus").alias("mode"), "l_linenumber").agg(F.avg("l_quantity").alias("score"), F.count_if(c("l_quantity") > 49).alias("failed"))
    return A.composites(means, "target", "mode", "score", "failed", "O", "F").select("target", *(F.round(x, 6).alias(x) for x in ("without", "with_context", "delta")), "status")


@query("a25_seed_run", "SELECT event_type AS source, count(*) AS candidates, count(*) FILTER (event_id % 2 = 0) AS records, coalesce(sum(user_id) FILTER (event_id % 2 = 0), 0)::BIGINT AS prompt_tokens, 3 * count(*) FILTER (event_id % 2 = 0) AS completion_tokens, coalesce(sum(user_id + 3) FILTER (event_id % 2 = 0), 0)::BIGINT AS total_tokens FROM events GROUP BY event_type")
def a25(spark, folder):
    even = c("event_id") % 2 == 0
    return A.seed_run_metrics(table(spark, folder, "events").select("event_type", F.when(even, c("user_id")).alias("p"), F.when(even, F.lit(3).cast("long")).alias("q")), "event_type", "p", "q").select("source", "candidates", "records", "prompt_tokens", "completion_tokens", "total_tokens")


@query("a27_estimated_tokens", "SELECT s_suppkey, CAST(round_even(s_nationkey / 8 * s_suppkey, 0) AS BIGINT) AS prompt, 0::BIGINT AS completion, CAST(round_even(s_nationkey / 8 * s_suppkey, 0) AS BIGINT) AS total FROM supplier")
def a27(spark, folder):
    got = A.estimated_tokens(c("s_suppkey"), c("s_nationkey") / 8, F.lit(None).cast("double"))
    return table(spark, folder, "supplier").select("s_suppkey", got.alias("t")).select("s_suppkey", "t.*")


@query("k5_target_count", "SELECT source, CASE WHEN n <= 100 THEN n ELSE least(n, greatest(100, CAST(floor(n * 0.25) AS BIGINT))) END AS target FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)")
def k5(spark, folder):
    return table(spark, folder, "documents").groupBy("source").agg(F.count("*").alias("n")).select("source", S.target_count(c("n")).cast("long").alias("target"))


@query("k6_top_density", "SELECT doc_id FROM documents ORDER BY n_chars % 97 DESC, doc_id LIMIT 50")
def k6(spark, folder):
    return S.top_density(table(spark, folder, "documents").select("doc_id", "n_chars"), c("n_chars") % 97, "doc_id", 50).select("doc_id")


@query("k13_remainder_split", "SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY source ORDER BY md5('42|' || doc_id), doc_id) <= greatest(1, floor(count(*) OVER (PARTITION BY source) * 0.05)) THEN 'validation' ELSE 'train' END AS split FROM documents")
def k13(spark, folder):
    return S.remainder_split(table(spark, folder, "documents").select("doc_id", "source"), "source", "doc_id").select("doc_id", "split")


@query("k14_subsample", "SELECT doc_id FROM documents ORDER BY md5('42|' || doc_id), doc_id LIMIT 100")
def k14(spark, folder):
    return S.subsample(table(spark, folder, "documents").select("doc_id"), "doc_id", 100)


@query("r3b_completions_to_do", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type IN ('purchase', 'error'))")
def r3b(spark, folder):
    e = table(spark, folder, "events").select(c("user_id").alias("c_custkey"), "event_type")
    return M.completions_to_do(table(spark, folder, "customer").select("c_custkey"), e.where("event_type = 'purchase'"), e.where("event_type = 'error'"), "c_custkey")


@query("r6_batches_to_do", "SELECT o_orderkey FROM orders WHERE o_custkey % 10 NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey % 2 = 0)")
def r6(spark, folder):
    done = table(spark, folder, "supplier").select(c("s_suppkey").alias("batch"), F.when(c("s_nationkey") % 2 == 0, "completed").otherwise("failed").alias("status"))
    return M.batches_to_do(table(spark, folder, "orders").select("o_orderkey", (c("o_custkey") % 10).alias("batch")), done, "batch").select("o_orderkey")


@query("x3_generation_status", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'llm_empty' WHEN 1 THEN 'parse_failed' WHEN 2 THEN 'no_pairs' ELSE 'generated' END AS status FROM events")
def x3(spark, folder):
    k = c("event_id") % 4
    response = F.when(k == 0, "<think>a</think> ").when(k == 1, "no json").when(k == 2, "[]").otherwise('[{"question": "q", "answer": "a"}]')
    return table(spark, folder, "events").select("event_id", X.generation_status(response, R._parsed(response)[0]).alias("status"))


@query("x5_judged", "SELECT event_id, event_id % 3 = 0 AS grounded, event_id % 3 <> 2 AS faithful, event_id % 3 = 0 AS all_passed, CASE WHEN event_id % 3 < 2 THEN 'r' END AS reason FROM events")
def x5(spark, folder):
    k = c("event_id") % 3
    answer = F.when(k == 0, 'Yes: {"grounded": true, "faithful": true, "reason": "r"}').when(k == 1, '{"grounded": "no", "faithful": true, "reason": "r"}').otherwise("?")
    return X.judged(table(spark, folder, "events").select("event_id", answer.alias("response")), "response", "grounded", "faithful").drop("response")

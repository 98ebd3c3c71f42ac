"""Matching, filtering by other tables, reranking, augmenting and resuming over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators import match as M
from ..operators.minhash import minhash_dedup
from ..operators.nearest import nearest
from ..sources.tables import table

QUERIES, ORACLE_SQL = {}, {}
c = F.col
KEY = r"lower(regexp_replace(coalesce(text,''), '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g'))"


def query(name, sql):
    def put(f):
        QUERIES[name] = f
        ORACLE_SQL[name] = sql
        return f

    return put


def keyed(spark, folder, name, id_col):
    return table(spark, folder, name).select(id_col, F.lower(strip(c("text"))).alias("key"))


@query("j1_must_match", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def j1(spark, folder):
    left = table(spark, folder, "orders").select("o_orderkey", c("o_custkey").alias("k"))
    right = table(spark, folder, "customer").select(c("c_custkey").alias("k"), "c_name", c("c_custkey").alias("pos"))
    return M.must_match(left, right, "k", "pos").select("o_orderkey", "c_name", "k").where("k is not null").drop("k")


@query("j3_url_registry", "WITH reg AS (SELECT split_part(url, '?', 1) AS k, min(page_id) AS hit FROM pages GROUP BY 1), v AS (SELECT page_id, url AS k, 1 AS r FROM pages UNION ALL SELECT page_id, split_part(url, '#', 1), 2 FROM pages UNION ALL SELECT page_id, split_part(url, '?', 1), 3 FROM pages) SELECT page_id, arg_min(hit, r) AS hit, min(CASE WHEN hit IS NOT NULL THEN r END) AS rank FROM v LEFT JOIN reg USING (k) GROUP BY page_id")
def j3(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    part = lambda mark: F.split_part("url", F.lit(mark), F.lit(1))
    registry = pages.select(part("?").alias("k"), c("page_id").alias("hit"), c("page_id").alias("pos"))
    return M.first_hit(pages, "page_id", [c("url"), part("#"), part("?")], registry, "k", "hit", "pos")


@query("j4_first_with_value", "SELECT o_orderkey, p AS first_part FROM orders LEFT JOIN (SELECT l_orderkey, arg_min(l_partkey, l_linenumber * 10000000000 + l_partkey) AS p FROM lineitem WHERE l_discount > 0 GROUP BY l_orderkey) ON o_orderkey = l_orderkey")
def j4(spark, folder):
    first = table(spark, folder, "lineitem").where("l_discount > 0").groupBy(c("l_orderkey").alias("o_orderkey")).agg(F.min(F.struct("l_linenumber", "l_partkey")).l_partkey.alias("first_part"))
    return table(spark, folder, "orders").select("o_orderkey").join(first, "o_orderkey", "left")


@query("j6_sidecar_merge", "SELECT d.doc_id, coalesce(l.quality, d.n_chars) AS lineage, coalesce(d.source, CAST(l.toxic AS VARCHAR)) AS metadata, CASE WHEN l.doc_id IS NOT NULL THEN 'sidecar' ELSE 'base' END AS origin FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def j6(spark, folder):
    side = table(spark, folder, "labels").withColumn("_hit", F.lit(True))
    both = table(spark, folder, "documents").select("doc_id", "source", "n_chars").join(side, "doc_id", "left")
    return both.select("doc_id", F.coalesce("quality", "n_chars").alias("lineage"), F.coalesce("source", c("toxic").cast("string")).alias("metadata"), F.when(c("_hit"), "sidecar").otherwise("base").alias("origin"))


@query("j10_matched_then_rest", f"WITH d AS (SELECT doc_id, {KEY} AS k FROM documents), b AS (SELECT item_id, {KEY} AS k FROM benchmark) SELECT 'matched' AS kind, CAST(min(doc_id) AS VARCHAR) AS id FROM d WHERE k IN (SELECT k FROM b) GROUP BY k UNION ALL SELECT 'unmatched', CAST(item_id AS VARCHAR) FROM b WHERE k NOT IN (SELECT k FROM d)")
def j10(spark, folder):
    docs, wanted = keyed(spark, folder, "documents", "doc_id"), keyed(spark, folder, "benchmark", "item_id").withColumn("item_id", c("item_id").cast("string"))
    return M.matched_then_rest(docs, wanted, "key", "doc_id", "item_id").select("kind", c("id").cast("string").alias("id"))


@query("j12_unreturned", "SELECT doc_id, 'no_record' AS reason FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def j12(spark, folder):
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left_anti").select("doc_id", F.lit("no_record").alias("reason"))


@query("j14_prompt_leakage", f"SELECT count(*) AS prompts, count(*) FILTER (WHERE k IN (SELECT {KEY} FROM documents)) AS leaked FROM (SELECT {KEY} AS k FROM benchmark)")
def j14(spark, folder):
    known = keyed(spark, folder, "documents", "doc_id").select("key").distinct().withColumn("_hit", F.lit(1))
    return keyed(spark, folder, "benchmark", "item_id").join(known, "key", "left").agg(F.count("*").alias("prompts"), F.count("_hit").alias("leaked"))


@query("j16_two_keys", "SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 'label' WHEN v.vec_id IS NOT NULL THEN 'vector' END AS via FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN embeddings v ON d.doc_id = v.vec_id")
def j16(spark, folder):
    got = table(spark, folder, "documents").select("doc_id").join(table(spark, folder, "labels").select("doc_id", F.lit(True).alias("a")), "doc_id", "left")
    got = got.join(table(spark, folder, "embeddings").select(c("vec_id").alias("doc_id"), F.lit(True).alias("b")), "doc_id", "left")
    return got.select("doc_id", F.when(c("a"), "label").when(c("b"), "vector").alias("via"))


@query("j19_batched_responses", "SELECT c_custkey, e AS event_id, e IS NULL AS fallback FROM customer LEFT JOIN (SELECT user_id, min(event_id) AS e FROM events GROUP BY user_id) ON c_custkey = user_id")
def j19(spark, folder):
    returned = table(spark, folder, "events").select(c("user_id").alias("c_custkey"), "event_id", c("event_id").alias("pos"))
    return M.returned_or_fallback(table(spark, folder, "customer"), returned, "c_custkey", "pos", "event_id")


@query("d8_unique_evidence", "SELECT word, min(doc_id) AS doc_id FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS word FROM documents) GROUP BY word")
def d8(spark, folder):
    lines = table(spark, folder, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("word"))
    return lines.groupBy("word").agg(F.min("doc_id").alias("doc_id"))


@query("d9_usage_triples", "SELECT count(*) AS calls, CAST(sum(l_quantity) AS DOUBLE) AS total FROM (SELECT DISTINCT l_partkey, l_suppkey, l_quantity FROM lineitem)")
def d9(spark, folder):
    return table(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_quantity").distinct().agg(F.count("*").alias("calls"), F.sum("l_quantity").cast("double").alias("total"))


@query("f2_essential_fields", r"SELECT page_id FROM pages WHERE coalesce(url, '') <> '' AND regexp_matches(coalesce(html, ''), '[^ \t\n\x0B\f\r]')")
def f2(spark, folder):
    return table(spark, folder, "pages").where((F.coalesce("url", F.lit("")) != "") & F.coalesce("html", F.lit("")).rlike(r"[^ \t\n\x0B\f\r]")).select("page_id")


@query("f10_exclusion_reason", f"SELECT doc_id, CASE WHEN k IN (SELECT {KEY} FROM benchmark) THEN 'overlap' WHEN contains(k, '.pdf') THEN 'pdf_context' WHEN k = '' THEN 'no_context' WHEN NOT contains(k, '.') THEN 'missing_required' END AS reason FROM (SELECT doc_id, {KEY} AS k FROM documents)")
def f10(spark, folder):
    known = keyed(spark, folder, "benchmark", "item_id").select("key").distinct().withColumn("_hit", F.lit(True))
    k = c("key")
    reason = F.when(c("_hit"), "overlap").when(k.contains(".pdf"), "pdf_context").when(k == "", "no_context").when(~k.contains("."), "missing_required")
    return keyed(spark, folder, "documents", "doc_id").join(known, "key", "left").select("doc_id", reason.alias("reason"))


@query("f11_allowed_after_rank", "SELECT user_id, count(*) FILTER (WHERE event_type IN ('click', 'purchase')) AS kept, count(*) FILTER (WHERE event_type NOT IN ('click', 'purchase')) AS filtered FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events) WHERE r <= 5 GROUP BY user_id")
def f11(spark, folder):
    allowed = c("event_type").isin("click", "purchase")
    ranked = table(spark, folder, "events").withColumn("r", F.row_number().over(W.partitionBy("user_id").orderBy(F.desc("value"), "event_id"))).where("r <= 5")
    return ranked.groupBy("user_id").agg(F.count_if(allowed).alias("kept"), F.count_if(~allowed).alias("filtered"))


@query("f12_kind_by_id", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def f12(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "lang").join(table(spark, folder, "labels").where("quality = 1"), "doc_id", "left_semi")


@query("f14_type_whitelist", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view', 'purchase') AND coalesce(props, '') <> ''")
def f14(spark, folder):
    return table(spark, folder, "events").where(c("event_type").isin("click", "view", "purchase") & (F.coalesce("props", F.lit("")) != "")).select("event_id", "event_type")


@query("f15_constraints", "SELECT count(*) FILTER (WHERE NOT (l_discount BETWEEN 0 AND 1)) AS discount, count(*) FILTER (WHERE NOT (l_quantity BETWEEN 1 AND 50)) AS quantity, count(*) FILTER (WHERE NOT (l_tax <= 2 * l_discount)) AS tax FROM lineitem")
def f15(spark, folder):
    bad = {"discount": ~c("l_discount").between(0, 1), "quantity": ~c("l_quantity").between(1, 50), "tax": ~(c("l_tax") <= 2 * c("l_discount"))}
    return table(spark, folder, "lineitem").agg(*(F.count_if(rule).alias(name) for name, rule in bad.items()))


@query("f16_upstream_ids", "SELECT page_id, CASE WHEN starts_with(v, 'https://') THEN v END AS upstream FROM (SELECT page_id, coalesce(nullif(url, ''), nullif(html, '')) AS v FROM pages)")
def f16(spark, folder):
    v = F.coalesce(F.nullif("url", F.lit("")), F.nullif("html", F.lit("")))
    return table(spark, folder, "pages").select("page_id", F.when(v.startswith("https://"), v).alias("upstream"))


RANKED = "(SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank FROM events WHERE value >= 50)"


def reranked(spark, folder):
    """Five best rows of each group whose score reaches the threshold."""
    w = W.partitionBy("user_id").orderBy(F.desc("value"), "event_id")
    return table(spark, folder, "events").where("value >= 50").select("user_id", "event_id", "event_type", F.row_number().over(w).alias("rank")).where("rank <= 5")


@query("k2_rerank", f"SELECT user_id, event_id, rank FROM {RANKED} WHERE rank <= 5")
def k2(spark, folder):
    return reranked(spark, folder).select("user_id", "event_id", "rank")


@query("k3_baked_context", f"SELECT user_id, string_agg('[' || rank || '] ' || event_type, chr(10) ORDER BY rank) AS context, count(*) AS chunks FROM {RANKED} WHERE rank <= 5 GROUP BY user_id")
def k3(spark, folder):
    lines = F.transform(F.array_sort(F.collect_list(F.struct("rank", "event_type"))), lambda x: F.concat(F.lit("["), x["rank"].cast("string"), F.lit("] "), x["event_type"]))
    return reranked(spark, folder).groupBy("user_id").agg(F.array_join(lines, "\n").alias("context"), F.count("*").alias("chunks"))


@query("u2_augment_train", "SELECT CASE WHEN quality = 1 THEN 'train' ELSE 'validation' END AS split, CAST(doc_id AS VARCHAR) AS id FROM labels UNION ALL SELECT 'train', CAST(item_id AS VARCHAR) FROM benchmark")
def u2(spark, folder):
    base = table(spark, folder, "labels").select(F.when(c("quality") == 1, "train").otherwise("validation").alias("split"), c("doc_id").cast("string").alias("id"))
    return base.unionByName(table(spark, folder, "benchmark").select(F.lit("train").alias("split"), c("item_id").cast("string").alias("id")))


@query("u3_key_sets", "SELECT 'both' AS side, c_custkey AS k FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) UNION ALL SELECT 'left', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def u3(spark, folder):
    left, right = table(spark, folder, "customer").select(c("c_custkey").alias("k")), table(spark, folder, "orders").select(c("o_custkey").alias("k"))
    part = lambda how, side: left.join(right, "k", how).select(F.lit(side).alias("side"), "k")
    return part("left_semi", "both").unionByName(part("left_anti", "left"))


@query("r2_row_resume", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM (SELECT user_id, arg_max(event_type, event_id) AS s FROM events WHERE user_id IS NOT NULL GROUP BY user_id) WHERE s IN ('purchase', 'signup'))")
def r2(spark, folder):
    log = table(spark, folder, "events").select(c("user_id").alias("c_custkey"), "event_id", "event_type")
    return M.to_do(table(spark, folder, "customer").select("c_custkey"), log, "c_custkey", "event_id", "event_type", ["purchase", "signup"])


@query("r3_attempts", "SELECT c_custkey, CASE WHEN d THEN 'done' WHEN f >= 2 THEN 'exhausted' ELSE 'missing' END AS state FROM customer LEFT JOIN (SELECT user_id, bool_or(event_type = 'purchase') AS d, count(*) FILTER (WHERE event_type = 'error') AS f FROM events GROUP BY user_id) ON c_custkey = user_id")
def r3(spark, folder):
    log = table(spark, folder, "events").select(c("user_id").alias("c_custkey"), "event_type")
    return M.attempts(table(spark, folder, "customer"), log, "c_custkey", c("event_type") == "purchase", c("event_type") == "error", 2)


@query("r4_seed_resume", "SELECT 'seed_' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 24) AS seed_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def r4(spark, folder):
    seed = F.concat(F.lit("seed_"), F.substring(F.sha2(c("doc_id").cast("string"), 256), 1, 24)).alias("seed_id")
    done = table(spark, folder, "labels").select(seed)
    return table(spark, folder, "documents").select(seed).join(done, "seed_id", "left_anti")


@query("s18_dataset_specs", "SELECT n_name || '-' || v AS spec FROM nation, (VALUES ('train'), ('test'), ('test-with-context')) t(v)")
def s18(spark, folder):
    variants = F.array(*(F.lit(v) for v in ("train", "test", "test-with-context")))
    return table(spark, folder, "nation").select("n_name", F.explode(variants).alias("v")).select(F.concat("n_name", F.lit("-"), "v").alias("spec"))


@query("x4_admission_status", "SELECT event_id, CASE WHEN coalesce(props, '') = '' THEN 'llm_empty' WHEN k IS NULL THEN 'parse_failed' WHEN k < 10 THEN 'dropped' WHEN k <> floor(value) THEN 'refined' ELSE 'accepted' END AS status FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)")
def x4(spark, folder):
    k = F.get_json_object("props", "$.k").try_cast("long")
    status = F.when(F.coalesce("props", F.lit("")) == "", "llm_empty").when(k.isNull(), "parse_failed").when(k < 10, "dropped").when(k != F.floor("value"), "refined").otherwise("accepted")
    return table(spark, folder, "events").select("event_id", status.alias("status"))


@query("k1_nearest", """WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([1 FOR x IN embedding IF x <> 0]) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, round(list_cosine_similarity(q.e, c.e), 9) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.label IS DISTINCT FROM c.label WHERE q.vec_id % 100 = 0)
SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, rank <= 3 AS kept FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 6""")
def k1(spark, folder):
    """Six nearest of another label for each query, of which three are kept; the queries are the ids divisible by 100."""
    got = nearest(table(spark, folder, "embeddings"), c("vec_id") % 100 == 0, 6, "vec_id", "embedding", "label")
    return got.select("query_id", "vec_id", "rank", (c("rank") <= 3).alias("kept"))


def d2(spark, folder):
    """Documents that greedy MinHash keeps; no SQL, tests compare it with a plain loop."""
    return minhash_dedup(table(spark, folder, "documents"), "doc_id", "text").select("doc_id")


QUERIES["d2_minhash_dedup"] = d2

"""Joins, deduplication, aggregation, ranking and resuming over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import prompt_key, strip
from ..operators import dedup as D
from ..operators import rollups as U
from ..operators import select as S
from ..sources.tables import table

QUERIES, ORACLE_SQL = {}, {}
c = F.col


def query(name, sql):
    def put(f):
        QUERIES[name] = f
        ORACLE_SQL[name] = sql
        return f

    return put


def pairs(spark, folder):
    """Question and answer: a user turn and the assistant turn right after it."""
    w = W.partitionBy("conv_id").orderBy("turn")
    t = table(spark, folder, "conversations").withColumns({"answer": F.lead("text").over(w), "next_role": F.lead("role").over(w)})
    return t.where("role = 'user' and next_role = 'assistant'").select("conv_id", "turn", c("text").alias("question"), "answer")


PAIRS = "(SELECT conv_id, turn, text AS question, answer FROM (SELECT *, lead(text) OVER w AS answer, lead(role) OVER w AS next_role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND next_role = 'assistant')"
KEY = r"lower(regexp_replace(coalesce(text,''), '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g'))"


@query("qa_pairs", f"SELECT * FROM {PAIRS}")
def qa_pairs(spark, folder):
    return pairs(spark, folder)


@query("d1_exact_dedup", f"SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY {KEY} ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def d1(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.md5(F.lower(strip(c("text")))).alias("key"))
    return D.first_of(docs, c("key"), "doc_id").select("doc_id")


@query("d3_md5_dedup", "SELECT min(doc_id) AS doc_id, md5(text) AS h FROM documents GROUP BY md5(text)")
def d3(spark, folder):
    return table(spark, folder, "documents").groupBy(F.md5("text").alias("h")).agg(F.min("doc_id").alias("doc_id"))


@query("d5_admission", f"SELECT doc_id, concat_ws(',', CASE WHEN k = '' THEN 'empty' END, CASE WHEN known THEN 'known' END, CASE WHEN k <> '' AND NOT known AND r > 1 THEN 'repeated' END) AS reasons FROM (SELECT doc_id, k, k IN (SELECT {KEY} FROM benchmark) AS known, row_number() OVER (PARTITION BY k ORDER BY doc_id) AS r FROM (SELECT doc_id, {KEY} AS k FROM documents))")
def d5(spark, folder):
    keyed = lambda t, i: table(spark, folder, t).select(i, F.lower(strip(c("text"))).alias("key"))
    return D.admit(keyed("documents", "doc_id"), keyed("benchmark", "item_id"), ["key"], "doc_id").select("doc_id", F.array_join("reasons", ",").alias("reasons"))


@query("d6_latest_by_key", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def d6(spark, folder):
    return D.latest_of(table(spark, folder, "events").select("user_id", "event_id", "event_type"), c("user_id"), "event_id")


@query("d7_duplicate_count", "SELECT coalesce(sum(n - 1), 0)::BIGINT AS duplicates FROM (SELECT count(*) AS n FROM events GROUP BY user_id)")
def d7(spark, folder):
    return D.surplus(table(spark, folder, "events"), c("user_id"))


@query("d10_first_ids", "SELECT source, array_to_string(list(doc_id ORDER BY doc_id)[1:12], ',') AS ids FROM documents GROUP BY source")
def d10(spark, folder):
    return D.first_n_per_slice(table(spark, folder, "documents"), "source", "doc_id", "doc_id").select("source", F.array_join(c("ids").cast("array<string>"), ",").alias("ids"))


@query("j2_last_match_wins", "SELECT o.o_orderkey, coalesce(l.l_returnflag, 'unknown') AS flag FROM orders o LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS r FROM lineitem) WHERE r = 1) l ON o.o_orderkey = l.l_orderkey")
def j2(spark, folder):
    last = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.max_by("l_returnflag", F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("flag"))
    orders = table(spark, folder, "orders").select("o_orderkey")
    return orders.join(last, orders.o_orderkey == last.l_orderkey, "left").select("o_orderkey", F.coalesce("flag", F.lit("unknown")).alias("flag"))


@query("j5_ordered_children", "SELECT conv_id, string_agg(role, '>' ORDER BY turn) AS roles FROM conversations GROUP BY conv_id")
def j5(spark, folder):
    t = table(spark, folder, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("t"))
    return t.select("conv_id", F.array_join(F.transform("t", lambda x: x["role"]), ">").alias("roles"))


@query("j7_merge_status", "SELECT d.doc_id, d.source, l.quality, CASE WHEN l.quality = 1 THEN 'accepted' ELSE 'rejected' END AS status FROM documents d JOIN labels l USING (doc_id)")
def j7(spark, folder):
    docs, labels = table(spark, folder, "documents").select("doc_id", "source"), table(spark, folder, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id").select("doc_id", "source", "quality", F.when(c("quality") == 1, "accepted").otherwise("rejected").alias("status"))


@query("j8_rejected_only", "SELECT DISTINCT doc_id FROM labels WHERE quality = 0 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def j8(spark, folder):
    labels = table(spark, folder, "labels")
    return labels.where("quality = 0").select("doc_id").distinct().join(labels.where("quality = 1").select("doc_id"), "doc_id", "left_anti")


@query("j9_minus_holdout", f"SELECT doc_id FROM documents WHERE {KEY} NOT IN (SELECT {KEY} FROM documents WHERE lang = 'de') ")
def j9(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang", F.lower(strip(c("text"))).alias("key"))
    return docs.join(docs.where("lang = 'de'").select("key"), "key", "left_anti").select("doc_id")


@query("j11_overlay", "SELECT c.c_custkey, coalesce(nullif(s.s_name, ''), c.c_name) AS name FROM customer c LEFT JOIN supplier s ON c.c_custkey = s.s_suppkey")
def j11(spark, folder):
    a, b = table(spark, folder, "customer").select("c_custkey", "c_name"), table(spark, folder, "supplier").select("s_suppkey", "s_name")
    return a.join(b, a.c_custkey == b.s_suppkey, "left").select("c_custkey", F.coalesce(F.nullif("s_name", F.lit("")), "c_name").alias("name"))


@query("j13_zip_by_position", "SELECT a.pos, a.doc_id, b.item_id FROM (SELECT row_number() OVER (ORDER BY doc_id) AS pos, doc_id FROM labels) a JOIN (SELECT row_number() OVER (ORDER BY item_id) AS pos, item_id FROM benchmark) b USING (pos)")
def j13(spark, folder):
    ranked = lambda t, i: S.numbered(table(spark, folder, t).select(i), [], [c(i)], "pos")
    return ranked("labels", "doc_id").join(ranked("benchmark", "item_id"), "pos").select("pos", "doc_id", "item_id")


@query("j15_pair_rows", "SELECT a.doc_id FROM documents a JOIN labels b USING (doc_id) WHERE doc_id NOT IN (SELECT item_id FROM benchmark) ORDER BY doc_id LIMIT 50")
def j15(spark, folder):
    docs, labels, done = table(spark, folder, "documents").select("doc_id"), table(spark, folder, "labels").select("doc_id"), table(spark, folder, "benchmark").select(c("item_id").alias("doc_id"))
    return docs.join(labels, "doc_id").join(done, "doc_id", "left_anti").orderBy("doc_id").limit(50)


@query("j18_pairs_within", "SELECT a.n_name AS left_name, b.n_name AS right_name FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey UNION ALL SELECT r_name, n_name FROM region JOIN nation ON r_regionkey = n_regionkey")
def j18(spark, folder):
    n, r = table(spark, folder, "nation"), table(spark, folder, "region")
    a, b = n.alias("a"), n.alias("b")
    own = a.join(b, (c("a.n_regionkey") == c("b.n_regionkey")) & (c("a.n_nationkey") < c("b.n_nationkey"))).select(c("a.n_name").alias("left_name"), c("b.n_name").alias("right_name"))
    return own.union(r.join(n, r.r_regionkey == n.n_regionkey).select("r_name", "n_name"))


@query("a1_group_passages", "SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text, count(*) AS chunks, min_by(role, turn) AS first_role FROM conversations GROUP BY conv_id")
def a1(spark, folder):
    g = table(spark, folder, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text", "role"))).alias("t"))
    return g.select("conv_id", F.array_join(F.transform("t", lambda x: x["text"]), " ").alias("text"), F.size("t").cast("long").alias("chunks"), c("t")[0]["role"].alias("first_role"))


DENSITY = "WITH d AS (SELECT source, count(*) AS chunks, count(l.doc_id) AS pairs FROM documents LEFT JOIN labels l USING (doc_id) GROUP BY source), k AS (SELECT *, pairs / chunks AS density FROM d WHERE chunks >= 10), m AS (SELECT coalesce(median(density), 0.0) AS median FROM k)"


def density(spark, folder):
    docs, labels = table(spark, folder, "documents").select("doc_id", "source"), table(spark, folder, "labels").select("doc_id", c("doc_id").alias("hit"))
    d = docs.join(labels, "doc_id", "left").groupBy("source").agg(F.count("*").alias("chunks"), F.count("hit").alias("pairs")).where("chunks >= 10").withColumn("density", c("pairs") / c("chunks"))
    return d.join(F.broadcast(d.agg(F.coalesce(F.median("density"), F.lit(0.0)).alias("median"))))  # one row


@query("a4_density_report", DENSITY + " SELECT source, chunks, pairs, round_even(density, 4) AS density, density < median * 0.5 AS underrepresented FROM k, m")
def a4(spark, folder):
    return density(spark, folder).select("source", "chunks", "pairs", F.bround("density", 4).alias("density"), (c("density") < c("median") * 0.5).alias("underrepresented"))


@query("a4b_upper_median", "WITH d AS (SELECT source, count(*) AS n FROM documents GROUP BY source) SELECT list(n ORDER BY n)[len(list(n)) // 2 + 1] AS upper_median FROM d")
def a4b(spark, folder):
    n = table(spark, folder, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return n.agg(F.sort_array(F.collect_list("n")).alias("a")).select(F.element_at("a", F.floor(F.size("a") / 2).cast("int") + 1).alias("upper_median"))


@query("a5_gap_manifest", DENSITY + """, g AS (SELECT source, pairs AS observed, greatest(pairs, CAST(ceil(median * 0.8 * chunks) AS BIGINT)) AS target FROM k, m)
SELECT source, observed, target, CASE WHEN target <= 0 THEN 'low' WHEN observed = 0 AND target >= 10 THEN 'critical' WHEN (target - observed) / target >= 0.75 THEN 'high' WHEN (target - observed) / target >= 0.5 THEN 'medium' ELSE 'low' END AS severity FROM g WHERE target > observed""")
def a5(spark, folder):
    g = density(spark, folder).select("source", c("pairs").alias("observed"), F.greatest("pairs", F.ceil(c("median") * 0.8 * c("chunks"))).alias("target")).where("target > observed")
    missing = (c("target") - c("observed")) / c("target")
    return g.withColumn("severity", F.when(c("target") <= 0, "low").when((c("observed") == 0) & (c("target") >= 10), "critical").when(missing >= 0.75, "high").when(missing >= 0.5, "medium").otherwise("low"))


@query("a10_composition", "SELECT count(*) AS rows, count(DISTINCT nullif(doc_id::VARCHAR, '')) AS doc_id_count, count(DISTINCT nullif(lang, '')) AS lang_count, count(DISTINCT nullif(source, '')) AS source_count, count(*) FILTER (source = 'web') AS synthetic, round_even(count(*) FILTER (source = 'web') / count(*), 6) AS synthetic_ratio FROM documents")
def a10(spark, folder):
    return U.composition(table(spark, folder, "documents"), ["doc_id", "lang", "source"], c("source") == "web")


@query("a10_value_counts", "SELECT 'lang' AS field, coalesce(nullif(lang, ''), 'unknown') AS value, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'words', coalesce(w, 'unknown'), count(*) FROM (SELECT unnest(CASE WHEN len(l) = 0 THEN [NULL] ELSE l END) AS w FROM (SELECT [x FOR x IN string_split(coalesce(text, ''), ' ') IF x <> ''][1:3] AS l FROM documents)) GROUP BY 2")
def a10_counts(spark, folder):
    first = F.slice(F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda x: x != ""), 1, 3)
    return U.value_counts(table(spark, folder, "documents").withColumn("words", first), ["lang"], ["words"])


JUDGED = "(SELECT doc_id, quality = 1 AS good, toxic = 0 AS clean FROM labels)"


def judged(spark, folder):
    return table(spark, folder, "labels").select("doc_id", (c("quality") == 1).alias("good"), (c("toxic") == 0).alias("clean"))


@query("a13_curation_metrics", f"WITH r AS (SELECT CASE WHEN good THEN NULL WHEN clean THEN 'poor' END AS reason, coalesce(good, false) AS ok FROM {JUDGED}), n AS (SELECT count(*) AS t FROM r) SELECT 'accepted' AS kind, '' AS reason, count(*) AS n, round_even(count(*) / any_value(t), 6) AS share FROM r, n WHERE ok UNION ALL SELECT 'rejected', coalesce(reason, 'unknown'), count(*), round_even(count(*) / any_value(t), 6) FROM r, n WHERE NOT ok GROUP BY 2")
def a13(spark, folder):
    return U.curation_metrics(judged(spark, folder), c("good"), F.when(c("clean"), "poor"))


@query("a13_rejection_report", f"SELECT doc_id, CASE WHEN clean THEN 'poor' END AS rejection_reason FROM {JUDGED} WHERE NOT coalesce(good, false)")
def a13_report(spark, folder):
    return U.rejections(judged(spark, folder), c("good"), F.when(c("clean"), "poor"), "doc_id")


@query("a15_gate_report", f"SELECT count(*) AS rows, count(*) FILTER (good) AS good_count, count(*) FILTER (clean) AS clean_count, count(*) FILTER (good AND clean) AS all_count, round_even(count(*) FILTER (good AND clean) / count(*), 3) AS pass_rate, count(*) FILTER (good AND clean) / count(*) >= 0.9 AS passed FROM {JUDGED}")
def a15(spark, folder):
    return U.gate_report(judged(spark, folder), ["good", "clean"])


@query("a15_gate_failures", f"SELECT doc_id, good, clean FROM {JUDGED} WHERE NOT (coalesce(good, false) AND coalesce(clean, false))")
def a15_failures(spark, folder):
    return U.gate_failures(judged(spark, folder), ["good", "clean"])


LAST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events WHERE event_type <> 'error') WHERE r = 1)"


@query("a16_score_summary", f"WITH l AS {LAST}, e AS (SELECT * FROM events WHERE event_type = 'error') SELECT any_value(a) AS rows_scored_raw, count(*) AS rows_scored, any_value(a) - count(*) AS duplicates, (SELECT count(DISTINCT user_id) FROM e WHERE user_id NOT IN (SELECT user_id FROM l)) AS rows_failed, (SELECT count(*) FROM e) AS error_attempts, round(avg(nullif(value, 0)), 6) AS mean_value, sum(event_id)::BIGINT AS total_event_id FROM l, (SELECT count(*) AS a FROM events WHERE event_type <> 'error')")
def a16(spark, folder):
    events = table(spark, folder, "events")
    got = U.score_summary(events.where("event_type <> 'error'"), events.where("event_type = 'error'"), "user_id", "event_id", ["value"], ["event_id"])
    return got.withColumn("mean_value", F.round("mean_value", 6))


@query("a16_unresolved", "SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND user_id NOT IN (SELECT user_id FROM events WHERE value > 300)")
def a16_unresolved(spark, folder):
    events = table(spark, folder, "events")
    return U.unresolved(events.where("event_type = 'error'"), events.where("value > 300"), "user_id").select("user_id").distinct()


SIDES = "(SELECT user_id, CASE abs(event_id) % 3 WHEN 0 THEN 'left' WHEN 1 THEN 'right' ELSE 'tie' END AS side FROM events)"


@query("a18_position_swap", f"SELECT user_id, CASE WHEN count(DISTINCT side) = 1 THEN min(side) WHEN count(DISTINCT nullif(side, 'tie')) = 1 THEN min(nullif(side, 'tie')) ELSE 'tie' END AS winner, CASE WHEN count(DISTINCT side) = 1 THEN 'agree' WHEN count(DISTINCT nullif(side, 'tie')) = 1 THEN 'weak' ELSE 'conflict' END AS agreement FROM {SIDES} GROUP BY user_id")
def a18(spark, folder):
    side = table(spark, folder, "events").select("user_id", F.element_at(F.array(F.lit("left"), F.lit("right"), F.lit("tie")), (F.abs("event_id") % 3 + 1).cast("int")).alias("side"))
    g = side.groupBy("user_id").agg(F.collect_set("side").alias("s"))
    firm = F.filter("s", lambda x: x != "tie")
    agree, weak = F.size("s") == 1, F.size(firm) == 1
    return g.select("user_id", F.when(agree, F.element_at("s", 1)).when(weak, F.try_element_at(firm, F.lit(1))).otherwise("tie").alias("winner"), F.when(agree, "agree").when(weak, "weak").otherwise("conflict").alias("agreement"))


@query("a17_pairwise_summary", f"WITH p AS (SELECT CASE side WHEN 'tie' THEN 'none' ELSE side END AS winner, nullif(event_type, 'click') AS agreement, event_id, value FROM {SIDES} JOIN (SELECT event_id, event_type, value FROM events) USING (event_id)), n AS (SELECT count(*) AS t FROM p) SELECT 'rows' AS kind, 'compared' AS name, t AS n, 1.0 AS rate FROM n UNION ALL SELECT 'wins', w, count(winner), round(count(winner) / any_value(t), 6) FROM (VALUES ('left'), ('right'), ('tie')) v(w) CROSS JOIN n LEFT JOIN (SELECT CASE WHEN winner IN ('left', 'right') THEN winner ELSE 'tie' END AS winner FROM p) q ON w = winner GROUP BY w UNION ALL SELECT 'agreement', coalesce(agreement, 'unknown'), count(*), round(count(*) / any_value(t), 6) FROM p, n GROUP BY 2 UNION ALL SELECT 'tokens', 'event_id', sum(event_id)::BIGINT, NULL FROM p".replace("SELECT user_id, CASE", "SELECT event_id, CASE"))
def a17(spark, folder):
    side = F.element_at(F.array(F.lit("left"), F.lit("right"), F.lit("none")), (F.abs("event_id") % 3 + 1).cast("int"))
    rows = table(spark, folder, "events").select("event_id", side.alias("winner"), F.nullif("event_type", F.lit("click")).alias("agreement"))
    return U.pairwise_summary(rows, "winner", "agreement", ["event_id"]).withColumn("rate", F.round("rate", 6))


@query("a19_token_rollup", "SELECT coalesce(event_type, 'all') AS kind, count(*) AS rows, sum(user_id)::BIGINT AS tokens, round(sum(user_id) / count(*), 6) AS average FROM events GROUP BY GROUPING SETS ((event_type), ())")
def a19(spark, folder):
    g = table(spark, folder, "events").rollup("event_type").agg(F.count("*").alias("rows"), F.sum("user_id").alias("tokens"))
    return g.select(F.coalesce("event_type", F.lit("all")).alias("kind"), "rows", "tokens", F.round(c("tokens") / c("rows"), 6).alias("average"))


@query("a20_weighted_mean", "SELECT metric, round(sum(mean * n) / sum(n), 6) AS mean, sum(n)::BIGINT AS count FROM (SELECT l_returnflag AS metric, l_discount::DOUBLE AS mean, greatest(1, coalesce(nullif(CASE WHEN l_linenumber = 1 THEN 0 ELSE l_linenumber END, 0), nullif(CAST(floor(l_quantity) AS BIGINT), 0), 0)) AS n FROM lineitem WHERE l_discount IS NOT NULL) GROUP BY metric")
def a20(spark, folder):
    rows = table(spark, folder, "lineitem").select(c("l_returnflag").alias("metric"), c("l_discount").cast("double").alias("mean"), F.when(c("l_linenumber") != 1, c("l_linenumber")).otherwise(0).alias("count"), F.floor("l_quantity").alias("samples"))
    return U.weighted_means(rows, "metric", "mean", ["count", "samples"]).withColumn("mean", F.round("mean", 6))


@query("a23_inventory", "SELECT split_part(regexp_replace(url, '^[a-z]+://', ''), '/', 1) AS host, count(*) AS urls, max(url) AS last_url FROM pages GROUP BY 1")
def a23(spark, folder):
    return table(spark, folder, "pages").groupBy(F.substring_index(F.regexp_replace("url", "^[a-z]+://", ""), "/", 1).alias("host")).agg(F.count("*").alias("urls"), F.max("url").alias("last_url"))


@query("a26_set_fingerprint", r"SELECT sha256(string_agg(k, chr(10) ORDER BY k)) AS fingerprint FROM (SELECT DISTINCT lower(trim(regexp_replace(coalesce(text,''), '[ \t\n\x0B\f\r]+', ' ', 'g'))) AS k FROM benchmark)")
def a26(spark, folder):
    return table(spark, folder, "benchmark").agg(F.sha2(F.array_join(F.sort_array(F.collect_set(prompt_key(c("text")))), "\n"), 256).alias("fingerprint"))


@query("a28_error_attempts", "SELECT user_id, sum(greatest(1, CAST(floor(value) AS BIGINT)))::BIGINT AS attempts FROM events GROUP BY user_id")
def a28(spark, folder):
    return table(spark, folder, "events").groupBy("user_id").agg(F.sum(F.greatest(F.lit(1), F.floor("value"))).alias("attempts"))


@query("a30_stage_counts", "SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def a30(spark, folder):
    return table(spark, folder, "documents").groupBy("lang").agg(F.count("*").alias("n"))


@query("k10_split", "SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY md5('42|' || doc_id), doc_id) <= floor(count(*) OVER (PARTITION BY lang) * 0.9) THEN 'train' ELSE 'validation' END AS split FROM documents")
def k10(spark, folder):
    return S.split_by_stratum(table(spark, folder, "documents").select("doc_id", "lang"), "lang", "doc_id").select("doc_id", "split")


@query("k11_split_keep_one", "SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY source ORDER BY md5('7|' || doc_id), doc_id) <= CASE WHEN count(*) OVER w > 1 THEN least(floor(count(*) OVER w * 0.99), count(*) OVER w - 1) ELSE floor(count(*) OVER w * 0.99) END THEN 'train' ELSE 'validation' END AS split FROM documents WINDOW w AS (PARTITION BY source)")
def k11(spark, folder):
    return S.split_by_stratum(table(spark, folder, "documents").select("doc_id", "source"), "source", "doc_id", 0.99, 7, keep_one=True).select("doc_id", "split")


@query("k8_round_robin", "SELECT doc_id, turn FROM (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY md5('42|' || doc_id), doc_id) AS turn FROM documents) ORDER BY turn, lang, source LIMIT 100")
def k8(spark, folder):
    return S.round_robin(table(spark, folder, "documents").select("doc_id", "lang", "source"), ["lang", "source"], "doc_id", 100).select("doc_id", "turn")


@query("k7_stratified_draw", "WITH o AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars DESC, doc_id DESC) - 1 AS pos, count(*) OVER () AS n FROM documents), b AS (SELECT *, CAST(pos * 4 // n AS BIGINT) AS bin FROM o), t AS (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY doc_id DESC) AS turn FROM b) SELECT doc_id, bin, turn FROM t ORDER BY turn, bin LIMIT 60")
def k7(spark, folder):
    return S.stratified_draw(table(spark, folder, "documents").select("doc_id", "n_chars"), [F.desc("n_chars"), F.desc("doc_id")], 60).select("doc_id", "bin", "turn")


@query("k9_proportional_sample", "WITH s AS (SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5('42|' || doc_id), doc_id) AS p, greatest(1, round_even(count(*) OVER (PARTITION BY lang) / count(*) OVER () * 40, 0)) AS share FROM documents) SELECT doc_id FROM s WHERE p <= share ORDER BY md5('43|' || doc_id), doc_id LIMIT 40")
def k9(spark, folder):
    return S.proportional_sample(table(spark, folder, "documents").select("doc_id", "lang"), "lang", "doc_id", 40).select("doc_id")


@query("k12_holdout", "WITH f AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY source ORDER BY md5('42|' || doc_id), doc_id) > 1 AS free, count(*) OVER (PARTITION BY lang) AS n FROM documents) SELECT doc_id, free AND row_number() OVER (PARTITION BY lang, free ORDER BY md5('42|' || doc_id), doc_id) <= greatest(1, floor(n * 0.1)) AS test FROM f")
def k12(spark, folder):
    return S.holdout(table(spark, folder, "documents").select("doc_id", "lang", "source"), "doc_id", "lang", "source").select("doc_id", "test")


@query("u1_ordered_union", "SELECT 'documents' AS stage, doc_id AS id, text FROM documents UNION ALL SELECT 'benchmark', item_id, text FROM benchmark")
def u1(spark, folder):
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return docs.select(F.lit("documents").alias("stage"), c("doc_id").alias("id"), "text").unionByName(items.select(F.lit("benchmark").alias("stage"), c("item_id").alias("id"), "text"))


@query("u4_distinct_keys", f"SELECT DISTINCT k FROM (SELECT {KEY} AS k FROM documents UNION ALL SELECT {KEY} FROM benchmark) WHERE k <> ''")
def u4(spark, folder):
    key = F.lower(strip(c("text"))).alias("k")
    return table(spark, folder, "documents").select(key).union(table(spark, folder, "benchmark").select(key)).where("k <> ''").distinct()


@query("r1_resume", "WITH s AS (SELECT user_id, max_by(event_type, event_id) AS status FROM events GROUP BY user_id) SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM s WHERE status IN ('purchase', 'click'))")
def r1(spark, folder):
    last = table(spark, folder, "events").groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("status")).where(c("status").isin("purchase", "click"))
    people = table(spark, folder, "customer").select("c_custkey")
    return people.join(last, people.c_custkey == last.user_id, "left_anti")


@query("r7_delta_crawl", "WITH a AS (SELECT page_id, md5(html) AS h FROM pages WHERE page_id % 5 <> 0), b AS (SELECT page_id, md5(CASE WHEN page_id % 7 = 0 THEN html || '!' ELSE html END) AS h FROM pages WHERE page_id % 6 <> 0) SELECT page_id, CASE WHEN a.h IS NULL THEN 'added' WHEN b.h IS NULL THEN 'deleted' WHEN a.h = b.h THEN 'unchanged' ELSE 'changed' END AS status FROM a FULL JOIN b USING (page_id)")
def r7(spark, folder):
    pages = table(spark, folder, "pages")
    a = pages.where("page_id % 5 <> 0").select("page_id", F.md5("html").alias("old"))
    b = pages.where("page_id % 6 <> 0").select("page_id", F.md5(F.when(c("page_id") % 7 == 0, F.concat("html", F.lit("!"))).otherwise(c("html"))).alias("new"))
    return a.join(b, "page_id", "full").select("page_id", F.when(c("old").isNull(), "added").when(c("new").isNull(), "deleted").when(c("old") == c("new"), "unchanged").otherwise("changed").alias("status"))



"""Registered queries of the archive's build, imports and exports, with their SQL. Tables stand in as in catalogue.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules
from ..operators import archive, chunks, exports, imports, numbering
from .catalogue import CUSTOMERS, customers, query, table, turns

TURNS = "SELECT conv_id AS object_id, turn AS pos, role, coalesce(text, '') AS text FROM conversations"


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 3)")
def q_src_discover(spark, d):
    lines = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "id")
    return archive.having(table(spark, d, "orders").select(F.col("o_orderkey").alias("id")), "id", lines.where("l_returnflag = 'R'"), lines.where("l_linenumber = 3"))


@query("SELECT o_orderkey AS id FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 5)")
def q_flt_has_layout(spark, d):
    return archive.having(table(spark, d, "orders").select(F.col("o_orderkey").alias("id")), "id", table(spark, d, "lineitem").where("l_linenumber = 5").withColumnRenamed("l_orderkey", "id"))


@query("SELECT c_custkey AS id FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def q_flt_has_ocr(spark, d):
    return archive.having(table(spark, d, "customer").select(F.col("c_custkey").alias("id")), "id", table(spark, d, "orders").where("o_orderstatus = 'P'").withColumnRenamed("o_custkey", "id"))


@query("SELECT c_custkey AS id, CASE WHEN n IS NULL THEN -1 ELSE n END AS images FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def q_src_image_count(spark, d):
    return archive.with_count(table(spark, d, "customer").select(F.col("c_custkey").alias("id")), "id", table(spark, d, "orders").withColumnRenamed("o_custkey", "id"), "images")


@query("""WITH o AS (SELECT o_orderkey AS id, o_totalprice AS price FROM orders WHERE o_orderkey % 3 <> 0), l AS (SELECT l_orderkey AS id, l_quantity AS quantity FROM lineitem WHERE l_linenumber = 1 AND l_orderkey % 2 = 0)
SELECT id, price, quantity, o.id IS NOT NULL AS has_ocr, l.id IS NOT NULL AS has_layout FROM o FULL JOIN l USING (id)""")
def q_src_ocr_layout(spark, d):
    o = table(spark, d, "orders").where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    lines = table(spark, d, "lineitem").where("l_linenumber = 1 AND l_orderkey % 2 = 0").select(F.col("l_orderkey").alias("id"), F.col("l_quantity").alias("quantity"))
    return archive.paired(o, lines, "id", "has_ocr", "has_layout")


@query("""WITH j AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nth FROM orders)
SELECT c_custkey AS id, c_name AS title, o_orderkey AS judge, o_totalprice AS score FROM customer LEFT JOIN j ON o_custkey = c_custkey AND nth = 1""")
def q_src_consensus(spark, d):
    pages = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"))
    judges = table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("judge"), F.col("o_totalprice").alias("score"), "o_orderdate")
    return archive.with_one(pages, judges, ["id"], [F.col("o_orderdate"), F.col("judge")]).drop("o_orderdate")


@query("""WITH j AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_quantity) AS nth FROM lineitem)
SELECT o_orderkey AS page, o_orderstatus AS type, l_quantity AS width, l_linenumber AS version FROM orders LEFT JOIN j ON l_orderkey = o_orderkey AND nth = 1""")
def q_jn_layout_page(spark, d):
    pages = table(spark, d, "orders").select(F.col("o_orderkey").alias("page"), F.col("o_orderstatus").alias("type"))
    layouts = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_quantity").alias("width"), F.col("l_linenumber").alias("version"))
    return archive.with_one(pages, layouts, ["page"], [-F.col("version"), F.col("width")])


@query("SELECT conv_id AS object_id, turn AS page, text FROM conversations WHERE turn > 0 AND text IS NOT NULL")
def q_src_variant_b(spark, d):
    pages = F.sort_array(F.collect_list(F.struct(F.col("pos").alias("page"), F.when(F.col("pos") > 0, F.col("text")).alias("text"))))
    consensus = turns(spark, d).groupBy("object_id").agg(pages.alias("pages"))
    return consensus.select("object_id", F.inline("pages")).where("text is not null")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN 'object ' || c_custkey ELSE 'group ' || c_mktsegment END AS prompt FROM customer")
def q_src_object_prompt(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("group "), "c_mktsegment").alias("prompt"))
    own = table(spark, d, "customer").where("c_custkey % 5 = 0").select(F.col("c_custkey").alias("id"), F.concat(F.lit("object "), F.col("c_custkey").cast("string")).alias("prompt"))
    return archive.overridden(rows, own, ["id"], ["prompt"])


@query(f"""WITH p AS (SELECT object_id, pos, text, CASE WHEN (object_id + pos) % 3 = 0 THEN 'color_chart' WHEN text = '' THEN 'blank' ELSE 'content' END AS type, count(*) OVER (PARTITION BY object_id) AS n, row_number() OVER (PARTITION BY object_id ORDER BY pos) AS nth FROM ({TURNS})),
o AS (SELECT object_id, coalesce(string_agg(pos, ',' ORDER BY pos) FILTER (type <> 'color_chart'), '') AS pages, coalesce(string_agg('IMG_' || nth, ',' ORDER BY pos) FILTER (type <> 'color_chart' AND nth <= n - object_id % 2), '') AS images FROM p GROUP BY 1)
SELECT * FROM o""")
def q_flt_not_colorchart(spark, d):
    kind = F.when((F.col("object_id") + F.col("pos")) % 3 == 0, "color_chart").when(F.coalesce("text", F.lit("")) == "", "blank").otherwise("content")
    rows = turns(spark, d).groupBy("object_id").agg(F.sort_array(F.collect_list(F.struct("pos", kind.alias("type")))).alias("pages"))
    have = (F.size("pages") - F.col("object_id") % 2).cast("int")
    images = F.when(have > 0, F.transform(F.sequence(F.lit(1), F.greatest(have, F.lit(1))), lambda i: F.concat(F.lit("IMG_"), i.cast("string")))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("images", images)
    pages, kept = archive.without_charts(F.col("pages"), F.col("images"))
    rows = rows.select("object_id", F.transform(pages, lambda p: p["pos"].cast("string")).alias("content"), kept.alias("shown"))
    return rows.select("object_id", F.array_join("content", ",").alias("pages"), F.array_join("shown", ",").alias("images"))


@query("SELECT conv_id AS object_id, CAST(coalesce(min(turn) FILTER (role = 'assistant'), 0) AS BIGINT) AS opens_at FROM conversations GROUP BY 1")
def q_flt_first_content(spark, d):
    return archive.opening_page(turns(spark, d).withColumn("type", F.when(F.col("role") == "assistant", "content").otherwise("blank")), "object_id", "pos", "type")


@query(f"SELECT id, pid, collection FROM ({CUSTOMERS}) WHERE regexp_matches(pid, '^o:[0-9]*[13579]$') AND collection IN ('ASIA', 'EUROPE')")
def q_flt_ids(spark, d):
    return archive.valid_ids(customers(spark, d), "pid", "^o:[0-9]*[13579]$", ["ASIA", "EUROPE"]).select("id", "pid", "collection")


@query("""SELECT c_custkey AS id, c_mktsegment AS grp, CASE c_mktsegment WHEN 'BUILDING' THEN 'A' WHEN 'MACHINERY' THEN 'B' ELSE '?' END AS group_letter, CASE c_mktsegment WHEN 'BUILDING' THEN 'Bauten' WHEN 'MACHINERY' THEN 'Maschinen' ELSE c_mktsegment END AS group_label FROM customer""")
def q_jn_group_label(spark, d):
    labels = spark.createDataFrame([("BUILDING", "A", "Bauten"), ("MACHINERY", "B", "Maschinen")], "grp string, group_letter string, group_label string")
    return archive.labelled(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("grp")), F.broadcast(labels), "grp")


@query("SELECT p_partkey AS pid, p_name AS label, s_name AS title, coalesce(s_name, p_name) AS shown FROM part LEFT JOIN supplier ON s_suppkey = p_partkey")
def q_jn_tei(spark, d):
    records = table(spark, d, "supplier").select(F.col("s_suppkey").alias("pid"), F.col("s_name").alias("title"))
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("pid"), F.col("p_name").alias("label"))
    return archive.with_one(rows, records, ["pid"], [F.col("title")]).withColumn("shown", F.coalesce("title", "label"))


@query("""WITH ids AS (SELECT 'o_' || o_custkey || CASE WHEN o_orderkey % 2 = 0 THEN '_' || o_orderstatus ELSE 'x_' || o_orderstatus END || '_m' || o_orderkey % 3 AS id, o_orderkey AS place FROM orders),
drafts AS (SELECT 'o_' || c_custkey AS object_id FROM customer), m AS (SELECT object_id, id, row_number() OVER (PARTITION BY object_id ORDER BY place) AS nth FROM drafts JOIN ids ON starts_with(id, object_id || '_'))
SELECT object_id, coalesce(id, object_id) AS id FROM drafts LEFT JOIN m USING (object_id) WHERE coalesce(nth, 1) = 1""")
def q_jn_gt_catalog(spark, d):
    key = F.concat(F.lit("o_"), F.col("o_custkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, "_").otherwise("x_"), "o_orderstatus", F.lit("_m"), (F.col("o_orderkey") % 3).cast("string"))
    ids = table(spark, d, "orders").select(key.alias("id"), F.col("o_orderkey").alias("place"))
    return archive.drafts_with_objects(table(spark, d, "customer").select(F.concat(F.lit("o_"), F.col("c_custkey").cast("string")).alias("object_id")), ids, "place")


@query("""WITH g AS (SELECT o_custkey AS id, bool_or(o_orderstatus = 'F') AS v FROM orders WHERE o_orderkey % 5 = 0 GROUP BY 1) SELECT c_custkey AS id, g.id IS NOT NULL AS has_gt, v AS gt_verified FROM customer LEFT JOIN g ON g.id = c_custkey""")
def q_jn_gt_flags(spark, d):
    drafts = table(spark, d, "orders").where("o_orderkey % 5 = 0").select(F.col("o_custkey").alias("id"), (F.col("o_orderstatus") == "F").alias("expert_verified"))
    return archive.with_truth(table(spark, d, "customer").select(F.col("c_custkey").alias("id")), drafts)


@query(f"SELECT id, title, o_orderkey AS detail, o_totalprice AS size FROM ({CUSTOMERS}) JOIN orders ON o_custkey = id")
def q_jn_catalog_detail(spark, d):
    detail = table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("detail"), F.col("o_totalprice").alias("size"))
    return customers(spark, d).select("id", "title").join(detail, "id")


@query("SELECT conv_id AS object_id, turn AS page, CASE WHEN (conv_id + turn) % 4 = 0 THEN 'edited ' || turn ELSE coalesce(text, '') END AS text FROM conversations")
def q_jn_overlay(spark, d):
    rows = turns(spark, d).select("object_id", F.col("pos").alias("page"), F.coalesce("text", F.lit("")).alias("text"))
    local = rows.where("(object_id + page) % 4 = 0").select("object_id", "page", F.concat(F.lit("edited "), F.col("page").cast("string")).alias("text"))
    return archive.overridden(rows, local, ["object_id", "page"], ["text"])


@query("SELECT user_id AS slug, CASE WHEN c_name IS NULL THEN CAST(user_id AS VARCHAR) ELSE c_name END AS shown FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN customer ON c_custkey = user_id AND c_custkey % 2 = 0")
def q_jn_wiki_titles(spark, d):
    titles = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("slug"), F.col("c_name").alias("title"))
    rows = table(spark, d, "events").select(F.col("user_id").alias("slug")).distinct()
    return rows.join(titles, "slug", "left").select("slug", F.coalesce("title", F.col("slug").cast("string")).alias("shown"))


MARKED = "CASE (conv_id + turn) % 4 WHEN 0 THEN coalesce(text, '') || ' [?] [?]' WHEN 1 THEN '[...3...] ' || coalesce(text, '') WHEN 2 THEN ' ' || chr(160) || ' ' ELSE coalesce(text, '') END"


@query(rf"""WITH p AS (SELECT conv_id AS object_id, {MARKED} AS t FROM conversations), x AS (SELECT *, regexp_replace(t, '[\s\x{{00A0}}]', '', 'g') <> '' AS filled FROM p),
s AS (SELECT object_id, CAST(sum(CASE WHEN filled THEN len(regexp_extract_all(t, '\[\?\]')) ELSE 0 END) AS BIGINT) AS uncertain, CAST(sum(CASE WHEN filled THEN len(regexp_extract_all(t, '\[\.\.\..*?\]')) ELSE 0 END) AS BIGINT) AS illegible,
CAST(sum(CASE WHEN filled THEN length(t) ELSE 0 END) AS BIGINT) AS total_chars, count(*) FILTER (NOT filled) AS empty_pages, count(*) AS pages FROM x GROUP BY 1)
SELECT *, CAST(CASE WHEN pages > empty_pages THEN round_even(total_chars / (pages - empty_pages), 0) ELSE 0 END AS BIGINT) AS avg_chars_per_page FROM s""")
def q_agg_verification(spark, d):
    k, t = (F.col("object_id") + F.col("pos")) % 4, F.coalesce("text", F.lit(""))
    marked = F.when(k == 0, F.concat(t, F.lit(" [?] [?]"))).when(k == 1, F.concat(F.lit("[...3...] "), t)).when(k == 2, " \u00a0 ").otherwise(t)
    return archive.verification(turns(spark, d).withColumn("text", marked), "object_id", "text")


STATS = """SELECT o_orderpriority AS collection, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE o_orderstatus END AS "group", o_orderkey % 7 AS content_pages, o_custkey % 3 AS blank_pages, o_orderkey % 7 + o_custkey % 3 + o_orderkey % 2 AS page_count, CAST(floor(o_totalprice) AS BIGINT) AS total_chars,
o_orderkey % 17 = 0 AS gt_verified, CASE o_orderkey % 5 WHEN 0 THEN 'approved' WHEN 1 THEN 'agent_verified' ELSE '' END AS review_status, CASE WHEN o_orderkey % 6 = 5 THEN NULL ELSE o_orderkey % 6 < 2 END AS needs_review, CASE WHEN o_orderkey % 6 < 2 THEN CASE WHEN o_custkey % 2 = 0 THEN ['a', 'b'] ELSE ['b'] END END AS reasons,
CASE o_orderkey % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' ELSE '' END AS confidence, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_custkey % 100 AS DOUBLE) / 64 END AS dwr, CASE WHEN o_orderkey % 9 < 3 THEN 'consensus_' || o_orderkey % 9 ELSE '' END AS consensus_category, CASE WHEN o_orderkey % 9 < 3 THEN CAST(o_custkey % 64 AS DOUBLE) / 256 END AS consensus_cer FROM orders"""


@query(f"""WITH o AS ({STATS}), g AS (SELECT *, CASE WHEN "group" = '' THEN '?' ELSE "group" END AS g FROM o), r AS (SELECT g, unnest(reasons) AS r FROM g),
t AS (SELECT 'objects' AS section, '' AS key, count(*) AS n FROM o UNION ALL SELECT 'content_pages', '', sum(content_pages) FROM o UNION ALL SELECT 'blank_pages', '', sum(blank_pages) FROM o UNION ALL SELECT 'pages', '', sum(page_count) FROM o
UNION ALL SELECT 'chars', '', sum(total_chars) FROM o UNION ALL SELECT 'needs_review', '', count(*) FILTER (needs_review) FROM o
UNION ALL SELECT 'dwr', CAST(least(7, CAST(floor(dwr * 10) AS INT)) AS VARCHAR), count(*) FROM o WHERE dwr > 0 GROUP BY 2 UNION ALL SELECT 'collection', collection, count(*) FROM o GROUP BY 2
UNION ALL SELECT 'collection_content', collection, sum(content_pages) FROM o GROUP BY 2 UNION ALL SELECT 'collection_blank', collection, sum(blank_pages) FROM o GROUP BY 2 UNION ALL SELECT 'collection_other', collection, sum(page_count - content_pages - blank_pages) FROM o GROUP BY 2
UNION ALL SELECT 'tier', CASE WHEN gt_verified THEN 'gt_verified' WHEN review_status IN ('approved', 'agent_verified') THEN review_status ELSE 'llm_ok' END, count(*) FROM o WHERE gt_verified OR review_status <> '' OR NOT coalesce(needs_review, false) GROUP BY 2
UNION ALL SELECT 'confidence', confidence, count(*) FROM o WHERE confidence <> '' GROUP BY 2 UNION ALL SELECT 'consensus', consensus_category, count(*) FROM o WHERE consensus_category <> '' GROUP BY 2
UNION ALL SELECT 'consensus_cer', CASE WHEN consensus_cer * 100 < 3 THEN '0' WHEN consensus_cer * 100 < 5 THEN '1' WHEN consensus_cer * 100 < 10 THEN '2' WHEN consensus_cer * 100 < 20 THEN '3' ELSE '4' END, count(*) FROM o WHERE consensus_cer IS NOT NULL GROUP BY 2
UNION ALL SELECT 'group', g, count(*) FROM g GROUP BY 2 UNION ALL SELECT 'reason', r, count(*) FROM r GROUP BY 2 UNION ALL SELECT 'group_reason', g || '/' || r, count(*) FROM r GROUP BY 2)
SELECT section, key, CAST(n AS BIGINT) AS n FROM t""")
def q_agg_stats_page(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("collection"), F.when(k % 11 == 0, "").otherwise(F.col("o_orderstatus")).alias("group"), (k % 7).alias("content_pages"), (c % 3).alias("blank_pages"), (k % 7 + c % 3 + k % 2).alias("page_count"), F.floor("o_totalprice").alias("total_chars"),
        (k % 17 == 0).alias("gt_verified"), F.when(k % 5 == 0, "approved").when(k % 5 == 1, "agent_verified").otherwise("").alias("review_status"), F.when(k % 6 < 5, k % 6 < 2).alias("needs_review"),
        F.when(k % 6 < 2, F.when(c % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("b")))).alias("reasons"), F.when(k % 4 == 0, "high").when(k % 4 == 1, "medium").when(k % 4 == 2, "low").otherwise("").alias("confidence"),
        F.when(k % 3 > 0, (c % 100).cast("double") / 64).alias("dwr"), F.when(k % 9 < 3, F.concat(F.lit("consensus_"), (k % 9).cast("string"))).otherwise("").alias("consensus_category"), F.when(k % 9 < 3, (c % 64).cast("double") / 256).alias("consensus_cer"),
    )
    return archive.statistics_page(rows)


@query("""SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'Unbekannt' ELSE o_orderpriority END AS grp, count(*) AS objects, CAST(sum(o_orderkey % 7) AS BIGINT) AS pages, count(*) FILTER (o_custkey % 50 > 9) AS with_text, avg(o_custkey % 50) FILTER (o_custkey % 50 > 9) AS mean_chars, min(o_custkey % 50) FILTER (o_custkey % 50 > 9) AS least_chars, max(o_custkey % 50) FILTER (o_custkey % 50 > 9) AS most_chars, CAST(list_sort(list(o_custkey % 50) FILTER (o_custkey % 50 > 9))[count(*) FILTER (o_custkey % 50 > 9) // 2 + 1] AS DOUBLE) AS median_chars FROM orders GROUP BY 1""")
def q_agg_group_density(spark, d):
    rows = table(spark, d, "orders").select(F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority")).alias("grp"), (F.col("o_orderkey") % 7).alias("content_pages"), F.when(F.col("o_custkey") % 50 > 9, F.col("o_custkey") % 50).otherwise(0).alias("avg_chars"))
    return archive.density(rows, "grp")


@query("""WITH c AS (SELECT CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'consensus_moderate' WHEN 2 THEN 'consensus_review' WHEN 3 THEN 'consensus_divergent' ELSE 'consensus_verified' END AS c FROM documents)
SELECT count(*) FILTER (c = 'consensus_verified') AS verified, count(*) FILTER (c = 'consensus_moderate') AS moderate, count(*) FILTER (c = 'consensus_review') AS review, count(*) FILTER (c = 'consensus_divergent') AS divergent, count(*) FILTER (c IS NULL) AS failed, count(*) AS total,
CAST(round_even(count(*) FILTER (c = 'consensus_verified') / count(*) * 100, 0) AS BIGINT) AS verified_percent FROM c""")
def q_agg_consensus_rate(spark, d):
    k = F.col("doc_id") % 7
    kind = F.when(k == 0, None).when(k == 1, "consensus_moderate").when(k == 2, "consensus_review").when(k == 3, "consensus_divergent").otherwise("consensus_verified")
    return archive.consensus_rate(table(spark, d, "documents").select(kind.alias("category")), "category")


@query("""WITH p AS (SELECT l_orderkey AS id, l_linenumber AS page, CASE WHEN l_quantity > 45 THEN 'needs_correction' WHEN l_quantity > 25 THEN 'acceptable' ELSE 'good' END AS q FROM lineitem)
SELECT id, CASE WHEN bool_or(q = 'needs_correction') THEN 'needs_correction' WHEN bool_or(q = 'acceptable') THEN 'acceptable' ELSE 'good' END AS overall, coalesce(string_agg(page, ',' ORDER BY page) FILTER (q = 'needs_correction'), '') AS pages_needing_review FROM p GROUP BY 1""")
def q_agg_layout_quality(spark, d):
    q = F.when(F.col("l_quantity") > 45, "needs_correction").when(F.col("l_quantity") > 25, "acceptable").otherwise("good")
    rows = archive.layout_quality(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("page"), q.alias("overall")), "id")
    return rows.withColumn("pages_needing_review", F.array_join(F.transform("pages_needing_review", lambda p: p.cast("string")), ","))


@query("""WITH p AS (SELECT CASE WHEN turn % 3 = 0 THEN 'blank' WHEN turn % 5 = 0 THEN NULL ELSE 'content' END AS old, CASE WHEN trim(coalesce(text, '')) = '' THEN 'blank' ELSE 'content' END AS new FROM conversations)
SELECT old, new, count(*) AS n, old IS NOT DISTINCT FROM new AS same FROM p GROUP BY 1, 2""")
def q_agg_page_types(spark, d):
    old = F.when(F.col("pos") % 3 == 0, "blank").when(F.col("pos") % 5 == 0, None).otherwise("content")
    return archive.changed_values(turns(spark, d), old, rules.page_type(F.col("text"), F.lit("")))


@query("""SELECT o_orderstatus = 'P' AS old, o_totalprice > 100000 AS new, count(*) AS n, (o_orderstatus = 'P') = (o_totalprice > 100000) AS same FROM orders GROUP BY ALL""")
def q_upd_backfill_signals(spark, d):
    return archive.changed_values(table(spark, d, "orders"), F.col("o_orderstatus") == "P", F.col("o_totalprice") > 100000)


@query(f"SELECT DISTINCT group_label AS grp FROM ({CUSTOMERS}) WHERE collection = 'ASIA' ORDER BY 1")
def q_agg_distinct_groups(spark, d):
    return customers(spark, d).where("collection = 'ASIA'").select(F.col("group_label").alias("grp")).distinct().orderBy("grp")


@query("SELECT 'o' || user_id AS object_id, count(*) AS edits FROM events GROUP BY 1")
def q_agg_edit_count(spark, d):
    keys = table(spark, d, "events").select(F.concat(F.lit("o"), F.col("user_id").cast("string"), F.lit(":"), (F.col("event_id") % 9).cast("string")).alias("key"))
    return archive.edits_by_object(keys, "key")


@query("SELECT c_mktsegment AS collection, count(*) FILTER (c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')) AS have, count(*) AS total FROM customer GROUP BY 1")
def q_agg_mets_coverage(spark, d):
    objects = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("collection"))
    return archive.coverage(objects, table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id")), "id", "collection")


def _chunks(spark, d):
    """Chunks of two pages: every fifth failed, every seventh came back empty."""
    rows = turns(spark, d).withColumns({"chunk": F.floor(F.col("pos") / 2), "page": F.struct(F.coalesce("text", F.lit("")).alias("text"), F.col("role").alias("notes"))})
    rows = rows.groupBy("object_id", "chunk").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "page"))), lambda x: x["page"]).alias("pages"), F.count("*").alias("n"))
    k = F.col("object_id") + F.col("chunk")
    empty = F.array().cast("array<struct<text:string,notes:string>>")
    return rows.select(
        "object_id", (F.col("chunk") * 2 + 1).cast("int").alias("first"), (F.col("chunk") * 2 + F.col("n")).cast("int").alias("last"), (k % 5 != 0).alias("ok"), F.when((k % 5 == 0) | (k % 7 == 0), empty).otherwise(F.col("pages")).alias("pages"),
        F.when(k % 3 == 0, "low").when(k % 3 == 1, "medium").otherwise("high").alias("confidence"), F.when(k % 2 == 0, F.concat(F.lit("n"), k.cast("string"))).alias("confidence_notes"),
    )


CHUNKED = f"""WITH p AS (SELECT *, pos // 2 AS chunk, row_number() OVER (PARTITION BY object_id, pos // 2 ORDER BY pos) AS nth FROM ({TURNS})), q AS (SELECT *, object_id + chunk AS k FROM p),
c AS (SELECT object_id, chunk, k, count(*) AS n, k % 5 <> 0 AND k % 7 <> 0 AS good FROM q GROUP BY ALL)"""


@query(f"""{CHUNKED} SELECT object_id, CAST(chunk * 2 + nth AS INT) AS page, CASE WHEN k % 5 = 0 OR k % 7 = 0 THEN '' ELSE text END AS text, CASE WHEN k % 5 = 0 THEN '{chunks.FAILED}' WHEN k % 7 = 0 THEN '{chunks.EMPTY}' ELSE role END AS notes FROM q""")
def q_fill_failed_chunk(spark, d):
    return chunks.pages_of(_chunks(spark, d))


@query(f"""{CHUNKED} SELECT object_id, CAST(chunk * 2 + nth AS INT) AS page FROM q WHERE k % 5 <> 0 AND k % 7 <> 0""")
def q_win_renumber(spark, d):
    return chunks.filled(_chunks(spark, d)).where("good").select("object_id", F.inline("pages")).select("object_id", "page")


@query(f"""{CHUNKED}, r AS (SELECT object_id, min(CASE WHEN good THEN CASE k % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END END) AS r, coalesce(string_agg('S.' || (chunk * 2 + 1) || '-' || (chunk * 2 + n) || ': n' || k, '; ' ORDER BY chunk) FILTER (good AND k % 2 = 0), '') AS confidence_notes, CAST(sum(n) AS BIGINT) AS pages, CAST(coalesce(sum(n) FILTER (NOT good), 0) AS BIGINT) AS placeholders FROM c GROUP BY 1)
SELECT object_id, CASE r WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END AS confidence, confidence_notes, pages, placeholders FROM r""")
def q_merge_chunks(spark, d):
    return chunks.merged(_chunks(spark, d))


@query(f"SELECT id, collection, group_label, row_number() OVER (ORDER BY collection, group_label, id) AS nth FROM ({CUSTOMERS}) ORDER BY nth LIMIT 100")
def q_srt_build(spark, d):
    rows = customers(spark, d).select("id", "collection", F.col("group_label").alias("group_letter"))
    top = archive.build_order(rows, "id").limit(100)
    return numbering.numbered(top, ["collection", "group_letter", "id"], "nth").withColumnRenamed("group_letter", "group_label")


@query(f"SELECT id, collection FROM ({CUSTOMERS}) ORDER BY collection, id LIMIT 25")
def q_lim_n(spark, d):
    return archive.first_n(customers(spark, d).select("id", "collection"), 25, ["collection", "id"])


@query("SELECT c_custkey AS id, c_mktsegment AS kind, NULL AS size FROM customer UNION ALL SELECT s_suppkey, NULL, NULL FROM supplier UNION ALL SELECT p_partkey, p_type, p_size FROM part")
def q_set_union_collections(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("kind"))
    c = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("kind"), F.col("p_size").alias("size"))
    return archive.united(a, table(spark, d, "supplier").select(F.col("s_suppkey").alias("id")), c)


@query("SELECT n_name AS slug, CAST(row_number() OVER (ORDER BY CASE WHEN n_regionkey = 2 THEN 100 - n_nationkey END NULLS LAST, n_name) AS BIGINT) AS nth FROM nation")
def q_set_reading_order(spark, d):
    docs = table(spark, d, "nation").select(F.col("n_name").alias("slug"))
    sections = table(spark, d, "nation").where("n_regionkey = 2").select(F.col("n_name").alias("slug"), (F.lit(100) - F.col("n_nationkey")).alias("place"))
    return archive.reading_order(docs, sections)


@query("""WITH e AS (SELECT CASE event_id % 3 WHEN 0 THEN 'gt' WHEN 1 THEN 'edit' ELSE 'unknown' END AS format FROM events) SELECT format, count(*) AS n FROM e GROUP BY 1""")
def q_cls_export_format(spark, d):
    k = F.col("event_id") % 3
    kind = imports.export_format(F.when(k == 0, F.lit(False)), F.when(k == 0, "m"), F.when(k == 1, "viewer").otherwise("other"), "viewer", strict=False)
    return table(spark, d, "events").select(F.coalesce(kind, F.lit("unknown")).alias("format")).groupBy("format").agg(F.count("*").alias("n"))


def _drafts(spark, d):
    drafts = turns(spark, d).select("object_id", F.col("pos").alias("page"), F.coalesce("text", F.lit("")).alias("text"), F.lit("a").alias("source"), F.when(F.col("role") == "system", "blank").otherwise("content").alias("type"))
    k = F.col("object_id") + F.col("page")
    drafts = drafts.withColumns({"approved": F.when(k % 2 == 0, k % 6 == 0), "expert_edited": k % 9 == 0})
    out = drafts.where(k % 3 != 0).select(F.lit(2).alias("nth"), "object_id", "page", F.when(k % 2 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("text"), F.when(k % 4 == 1, "b").alias("source"), (k % 5 != 0).alias("approved"), F.when(k % 7 == 0, True).alias("expert_edited"))
    stale = out.where(k % 4 == 0).withColumns({"nth": F.lit(1), "text": F.lit("stale"), "approved": ~F.col("approved"), "source": F.lit("z")})
    return drafts, out.unionByName(stale)


TRUTH = """WITH p AS (SELECT conv_id AS object_id, turn AS page, coalesce(text, '') AS t, CASE WHEN role = 'system' THEN 'blank' ELSE 'content' END AS type, conv_id + turn AS k FROM conversations),
r AS (SELECT object_id, page, CASE WHEN k % 3 <> 0 AND k % 2 = 0 THEN t || '!' ELSE t END AS text, CASE WHEN k % 3 <> 0 AND k % 4 = 1 THEN 'b' ELSE 'a' END AS source, CASE WHEN k % 3 <> 0 THEN k % 5 <> 0 WHEN k % 2 = 0 THEN k % 6 = 0 END AS approved, CASE WHEN k % 3 <> 0 THEN k % 7 = 0 ELSE k % 9 = 0 END AS expert_edited, k % 3 <> 0 AND k % 2 = 0 AS updated, k % 3 <> 0 AS imported, type FROM p)"""


@query(f"{TRUTH} SELECT * FROM r")
def q_upd_import_gt(spark, d):
    return imports.import_truth(*_drafts(spark, d))


@query(f"""{TRUTH} SELECT object_id, count(*) FILTER (imported AND approved) AS approved, count(*) FILTER (updated) AS updated, count(*) FILTER (type = 'content') AS content_pages, object_id % 3 = 0 AS expert_verified,
CASE WHEN object_id % 2 = 0 THEN 'ex' ELSE 'importer' END AS reviewed_by, '2026' AS reviewed_at, CASE WHEN object_id % 3 = 0 THEN 'VERIFIZIERT' ELSE 'TEILWEISE' END AS state FROM r WHERE object_id % 5 <> 0 GROUP BY object_id""")
def q_jn_gt_review(spark, d):
    o = F.col("object_id")
    reviews = table(spark, d, "conversations").select(F.col("conv_id").alias("object_id")).distinct().where(o % 5 != 0)
    reviews = reviews.select(o, F.when(o % 3 == 0, True).alias("expert_verified"), F.when(o % 2 == 0, "ex").alias("reviewed_by"), F.lit("2026").alias("reviewed_at"))
    return imports.truth_states(imports.import_truth(*_drafts(spark, d)), reviews, "importer")


def _edits(spark, d):
    pages = turns(spark, d).select("object_id", F.col("pos").alias("page"), F.coalesce("text", F.lit("")).alias("text"), F.col("role").alias("notes"))
    k = F.col("object_id") + F.col("page")
    out = pages.select("object_id", (F.col("page") + F.when(k % 9 == 0, 1000).otherwise(0)).alias("page"), F.concat(F.lit("new "), "text").alias("text"), F.lit(None).cast("string").alias("notes"), (k % 3 == 0).alias("edited"))
    out = out.withColumn("nth", F.lit(2)).unionByName(out.where(k % 6 == 0).withColumns({"nth": F.lit(1), "text": F.lit("stale")}))
    reviews = pages.select("object_id").distinct().select("object_id", (F.col("object_id") % 4 == 0).alias("reviewed"), F.lit("x").alias("reviewed_by"), F.lit("2026").alias("reviewed_at"))
    return pages, out, reviews


@query("""WITH p AS (SELECT conv_id AS object_id, turn AS page, (conv_id + turn) % 3 = 0 AND (conv_id + turn) % 9 <> 0 AS e FROM conversations), s AS (SELECT object_id, coalesce(string_agg(page, ',' ORDER BY page) FILTER (e), '') AS edited_pages FROM p GROUP BY 1)
SELECT object_id, edited_pages, CASE WHEN object_id % 4 = 0 OR edited_pages <> '' THEN 'approved' ELSE 'reviewed' END AS status FROM s""")
def q_upd_import_edit(spark, d):
    _, states = imports.import_edits(*_edits(spark, d))
    return states.select("object_id", F.array_join(F.transform("edited_pages", lambda p: p.cast("string")), ",").alias("edited_pages"), "status")


@query("""SELECT conv_id AS object_id, turn AS page, CASE WHEN (conv_id + turn) % 3 = 0 AND (conv_id + turn) % 9 <> 0 THEN 'new ' || coalesce(text, '') ELSE coalesce(text, '') END AS text, CASE WHEN (conv_id + turn) % 3 = 0 AND (conv_id + turn) % 9 <> 0 THEN '' ELSE role END AS notes, (conv_id + turn) % 3 = 0 AND (conv_id + turn) % 9 <> 0 AS edited FROM conversations""")
def q_jn_import_edit(spark, d):
    rows, _ = imports.import_edits(*_edits(spark, d))
    return rows


@query("""SELECT conv_id AS object_id, turn AS page, coalesce(text, '') AS text_now, coalesce(text, '') || '?' AS text_before FROM conversations WHERE conv_id % 2 = 0 AND turn % 2 = 1 AND turn % 3 = 0""")
def q_jn_version(spark, d):
    pages = turns(spark, d).select("object_id", F.col("pos").alias("page"), F.coalesce("text", F.lit("")).alias("text"))
    before = pages.withColumn("text", F.when(F.col("page") % 3 == 0, F.concat("text", F.lit("?"))).otherwise(F.col("text")))
    reviews = pages.where("page % 2 = 1").groupBy("object_id").agg(F.collect_list("page").alias("edited_pages")).withColumn("status", F.when(F.col("object_id") % 2 == 0, "agent_verified").otherwise("approved"))
    return imports.earlier_versions(pages, before, reviews)


@query("""WITH h AS (SELECT user_id AS o, event_type AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth FROM events) SELECT c_custkey AS object_id, 1 AS page, c_name AS text, coalesce(t, c_name) AS original FROM customer LEFT JOIN h ON o = c_custkey AND nth = 1""")
def q_fraktur_source_text(spark, d):
    pages = table(spark, d, "customer").select(F.col("c_custkey").alias("object_id"), F.lit(1).alias("page"), F.col("c_name").alias("text"))
    history = table(spark, d, "events").select(F.col("user_id").alias("object_id"), F.lit(1).alias("page"), F.struct("ts", "event_id").alias("at"), F.col("event_type").alias("text"))
    return imports.original_text(pages, history)


@query("""SELECT user_id AS object_id, arg_min(event_type, (epoch_us(ts), event_id)) AS oldest FROM events GROUP BY 1""")
def q_win_first_history(spark, d):
    return table(spark, d, "events").groupBy(F.col("user_id").alias("object_id")).agg(F.min_by("event_type", F.struct("ts", "event_id")).alias("oldest"))


HASHES = ("help", "", "catalog?q=zwei%20drei&sort=title&asc=0&page=3", "knowledge", "knowledge/intro", "stats", "about", "view/o_1.2/7", "view/o_1.3", "catalog?collection=a&review=1&group=x%26y", "nonsense")


def _hash_sql(k: str) -> str:
    return "CASE " + k + " % " + str(len(HASHES)) + " " + " ".join(f"WHEN {i} THEN '{h}'" for i, h in enumerate(HASHES)) + " END"


def _param_sql(p: str) -> str:
    return rf"CASE WHEN view = 'catalog' THEN nullif(url_decode(regexp_extract(h, '\?(?:.*&)?{p}=([^&]*)', 1)), '') END"


@query(rf"""WITH x AS (SELECT page_id, {_hash_sql('page_id')} AS h FROM pages), v AS (SELECT *, CASE WHEN h IN ('help', 'knowledge', 'stats', 'about') THEN h WHEN starts_with(h, 'knowledge/') THEN 'knowledge-doc' WHEN starts_with(h, 'view/') THEN 'viewer' ELSE 'catalog' END AS view FROM x)
SELECT page_id, view, nullif(regexp_extract(h, '^knowledge/(.+)$', 1), '') AS slug, nullif(regexp_extract(h, '^view/([^/]+)', 1), '') AS object_id, CASE WHEN view = 'viewer' THEN coalesce(try_cast(regexp_extract(h, '/(\d+)$', 1) AS INT) - 1, 0) WHEN view = 'catalog' THEN 0 END AS at,
{', '.join(f"{_param_sql(p)} AS {p}" if p not in ('group', 'review_status') else (f'{_param_sql(p)} AS "group"' if p == 'group' else f"CASE WHEN {_param_sql('review')} = '1' THEN 'needs_review' ELSE {_param_sql(p)} END AS review_status") for p in archive.PARAMETERS)} FROM v""")
def q_route_parse(spark, d):
    h = F.element_at(F.array(*(F.lit(x) for x in HASHES)), (F.col("page_id") % len(HASHES) + 1).cast("int"))
    return table(spark, d, "pages").select("page_id", archive.route(h).alias("r")).select("page_id", "r.*")


def _metadata(spark, d):
    """Parts as objects with full metadata, some fields of some empty."""
    k = F.col("p_partkey")
    t = lambda n, c: F.when(k % n == 0, "").otherwise(c)
    none = F.array().cast("array<string>")
    m = F.struct(
        F.concat("p_name", F.lit(" & <x>")).alias("title"), t(3, F.concat(F.lit("S-"), "p_brand")).alias("signature"),
        F.when(k % 4 == 0, F.array().cast("array<struct<name:string,role:string,gnd:string>>")).otherwise(F.array(F.struct(F.col("p_brand").alias("name"), F.when(k % 2 == 0, "author").alias("role"), F.when(k % 3 == 0, "g1").alias("gnd")))).alias("creators"),
        t(5, F.col("p_size").cast("string")).alias("date"), t(6, F.lit("Wien")).alias("origin_place"), t(2, F.col("p_type")).alias("objecttyp"), F.when(k % 3 == 1, none).otherwise(F.array("p_brand", F.lit("s2"))).alias("subject"), t(7, F.lit("3 Blatt")).alias("extent"), t(2, F.lit("20 x 30")).alias("dimensions"),
        t(8, F.lit("Tinte")).alias("writing_instrument"), t(4, F.lit("Papier")).alias("writing_material"), F.when(k % 5 == 0, F.array(F.lit("h1"), F.lit("h2"))).otherwise(none).alias("hands"), t(9, F.lit("Archiv")).alias("repository"), t(2, F.lit("u")).alias("repository_gnd"), F.when(k % 2 == 0, F.array(F.lit("Erwerb: x"))).otherwise(none).alias("provenance"),
        t(3, F.lit("n")).alias("notes"), F.lit("").alias("binding"), t(4, F.lit("i")).alias("inscriptions"), F.when(k % 9 != 0, F.struct(F.lit("Archiv").alias("repository"))).alias("holding"),
    )
    return table(spark, d, "part").select(k.alias("id"), m.alias("m"), F.when(k % 4 == 1, "CC").otherwise("").alias("rights"))


PARTS = """SELECT p_partkey AS id, p_partkey AS k, p_name || ' & <x>' AS title, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'S-' || p_brand END AS signature, p_partkey % 4 <> 0 AS made, p_brand AS creator, CASE WHEN p_partkey % 2 = 0 THEN 'author' END AS role, CASE WHEN p_partkey % 3 = 0 THEN 'g1' END AS gnd,
CASE WHEN p_partkey % 5 > 0 THEN CAST(p_size AS VARCHAR) END AS date, CASE WHEN p_partkey % 6 > 0 THEN 'Wien' END AS origin_place, CASE WHEN p_partkey % 2 > 0 THEN p_type END AS objecttyp, p_partkey % 3 <> 1 AS has_subject, CASE WHEN p_partkey % 7 > 0 THEN '3 Blatt' END AS extent, CASE WHEN p_partkey % 2 > 0 THEN '20 x 30' END AS dimensions,
CASE WHEN p_partkey % 8 > 0 THEN 'Tinte' END AS instrument, CASE WHEN p_partkey % 4 > 0 THEN 'Papier' END AS material, p_partkey % 5 = 0 AS has_hands, CASE WHEN p_partkey % 9 > 0 THEN 'Archiv' END AS repository, CASE WHEN p_partkey % 2 > 0 THEN 'u' END AS repository_gnd, p_partkey % 2 = 0 AS has_provenance, CASE WHEN p_partkey % 3 > 0 THEN 'n' END AS notes,
CASE WHEN p_partkey % 4 > 0 THEN 'i' END AS inscriptions, CASE WHEN p_partkey % 4 = 1 THEN 'CC' END AS rights FROM part"""


def _json(**fields: str) -> str:
    """A JSON object of the SQL values that are not null; null if there is none."""
    parts = ", ".join(f"'\"{k}\":' || ({v})" for k, v in fields.items())
    return f"'{{' || nullif(concat_ws(',', {parts}), '') || '}}'"


def _text(c: str) -> str:
    return f"CAST(to_json({c}) AS VARCHAR)" if "'" in c else f"CASE WHEN {c} IS NOT NULL THEN CAST(to_json({c}) AS VARCHAR) END"


DESCRIPTIVE = _json(
    creator=f"CASE WHEN made THEN '[' || {_json(name=_text('creator'), role=_text('role'), gnd=_text('gnd'))} || ']' END",
    subject="CASE WHEN has_subject THEN '[\"' || creator || '\",\"s2\"]' END", origin_place=_text("origin_place"), extent=_text("extent"), rights=_text("rights"), holding="CASE WHEN repository IS NOT NULL THEN '{\"repository\":\"Archiv\"}' END",
    provenance="CASE WHEN has_provenance THEN '[\"Erwerb: x\"]' END",
    physical_description=_json(writing_instrument=_text("instrument"), writing_material=_text("material"), hands="CASE WHEN has_hands THEN '[\"h1\",\"h2\"]' END", dimensions=_text("dimensions"), inscriptions=_text("inscriptions")), notes=_text("notes"),
)


@query(f"SELECT id, {DESCRIPTIVE} AS block FROM ({PARTS})")
def q_meta_descriptive(spark, d):
    return _metadata(spark, d).select("id", F.to_json(exports.descriptive(F.col("m"), F.col("rights"))).alias("block"))


PAGES_JSON = """'[' || (CASE WHEN k % 2 = 0 THEN '{"page":1,"type":"content","text":' || CAST(to_json(title) AS VARCHAR) || ',"image":"IMG_1.jpg"}' ELSE '{"page":1,"type":"blank","text":"","notes":"leer"}' END) || ',{"page":2,"type":"content","text":""}]'"""


@query(f"""SELECT id, {_json(page_json="'\"0.2\"'", source=_json(id="'\"o' || id || '\"'", title=_text("title"), shelfmark=_text("signature"), date=_text("date"), descriptive_metadata=DESCRIPTIVE), provenance="'{\"pipeline\":\"p\"}'", pages=PAGES_JSON, confidence="CASE WHEN k % 3 > 0 THEN '\"high\"' END", quality="CASE WHEN k % 4 = 0 THEN '{\"needs_review\":true}' END")} AS page_json FROM ({PARTS})""")
def q_exp_page_json(spark, d):
    m, k = F.col("m"), F.col("id")
    page = lambda n, kind, text, notes, image: F.struct(F.lit(n).alias("page"), kind.alias("type"), text.alias("text"), exports.truthy(notes).alias("notes"), exports.truthy(image).alias("image"))
    even, empty = k % 2 == 0, F.lit("")
    pages = F.array(page(1, F.when(even, "content").otherwise("blank"), F.when(even, m["title"]).otherwise(""), F.when(even, "").otherwise("leer"), F.when(even, "IMG_1.jpg").otherwise("")), page(2, F.lit("content"), empty, empty, empty))
    source = F.struct(F.concat(F.lit("o"), k.cast("string")).alias("id"), m["title"].alias("title"), exports.truthy(m["signature"]).alias("shelfmark"), exports.truthy(m["date"]).alias("date"), exports.descriptive(m, F.col("rights")).alias("descriptive_metadata"))
    quality = F.when(k % 4 == 0, F.struct(F.lit(True).alias("needs_review")))
    out = exports.page_json(source, F.struct(F.lit("p").alias("pipeline")), pages, F.when(k % 3 > 0, "high"), F.lit(""), quality, F.lit(None).cast("struct<status:string>"))
    return _metadata(spark, d).select("id", out.alias("page_json"))


def _el(name: str, content: str, attributes: str = "") -> str:
    return f"('<{name}{attributes}>' || ({content}) || '</{name}>')"


def _esc(c: str) -> str:
    return f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _cat(*parts: str) -> str:
    return f"nullif(concat_ws('', {', '.join(parts)}), '')"


def _note(kind: str, c: str) -> str:
    return _el("mods:note", c, f' type="{kind}"')


MODS_SQL = _el("mods:mods", "concat_ws('', " + ", ".join([
    _el("mods:titleInfo", _cat(_el("mods:title", _esc("title")), _note("signature", "signature"))),
    f"CASE WHEN made THEN {_el('mods:name', _cat(_el('mods:displayForm', 'creator'), _el('mods:role', _el('mods:roleTerm', 'role', ' type="text"')), _el('mods:nameIdentifier', 'gnd', ' type="gnd"')), ' type="personal"')} END",
    f"CASE WHEN k % 3 > 0 THEN {_el('mods:language', _cat(_el('mods:languageTerm', '''CASE WHEN k % 3 = 1 THEN 'Deutsch' END''', ' type="text"'), _el('mods:languageTerm', '''CASE WHEN k % 3 = 1 THEN 'de' ELSE 'fr' END''', ' authority="iso639-1" type="code"')))} END",
    _el("mods:originInfo", _cat(_el("mods:dateCreated", "date"), _el("mods:place", _el("mods:placeTerm", "origin_place", ' type="text"')))),
    _el("mods:genre", "objecttyp"),
    f"CASE WHEN has_subject THEN {_el('mods:subject', _el('mods:topic', 'creator') + ' || ' + _el('mods:topic', '''CAST('s2' AS VARCHAR)'''))} END",
    _el("mods:physicalDescription", _cat(_el("mods:extent", "extent"), _el("mods:extent", "dimensions"), _note("writing_instrument", "instrument"), _note("writing_material", "material"), f"CASE WHEN has_hands THEN {_note('script', '''CAST('h1' AS VARCHAR)''')} || {_note('script', '''CAST('h2' AS VARCHAR)''')} END")),
    _el("mods:location", _cat("'<mods:physicalLocation' || CASE WHEN repository_gnd IS NULL THEN '' ELSE ' authority=\"gnd\" valueURI=\"u\"' END || '>' || repository || '</mods:physicalLocation>'", _el("mods:shelfLocator", "signature"))),
    _el("mods:identifier", "'info:fedora/o:' || k", ' type="urn"'),
    f"CASE WHEN has_provenance THEN {_note('provenance', '''CAST('Erwerb: x' AS VARCHAR)''')} END",
    _el("mods:accessCondition", "rights"), _el("mods:note", "notes"),
]) + ")", f' xmlns:mods="{exports.MODS}"')


def _mods():
    k = F.col("id")
    language = F.when(k % 3 == 1, "Deutsch").otherwise("")
    code = F.when(k % 3 == 1, "de").when(k % 3 == 2, "fr").otherwise("und")
    return exports.mods(F.col("m"), F.col("rights"), F.concat(F.lit("o:"), k.cast("string")), language, code)


@query(f"SELECT id, {MODS_SQL} AS mods FROM ({PARTS})")
def q_exp_mods(spark, d):
    return _metadata(spark, d).select("id", _mods().alias("mods"))


@query("""WITH p AS (SELECT conv_id AS object_id, turn AS page, CASE turn % 3 WHEN 0 THEN 'content' WHEN 1 THEN 'blank' END AS type FROM conversations) SELECT object_id, page, CASE WHEN coalesce(type, 'content') = 'content' THEN 'U.1' ELSE 'U.2' END AS target FROM p""")
def q_exp_struct_link(spark, d):
    kind = F.when(F.col("pos") % 3 == 0, "content").when(F.col("pos") % 3 == 1, "blank")
    return turns(spark, d).select("object_id", F.col("pos").alias("page"), exports.link_target(kind).alias("target"))


METS_SQL = f"""'<mets:mets xmlns:mets="{exports.METS}" xmlns:xlink="{exports.XLINK}" xmlns:dv="{exports.RIGHTS}"><mets:dmdSec ID="DMD.1"><mets:mdWrap MDTYPE="MODS" MIMETYPE="text/xml"><mets:xmlData>' || {MODS_SQL} || '</mets:xmlData></mets:mdWrap></mets:dmdSec><mets:amdSec ID="AMD.1"><mets:rightsMD ID="RMD.1"><mets:mdWrap MDTYPE="OTHER" MIMETYPE="text/xml" OTHERMDTYPE="DVRIGHTS"><mets:xmlData><dv:rights><dv:owner>A &amp; B</dv:owner></dv:rights></mets:xmlData></mets:mdWrap></mets:rightsMD><mets:digiprovMD ID="PMD.1"><mets:mdWrap MDTYPE="OTHER" MIMETYPE="text/xml" OTHERMDTYPE="DVLINKS"><mets:xmlData><dv:links><dv:reference /><dv:presentation /></dv:links></mets:xmlData></mets:mdWrap></mets:digiprovMD></mets:amdSec><mets:fileSec><mets:fileGrp USE="DEFAULT">'
|| array_to_string(list_transform(range(1, k % 4 + 2), lambda i: '<mets:file ID="IMG.' || i || '" MIMETYPE="image/jpeg"><mets:FLocat LOCTYPE="URL" xlink:href="http://x/' || i || '?a=&quot;1&quot;&amp;b=2" /></mets:file>'), '') || '</mets:fileGrp>' || CASE WHEN k % 3 = 0 THEN '<mets:fileGrp USE="PAGE"><mets:file ID="PAGE.1" MIMETYPE="application/xml"><mets:FLocat LOCTYPE="URL" xlink:href="o' || k || '_page/page_001.xml" /></mets:file></mets:fileGrp>' ELSE '' END
|| '</mets:fileSec><mets:structMap TYPE="PHYSICAL"><mets:div ID="PHY.1" TYPE="physSequence">' || array_to_string(list_transform(range(1, k % 4 + 2), lambda i: '<mets:div ID="DIV.' || i || '" ORDER="' || i || '" TYPE="page" CONTENTIDS="http://x/?q=&quot;1&quot;&amp;o:' || k || '/IMG.' || i || '"><mets:fptr FILEID="IMG.' || i || '" />' || CASE WHEN k % 3 = 0 AND i = 1 THEN '<mets:fptr FILEID="PAGE.1" />' ELSE '' END || '</mets:div>'), '')
|| '</mets:div></mets:structMap><mets:structMap TYPE="LOGICAL"><mets:div ADMID="AMD.1" DMDID="DMD.1" ID="LOG.1" TYPE="monograph"><mets:div ID="U.1" TYPE="Textseiten" /><mets:div ID="U.2" TYPE="Farbreferenz/Schluss" /></mets:div></mets:structMap><mets:structLink>' || array_to_string(list_transform(range(1, k % 4 + 2), lambda i: '<mets:smLink xlink:from="' || CASE WHEN i = 2 THEN 'U.2' ELSE 'U.1' END || '" xlink:to="DIV.' || i || '" />'), '') || '</mets:structLink></mets:mets>'"""


@query(f"SELECT id, {METS_SQL} AS mets FROM ({PARTS})")
def q_exp_mets(spark, d):
    k = F.col("id")
    images = F.transform(F.sequence(F.lit(1), (k % 4 + 1).cast("int")), lambda i: F.concat(F.lit("http://x/"), i.cast("string"), F.lit('?a="1"&b=2')))
    layouts = F.when(k % 3 == 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    out = exports.mets(_mods(), F.lit("A & B"), F.concat(F.lit("o"), k.cast("string")), F.concat(F.lit('http://x/?q="1"&o:'), k.cast("string")), images, F.array(F.lit("content"), F.lit("color_chart")), layouts)
    return _metadata(spark, d).select("id", out.alias("mets"))

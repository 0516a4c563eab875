"""Registered queries of the small rules: bins, classes and boxes, with their SQL. Tables stand in as in catalogue.py."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import letters, rules, similarity, text
from ..functions.text import lookup
from ..operators import layout, pages, readings
from .catalogue import _ascii, _flat, _jaccard, _words, plain_ascii, query, table, turns

TITLES = ("Ansichtspostkarte an X", "Postkarte", "ein Telegramm", "An den Bruder", "POSTKARTE mit Bild")
LABELS = ("text", "Title", "section_header", "list-item", "table", "picture", "caption", "unheard-of")


def _of(values, k):
    return F.element_at(F.array(*(F.lit(v) for v in values)), (k % len(values) + 1).cast("int"))


def _sql_of(values, k: str) -> str:
    return f"[{', '.join(repr(v) for v in values)}][CAST(({k}) % {len(values)} + 1 AS INT)]"


@query(f"WITH t AS (SELECT lower({_sql_of(TITLES, 'o_orderkey')}) AS t FROM orders) SELECT CASE WHEN contains(t, 'ansichtspostkarte') THEN 'Ansichtspostkarte' WHEN contains(t, 'postkarte') THEN 'Postkarte' WHEN contains(t, 'telegramm') THEN 'Telegramm' ELSE 'Brief' END AS type, count(*) AS n FROM t GROUP BY 1")
def q_cls_corresp_type(spark, d):
    return table(spark, d, "orders").select(rules.letter_type(_of(TITLES, F.col("o_orderkey"))).alias("type")).groupBy("type").agg(F.count("*").alias("n"))


@query("""SELECT l_orderkey AS page, CASE WHEN bool_or(l_quantity > 45) THEN 'needs_correction' WHEN bool_or(l_quantity > 25) THEN 'acceptable' ELSE 'good' END AS overall FROM lineitem GROUP BY 1""")
def q_cls_layout_overall(spark, d):
    mark = F.when(F.col("l_quantity") > 45, "needs_correction").when(F.col("l_quantity") > 25, "acceptable").otherwise("good")
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("page")).agg(rules.layout_overall(F.collect_set(mark)).alias("overall"))


@query("""SELECT l_orderkey AS object_id, CASE min(CASE WHEN l_linenumber % 3 = 0 THEN 0 WHEN l_linenumber % 3 = 1 THEN 2 ELSE 1 END) WHEN 0 THEN 'low' WHEN 1 THEN 'medium' ELSE 'high' END AS confidence FROM lineitem GROUP BY 1""")
def q_cls_confidence_merge(spark, d):
    c = F.when(F.col("l_linenumber") % 3 == 0, "low").when(F.col("l_linenumber") % 3 == 1, "high").otherwise("medium")
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("object_id")).agg(rules.least_confidence(F.collect_set(c)).alias("confidence"))


@query("""WITH c AS (SELECT CAST(event_id % 64 AS DOUBLE) / 256 AS c FROM events) SELECT CASE WHEN c < 0.03 THEN '<3' WHEN c < 0.05 THEN '<5' WHEN c < 0.1 THEN '<10' WHEN c < 0.2 THEN '<20' ELSE '>=20' END AS bin, count(*) AS n FROM c GROUP BY 1""")
def q_cls_consensus_bin(spark, d):
    return table(spark, d, "events").select(rules.cer_bin((F.col("event_id") % 64).cast("double") / 256).alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))


@query("""WITH c AS (SELECT CAST(event_id % 64 AS DOUBLE) / 128 AS c FROM events) SELECT CASE WHEN c < 0.05 THEN '<5' WHEN c <= 0.15 THEN '5-15' WHEN c <= 0.3 THEN '15-30' ELSE '>30' END AS band, count(*) AS n FROM c GROUP BY 1""")
def q_cls_adaptive_band(spark, d):
    return table(spark, d, "events").select(rules.adaptive_band((F.col("event_id") % 64).cast("double") / 128).alias("band")).groupBy("band").agg(F.count("*").alias("n"))


@query("SELECT CAST(least(7, floor(CAST(event_id % 100 AS DOUBLE) / 64 * 10)) AS INT) AS bin, count(*) AS n FROM events GROUP BY 1")
def q_cls_dwr_bin(spark, d):
    return table(spark, d, "events").select(rules.ratio_bin((F.col("event_id") % 100).cast("double") / 64).alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))


REGIONS_SQL = "CASE " + " ".join(f"WHEN l = '{k}' THEN '{v}'" for k, v in rules.REGION_TYPES.items()) + f" WHEN l IN {rules.REGION_SKIP!r} THEN NULL ELSE 'paragraph' END"
PAGE_SQL = "CASE " + " ".join(f"WHEN r = '{k}' THEN '{v}'" for k, v in rules.PAGE_XML_TYPES.items()) + " END"


@query(f"WITH l AS (SELECT {_sql_of(LABELS, 'l_orderkey + l_linenumber')} AS l FROM lineitem) SELECT l AS label, {REGIONS_SQL} AS type, count(*) AS n FROM l GROUP BY ALL")
def q_cls_region_type(spark, d):
    label = _of(LABELS, F.col("l_orderkey") + F.col("l_linenumber"))
    return table(spark, d, "lineitem").select(label.alias("label")).select("label", rules.region_type(F.col("label")).alias("type")).groupBy("label", "type").agg(F.count("*").alias("n"))


@query(f"WITH l AS (SELECT {_sql_of(LABELS, 'l_orderkey + l_linenumber')} AS l FROM lineitem), r AS (SELECT {REGIONS_SQL} AS r FROM l) SELECT {PAGE_SQL} AS type, count(*) AS n FROM r WHERE r IS NOT NULL GROUP BY 1")
def q_cls_pagexml_type(spark, d):
    kind = rules.region_type(_of(LABELS, F.col("l_orderkey") + F.col("l_linenumber")))
    rows = table(spark, d, "lineitem").select(kind.alias("r")).where("r is not null")
    return rows.select(lookup(F.col("r"), rules.PAGE_XML_TYPES).alias("type")).groupBy("type").agg(F.count("*").alias("n"))


def _boxes(spark, d):
    k = F.col("l_orderkey") + F.col("l_linenumber")
    box = F.array((k % 11 * 8).cast("double"), (k % 7 * 12).cast("double"), F.when(k % 5 == 0, 96.0).otherwise(k % 9 / 4), F.when(k % 5 == 0, 97.0).otherwise(k % 3 / 4))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", k.alias("k"), box.alias("b"))


BOXES = "SELECT *, CASE WHEN k % 5 = 0 THEN 96.0 ELSE k % 9 / 4 END AS w, CASE WHEN k % 5 = 0 THEN 97.0 ELSE k % 3 / 4 END AS h, k % 11 * 8.0 AS x, k % 7 * 12.0 AS y FROM (SELECT *, l_orderkey + l_linenumber AS k FROM lineitem)"


@query(f"SELECT l_orderkey AS page, count(*) FILTER (w > 0.5 AND h > 0.3 AND NOT (w > 95 AND h > 95)) AS valid, count(*) AS n FROM ({BOXES}) GROUP BY 1")
def q_flt_region_valid(spark, d):
    return _boxes(spark, d).groupBy(F.col("l_orderkey").alias("page")).agg(F.count_if(layout.valid(F.col("b"))).alias("valid"), F.count("*").alias("n"))


@query(f"""WITH p AS (SELECT l_orderkey AS page, l_linenumber AS region, CAST(l_quantity AS DOUBLE) AS q, greatest(0, CAST(round_even(x / 100 * 1000, 0) AS INT)) AS x1, greatest(0, CAST(round_even(y / 100 * 800, 0) AS INT)) AS y1, least(1000, CAST(round_even((x + w) / 100 * 1000, 0) AS INT)) AS x2, least(800, CAST(round_even((y + h) / 100 * 800, 0) AS INT)) AS y2 FROM ({BOXES}))
SELECT page, region, q, x1 || ',' || y1 || ' ' || x2 || ',' || y1 || ' ' || x2 || ',' || y2 || ' ' || x1 || ',' || y2 AS points FROM p""")
def q_geo_coords(spark, d):
    return _boxes(spark, d).select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("region"), F.col("l_quantity").cast("double").alias("q"), layout.polygon(F.col("b"), F.lit(1000), F.lit(800)).alias("points"))


@query("""WITH b AS (SELECT l_orderkey AS page, l_linenumber AS region, l_orderkey % 97 * 8.0 AS x, l_linenumber * 64.0 AS y FROM lineitem)
SELECT page, region, x / 1024 * 100 // 0.0000001 IS NOT NULL AS known, round_even(least(100, x / 1024 * 100), 1) AS x, round_even(least(100, (1024 - y) / 1024 * 100), 1) AS y, round_even(128 / 1024 * 100, 1) AS w, round_even(32 / 1024 * 100, 1) AS h FROM b""")
def q_geo_pct_bbox(spark, d):
    x, y, n = F.col("l_orderkey") % 97 * 8.0, F.col("l_linenumber") * 64.0, F.lit(1024)
    box = layout.percent_box(x, y, x + 128, y - 32, n, n, from_bottom=True)
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("region"), F.lit(True).alias("known"), box.alias("b"))
    return rows.select("page", "region", "known", *(F.col("b")[i].alias(c) for i, c in enumerate("xywh")))


DOUBLED = "SELECT conv_id AS object_id, turn AS pos, coalesce(text, '') AS text FROM conversations UNION ALL SELECT conv_id, turn + 100, repeat(text || ' ', 2) || 'xyz' FROM conversations WHERE conv_id % 3 = 0 AND text IS NOT NULL"


@query(rf"""WITH p AS (SELECT *, list_distinct({_words('lower(text)')}) AS bag FROM ({DOUBLED}) WHERE regexp_replace(text, '\s', '', 'g') <> '' AND length(trim(text)) > 50)
SELECT a.object_id, a.pos AS i, b.pos AS j FROM p a JOIN p b ON a.object_id = b.object_id AND a.pos < b.pos WHERE {_jaccard('a.bag', 'b.bag')} > 0.9""")
def q_duplicate_pages(spark, d):
    rows = turns(spark, d).select("object_id", "pos", F.coalesce("text", F.lit("")).alias("text"))
    copies = turns(spark, d).where("object_id % 3 = 0 and text is not null").select("object_id", (F.col("pos") + 100).alias("pos"), F.concat(F.repeat(F.concat("text", F.lit(" ")), F.lit(2)), F.lit("xyz")).alias("text"))
    return pages.duplicate_pairs(pages.typed(rows.unionByName(copies)))


@query(rf"""WITH t AS (SELECT conv_id AS object_id, turn AS pos, CASE WHEN turn % 2 = 0 THEN coalesce(text, '') || ' [?] [...]' ELSE coalesce(text, '') END AS t FROM conversations)
SELECT object_id, pos, coalesce((len(regexp_extract_all(t, '\[\?\]')) + len(regexp_extract_all(t, '\[\.\.\..*?\]'))) / CAST(nullif(len({_words('t')}), 0) AS DOUBLE), 0) AS density FROM t""")
def q_marker_density(spark, d):
    t = F.coalesce("text", F.lit(""))
    rows = turns(spark, d).select("object_id", "pos", F.when(F.col("pos") % 2 == 0, F.concat(t, F.lit(" [?] [...]"))).otherwise(t).alias("t"))
    return rows.select("object_id", "pos", text.marker_density("t").alias("density"))


@query("""SELECT o_custkey AS object_id, count(*) FILTER (o_orderkey % 4 = 0) AS consensus_3of3, count(*) FILTER (o_orderkey % 4 = 1) AS majority_2of3, count(*) FILTER (o_orderkey % 4 = 2) AS strongest_only, count(*) FILTER (o_orderkey % 4 = 3) AS skipped FROM orders GROUP BY 1""")
def q_agg_merge_stats(spark, d):
    kind = _of(("consensus_3of3", "majority_2of3", "strongest_only", "skipped"), F.col("o_orderkey"))
    return readings.merge_statistics(table(spark, d, "orders").select(F.col("o_custkey").alias("object_id"), kind.alias("source")))


@query("""WITH p AS (SELECT conv_id AS object_id, turn + 1 AS n, text FROM conversations), o AS (SELECT object_id, count(*) AS pages, count(*) FILTER (regexp_replace(coalesce(text, ''), '\\s', '', 'g') = '') AS bare FROM p GROUP BY 1)
SELECT object_id, pages, object_id % 3 = 0 AS page_image_mismatch FROM o""".replace("\\\\", "\\"))
def q_page_image_mismatch(spark, d):
    rows = pages.typed(turns(spark, d))
    objects = rows.groupBy("object_id").agg((F.count("*") + F.when(F.col("object_id") % 3 == 0, 1).otherwise(0)).alias("images"))
    return pages.signals(rows, objects).select("object_id", "pages", "page_image_mismatch")


def _two(spark, d):
    """Two readings of each turn: the second one changes vowels on some pages, and drops or repeats words on others."""
    k, t = (F.col("object_id") + F.col("pos")) % 6, plain_ascii(F.coalesce("text", F.lit("")))
    other = F.when(k == 1, F.replace(t, F.lit("e"), F.lit("a"))).when(k == 2, F.regexp_replace(t, " the ", " ")).when(k == 3, F.regexp_replace(t, " a ", " a a ")).otherwise(t)
    return turns(spark, d).select("object_id", "pos", t.alias("text_a"), other.alias("text_b"))


_T = _ascii("coalesce(text, '')")


@query(f"""WITH t AS (SELECT conv_id AS object_id, turn AS pos, {_T} AS t, (conv_id + turn) % 6 AS k FROM conversations), r AS (SELECT object_id, pos, t AS a, CASE k WHEN 1 THEN replace(t, 'e', 'a') WHEN 2 THEN replace(t, ' the ', ' ') WHEN 3 THEN replace(t, ' a ', ' a a ') ELSE t END AS b FROM t),
n AS (SELECT object_id, pos, {_flat('a')} AS a, {_flat('b')} AS b FROM r), m AS (SELECT *, levenshtein(a, b) AS apart, length(a) AS size FROM n),
o AS (SELECT object_id, CASE WHEN sum(size) > 0 THEN sum(apart) / sum(size) WHEN sum(apart) > 0 THEN 1.0 ELSE 0.0 END AS agreement_cer, coalesce(string_agg(pos, ',' ORDER BY pos) FILTER (CASE WHEN size > 0 THEN apart / size > 0.05 ELSE apart > 0 END), '') AS disagreement_pages FROM m GROUP BY 1)
SELECT object_id, CAST(agreement_cer AS DOUBLE) AS agreement_cer, disagreement_pages, agreement_cer < 0.03 AS high_agreement FROM o""")
def q_sim_agreement(spark, d):
    rows = readings.object_agreement(_two(spark, d))
    return rows.withColumn("disagreement_pages", F.array_join(F.transform("disagreement_pages", lambda p: p.cast("string")), ","))


@query()
def q_sim_agreement_wer(spark, d):
    return readings.object_agreement(_two(spark, d), words=True)


@query()
def q_sim_omission(spark, d):
    a, b = F.col("text_a"), F.col("text_b")
    rows = readings.spread_out(_two(spark, d))
    return rows.select("object_id", "pos", similarity.omission(a, b).alias("omission"), similarity.hallucination(a, b).alias("hallucination"))


@query()
def q_fraktur_find(spark, d):
    """Texts with f for s, against the words of those without."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    known = docs.where("doc_id % 2 = 1").select(F.explode(text.letter_runs("text")).alias("known")).distinct()
    return letters.find_corrections(docs.where("doc_id % 2 = 0").withColumn("text", F.regexp_replace("text", "(?<=[a-z])s(?=[a-z])", "f")), ["doc_id"], known)

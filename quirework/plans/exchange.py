"""Registered queries of XML readers, versions and ranks, with their SQL. Tables stand in as in catalogue.py; XML is made of their rows and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import edits, frontmatter, letters, normal_forms, similarity, text
from ..operators import archive, artefacts, chunks, layout, readings, review, review_exports, versions
from ..sources import archival_xml, parsing
from .catalogue import _normalize, query, table, turns

#: An entry's XML, made alike in both engines.
_ENTRY = """'<biblFull xmlns="http://www.tei-c.org/ns/1.0"><titleStmt><title>' || c_name || ' &amp; Co</title><title xml:lang="en">x</title>' ||
 CASE WHEN c_custkey % 3 > 0 THEN '<author><persName' || CASE WHEN c_custkey % 2 = 0 THEN ' ref="g' || c_custkey || '"' ELSE '' END || '><forename>F</forename><surname>' || c_mktsegment || '</surname></persName></author>' ELSE '<editor><persName>' || c_mktsegment || '</persName></editor>' END ||
 '</titleStmt><sourceDesc><msDesc><msIdentifier><settlement>S' || c_nationkey || '</settlement><idno type="other">no</idno><idno type="signature">AB-' || c_custkey || '</idno><altIdentifier><idno type="PID">o:c.' || c_custkey || '</idno></altIdentifier></msIdentifier>' ||
 '<physDesc><objectDesc><supportDesc><support><material ana="WritingInstrument" xml:lang="en">ink</material><material ana="x WritingInstrument">Tinte' || CASE WHEN c_custkey % 5 = 0 THEN '   schwarz' ELSE '' END || '</material></support><extent><measure type="leaf">' || CASE WHEN c_custkey % 4 = 0 THEN ' ' ELSE c_nationkey || ' Blatt' END || '</measure></extent></supportDesc></objectDesc><handDesc><ab>A, B' || c_nationkey || ', </ab></handDesc></physDesc>' ||
 '<history><origin><origDate' || CASE WHEN c_custkey % 2 = 0 THEN ' when="19' || c_nationkey || '"/>' ELSE '>um ' || c_nationkey || '</origDate>' END || '</origin><provenance><ab>P</ab><ab xml:lang="en">E</ab></provenance><acquisition><ab>K' || c_nationkey || '</ab></acquisition></history></msDesc></sourceDesc>' ||
 '<profileDesc><textClass><keywords><term type="objecttyp">Brief</term><term type="classification">' || c_mktsegment || '</term></keywords></textClass></profileDesc></biblFull>'"""


def _entries(spark, d):
    rows = readings.spread_out(table(spark, d, "customer"), ("c_custkey",)).select("c_custkey", F.expr(_ENTRY).alias("xml"))  # a small file is many entries to parse
    return archival_xml.described(rows, "xml")


@query("""SELECT c_custkey, 'o:c.' || c_custkey AS pid, c_name || ' & Co' AS title, 'AB-' || c_custkey AS signature, CASE WHEN c_custkey % 2 = 0 THEN '19' || c_nationkey ELSE 'um ' || c_nationkey END AS date, '' AS language, 'Brief' AS objecttyp,
CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_nationkey || ' Blatt' END AS extent, 'Tinte' || CASE WHEN c_custkey % 5 = 0 THEN ' schwarz' ELSE '' END AS writing_instrument, 'A, B' || c_nationkey || ',' AS hand, '' AS notes, c_mktsegment AS classification FROM customer""")
def q_tei_extract(spark, d):
    return _entries(spark, d).select("c_custkey", "pid", "title", "signature", "date", "language", "objecttyp", "extent", "writing_instrument", "hand", "notes", "classification")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN 'F ' ELSE '' END || c_mktsegment AS creator, CASE WHEN c_custkey % 3 > 0 THEN 'author' ELSE 'editor' END AS role, CASE WHEN c_custkey % 3 > 0 AND c_custkey % 2 = 0 THEN 'g' || c_custkey END AS gnd,
'S' || c_nationkey AS settlement, 'P|Erwerb: K' || c_nationkey AS provenance, 'A|B' || c_nationkey AS hands, c_mktsegment AS subject, '' AS inscriptions, '' AS binding FROM customer""")
def q_tei_extract_full(spark, d):
    rows = _entries(spark, d).withColumn("c", F.get("creators", F.lit(0)))
    return rows.select("c_custkey", F.col("c.name").alias("creator"), "c.role", "c.gnd", "holding.settlement", *(F.array_join(c, "|").alias(c) for c in ("provenance", "hands", "subject", "inscriptions")), "binding")


def _layout(spark, d):
    """Regions of orders, one a line; the order of reading runs against the line numbers."""
    n = F.col("l_linenumber")
    kind = F.element_at(F.array(*(F.lit(x) for x in ("paragraph", "heading", "list", "table", "marginalia"))), (n % 5 + 1).cast("int"))
    box = F.array(n * 3.5, n * 7.1, F.lit(20.4), n * 0.3)
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("l_returnflag"))
    return lines.select(
        F.col("l_orderkey").cast("string").alias("object_id"), F.lit(1).alias("page"), F.lit('a"b.jpg').alias("image"), F.lit(1000).alias("width"), F.lit(2000).alias("height"),
        F.concat(F.lit("r"), n).alias("region_id"), kind.alias("type"), box.alias("bbox"), (10 - n).cast("int").alias("reading_order"), F.concat("l_returnflag", F.lit(' <&\n"> ')).alias("text"),
    )


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS object_id, 1 AS page, 'a"b.jpg' AS image, 'r' || l_linenumber AS region_id, ['paragraph', 'heading', 'list', 'table', 'marginalia'][l_linenumber % 5 + 1] AS type,
CAST(l_linenumber * 35 AS INTEGER) AS x, CAST(l_linenumber * 71 AS INTEGER) AS y, 204 AS w, CAST(l_linenumber * 3 AS INTEGER) AS h, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC) AS INTEGER) AS reading_order, l_returnflag || ' <&' || chr(10) || '"> ' AS text FROM (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1, 2)""")
def q_imp_page_xml(spark, d):
    rows = archival_xml.page_regions(layout.page_xml(_layout(spark, d)), ["object_id", "page"], "xml")
    tenths = lambda i: F.round(F.col("bbox")[i] * 10).cast("int")
    return rows.select("object_id", "page", "image", "region_id", "type", *(tenths(i).alias(c) for i, c in enumerate("xywh")), "reading_order", "text")


@query("""WITH r AS (SELECT l_quantity, l_extendedprice, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS x, rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS y FROM lineitem)
SELECT round(corr(CAST(x AS DOUBLE), CAST(y AS DOUBLE)), 6) AS rho, count(*) AS n FROM r""")
def q_agg_signal_rho(spark, d):
    return review.spearman(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice").select(F.round("rho", 6).alias("rho"), "n")


@query("""WITH c AS (SELECT l_quantity AS v, count(*) AS n FROM lineitem GROUP BY 1) SELECT CAST(v AS DOUBLE) AS l_quantity, CAST(coalesce(sum(n) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (n + 1) / 2 AS DOUBLE) AS rank FROM c""")
def q_win_mean_rank(spark, d):
    return review.ranks(table(spark, d, "lineitem"), "l_quantity", 8)


#: Versions of users' states: one a change of the event's type, as the log tells them.
_VERSIONS = """v AS (SELECT user_id AS object_id, event_type AS state, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS version, event_id AS "at" FROM events WHERE event_id % 3 <> 0)"""


def _versions(spark, d):
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, d, "events").where("event_id % 3 <> 0").select(F.col("user_id").alias("object_id"), F.col("event_type").alias("state"), nth.alias("version"), F.col("event_id").alias("at"))


@query(f"""WITH {_VERSIONS} SELECT object_id, arg_max(state, version) AS state, max(version) AS version FROM v WHERE "at" <= 5000 GROUP BY 1""")
def q_ver_as_of(spark, d):
    return versions.as_of(_versions(spark, d), ["object_id"], F.lit(5000)).select("object_id", "state", "version")


@query(f"""WITH {_VERSIONS}, s AS (SELECT object_id, arg_max(state, version) AS state, max(version) AS version FROM v GROUP BY 1),
n AS (SELECT user_id AS object_id, max(event_type) FILTER (event_id % 3 = 0) AS state FROM events GROUP BY 1)
SELECT object_id, n.state, CAST(coalesce(version, 0) + 1 AS INTEGER) AS version FROM n LEFT JOIN s USING (object_id) WHERE version IS NULL OR n.state IS DISTINCT FROM s.state""")
def q_upd_new_versions(spark, d):
    """New versions of states that differ from the latest; nulls count as a state."""
    now = table(spark, d, "events").groupBy(F.col("user_id").alias("object_id")).agg(F.max(F.when(F.col("event_id") % 3 == 0, F.col("event_type"))).alias("state"))
    current = versions.state(_versions(spark, d), ["object_id"])
    return versions.changes(current, now, ["object_id"], ["state"]).select("object_id", "state", F.col("version").cast("int").alias("version"))


#: Letters taken apart, by both engines.
_APART = (("é", "e\u0301"), ("ü", "u\u0308"), ("ö", "o\u0308"), ("ñ", "n\u0303"), ("Å", "\u212b"))


def _apart_sql(c: str) -> str:
    for a, b in _APART:
        c = f"replace({c}, '{a}', '{b}')"
    return c


@query(f"SELECT doc_id, md5({_normalize('t')}) AS normal FROM (SELECT doc_id, nfc_normalize({_apart_sql('text')}) AS t FROM documents)")
def q_fn_normalize_nfc(spark, d):
    c = F.col("text")
    for a, b in _APART:
        c = F.replace(c, F.lit(a), F.lit(b))
    return table(spark, d, "documents").select("doc_id", F.md5(normal_forms.normalized(c)).alias("normal"))


@query("""SELECT conv_id AS object_id, turn AS pos, CAST(len(w) - (turn % 3) AS BIGINT) AS matches, CAST(turn % 3 + turn % 2 AS BIGINT) AS divergent, CAST(len(w) - (turn % 3) AS BIGINT) AS common
FROM (SELECT *, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS w FROM conversations) WHERE len(w) > 3""")
def q_sim_edit_diff(spark, d):
    """Present texts lack the first words of the oldest and have one more at the end: what was done is what the script tells."""
    rows = readings.spread_out(turns(spark, d)).withColumn("w", text.words("text")).where(F.size("w") > 3)
    now = F.concat(F.array_join(F.slice("w", F.col("pos") % 3 + 1, F.size("w")), " "), F.when(F.col("pos") % 2 == 1, " \u00a7new").otherwise(""))
    rows = rows.select("object_id", "pos", F.array(F.struct(F.col("text").alias("original_transcription")), F.struct(F.lit("later").alias("original_transcription"))).alias("history"), now.alias("now"))
    rows = rows.withColumns({"d": edits.edit_diff(F.col("history"), F.col("now")), "common": edits.words_in_common(F.get("history", F.lit(0))["original_transcription"], F.col("now"))}).withColumn("s", similarity.diff_statistics(F.col("d")))
    return rows.select("object_id", "pos", F.col("s.matches").cast("long").alias("matches"), F.col("s.divergent").cast("long").alias("divergent"), "common")


@query(f"""WITH t AS (SELECT c_custkey AS slug, c_name AS title FROM customer WHERE c_custkey % 2 = 0)
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'no link ' || event_type ELSE 'see ' || '{text.LINK[0]}' || user_id || '{text.LINK[1]}' || coalesce(title, CAST(user_id AS VARCHAR)) || '{text.LINK[2]}' || ' and {text.LINK[0]}no such{text.LINK[1]}no such{text.LINK[2]}{text.LINK[0]}' || user_id || '{text.LINK[1]}' || coalesce(title, CAST(user_id AS VARCHAR)) || '{text.LINK[2]}.' END AS body
FROM events LEFT JOIN t ON slug = user_id""")
def q_fn_wikilink(spark, d):
    link = F.concat(F.lit("[["), "user_id", F.lit("]]"))
    body = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("no link "), "event_type")).otherwise(F.concat(F.lit("see "), link, F.lit(" and [[no such]]"), link, F.lit(".")))
    titles = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("slug"), F.col("c_name").alias("title"))
    return text.resolved_links(table(spark, d, "events").select("event_id", body.alias("body")), "event_id", "body", titles)


@query("""WITH t AS (SELECT conv_id AS object_id, turn AS pos, coalesce(text, '') AS x FROM conversations), a AS (SELECT * FROM t WHERE pos % 2 = 0), b AS (SELECT object_id, pos + 1 AS pos, x FROM t), c AS (SELECT * FROM t WHERE object_id % 3 = 0)
SELECT object_id, pos, coalesce(a.x, '') AS a, coalesce(b.x, '') AS b, coalesce(c.x, '') AS c FROM a FULL JOIN b USING (object_id, pos) FULL JOIN c USING (object_id, pos)""")
def q_jn_positional_three(spark, d):
    t = turns(spark, d).select("object_id", F.col("pos").cast("long").alias("pos"), "text")
    return readings.positional({"a": t.where("pos % 2 = 0"), "b": t.withColumn("pos", F.col("pos") + 1), "c": t.where("object_id % 3 = 0")})


@query("""WITH o AS (SELECT o_orderkey AS object_id, CAST(o_orderkey % 4 AS INTEGER) AS page FROM orders), p AS (SELECT l_orderkey AS object_id, CAST(l_linenumber AS INTEGER) AS page, min(l_partkey) AS pos FROM lineitem GROUP BY 1, 2)
SELECT object_id, page, CASE WHEN pos IS NULL THEN '' ELSE 'p' || pos END AS text FROM o LEFT JOIN p USING (object_id, page)""")
def q_jn_ocr_to_layout(spark, d):
    layouts = table(spark, d, "orders").select(F.col("o_orderkey").alias("object_id"), (F.col("o_orderkey") % 4).cast("int").alias("page"))
    found = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("object_id"), F.col("l_linenumber").cast("int").alias("page"), F.col("l_partkey").alias("pos"), F.concat(F.lit("p"), "l_partkey").alias("text"))
    return layout.with_first_text(layouts, found)


@query("""WITH e AS (SELECT DISTINCT l_orderkey AS object_id, l_partkey AS nth FROM lineitem), m AS (SELECT * FROM e WHERE object_id % 3 = 0 AND nth % 2 = 0), g AS (SELECT * FROM e WHERE nth % 3 = 0), l AS (SELECT * FROM e WHERE nth % 3 = 1),
u AS (SELECT object_id, nth, 0 AS rank, 'heading' AS type, 'model' AS source FROM m UNION ALL SELECT object_id, nth, 1, 'table', 'regions' FROM g UNION ALL SELECT object_id, nth, 2, 'paragraph', 'lines' FROM l),
k AS (SELECT *, min(rank) OVER (PARTITION BY object_id) AS best FROM u)
SELECT object_id, 1 AS page, type, nth * 0.5::DOUBLE AS x, source, CAST(row_number() OVER (PARTITION BY object_id ORDER BY rank, nth) AS INTEGER) AS nth FROM k WHERE best > 0 OR rank = 0""")
def q_geo_fallback_merge(spark, d):
    e = readings.spread_out(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("object_id"), F.lit(1).alias("page"), F.col("l_partkey").alias("nth")), ("object_id", "nth")).distinct().withColumn("bbox", F.array(F.col("nth") * F.lit(0.5), F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    model = e.where("object_id % 3 = 0 and nth % 2 = 0").withColumn("type", F.lit("heading"))
    rows = layout.merged_sources(model, e.where("nth % 3 = 0").withColumn("type", F.lit("table")), e.where("nth % 3 = 1"))
    return rows.select("object_id", "page", "type", F.col("bbox")[0].alias("x"), "source", "nth")


@query("""SELECT conv_id AS object_id, turn AS pos, CASE turn % 6 WHEN 0 THEN 'direct' WHEN 1 THEN 'fence' WHEN 2 THEN 'escapes' WHEN 3 THEN 'repair' WHEN 4 THEN 'extract' ELSE 'raw' END AS step,
CASE WHEN turn % 6 < 5 THEN translate(coalesce(text, ''), chr(92) || chr(10), '') || CASE turn % 6 WHEN 2 THEN 'd' WHEN 3 THEN chr(10) ELSE '' END END AS text FROM conversations""")
def q_json_parse_ladder(spark, d):
    """Model outputs broken in five ways; backslashes and line feeds are taken out of the texts first."""
    t = F.translate(F.coalesce("text", F.lit("")), "\\\n", "")
    body = F.to_json(F.struct(t.alias("text")))
    put = lambda c, more: F.regexp_replace(c, r'"\}\z', more)
    k = F.col("pos") % 6
    raw = F.when(k == 0, body).when(k == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(k == 2, put(body, '\\\\d"}')).when(k == 3, put(body, '\n",}')).when(k == 4, F.concat(F.lit("Here: "), F.rtrim(put(body, '"')))).otherwise(F.concat(F.lit("no object "), t.substr(1, 0)))
    rows = turns(spark, d).select("object_id", "pos", parsing.ladder(raw).alias("p"))
    return rows.select("object_id", "pos", "p.step", F.try_variant_get("p.value", "$.text", "string").alias("text"))


@query("""SELECT count(*) AS files, count(*) FILTER (c_custkey % 3 = 0 OR c_custkey % 4 = 0) AS files_with_corrections, CAST(2 * count(*) FILTER (c_custkey % 3 = 0) AS BIGINT) AS suggestions, count(*) FILTER (c_custkey % 4 = 0) AS ambiguous FROM customer""")
def q_agg_fraktur_summary(spark, d):
    """Objects with a word that has one known variant, standing twice, or one that has several."""
    o = F.col("object_id")
    objects = table(spark, d, "customer").select(F.col("c_custkey").alias("object_id"))
    known = spark.createDataFrame([(w,) for w in ("hause", "wieder", "sein", "lawme", "lamwe")], "known string")
    body = F.concat(F.lit("wieder "), F.when(o % 3 == 0, "im haufe, haufe ").otherwise(""), F.when(o % 4 == 0, "lamme ").otherwise("sein"))
    return letters.summary(objects, letters.find_corrections(objects.withColumn("text", body), ["object_id"], known))


@query()
def q_udtf_fraktur_variants(spark, d):
    """Variants of the distinct words of texts, by the table function."""
    letters.register(spark)
    words = table(spark, d, "documents").select(F.explode(text.letter_runs("text")).alias("word")).where(F.length("word") >= 4).distinct()
    return spark.sql("SELECT word, v.variant, v.rule, v.at FROM {words}, LATERAL letter_variants(word) v", words=words)


#: Files of objects: with and without a model's name, and derived ones.
_NAMES = """n AS (SELECT DISTINCT 'c' || o_custkey % 2 AS collection, 'o' || o_custkey AS object_id, 'o' || o_custkey || CASE o_orderkey % 8 WHEN 0 THEN '_fam-1' WHEN 1 THEN '_fam-2' WHEN 2 THEN '_layout' WHEN 3 THEN '_old' WHEN 4 THEN '' WHEN 5 THEN '_consensus' WHEN 6 THEN '_page' ELSE 'x_fam-1' END || '.json' AS name FROM orders WHERE o_orderkey % 3 > 0)"""


def _names(spark, d):
    ends = F.element_at(F.array(*(F.lit(x) for x in ("_fam-1", "_fam-2", "_layout", "_old", "", "_consensus", "_page", "x_fam-1"))), (F.col("o_orderkey") % 8 + 1).cast("int"))
    o = F.concat(F.lit("o"), "o_custkey")
    return table(spark, d, "orders").where("o_orderkey % 3 > 0").select(F.concat(F.lit("c"), F.col("o_custkey") % 2).alias("collection"), o.alias("object_id"), F.concat(o, ends, F.lit(".json")).alias("name")).distinct()


@query(f"""WITH {_NAMES}, c AS (SELECT *, row_number() OVER (PARTITION BY object_id ORDER BY NOT starts_with(name, object_id || '_fam'), name) AS nth FROM n WHERE starts_with(name, object_id || '_') AND (starts_with(name, object_id || '_fam') OR NOT (contains(name, '_layout') OR contains(name, '_consensus') OR contains(name, '_page'))))
SELECT collection, object_id, name FROM c WHERE nth = 1""")
def q_src_ocr_file(spark, d):
    return artefacts.resolve_transcription(_names(spark, d), "fam")


_ASKED = "q AS (SELECT 'c' || c_custkey % 2 AS collection, 'o' || c_custkey AS object_id, CASE c_custkey % 3 WHEN 0 THEN 'fam-2' WHEN 1 THEN '' END AS model FROM customer)"


def _asked(spark, d):
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(F.concat(F.lit("c"), k % 2).alias("collection"), F.concat(F.lit("o"), k).alias("object_id"), F.when(k % 3 == 0, "fam-2").when(k % 3 == 1, "").alias("model"))


@query(f"""WITH {_NAMES}, {_ASKED}, m AS (SELECT q.collection, q.object_id, model, bool_or(name = q.object_id || '_fam-2.json' AND model = 'fam-2') AS a, bool_or(name = q.object_id || '_fam-1.json') AS b,
list(name) FILTER (starts_with(name, q.object_id || '_') AND NOT regexp_matches(name, '_(consensus|layout|gt_draft|judge_data)[.]json$')) AS l FROM q LEFT JOIN n USING (collection, object_id) GROUP BY ALL)
SELECT collection, object_id, model, CASE WHEN a THEN object_id || '_fam-2.json' WHEN b THEN object_id || '_fam-1.json' WHEN len(l) = 1 THEN l[1] END AS name, CASE WHEN a THEN 'exact' WHEN b THEN 'primary' WHEN len(l) = 1 THEN 'only' WHEN len(l) > 1 THEN 'ambiguous' ELSE 'missing' END AS found FROM m""")
def q_src_result_file(spark, d):
    return artefacts.resolve_result(_names(spark, d), _asked(spark, d), "fam-1")


@query(f"""WITH {_NAMES}, {_ASKED}, m AS (SELECT q.collection, q.object_id, model, bool_or(name = q.object_id || '.json') AS a, bool_or(name = q.object_id || '_fam-2.json' AND model = 'fam-2') AS b,
list(name) FILTER (starts_with(name, q.object_id || '_') AND NOT regexp_matches(name, '_(consensus|layout|gt_draft)[.]json$')) AS l FROM q LEFT JOIN n USING (collection, object_id) GROUP BY ALL)
SELECT collection, object_id, model, CASE WHEN a THEN object_id || '.json' WHEN b THEN object_id || '_fam-2.json' WHEN len(l) = 1 THEN l[1] END AS name, CASE WHEN a THEN 'object' WHEN b THEN 'model' WHEN len(l) = 1 THEN 'only' WHEN len(l) > 1 THEN 'ambiguous' ELSE 'missing' END AS found FROM m""")
def q_src_edit_file(spark, d):
    return artefacts.resolve_edit(_names(spark, d), _asked(spark, d))


@query(f"""WITH {_NAMES} SELECT collection, object_id, min(name) AS name FROM n WHERE starts_with(name, object_id || '_') AND length(name) % 2 = 0 GROUP BY 1, 2""")
def q_src_first_with_pages(spark, d):
    return artefacts.first_with_pages(_names(spark, d).withColumn("pages", F.when(F.length("name") % 2 == 0, 2).otherwise(0)))


@query("""SELECT o_orderstatus || ' \u2013 ' || lower(o_orderstatus) AS grp, count(*) AS objects, CAST(list_sort(list(o_custkey % 50) FILTER (o_custkey % 50 > 9))[count(*) FILTER (o_custkey % 50 > 9) // 2 + 1] AS BIGINT) AS median_chars FROM orders GROUP BY 1""")
def q_agg_group_median(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderstatus").alias("grp"), F.lower("o_orderstatus").alias("label"), F.lit(1).alias("content_pages"), F.when(F.col("o_custkey") % 50 > 9, F.col("o_custkey") % 50).otherwise(0).alias("avg_chars"))
    return archive.density(rows, "grp", "label").select("grp", "objects", F.col("median_chars").cast("long").alias("median_chars"))


@query("""WITH p AS (SELECT conv_id AS object_id, turn AS pos, text, role FROM conversations), e AS (SELECT object_id, pos FROM p WHERE (object_id + pos) % 3 = 0)
SELECT 'o' || object_id AS object_id, pos, CAST(CASE WHEN pos % 4 = 3 THEN 100 + pos ELSE pos + 1 END AS INTEGER) AS page, CASE WHEN e.pos IS NULL THEN text ELSE 'new ' || coalesce(text, '') END AS transcription, CASE WHEN e.pos IS NULL THEN role WHEN pos % 2 = 0 THEN 'n' END AS notes, e.pos IS NOT NULL AS edited,
object_id % 2 = 0 AS reviewed, CASE WHEN object_id % 2 = 0 THEN 'r' || object_id END AS reviewed_by, 'viewer' AS source FROM p LEFT JOIN e USING (object_id, pos)""")
def q_snk_export_edit(spark, d):
    """The export's pages, one a row; edits of pages that do not exist are among the input."""
    o, pos = F.col("object_id"), F.col("pos")
    rows = turns(spark, d).withColumn("object_id", F.concat(F.lit("o"), "object_id", F.lit("_gemini-x"))).withColumn("n", F.regexp_extract("object_id", r"o(\d+)", 1).cast("long"))
    pages = rows.select("object_id", "pos", F.when(pos % 4 == 3, 100 + pos).when(pos % 4 == 2, 0).alias("page_no"), "text", F.col("role").alias("notes"))
    edits = rows.where((F.col("n") + pos) % 3 == 0).select("object_id", "pos", F.concat(F.lit("new "), F.coalesce("text", F.lit(""))).alias("text"), F.when(pos % 2 == 0, "n").alias("notes"))
    edits = edits.unionByName(edits.withColumn("pos", pos + 100_000))
    objects = rows.select("object_id", "n").distinct()
    approvals = objects.where("n % 2 = 0").select("object_id", F.concat(F.lit("r"), "n").alias("reviewed_by"), F.lit("2026").alias("reviewed_at"))
    objects = objects.select("object_id", *(F.lit(x).alias(x) for x in ("pid", "signature", "collection", "title", "model")))
    out = review_exports.edit_export(objects, pages, edits, approvals, F.lit("2026"), "viewer")
    out = out.select(o, "reviewed", "reviewed_by", "source", F.posexplode("pages").alias("pos", "p"))
    return out.select(o, pos.cast("long").alias("pos"), "p.page", "p.transcription", "p.notes", "p.edited", "reviewed", "reviewed_by", "source")


@query("""WITH p AS (SELECT conv_id AS object_id, turn AS pos, CASE WHEN turn % 4 = 1 THEN 'blank' ELSE 'content' END AS type, (conv_id + turn) % 5 > 0 AS found, (conv_id + turn) % 7 > 0 AS ok FROM conversations)
SELECT object_id, bool_and(type <> 'content' OR (found AND ok)) AS expert_verified, count(*) AS pages, count(*) FILTER (found AND ok) AS approved, count(*) FILTER (found) AS edited, count(*) FILTER (found AND pos % 2 = 0) AS from_review FROM p GROUP BY 1""")
def q_snk_export_gt(spark, d):
    pos = F.col("pos")
    rows = turns(spark, d)
    pages = rows.select("object_id", "pos", "text", F.when(pos % 4 == 1, "blank").when(pos % 4 == 2, "").when(pos % 4 == 3, "content").alias("type"), F.lit("consensus").alias("source"))
    k = F.col("object_id") + pos
    reviews = rows.where(k % 5 > 0).select("object_id", "pos", F.lit("t").alias("text"), F.when(pos % 2 == 0, "expert").otherwise("consensus").alias("source"), (k % 7 > 0).alias("approved"))
    drafts = rows.select("object_id").distinct().select("object_id", *(F.lit("x").alias(c) for c in ("collection", "group", "title", "models")))
    out = review_exports.truth_export(drafts, pages, reviews, "ex", F.lit("2026"))
    n = lambda test: F.size(F.filter("pages", test)).cast("long")
    return out.select("object_id", "expert_verified", F.size("pages").cast("long").alias("pages"), n(lambda p: p["approved"]).alias("approved"), n(lambda p: p["expert_edited"]).alias("edited"), n(lambda p: p["source"] == "expert").alias("from_review"))


@query("""SELECT p_partkey AS slug, CASE WHEN p_partkey % 5 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE p_name || ': "q"' END AS title, CASE WHEN p_partkey % 5 > 0 THEN 'it''s ' || p_brand ELSE '' END AS type, CASE WHEN p_partkey % 5 = 0 THEN '' WHEN p_partkey % 2 = 0 THEN 'a|b, c|' || p_size ELSE 'x|' || p_size END AS tags, CASE WHEN p_partkey % 5 > 0 THEN 'r' || p_partkey ELSE '' END AS related, CASE WHEN p_partkey % 5 > 0 THEN '2026-04-01' ELSE '' END AS created,
CASE WHEN p_partkey % 5 = 0 THEN p_type || ' --- no header ' ELSE p_type || ' --- text' END AS body FROM part""")
def q_src_frontmatter(spark, d):
    k = F.col("p_partkey")
    tags = F.when(k % 2 == 0, F.concat(F.lit("tags: [a, \"b, c\", "), "p_size", F.lit("]"))).otherwise(F.concat(F.lit("tags:\n  - x  # note\n  - '"), "p_size", F.lit("'")))
    head = F.concat(F.lit('---\ntitle: "'), "p_name", F.lit(": \\\"q\\\"\"\ntype: 'it''s "), "p_brand", F.lit("'\n"), tags, F.lit('\nrelated: ["[[r'), k, F.lit(']] x", "no link"]\ncreated: 2026-04-01 # day\n---\n\n'))
    raw = F.when(k % 5 == 0, F.concat("p_type", F.lit(" --- no header "))).otherwise(F.concat(head, "p_type", F.lit(" --- text\n\n")))
    rows = table(spark, d, "part").select(k.alias("slug"), frontmatter.parts(raw).alias("p")).select("slug", "p.*")
    rows = rows.select("slug", frontmatter.record("header", F.col("slug").cast("string")).alias("m"), "body")
    return rows.select("slug", "m.title", "m.type", F.array_join("m.tags", "|").alias("tags"), F.array_join("m.related", "|").alias("related"), "m.created", "body")


@query(r"""SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(p_size || ' ' || p_name || ' ,  ' || p_brand || ',, 1' || p_type, ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS hands FROM part""")
def q_fn_split_hands(spark, d):
    listed = F.concat("p_size", F.lit(" "), "p_name", F.lit(" ,  "), "p_brand", F.lit(",, 1"), "p_type")
    return table(spark, d, "part").select("p_partkey", F.array_join(text.split_list(listed), "|").alias("hands"))

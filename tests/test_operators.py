import json
import struct

from pyspark.sql import functions as F

from quirework.functions import text
from quirework.operators import catalogue, layout, pages, readings, review
from quirework.sources import files
from quirework.streaming import reviews


def test_fill_missing(spark):
    rows = [("a", 0, 1, "x"), ("a", 1, 3, "y"), ("b", 0, 1, "x"), ("c", 0, 1, "x"), ("c", 1, 2, "y")]
    df = spark.createDataFrame(rows, "object_id string, pos int, page_no int, text string")
    n = spark.createDataFrame([("a", 4), ("b", 3), ("c", 1)], "object_id string, n int")
    got = sorted(tuple(r) for r in pages.fill_missing(df, n).collect())
    assert got == [("a", 1, "x"), ("a", 2, ""), ("a", 3, "y"), ("a", 4, ""), ("b", 1, "x"), ("b", 2, ""), ("b", 3, ""), ("c", 1, "x"), ("c", 2, "y")]


def test_signals(spark):
    rows = [("a", 0, "der die und " * 30, ""), ("a", 1, "x" * 20 + "[?]", ""), ("a", 2, "", "Rückseite"), ("b", 0, "the and of " * 30, "")]
    df = pages.typed(spark.createDataFrame(rows, "object_id string, pos int, text string, notes string"))
    objects = spark.createDataFrame([("a", 3, "Französisch"), ("b", 2, "English")], "object_id string, images long, language string")
    got = {r.object_id: r for r in pages.signals(df, objects).collect()}
    assert got["a"].needs_review_reasons == ["language_mismatch"] and got["a"].blank_pages == 1 and got["a"].marker_uncertain_count == 1
    assert got["b"].needs_review_reasons == ["page_image_mismatch"] and got["b"].language_match


def test_merge(spark):
    same = "abcdefghij" * 10
    rows = [(same, same, same), (same, same[:-3] + "xyz", "other" * 20), ("a" * 50, "b" * 50, "c" * 50), ("", "", "")]
    df = spark.createDataFrame(rows, "text_a string, text_b string, text_c string")
    got = [(r.source, r.merged == r.text_c, r.merged == r.text_b) for r in readings.merge_three(df).collect()]
    assert got == [("consensus_3of3", True, True), ("majority_2of3", False, True), ("strongest_only", True, False), ("consensus_3of3", True, True)]


def test_catalogue_sort_by_locale(spark):
    df = spark.createDataFrame([(1, "Zebra"), (2, "ähre"), (3, "Ast"), (4, "b")], "id int, title string")
    q = catalogue.Query(sort="title", per_page=3)
    assert [r.title for r in catalogue.run(df, q).collect()] == ["ähre", "Ast", "b"]
    assert [r.title for r in catalogue.paged(catalogue.ordered(df, q), catalogue.Query(sort="title", per_page=3, page=9), 4).collect()] == ["Zebra"]


def test_history_grows_only_by_changes(spark):
    none = F.array().cast("array<struct<text:string,by:string,at:string>>")
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "object_id string, page_no int, text string").withColumn("history", none)
    edits = spark.createDataFrame([("a", 1, "x", "me", "t"), ("a", 2, "z", "me", "t"), ("a", 9, "z", "me", "t")], "object_id string, page_no int, new_text string, by string, at string")
    got = {r.page_no: r for r in review.apply_edits(df, edits).collect()}
    assert got[1].history == [] and got[1].edited and got[2].history[0].text == "y" and got[2].text == "z"
    assert review.unmatched(df, edits).count() == 1


def test_layout(spark):
    regions = [("a", 1, "r1", "paragraph", [10.0, 10.0, 50.0, 40.0], 1), ("a", 1, "r2", "paragraph", [10.0, 10.0, 50.0, 38.0], 2), ("a", 1, "r3", "heading", [40.0, 1.0, 5.0, 1.0], 3), ("a", 1, "r4", "paragraph", [40.0, 97.0, 50.0, 1.0], 4), ("a", 1, "r5", "list", [20.0, 20.0, 5.0, 1.0], 5), ("a", 2, "r1", "paragraph", [0.0, 0.0, 50.0, 1.0], 1)]
    df = spark.createDataFrame(regions, "object_id string, page int, region_id string, type string, bbox array<double>, reading_order int")
    got = sorted((r.page, r.region_id, r.type, r.reading_order) for r in layout.cleaned(df).collect())
    assert got == [(1, "r1", "paragraph", 1), (1, "r2", "heading", 2), (2, "r1", "paragraph", 1)]
    lines = df.where("page = 1 and reading_order <= 2").withColumn("lines", F.lit(1))
    texts = spark.createDataFrame([("a", 1, "1\n2\n3\n4\n5")], "object_id string, page int, text string")
    assert [r.text for r in layout.text_to_regions(lines, texts).orderBy("reading_order").collect()] == ["1\n2", "3\n4\n5"]
    rows = layout.text_to_regions(lines, texts).withColumns({"image": F.lit("a&b.jpg"), "width": F.lit(100), "height": F.lit(200)})
    xml = layout.page_xml(rows).first().xml
    assert 'imageFilename="a&amp;b.jpg"' in xml and 'points="10,20 60,20 60,100 10,100"' in xml and xml.index("r1") < xml.index("r2")


def test_readers(spark, tmp_path):
    (tmp_path / "o_ab.1_m.json").write_text(json.dumps({"object_id": "o_ab.1", "collection": "werke", "result": {"pages": [{"page": 1, "transcription": "x"}, {"page": 2}]}}))
    (tmp_path / "o_ab.2_m.json").write_text(json.dumps({"object_id": "o_ab.2", "collection": "werke", "result": {"raw": "broken"}}))
    (tmp_path / "o_ab.3_m.json").write_text(json.dumps({"object_id": "o_ab.3"}))
    rows = files.results(spark, str(tmp_path))
    assert {r.object_id: r.is_broken for r in rows.collect()} == {"o_ab.1": False, "o_ab.2": True}
    assert [(r.pos, r.page_no, r.text) for r in files.pages_of(rows).orderBy("pos").collect()] == [(0, 1, "x"), (1, 2, "")]
    (tmp_path / "x.xml").write_text('<TEI><biblFull><title>A  B</title><lang>Deutsch</lang><idno type="PID">o:ab.7</idno></biblFull></TEI>')
    assert [(r.pid, r.title, r.language) for r in files.tei(spark, str(tmp_path / "x.xml")).collect()] == [("o:ab.7", "A B", "Deutsch")]
    (tmp_path / "doc.md").write_text("---\ntitle: T\n---\n# H\n## First\n- [[a]] [[b]]\n## Verwandte\n[[c]]\n")
    doc = files.markdown(spark, str(tmp_path / "doc.md"))
    assert [(r.header, r.body[:4], r.words) for r in doc.collect()] == [("title: T", "# H\n", 6)]
    assert [(r.level, r.heading) for r in files.headings(doc, "slug", "body").orderBy("line").collect()] == [(1, "H"), (2, "First"), (2, "Verwandte")]
    assert [r.slug for r in files.index_sections(doc.withColumnRenamed("slug", "k"), "k", "body").collect()] == ["a", "b"]
    jpeg = b"\xff\xd8\xff\xe0" + struct.pack(">H", 4) + b"xx" + b"\xff\xc0" + struct.pack(">HBHH", 11, 8, 480, 640) + b"x" * 8
    got = spark.createDataFrame([(bytearray(jpeg),), (bytearray(b"no"),), (None,)], "c binary").select(files.jpeg_size("c").alias("s")).select("s.*").collect()
    assert [tuple(r) for r in got] == [(640, 480), (0, 0), (0, 0)]


def test_stream_appends_once(spark, sf, tmp_path):
    rows = reviews.events(spark, sf, "events.parquet")
    for k in range(2):
        reviews.append_new(rows, str(tmp_path / "out"), ["event_id"], str(tmp_path / f"c{k}")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == spark.read.parquet(f"{sf}/events.parquet").count()


def test_relative_time(spark):
    rows = spark.sql("select timestamp'2024-01-01 00:00:00' as a, timestamp'2024-01-01 02:00:00' as b")
    assert rows.select(text.relative_time(F.col("a"), F.col("b"))).first()[0] == "2h"

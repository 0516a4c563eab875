import random
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from quirework.operators import exports, layout
from quirework.sources import archival_xml

ONE = """<biblFull xmlns="http://www.tei-c.org/ns/1.0"><titleStmt><title>  Der  Brief &amp; mehr </title><title xml:lang="en">The Letter</title>
<author><persName ref="gnd/1"><forename>Anna</forename><surname>Berg</surname></persName></author><author><persName>Max Weber</persName></author><author><persName></persName></author>
<editor role="translator"><persName ref="gnd/3"><surname>Kohl</surname></persName></editor><editor><persName><name>Institut</name></persName></editor></titleStmt>
<notesStmt><note>eine Notiz</note><note>zweite</note></notesStmt>
<sourceDesc><msDesc><msIdentifier><country>AT</country><settlement> Salzburg </settlement><repository ref="gnd/9">Archiv
 der  Stadt</repository><idno type="signature">AB-1/B2</idno><idno type="other">x</idno><altIdentifier><idno type="PID">o:x.12</idno></altIdentifier></msIdentifier>
<msContents><textLang><lang>Deutsch</lang><lang>Englisch</lang></textLang><msItem><docEdition xml:lang="en">inscribed</docEdition><docEdition xml:lang="de">Widmung</docEdition><docEdition>zwei</docEdition></msItem></msContents>
<physDesc><objectDesc><supportDesc><support><material ana="a:WritingInstrument" xml:lang="en">blue ink</material><material ana="a:WritingInstrument" xml:lang="de">blaue
  Tinte</material><material ana="a:WritingMaterial" xml:lang="en">paper</material><material ana="a:WritingMaterial">Papier</material></support>
<extent><measure type="leaf"> </measure><measure type="leaf">2 Blatt</measure><measure type="format">10 x 20</measure></extent></supportDesc></objectDesc>
<handDesc><ab>Anna Berg, , Max</ab></handDesc><bindingDesc><binding><ab xml:lang="en">cloth</ab></binding><binding><ab>Leinen</ab></binding></bindingDesc></physDesc>
<history><origin><origDate when="1920-01-02"/><origPlace xml:lang="en">Vienna</origPlace><origPlace>Wien</origPlace></origin>
<provenance><ab>Nachlass</ab><ab xml:lang="en">estate</ab></provenance><acquisition><ab>Kauf 1990</ab></acquisition></history></msDesc></sourceDesc>
<profileDesc><textClass><keywords><term type="classification">Briefe</term><term type="objecttyp">Brief</term></keywords></textClass></profileDesc></biblFull>"""
BARE = '<biblFull><titleStmt/><sourceDesc><msDesc><msIdentifier><altIdentifier><idno type="PID">o:x.13</idno></altIdentifier></msIdentifier></msDesc></sourceDesc></biblFull>'


def test_full_record(spark):
    rows = spark.createDataFrame([(1, ONE), (2, BARE), (3, "<broken"), (4, None), (5, "")], "id long, xml string")
    got = {r.id: r for r in archival_xml.described(rows, "xml").collect()}
    r = got[1]
    assert (r.pid, r.title, r.signature, r.date, r.language, r.objecttyp, r.extent) == ("o:x.12", "Der  Brief & mehr", "AB-1/B2", "1920-01-02", "Deutsch", "Brief", "2 Blatt")
    assert (r.writing_instrument, r.hand, r.notes, r.classification) == ("blaue Tinte", "Anna Berg, , Max", "eine Notiz", "Briefe")
    assert [tuple(c) for c in r.creators] == [("Anna Berg", "author", "gnd/1"), ("Max Weber", "author", None), ("Kohl", "translator", "gnd/3"), ("Institut", "editor", None)]
    assert tuple(r.holding) == ("Archiv der Stadt", "gnd/9", "AT", "Salzburg")
    assert r.provenance == ["Nachlass", "Erwerb: Kauf 1990"] and r.inscriptions == ["Widmung", "zwei"] and r.hands == ["Anna Berg", "Max"] and r.subject == ["Briefe"]
    assert (r.origin_place, r.writing_material, r.dimensions, r.binding) == ("Wien", "Papier", "10 x 20", "Leinen")
    assert got[2].pid == "o:x.13"
    for i in (2, 3, 4, 5):
        assert {got[i][c] or "" for c in ("title", "signature", "date", "extent", "hand", "binding")} == {""}
        assert not (got[i].creators or got[i].provenance or got[i].hands or got[i].subject or got[i].inscriptions)


def test_files_and_the_last_of_equal_pids(spark, tmp_path):
    for name, body in (("a.xml", ONE + BARE), ("b.xml", ONE.replace("2 Blatt", "3 Blatt") + ONE.replace("2 Blatt", "4 Blatt") + ONE.replace("o:x.12", "elsewhere"))):
        (tmp_path / name).write_text(f'<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader>{body}</teiHeader></TEI>')
    got = {r.pid: r for r in archival_xml.descriptions(spark, str(tmp_path)).collect()}
    assert set(got) == {"o:x.12", "o:x.13"} and got["o:x.12"].extent == "4 Blatt"


def test_record_feeds_the_exports(spark):
    rows = archival_xml.described(spark.createDataFrame([(1, ONE), (2, BARE)], "id long, xml string"), "xml")
    rows = rows.withColumns({"repository": F.col("holding.repository"), "repository_gnd": F.col("holding.repository_gnd"), "inscriptions": F.array_join("inscriptions", "; ")})
    m = F.struct(*rows.columns)
    got = {r.id: r for r in rows.select("id", F.to_json(exports.descriptive(m, F.lit("CC"))).alias("block"), exports.mods(m, F.lit("CC"), F.col("pid"), F.col("language"), F.lit("de")).alias("mods")).collect()}
    assert '"creator":[{"name":"Anna Berg","role":"author","gnd":"gnd/1"}' in got[1].block and '"writing_instrument":"blaue Tinte"' in got[1].block
    for r in got.values():
        ET.fromstring(r.mods)


@pytest.mark.parametrize("seed", range(3))
def test_page_xml_round_trip(spark, seed, tmp_path):
    rng = random.Random(seed)
    rows = []
    for page in range(1, 8):
        order = list(range(1, rng.randint(2, 9)))
        for i, o in enumerate(rng.sample(order, len(order))):
            x, y = rng.randint(0, 600) / 10, rng.randint(0, 600) / 10
            text = rng.choice(["", "a < b & c \"d\" 'e'", "zwei\nZeilen  hier", " ä 日本 ", "]]>"])
            rows.append(("o1", page, "p.jpg", 1000, 2000, f"r{i}", rng.choice(["paragraph", "heading", "list", "table", "marginalia"]), [x, y, rng.randint(1, 390) / 10, rng.randint(1, 390) / 10], o, text))
    df = spark.createDataFrame(rows, "object_id string, page int, image string, width int, height int, region_id string, type string, bbox array<double>, reading_order int, text string")
    xml = layout.page_xml(df)
    got = {(r.page, r.region_id): r for r in archival_xml.page_regions(xml, ["object_id", "page"], "xml").collect()}
    assert len(got) == len(rows)
    for o, page, image, w, h, region, kind, box, order, text in rows:
        r = got[page, region]
        assert (r.type, r.reading_order, r.text, r.image, r.width, r.height) == (kind, order, text, image, w, h)
        assert all(abs(a - b) <= 0.1 + 1e-9 for a, b in zip(r.bbox, box, strict=True)), (r.bbox, box)
    for r in xml.collect():
        (tmp_path / "o1_page").mkdir(exist_ok=True)
        (tmp_path / "o1_page" / f"page_{r.page:03d}.xml").write_text(r.xml)
    files = archival_xml.read_page_xml(spark, str(tmp_path))
    assert sorted(map(repr, files.collect())) == sorted(map(repr, got.values()))


def test_odd_page_xml(spark):
    head = '<PcGts><Page imageFilename="i" imageWidth="{w}" imageHeight="100">{o}{r}</Page></PcGts>'
    region = '<TextRegion id="{}"><Coords points="{}"/></TextRegion>'.format
    rows = [
        (1, head.format(w=200, o="", r=region("b", "20,10 40,10 60,30 20,50") + region("a", ""))),
        (2, head.format(w=0, o='<ReadingOrder><OrderedGroup><RegionRefIndexed regionRef="a" index="5"/><RegionRefIndexed regionRef="zz" index="1"/></OrderedGroup></ReadingOrder>', r=region("b", "1,1 2,2") + region("a", "1,1"))),
        (3, head.format(w=1, o="", r="")), (4, None), (5, "no xml"),
    ]
    got = archival_xml.page_regions(spark.createDataFrame(rows, "id long, xml string"), ["id"], "xml").orderBy("id", "reading_order").collect()
    assert [(r.id, r.region_id, r.bbox, r.type, r.text) for r in got] == [(1, "b", [10.0, 10.0, 20.0, 40.0], "paragraph", ""), (1, "a", None, "paragraph", ""), (2, "a", None, "paragraph", ""), (2, "b", None, "paragraph", "")]


def test_regions_are_ranked_within_their_page(spark):
    """F8: ranking by a window sent every region through a second shuffle."""
    xml = "<PcGts><Page imageFilename='a' imageWidth='10' imageHeight='10'><ReadingOrder><OrderedGroup><RegionRefIndexed regionRef='c' index='0'/></OrderedGroup></ReadingOrder><TextRegion id='a'/><TextRegion id='b'/><TextRegion id='c'/></Page></PcGts>"
    found = archival_xml.page_regions(spark.createDataFrame([("o", 1, xml)], "object_id string, page int, xml string"), ["object_id", "page"], "xml")
    assert sorted((r.reading_order, r.region_id) for r in found.collect()) == [(1, "c"), (2, "a"), (3, "b")]
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_parsing_and_merging_are_dealt_by_what_is_read(spark, sf, monkeypatch):
    """tasks held as much more as the tables grew, and a small file of entries was one task."""
    from quirework.operators import readings
    from quirework.plans import exchange

    monkeypatch.setattr(readings, "SHARE", 10)
    monkeypatch.setattr(readings, "MOST", 9)
    assert exchange._entries(spark, sf).rdd.getNumPartitions() == 9
    assert "REPARTITION_BY_NUM" in exchange.q_geo_fallback_merge(spark, sf)._jdf.queryExecution().executedPlan().toString()

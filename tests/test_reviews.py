import random
import xml.etree.ElementTree as ET

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quirework.operators import archive, exports, imports, review


def test_flags_of_pages_that_an_export_does_not_name(spark):
    drafts = spark.createDataFrame([("o", 1, "a", "s", True, True), ("o", 2, "b", "s", True, None), ("o", 3, None, "s", None, None)], "object_id string, page int, text string, source string, approved boolean, expert_edited boolean")
    out = spark.createDataFrame([("o", 2, "old", None, True, None, 1), ("o", 2, "new", None, None, True, 2), ("o", 3, None, "t", True, None, 3), ("o", 9, "x", None, True, None, 4)], "object_id string, page int, text string, source string, approved boolean, expert_edited boolean, nth int")
    got = {r.page: (r.text, r.source, r.approved, r.expert_edited, r.updated, r.imported) for r in imports.import_truth(drafts, out).collect()}
    assert got == {1: ("a", "s", True, True, False, False), 2: ("new", "s", False, True, True, True), 3: (None, "t", True, False, False, True)}
    bare = imports.import_truth(drafts.drop("approved", "expert_edited"), out.drop("nth")).where("page = 1").first()
    assert bare.approved is None and bare.expert_edited is None


def test_the_export_says_what_is_verified(spark):
    drafts = spark.createDataFrame([("o", 1, "a", "s", "content"), ("o", 2, "b", "s", "blank"), ("p", 1, "c", "s", "content")], "object_id string, page int, text string, source string, type string")
    out = spark.createDataFrame([("o", 1, "a", None, True, None), ("p", 1, "c", None, True, None)], "object_id string, page int, text string, source string, approved boolean, expert_edited boolean")
    reviews = spark.createDataFrame([("o", True, None, "t"), ("p", None, "me", None)], "object_id string, expert_verified boolean, reviewed_by string, reviewed_at string")
    got = {r.object_id: (r.approved, r.updated, r.content_pages, r.state, r.reviewed_by) for r in imports.truth_states(imports.import_truth(drafts, out), reviews, "importer").collect()}
    assert got == {"o": (1, 0, 1, "VERIFIZIERT", "importer"), "p": (1, 0, 1, "TEILWEISE", "me")}


def test_reasons_of_objects_on_one_side(spark):
    schema = "object_id string, reasons array<string>"
    old = spark.createDataFrame([("1", ["a", "b"]), ("2", ["a"]), ("3", []), ("4", ["x", "x"])], schema)
    new = spark.createDataFrame([("1", ["b", "a", "a"]), ("2", []), ("4", ["x"]), ("5", ["a"]), ("6", None)], schema)
    assert sorted(r.object_id for r in review.reason_changes(old, new).collect()) == ["2", "3", "5"]


@pytest.mark.parametrize("blank", ["", "   ", " ", " \n\t", "\x1c\x1f", "\x85"])
def test_pages_of_white_space_are_empty(spark, blank):
    r = archive.verification(spark.createDataFrame([(1, blank), (1, "ab")], "o int, t string"), "o", "t").first()
    assert (r.empty_pages, r.total_chars, r.avg_chars_per_page) == (1, 2, 2)


def test_exports_parse_whatever_their_values(spark):
    odd = "a\"b<c>&'d"
    m = F.struct(
        *(F.lit(odd).alias(k) for k in ("title", "signature", "date", "origin_place", "objecttyp", "extent", "dimensions", "writing_instrument", "writing_material", "repository", "repository_gnd", "notes")),
        F.array(F.struct(F.lit(odd).alias("name"), F.lit(odd).alias("role"), F.lit(odd).alias("gnd"))).alias("creators"), *(F.array(F.lit(odd)).alias(k) for k in ("subject", "hands", "provenance")),
    )
    mods = exports.mods(m, F.lit(odd), F.lit(odd), F.lit(odd), F.lit("de"))
    mets = exports.mets(mods, F.lit(odd), F.lit(odd), F.lit(odd), F.array(F.lit(odd), F.lit("u")), F.array(F.lit("content")), F.array(F.lit(1)))
    r = spark.range(1).select(mods.alias("mods"), mets.alias("mets")).first()
    assert any(e.text == odd for e in ET.fromstring(r.mods).iter())
    values = [v for e in ET.fromstring(r.mets).iter() for v in e.attrib.values()]
    assert odd in values and f"{odd}/IMG.1" in values and f"{odd}_page/page_001.xml" in values


def test_ranks_and_their_correlation(spark):
    rng = random.Random(2)
    rows = [(rng.choice([rng.randint(0, 50), rng.random() * 1000, -1.0]), rng.randint(0, 9)) for _ in range(100_000)]
    rows = [(float(a), float(b + a / 100)) for a, b in rows]
    frame = pd.DataFrame(rows, columns=["a", "b"])
    expected = duckdb.connect().sql("WITH r AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0::DOUBLE AS x, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0::DOUBLE AS y FROM frame) SELECT corr(x, y) FROM r").fetchall()[0][0]
    df = spark.createDataFrame(rows + [(None, 1.0), (float("nan"), 2.0), (3.0, None)], "a double, b double")
    got = review.spearman(df, "a", "b", 16)
    assert abs(got.first().rho - expected) < 1e-9 and got.first().n == 100_000
    plan = review.ranks(df, "a", 16)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan.split("Window")[1].split("Sort")[0]
    ranks = {r.a: r["rank"] for r in review.ranks(df.where("b is not null"), "a", 16).where("not isnan(a)").collect()}
    values = frame.a.rank(method="average")
    assert all(abs(ranks[a] - x) < 1e-9 for a, x in zip(frame.a, values, strict=True))


def test_ranks_of_odd_columns(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None)], "a double, b double")
    assert [tuple(r) for r in review.ranks(df, "a").collect()] == [(1.0, 1.5)] and review.ranks(df, "b").count() == 0
    assert tuple(review.spearman(df, "a", "b").first()) == (None, 0)
    assert review.spearman(df, "a", "a").first().rho is None

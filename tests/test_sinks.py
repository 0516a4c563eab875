import json

import pytest
from pyspark.sql import functions as F

from quirework.operators import imports, review_exports, versions
from quirework.sources import sinks

SCHEMA = "collection string, object_id string, model string, text string, pages array<struct<page:int,text:string>>"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, [(1, r[3])]) for r in rows], SCHEMA)


def held(spark, path):
    return sorted((r.collection, r.object_id, r.model, r.text, r.pages[0].text) for r in spark.read.schema(SCHEMA).json(path).collect())


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("part-*.json")}


def test_a_second_run_changes_nothing(spark, tmp_path):
    path, df = tmp_path / "out", rows_of(spark, [("a", "1", "m", "x"), ("a", "2", "m", "y"), ("b", "1", "m", "z"), ("b", "1", "m", "z")])
    assert sinks.save_results(df, str(path)) == {"written": 3, "skipped": 0}
    before, seen = held(spark, str(path)), files(path)
    assert sinks.save_results(df.withColumn("text", F.lit("other")), str(path)) == {"written": 0, "skipped": 3}
    assert held(spark, str(path)) == before and files(path) == seen
    more = rows_of(spark, [("a", "3", "m", "w"), ("a", "1", "m2", "v"), ("a", "1", "m", "no")])
    assert sinks.save_results(more, str(path)) == {"written": 2, "skipped": 1}
    assert len(held(spark, str(path))) == 5 and ("a", "1", "m", "x", "x") in held(spark, str(path))


def test_force_replaces_rows_and_leaves_other_divisions(spark, tmp_path):
    path = tmp_path / "out"
    sinks.save_results(rows_of(spark, [("a", "1", "m", "x"), ("a", "2", "m", "y"), ("b", "1", "m", "z")]), str(path))
    seen = {k: v for k, v in files(path).items() if "collection=b" in k}
    new = rows_of(spark, [("a", "1", "m", "new"), ("c", "9", "m", "q")])
    for _ in range(2):
        assert sinks.save_results(new, str(path), force=True) == {"written": 2, "skipped": 0}
        assert held(spark, str(path)) == [("a", "1", "m", "new", "new"), ("a", "2", "m", "y", "y"), ("b", "1", "m", "z", "z"), ("c", "9", "m", "q", "q")]
    assert {k: v for k, v in files(path).items() if "collection=b" in k} == seen


@pytest.mark.parametrize("force", [False, True])
def test_a_run_that_dies_leaves_what_was_there(spark, tmp_path, force):
    path = tmp_path / "out"
    sinks.save_results(rows_of(spark, [("a", "1", "m", "x"), ("b", "1", "m", "z")]), str(path))
    before = held(spark, str(path))
    bad = rows_of(spark, [("a", str(i), "m", "t") for i in range(20)]).repartition(4).withColumn("text", F.when(F.col("object_id") == "13", F.raise_error(F.lit("killed"))).otherwise(F.col("text")))
    bad = bad.select("collection", "object_id", "model", F.col("text").cast("string"), "pages")
    with pytest.raises(Exception, match="killed"):
        sinks.save_results(bad, str(path), force=force)
    assert held(spark, str(path)) == before


def test_nothing_and_manifest(spark, tmp_path):
    assert sinks.save_results(rows_of(spark, []), str(tmp_path / "none")) == {"written": 0, "skipped": 0}
    found = spark.createDataFrame([("1", "zero_pages"), ("2", "none"), ("3", None)], "id string, issue string")
    assert sinks.manifest(found, str(tmp_path / "m")) == 1
    assert [json.loads(x) for p in (tmp_path / "m").glob("part-*") for x in p.read_text().splitlines()] == [{"id": "1", "issue": "zero_pages"}]


def test_catalogue(spark, tmp_path):
    light = spark.createDataFrame([("a", "1", "t"), ("b", "2", "u")], "collection string, id string, title string")
    for _ in range(2):
        sinks.save_catalogue(light, light.withColumn("text", F.lit("long")), str(tmp_path))
    assert spark.read.json(f"{tmp_path}/data").count() == 2 and {p.name for p in (tmp_path / "data").glob("collection=*")} == {"collection=a", "collection=b"}


def test_versions(spark, tmp_path):
    path = str(tmp_path / "v")
    schema = "object_id string, reasons array<string>, needs_review boolean, note string"
    first = [("1", ["a"], True, "n"), ("2", [], False, "n"), ("3", None, None, "n")]
    put = lambda rows, at: versions.append(spark.createDataFrame(rows, schema), path, ["object_id"], ["reasons", "needs_review"], F.lit(at))
    assert put(first, 1) == 3 and put(first, 2) == 0
    assert put([("1", ["a"], True, "not compared"), ("2", ["b"], True, "n"), ("3", None, None, "n"), ("4", ["c"], True, "n")], 3) == 2
    assert put([("2", [], False, "n"), ("3", [], None, "n")], 4) == 2
    table = spark.read.parquet(path)
    read = lambda df: {r.object_id: (r.reasons, r.needs_review, r.version) for r in df.collect()}
    assert read(versions.state(table, ["object_id"])) == {"1": (["a"], True, 1), "2": ([], False, 3), "3": ([], None, 2), "4": (["c"], True, 1)}
    assert read(versions.as_of(table, ["object_id"], F.lit(3))) == {"1": (["a"], True, 1), "2": (["b"], True, 2), "3": (None, None, 1), "4": (["c"], True, 1)}
    assert read(versions.as_of(table, ["object_id"], F.lit(0))) == {}
    assert {r.object_id: r.before for r in versions.history(table, ["object_id"], "reasons").collect()} == {"1": [], "2": [[], ["b"]], "3": [None], "4": []}


def test_documents(spark, tmp_path):
    path = str(tmp_path / "page")
    put = lambda rows, **more: sinks.save_documents(spark.createDataFrame(rows, "object_id string, page int, xml string"), path, ["object_id", "page"], "xml", **more)
    read = lambda: {str(p.parent.relative_to(path)): p.read_text() for p in (tmp_path / "page").rglob("part-*.txt")}
    assert put([("007", 1, "<a>\n</a>"), ("007", 2, "<b/>"), ("x y", 1, None)]) == {"written": 2, "skipped": 0}
    assert read() == {"object_id=007/page=1": "<a>\n</a>\n", "object_id=007/page=2": "<b/>\n"}
    assert put([("007", 1, "other"), ("7", 1, "<c/>"), ("x y", 1, "<d/>")]) == {"written": 2, "skipped": 1}
    assert read()["object_id=007/page=1"] == "<a>\n</a>\n" and len(read()) == 4
    for _ in range(2):
        assert put([("007", 1, "new")], force=True) == {"written": 1, "skipped": 0}
    assert read()["object_id=007/page=1"] == "new\n" and len(read()) == 4
    assert put([]) == {"written": 0, "skipped": 0}


def test_a_review_goes_out_and_comes_back(spark, tmp_path):
    drafts = spark.createDataFrame([("1", "c", "g", "t", ["m"]), ("2", "c", "g", "t", ["m"]), ("3", "d", "g", "t", None)], "object_id string, collection string, `group` string, title string, models array<string>")
    pages = spark.createDataFrame([("1", 0, "old", "content", "a"), ("1", 1, "blank", "blank", "a"), ("2", 0, "x", None, "a"), ("2", 1, "y", "", "a")], "object_id string, pos int, text string, type string, source string")
    reviews = spark.createDataFrame([("1", 0, "right", "expert", True), ("2", 1, "z", "expert", True), ("2", 9, "no page", "expert", True)], "object_id string, pos int, text string, source string, approved boolean")
    out = review_exports.truth_export(drafts, pages, reviews, "ex", F.lit("2026"))
    assert sinks.save(out, str(tmp_path / "gt"), ["object_id"], ["collection"]) == {"written": 3, "skipped": 0}
    back = spark.read.schema(out.schema).json(str(tmp_path / "gt"))
    assert {r.object_id: r.expert_verified for r in back.collect()} == {"1": True, "2": False, "3": True}
    exports = back.select("object_id", F.posexplode("pages").alias("nth", "p")).select("object_id", "nth", "p.page", F.col("p.transcription").alias("text"), "p.source", "p.approved", "p.expert_edited")
    got = imports.import_truth(pages.withColumn("page", F.col("pos") + 1).drop("pos"), exports)
    assert sorted((r.object_id, r.page, r.text, r.source, r.approved, r.updated) for r in got.collect()) == [("1", 1, "right", "expert", True, True), ("1", 2, "blank", "a", False, False), ("2", 1, "x", "a", False, False), ("2", 2, "z", "expert", True, True)]

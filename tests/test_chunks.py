from quirework.operators import artefacts, chunks

SCHEMA = "object_id string, first int, last int, ok boolean, parsed boolean, pages array<struct<text:string,notes:string,type:string>>, confidence string, confidence_notes string"


def test_pages_keep_their_fields_and_say_what_failed(spark):
    rows = [("o", 1, 2, True, True, [("a", "n", "content"), ("b", None, "blank")], "low", None), ("o", 3, 3, False, True, [], None, None), ("o", 4, 4, True, False, [], None, None), ("o", 5, 5, True, True, [], None, None), ("o", 6, 6, True, True, None, None, None)]
    got = [tuple(r) for r in chunks.pages_of(spark.createDataFrame(rows, SCHEMA)).orderBy("page").collect()]
    assert got == [("o", 1, "a", "n", "content"), ("o", 2, "b", None, "blank"), ("o", 3, "", chunks.FAILED, None), ("o", 4, "", chunks.UNPARSED, None), ("o", 5, "", chunks.EMPTY, None), ("o", 6, "", chunks.EMPTY, None)]


def test_smaller_chunks_take_the_place_of_empty_ones(spark):
    rows = [("o", 1, 12, True, False, [], "low", "x"), ("o", 13, 20, False, True, [], None, None), ("o", 21, 22, True, True, [], None, None), ("p", 1, 12, True, True, [], None, None)]
    subs = [("o", 1, 5, True, True, [("s", "", "content")] * 5, "low", "y"), ("o", 6, 10, False, True, [], None, None), ("o", 11, 12, True, True, [("t", "", "content")], None, None), ("o", 13, 17, True, True, [("no", "", "content")], None, None), ("o", 21, 22, True, True, [("no", "", "content")], None, None)]
    all_ = chunks.recovered(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(subs, SCHEMA))
    got = {(r.object_id, r.page): (r.text, r.notes) for r in chunks.pages_of(all_).collect()}
    assert [got["o", i][0] for i in range(1, 6)] == ["s"] * 5 and got["o", 7] == ("", chunks.SUB) and got["o", 11] == ("t", "") and ("o", 12) not in got
    assert got["o", 13] == ("", chunks.FAILED) and got["o", 21] == ("", chunks.EMPTY) and got["p", 12] == ("", chunks.EMPTY)
    merged = {r.object_id: r for r in chunks.merged(all_).collect()}
    assert merged["o"].confidence == "high" and merged["o"].confidence_notes == ""


def test_names(spark):
    names = spark.createDataFrame([("c", "o1", n) for n in ("o1_gt_draft.json", "o1_layout.json", "o1_b.json")] + [("c", "o2", "o2.json"), ("c", "o2", "o2_a.json"), ("c", "o2", "o2_b.json")], "collection string, object_id string, name string")
    asked = spark.createDataFrame([("c", "o1", None), ("c", "o2", "zz"), ("c", "o3", "a"), ("d", "o1", "")], "collection string, object_id string, model string")
    got = {(r.collection, r.object_id): (r.name, r.found) for r in artefacts.resolve_result(names, asked, "p").collect()}
    assert got == {("c", "o1"): ("o1_b.json", "only"), ("c", "o2"): (None, "ambiguous"), ("c", "o3"): (None, "missing"), ("d", "o1"): (None, "missing")}
    got = {(r.collection, r.object_id): (r.name, r.found) for r in artefacts.resolve_edit(names, asked).collect()}
    assert got["c", "o2"] == ("o2.json", "object")
    assert {r.object_id: r.name for r in artefacts.resolve_transcription(names, "b").collect()} == {"o1": "o1_b.json", "o2": "o2_b.json"}

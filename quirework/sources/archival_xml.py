"""Readers of archival XML: descriptions of objects (TEI) and page layouts (PAGE). Schemas are explicit, so each reads only the elements that it names.

Elements that may be repeated are lists, in the order of the file. Names of elements are read without their namespace. Both readers also
work on a column of text (`described`, `page_regions`), so XML that lies in a table needs no files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import PAGE_XML_TYPES
from ..functions.text import lookup

_TEXT = "array<struct<_lang:string,_type:string,_VALUE:string>>"
_NAME = "struct<_ref:string,forename:string,surname:string,name:array<string>,orgName:array<string>,_VALUE:array<string>>"
_IDENTIFIER = f"struct<country:string,settlement:string,repository:struct<_ref:string,orgName:array<string>,name:array<string>,_VALUE:array<string>>,idno:{_TEXT},altIdentifier:array<struct<idno:{_TEXT}>>>"
_CONTENTS = f"struct<textLang:array<struct<lang:{_TEXT}>>,msItem:array<struct<docEdition:{_TEXT}>>,docEdition:{_TEXT}>"
_SUPPORT = f"struct<support:array<struct<material:array<struct<_ana:string,_lang:string,_VALUE:string>>>>,extent:array<struct<measure:{_TEXT}>>>"
_PHYSICAL = f"struct<objectDesc:struct<supportDesc:{_SUPPORT}>,handDesc:array<struct<ab:{_TEXT}>>,bindingDesc:array<struct<binding:array<struct<ab:{_TEXT}>>>>>"
_HISTORY = f"struct<origin:array<struct<origDate:array<struct<_when:string,_VALUE:string>>,origPlace:{_TEXT}>>,provenance:array<struct<ab:{_TEXT}>>,acquisition:array<struct<ab:{_TEXT}>>>"
#: The element biblFull of a description, as far as it is read.
DESCRIPTION = (
    f"titleStmt struct<title:{_TEXT},author:array<struct<persName:{_NAME}>>,editor:array<struct<_role:string,persName:{_NAME}>>>, notesStmt struct<note:{_TEXT}>, "
    f"sourceDesc struct<msDesc:struct<msIdentifier:{_IDENTIFIER},msContents:{_CONTENTS},physDesc:{_PHYSICAL},history:{_HISTORY}>>, profileDesc struct<textClass:struct<keywords:array<struct<term:{_TEXT}>>>>"
)
_PAGE = (
    "struct<_imageFilename:string,_imageWidth:int,_imageHeight:int,ReadingOrder:struct<OrderedGroup:struct<RegionRefIndexed:array<struct<_regionRef:string,_index:int>>>>,"
    "TextRegion:array<struct<_id:string,_type:string,Coords:struct<_points:string>,TextEquiv:array<struct<Unicode:string>>>>>"
)
PAGE = f"Page {_PAGE}"


def _of(b: Column, *path: str) -> Column:
    for p in path:
        b = b[p]
    return b


def _flat(elements: Column, name: str) -> Column:
    """All elements of a name within the elements of a list; null without the list."""
    return F.flatten(F.filter(F.transform(elements, lambda x: x[name]), lambda x: x.isNotNull()))


def _text(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit("")))


def _squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def _first(values: Column, test=lambda x: F.lit(True), name: str = "_VALUE") -> Column:
    """The first value that passes, trimmed; an empty text if none does."""
    return _text(F.get(F.filter(values, test), F.lit(0))[name])


def _native(values: Column) -> Column:
    """Texts that are not marked as English, without empty ones."""
    kept = F.filter(values, lambda x: ~F.coalesce(x["_lang"], F.lit("")).eqNullSafe("en") & (_text(x["_VALUE"]) != ""))
    return F.coalesce(F.transform(kept, lambda x: _text(x["_VALUE"])), F.array().cast("array<string>"))


def _words(*parts: Column) -> Column:
    """Parts of mixed content in one text; an element's own text comes before that of the elements in it."""
    return _squeezed(F.array_join(F.flatten(F.array(*(F.coalesce(p, F.array().cast("array<string>")) for p in parts))), " "))


def _person(p: Column, role: Column) -> Column:
    surname = F.array_join(F.array_compact(F.array(F.trim(p["forename"]), F.trim(p["surname"]))), " ")
    name = F.when(p["surname"].isNotNull(), surname).otherwise(_words(p["_VALUE"], F.array_compact(F.array(p["forename"])), p["name"], p["orgName"]))
    return F.struct(name.alias("name"), role.alias("role"), F.nullif(p["_ref"], F.lit("")).alias("gnd"))


def description(b: Column) -> list[Column]:
    """The fields of a description: pid, 10 basic ones, then the full record. b: a struct as DESCRIPTION. Texts that are missing are empty, lists too.

    Of several values the first counts; English ones are passed over where a field has values in two languages (instrument, material, place, provenance,
    binding, inscriptions). A date without text is its attribute `when`. Hands are the basic field's parts between commas.
    """
    ms = _of(b, "sourceDesc", "msDesc")
    ids, physical, history, contents = ms["msIdentifier"], ms["physDesc"], ms["history"], ms["msContents"]
    support = _of(physical, "objectDesc", "supportDesc")
    material, measure = _flat(support["support"], "material"), _flat(support["extent"], "measure")
    term = _flat(_of(b, "profileDesc", "textClass", "keywords"), "term")
    typed = lambda values, kind: _first(values, lambda x: x["_type"] == kind)
    of_material = lambda kind: F.filter(material, lambda x: F.contains(F.coalesce(x["_ana"], F.lit("")), F.lit(kind)) & ~F.coalesce(x["_lang"], F.lit("")).eqNullSafe("en") & x["_VALUE"].isNotNull())
    measured = lambda kind: _first(measure, lambda x: (x["_type"] == kind) & (_text(x["_VALUE"]) != ""))
    dated = F.get(_flat(history["origin"], "origDate"), F.lit(0))
    hand, classification = _first(_flat(physical["handDesc"], "ab")), typed(term, "classification")
    repository = ids["repository"]
    none = F.array().cast("array<string>")
    people = F.concat(
        F.coalesce(F.transform(_of(b, "titleStmt", "author"), lambda a: _person(a["persName"], F.lit("author"))), F.array()),
        F.coalesce(F.transform(_of(b, "titleStmt", "editor"), lambda a: _person(a["persName"], F.coalesce(a["_role"], F.lit("editor")))), F.array()),
    )
    bound = _flat(_flat(physical["bindingDesc"], "binding"), "ab")
    inscribed = F.concat(F.coalesce(_native(contents["docEdition"]), none), F.coalesce(_native(_flat(contents["msItem"], "docEdition")), none))
    owned = F.concat(_native(_flat(history["provenance"], "ab")), F.transform(_native(_flat(history["acquisition"], "ab")), lambda x: F.concat(F.lit("Erwerb: "), x)))
    fields = {
        "pid": _first(_flat(ids["altIdentifier"], "idno"), lambda x: x["_type"] == "PID"),
        "title": _first(_of(b, "titleStmt", "title")),
        "signature": typed(ids["idno"], "signature"),
        "date": _text(F.coalesce(dated["_VALUE"], dated["_when"])),
        "language": _first(_flat(contents["textLang"], "lang")),
        "objecttyp": typed(term, "objecttyp"),
        "extent": measured("leaf"),
        "writing_instrument": _squeezed(F.get(of_material("WritingInstrument"), F.lit(0))["_VALUE"]),
        "hand": hand,
        "notes": _first(_of(b, "notesStmt", "note")),
        "classification": classification,
        "creators": F.filter(people, lambda p: F.coalesce(p["name"], F.lit("")) != ""),
        "holding": F.struct(
            F.nullif(_words(repository["_VALUE"], repository["name"], repository["orgName"]), F.lit("")).alias("repository"), F.nullif(repository["_ref"], F.lit("")).alias("repository_gnd"),
            F.trim(ids["country"]).alias("country"), F.trim(ids["settlement"]).alias("settlement"),
        ),
        "provenance": owned,
        "origin_place": F.coalesce(F.get(_native(_flat(history["origin"], "origPlace")), F.lit(0)), F.lit("")),
        "writing_material": _text(F.get(of_material("WritingMaterial"), F.lit(0))["_VALUE"]),
        "dimensions": measured("format"),
        "binding": F.coalesce(F.get(_native(bound), F.lit(0)), F.lit("")),
        "inscriptions": inscribed,
        "hands": F.filter(F.transform(F.split(hand, ","), lambda h: F.trim(h)), lambda h: h != ""),
        "subject": F.filter(F.array(classification), lambda s: s != ""),
    }
    return [v.alias(k) for k, v in fields.items()]


def described(rows: DataFrame, xml: str) -> DataFrame:
    """Adds the fields of the description in a column of XML."""
    parsed = rows.withColumn("b_", F.from_xml(xml, DESCRIPTION, {"rowTag": "biblFull", "ignoreNamespace": "true"}))
    return parsed.select(*rows.columns, *description(F.col("b_")))


def descriptions(spark: SparkSession, path: str, pid: str = r"^o:\w+\.\d+$") -> DataFrame:
    """The full record of each object described below a path whose pid matches: one scan for all. Of equal pids the last counts, by path, then place in the file."""
    rows = spark.read.format("xml").option("rowTag", "biblFull").option("ignoreNamespace", True).schema(DESCRIPTION).load(path)
    b = F.struct(*(F.col(c) for c in ("titleStmt", "notesStmt", "sourceDesc", "profileDesc")))
    rows = rows.select(b.alias("b"), F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("nth")).alias("at"))
    rows = rows.select(*description(F.col("b")), "at").where(F.col("pid").rlike(pid))
    fields = [c for c in rows.columns if c not in ("pid", "at")]
    return rows.groupBy("pid").agg(F.max_by(F.struct(*fields), "at").alias("m")).select("pid", "m.*")


def _number(i: int):
    return lambda pair: pair[i].cast("double")


def percent(points: Column, width: Column, height: Column) -> Column:
    """The smallest box [x, y, w, h] around a polygon "x,y x,y ...", in percent of the page, to one decimal; null without points or size."""
    pairs = F.transform(F.filter(F.split(F.trim(points), r"\s+"), lambda p: p.rlike(r"^-?[\d.]+,-?[\d.]+$")), lambda p: F.split(p, ","))
    xs, ys = (F.transform(pairs, _number(i)) for i in (0, 1))
    x, y = F.array_min(xs), F.array_min(ys)
    share = lambda v, n: F.round(F.try_divide(v * 100, n), 1)
    box = F.array(share(x, width), share(y, height), share(F.array_max(xs) - x, width), share(F.array_max(ys) - y, height))
    return F.when(F.size(pairs) > 0, F.when((width > 0) & (height > 0), box))


def _regions(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, image, width, height, region_id, type, bbox, reading_order (of each document), text. Regions that the reading order leaves out come last, in the order of the file."""
    back = {v: k for k, v in PAGE_XML_TYPES.items()}
    p = F.col("page_")
    order = F.coalesce(_of(p, "ReadingOrder", "OrderedGroup", "RegionRefIndexed"), F.array().cast("array<struct<_regionRef:string,_index:int>>"))
    place = lambda r: F.array_min(F.transform(F.filter(order, lambda o: o["_regionRef"] == r["_id"]), lambda o: o["_index"]))
    ranked = F.array_sort(F.transform(p["TextRegion"], lambda r, i: F.struct(F.coalesce(place(r).cast("long"), F.lit(1 << 40)).alias("place"), i.alias("nth"), r.alias("r"))))  # within the page: no shuffle
    rows = rows.select(*keys, p["_imageFilename"].alias("image"), p["_imageWidth"].alias("width"), p["_imageHeight"].alias("height"), F.posexplode(ranked).alias("nth_", "s_")).select("*", "s_.r")
    kind = F.coalesce(lookup(F.col("r._type"), back), F.lit("paragraph"))
    text = F.coalesce(F.get(F.col("r.TextEquiv"), F.lit(0))["Unicode"], F.lit(""))
    return rows.select(*keys, "image", "width", "height", F.col("r._id").alias("region_id"), kind.alias("type"), percent(F.col("r.Coords._points"), F.col("width"), F.col("height")).alias("bbox"), (F.col("nth_") + 1).alias("reading_order"), text.alias("text"))


_EXACT = {"rowTag": "PcGts", "ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"}


def page_regions(rows: DataFrame, keys: list[str], xml: str) -> DataFrame:
    """The regions of PAGE documents in a column of text."""
    return _regions(rows.select(*keys, F.from_xml(xml, PAGE, _EXACT)["Page"].alias("page_")), keys)


def read_page_xml(spark: SparkSession, path: str) -> DataFrame:
    """The regions of PAGE files: object_id and page are read from `<object>_page/page_<n>.xml`."""
    rows = spark.read.format("xml").options(**_EXACT).option("pathGlobFilter", "*.xml").option("recursiveFileLookup", True).schema(PAGE).load(path)
    file = F.col("_metadata.file_path")
    return _regions(rows.select(F.regexp_extract(file, r"([^/]+)_page/[^/]+$", 1).alias("object_id"), F.regexp_extract(file, r"page_(\d+)\.xml$", 1).cast("int").alias("page"), F.col("Page").alias("page_")), ["object_id", "page"])

"""Readers: result files, metadata, Markdown and pictures, with explicit schemas; what a file lacks is null."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import frontmatter
from ..functions.text import wiki_slugs

PAGE = "struct<page:int,transcription:string,notes:string,type:string,edit_history:array<struct<original_transcription:string,edited_by:string,edited_at:string,source:string>>>"
SIGNALS = (
    "struct<version:string,total_chars:int,total_words:int,total_pages:int,empty_pages:int,blank_pages:int,color_chart_pages:int,content_pages:int,input_images:int,page_types:array<string>,"
    "chars_per_page:array<int>,chars_per_page_median:double,marker_uncertain_count:int,marker_illegible_count:int,marker_density:double,duplicate_page_pairs:array<array<int>>,language_expected:string,"
    "language_detected:string,language_match:boolean,page_length_anomalies:array<int>,needs_review:boolean,needs_review_reasons:array<string>>"
)
RESULT = (
    "object_id string, collection string, `group` string, model string, context string, metadata struct<title:string,language:string,images:array<string>,input_image_count_total:int>, "
    f"result struct<pages:array<{PAGE}>,confidence:string,confidence_notes:string,raw:string>, quality_signals {SIGNALS}, "
    "review struct<status:string,edited_pages:array<int>,reviewed_by:string,reviewed_at:string,agent_model:string,errors_found:int,estimated_accuracy:double>"
)
REGION = "struct<id:string,type:string,bbox:array<double>,reading_order:int,lines:int,label:string,source:string>"
LAYOUT = f"object_id string, collection string, `group` string, model string, pages array<struct<page:int,image_filename:string,image_width_px:int,image_height_px:int,regions:array<{REGION}>>>"


def _json(spark: SparkSession, path: str, schema: str, glob: str) -> DataFrame:
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").option("pathGlobFilter", glob).option("recursiveFileLookup", True).json(path)
    return rows.select("*", F.col("_metadata.file_name").alias("file"))


def results(spark: SparkSession, path: str, glob: str = "*.json", collection: str | None = None, group: str | None = None) -> DataFrame:
    """Result files that name their collection. is_broken: the model's output could not be parsed."""
    rows = _json(spark, path, RESULT, glob).where("collection is not null")
    if collection is not None:
        rows = rows.where(F.col("collection") == collection)
    if group is not None:
        rows = rows.where(F.col("group") == group)
    return rows.withColumn("is_broken", F.col("result.raw").isNotNull())


def pages_of(rows: DataFrame) -> DataFrame:
    """One row a page: object_id, pos (0-based), page_no, text, notes, stored_type."""
    return rows.select("object_id", F.posexplode("result.pages").alias("pos", "p")).select("object_id", "pos", F.col("p.page").alias("page_no"), F.coalesce("p.transcription", F.lit("")).alias("text"), F.coalesce("p.notes", F.lit("")).alias("notes"), F.col("p.type").alias("stored_type"))


def layouts(spark: SparkSession, path: str, glob: str = "*_layout.json") -> DataFrame:
    """One row a region."""
    rows = _json(spark, path, LAYOUT, glob).select("object_id", F.explode("pages").alias("p"))
    rows = rows.select("object_id", F.col("p.page").alias("page"), F.col("p.image_filename").alias("image"), F.col("p.image_width_px").alias("width"), F.col("p.image_height_px").alias("height"), F.explode("p.regions").alias("r"))
    return rows.select("object_id", "page", "image", "width", "height", F.col("r.id").alias("region_id"), "r.type", "r.bbox", "r.reading_order", F.coalesce("r.lines", F.lit(1)).alias("lines"), "r.label")


def tei(spark: SparkSession, path: str, pids: str = r"o:\w+\.\d+") -> DataFrame:
    """pid, title, language, object_type, extent of each described object: one scan for all, the last of equal pids by path and place. pids: what identifiers look like, without groups."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.regexp_extract_all("value", F.lit(r"(?s)(<biblFull\b.*?</biblFull>)"), F.lit(1))).alias("place", "x"))
    one = lambda tag: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract("x", rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1), "<[^>]+>", ""), r"(?U)\s+", " "))
    rows = rows.withColumn("at", F.struct("file", "place")).select(F.regexp_extract("x", r'<idno[^>]*type="PID"[^>]*>\s*(' + pids + r')\s*<', 1).alias("pid"), one("title").alias("title"), one("lang").alias("language"), one("term").alias("object_type"), one("extent").alias("extent"), "at")
    return rows.where("pid != ''").groupBy("pid").agg(F.max_by(F.struct("title", "language", "object_type", "extent"), "at").alias("m")).select("pid", "m.*")


def with_fallback(objects: DataFrame, first: DataFrame, second: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Fields from the first table, else the second; an empty text counts as missing."""
    a = first.select(key, *(F.col(f).alias(f"a_{f}") for f in fields))
    b = second.select(key, *(F.col(f).alias(f"b_{f}") for f in fields))
    rows = objects.join(a, key, "left").join(b, key, "left")
    return rows.withColumns({f: F.coalesce(F.nullif(f"a_{f}", F.lit("")), F.nullif(f"b_{f}", F.lit(""))) for f in fields}).drop(*(f"{x}_{f}" for f in fields for x in "ab"))


def markdown(spark: SparkSession, path: str) -> DataFrame:
    """slug, header and body (as of frontmatter.parts), words. Fields of the header: frontmatter.record()."""
    rows = spark.read.text(path, wholetext=True).select(F.regexp_extract("_metadata.file_name", r"(.+)\.md$", 1).alias("slug"), "value")
    rows = rows.select("slug", frontmatter.parts("value").alias("p")).select("slug", "p.*")
    return rows.withColumn("words", F.regexp_count("body", F.lit(r"(?U)\w+")))


#: Letters with marks and those that stand for them in ids; all others beyond ASCII are left out.
_MARKED, _PLAIN = "ÄäÖöÜüÀàÁáÂâÇçÈèÉéÊêËëÍíÎîÏïÑñÓóÔôÙùÚúÛû", "AaOoUuAaAaAaCcEeEeEeEeIiIiIiNnOoOoUuUuUu"


def heading_id(c: Column) -> Column:
    """A heading as an id: lower-case ASCII letters, digits and underscores, with a hyphen for white space and hyphens between them."""
    kept = F.trim(F.regexp_replace(F.translate(c, _MARKED, _PLAIN), r"[^\w\s-]", ""))
    return F.regexp_replace(F.lower(kept), r"[-\s]+", "-")


def headings(rows: DataFrame, key: str, body: str) -> DataFrame:
    """key, nth line, level, id, heading, by lines that begin with number signs outside of fenced blocks. An id that a text has had already gets _1, _2 and so on."""
    lines = rows.select(key, F.posexplode(F.split(body, "\n")).alias("line", "l"))
    w = Window.partitionBy(key).orderBy("line")
    fences = F.count_if(F.col("l").rlike(r"^(?:```|~~~)")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    lines = lines.withColumn("within", fences % 2 == 1).where(~F.col("within") & F.col("l").rlike(r"^#{1,6}\s+\S"))
    heading = F.trim(F.regexp_replace(F.regexp_replace("l", r"^#+\s+", ""), r"\s+#+\s*$", ""))
    lines = lines.select(key, "line", F.length(F.regexp_extract("l", r"^(#+)", 1)).alias("level"), heading.alias("heading")).withColumn("slug_", heading_id(F.col("heading")))
    nth = F.row_number().over(Window.partitionBy(key, "slug_").orderBy("line")) - 1
    return lines.withColumn("nth_", nth).select(key, "line", "level", F.concat("slug_", F.when(F.col("nth_") > 0, F.concat(F.lit("_"), "nth_")).otherwise("")).alias("id"), "heading")


def index_sections(rows: DataFrame, key: str, body: str, skip: str = "verwandte") -> DataFrame:
    """key, section, slug: links below each second-level heading; sections whose title starts with `skip` are left out."""
    lines = rows.select(key, F.posexplode(F.split(body, "\n")).alias("line", "l"))
    w = Window.partitionBy(key).orderBy("line")
    lines = lines.withColumn("section", F.last(F.when(F.col("l").rlike(r"^## "), F.trim(F.substring("l", 4, 1000))), ignorenulls=True).over(w))
    return lines.where(F.col("section").isNotNull() & ~F.lower("section").startswith(skip)).select(key, "line", "section", F.explode(wiki_slugs("l")).alias("slug"))


def _dimensions(data: bytes | None) -> tuple[int, int]:
    """Width and height from the frame header of a JPEG; zeros if there is none."""
    at = 2
    while data and at + 9 <= len(data) and data[at] == 0xFF:
        mark, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
        if mark in (0xC0, 0xC1, 0xC2):
            height, width = struct.unpack_from(">HH", data, at + 5)
            return width, height
        at += 2 + size
    return 0, 0


@F.pandas_udf(T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))
def jpeg_size(content: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_dimensions(c) for c in content], columns=["width", "height"])


def images(spark: SparkSession, path: str, most: int | None = None) -> DataFrame:
    """folder, name, nth of the pictures below a path, by the number at the end of their names."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").option("recursiveFileLookup", True).load(path).select("path")
    rows = rows.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("folder").orderBy(F.regexp_extract("name", r"(\d+)\.\w+$", 1).cast("int"))))
    return rows if most is None else rows.where(F.col("nth") <= most)

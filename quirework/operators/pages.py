"""Pages of objects: filling gaps, quality signals, duplicates, truncation. Page tables have object_id, pos (0-based), text and optionally notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules, similarity, text
from ..functions.rules import DEFAULT, Thresholds


def typed(pages: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """Adds type, chars and words."""
    notes = F.col("notes") if "notes" in pages.columns else F.lit("")
    body = F.coalesce(F.col("text"), F.lit(""))
    return pages.withColumns({"type": rules.page_type(body, notes, th), "chars": F.length(body), "words": text.word_count(body)})


def fill_missing(pages: DataFrame, expected: DataFrame) -> DataFrame:
    """Pages 1 to N for each object; expected: object_id, n. pages: object_id, page_no, text.

    Objects without pages, or with as many as expected, stay. If page numbers run beyond the number of pages, numbers 1 to N are
    laid out and those present filled in (numbers beyond N go; of equal numbers the last stays); else blanks follow up to N.
    """
    have = pages.groupBy("object_id").agg(F.count("*").alias("have"), F.max("page_no").alias("most")).join(expected, "object_id")
    gaps = (F.col("n") > 0) & (F.col("n") != F.col("have"))
    laid = have.where(gaps & (F.col("most") > F.col("have"))).select("object_id", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("page_no"))
    order = Window.partitionBy("object_id", "page_no").orderBy(F.col("pos").desc())
    last = pages.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("object_id", "page_no", "text")
    laid = laid.join(last, ["object_id", "page_no"], "left").withColumn("text", F.coalesce("text", F.lit("")))
    tail = have.where(gaps & (F.col("most") <= F.col("have")) & (F.col("n") > F.col("have")))
    tail = tail.select("object_id", F.explode(F.sequence(F.col("have").cast("int") + 1, F.col("n").cast("int"))).alias("page_no"), F.lit("").alias("text"))
    replaced = have.where(gaps & (F.col("most") > F.col("have"))).select("object_id")
    return pages.join(replaced, "object_id", "left_anti").select("object_id", F.col("page_no").cast("int"), "text").unionByName(laid).unionByName(tail)


def duplicate_pairs(pages: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """object_id, i, j: content pages of one object whose word sets are alike. pages as of typed().

    Two sets can only reach the limit if their sizes do, so sizes are compared before sets are met.
    """
    rows = pages.where((F.col("type") == "content") & (F.length(F.trim("text")) > th.duplicate_chars)).select("object_id", "pos", text.word_set("text").alias("bag"))
    a, b = rows.alias("a"), rows.alias("b")
    x, y = F.size("a.bag"), F.size("b.bag")
    pairs = a.join(b, (F.col("a.object_id") == F.col("b.object_id")) & (F.col("a.pos") < F.col("b.pos")) & (F.least(x, y) >= F.greatest(x, y) * th.duplicate_jaccard))
    return pairs.where(similarity.jaccard(F.col("a.bag"), F.col("b.bag")) > th.duplicate_jaccard).select("a.object_id", F.col("a.pos").alias("i"), F.col("b.pos").alias("j"))


def signals(pages: DataFrame, objects: DataFrame | None = None, th: Thresholds = DEFAULT) -> DataFrame:
    """Quality signals, one row an object. pages as of typed(); objects: object_id and optionally images, language."""
    kind, chars = F.col("type"), F.col("chars")
    content = kind == "content"
    empty = F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)\s+", "") == ""
    rows = pages.groupBy("object_id").agg(
        F.sum("chars").alias("total_chars"),
        F.sum("words").alias("total_words"),
        F.count_if(content & (chars > 0)).alias("total_pages"),
        F.count_if(chars == 0).alias("empty_pages"),
        F.count_if(kind == "blank").alias("blank_pages"),
        F.count_if(kind == "color_chart").alias("color_chart_pages"),
        F.count_if(content).alias("content_pages"),
        F.count_if(content & empty).alias("empty_content"),
        F.count("*").alias("pages"),
        F.array_sort(F.collect_list(F.struct("pos", "type", "chars"))).alias("each"),
        F.array_distinct(F.flatten(F.collect_list(rules.language_marks(F.coalesce("text", F.lit("")))))).alias("marks"),
        F.bround(F.coalesce(F.median(F.when(content & (chars > 0), chars)), F.lit(0.0)), 1).alias("chars_per_page_median"),
        F.sum(text.doubtful_marks(F.coalesce("text", F.lit("")))).alias("marker_uncertain_count"),
        F.sum(text.illegible_marks(F.coalesce("text", F.lit("")))).alias("marker_illegible_count"),
    )
    short = lambda p: (p["type"] == "content") & (p["chars"] > 0) & (p["chars"] < F.col("chars_per_page_median") * th.length_share)
    rows = rows.withColumns(
        {
            "page_types": F.transform("each", lambda p: p["type"]),
            "chars_per_page": F.transform("each", lambda p: p["chars"]),
            "page_length_anomalies": F.transform(F.filter("each", short), lambda p: p["pos"]),
            "language_detected": rules.language_of_marks(F.col("marks"), th),
            "marker_density": F.coalesce(F.try_divide(F.col("marker_uncertain_count") + F.col("marker_illegible_count"), F.col("total_words")), F.lit(0.0)),
        }
    ).drop("each", "marks")
    if objects is not None:
        rows = rows.join(objects, "object_id", "left")
    images = F.col("images") if objects is not None and "images" in objects.columns else F.lit(None).cast("long")
    language = text.language_key("language") if objects is not None and "language" in objects.columns else F.lit("")
    mismatch = (images.isNotNull() & (F.col("pages") != images)) | ((F.col("content_pages") > 0) & (F.col("empty_content") > F.col("content_pages") * th.empty_share))
    rows = rows.withColumns({"language_expected": language, "page_image_mismatch": mismatch})
    known = (F.col("language_expected") != "") & (F.col("language_detected") != "")
    rows = rows.withColumn("language_match", F.when(known, F.col("language_expected") == F.col("language_detected")))
    other = ~F.coalesce("language_match", F.lit(True)) & (F.col("total_words") >= th.language_words)
    reasons = F.array_compact(F.array(F.when(F.size("page_length_anomalies") > 0, "page_length_anomaly"), F.when(F.col("page_image_mismatch"), "page_image_mismatch"), F.when(other, "language_mismatch")))
    return rows.withColumn("needs_review_reasons", reasons).withColumn("needs_review", F.size("needs_review_reasons") > 0).drop("empty_content")


def quality_report(rows: DataFrame) -> DataFrame:
    """grain, key, n, flagged: objects in all, by group, collection and confidence; and reasons, by themselves and by group.

    Objects and reasons have grains of their own, so an object with two reasons counts once among objects.
    """
    by = ["group", "collection", "confidence"]
    grain = F.when(F.grouping("group") == 0, "group").when(F.grouping("collection") == 0, "collection").when(F.grouping("confidence") == 0, "confidence").otherwise("all")
    key = F.coalesce(*by, F.lit(""))
    sets = [[F.col(c)] for c in by]
    objects = rows.groupingSets([[], *sets], *by).agg(F.count("*").alias("n"), F.count_if("needs_review").alias("flagged"), grain.alias("grain"))
    objects = objects.select("grain", key.alias("key"), "n", "flagged")
    each = rows.select("group", F.explode("needs_review_reasons").alias("reason"))
    kind = F.when(F.grouping("group") == 0, "group_reason").otherwise("reason")
    reasons = each.groupingSets([[F.col("reason")], [F.col("group"), F.col("reason")]], "group", "reason").agg(F.count("*").alias("n"), kind.alias("grain"))
    return objects.unionByName(reasons.select("grain", F.concat_ws("/", "group", "reason").alias("key"), "n", F.col("n").alias("flagged")))


def top_reasons(rows: DataFrame, k: int = 3) -> DataFrame:
    counts = rows.select("group", F.explode("needs_review_reasons").alias("reason")).groupBy("group", "reason").agg(F.count("*").alias("n"))
    nth = F.row_number().over(Window.partitionBy("group").orderBy(F.col("n").desc(), "reason"))
    return counts.withColumn("nth", nth).where(F.col("nth") <= k)


def length_outliers(rows: DataFrame, least: int = 10, limit: float = 2.0) -> DataFrame:
    """Adds z, of characters per page within the group, and outlier; groups of fewer than `least` have none. rows: group, chars_per_page."""
    of = rows.groupBy("group").agg(F.count("*").alias("n_"), F.avg("chars_per_page").alias("mean_"), F.stddev_samp("chars_per_page").alias("sd_"))
    rows = rows.join(of, rows["group"].eqNullSafe(of["group"]), "left").drop(of["group"])
    z = F.when(F.col("n_") >= least, F.try_divide(F.col("chars_per_page") - F.col("mean_"), F.col("sd_")))
    return rows.withColumn("z", z).withColumn("outlier", F.coalesce(F.abs("z") > limit, F.lit(False))).drop("n_", "mean_", "sd_")


def chunks(objects: DataFrame, size: int = 20) -> DataFrame:
    """object_id, chunk, first, last (1-based pages) for objects with n pages."""
    k = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / size).cast("int"))).alias("chunk")
    rows = objects.where("n > 0").select("object_id", "n", k)
    return rows.select("object_id", "chunk", (F.col("chunk") * size + 1).alias("first"), F.least((F.col("chunk") + 1) * size, "n").alias("last"))


def page_at(pages: Column, i: int) -> Column:
    """The ith of an array of page texts, empty beyond its end."""
    return F.coalesce(F.try_element_at(pages, F.lit(i + 1)), F.lit(""))

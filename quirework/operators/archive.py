"""The archive behind the catalogue: which objects exist, what belongs to them, and what a build gathers from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import numbered

VIEWS = ("help", "knowledge", "stats", "about")
PARAMETERS = ("collection", "group", "confidence", "review_status", "q", "sort", "asc", "page")


def having(objects: DataFrame, key: str, *parts: DataFrame) -> DataFrame:
    """Objects that have a row in every part: discovery, or a filter on layout or results."""
    for part in parts:
        objects = objects.join(part.select(key).distinct(), key, "left_semi")
    return objects


def with_count(objects: DataFrame, key: str, files: DataFrame, name: str, absent: int = -1) -> DataFrame:
    """Files of each object; `absent` where there are none."""
    counts = files.groupBy(key).agg(F.count("*").alias(name))
    return objects.join(counts, key, "left").withColumn(name, F.coalesce(name, F.lit(absent)))


def paired(left: DataFrame, right: DataFrame, key: str, has_left: str, has_right: str) -> DataFrame:
    """Both sides, each optional, with a flag for each."""
    left, right = left.withColumn(has_left, F.lit(True)), right.withColumn(has_right, F.lit(True))
    return left.join(right, key, "full").withColumns({c: F.coalesce(c, F.lit(False)) for c in (has_left, has_right)})


def with_one(rows: DataFrame, more: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """A left join with the first of the matching rows only. Partial minima keep many matches of a key out of one task."""
    rest = [c for c in more.columns if c not in key]
    first = more.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("first"))
    return rows.join(first, key, "left").select(*rows.columns, *(F.col("first").getField(c).alias(c) for c in rest))


def overridden(rows: DataFrame, overrides: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Rows whose columns give way to those of an override with the same key, where it has them."""
    named = overrides.select(*key, *(F.col(c).alias(f"{c}__over") for c in columns))
    return rows.join(named, key, "left").withColumns({c: F.coalesce(f"{c}__over", c) for c in columns}).drop(*(f"{c}__over" for c in columns))


def labelled(rows: DataFrame, labels: DataFrame, group: str) -> DataFrame:
    """labels: the group, group_letter, group_label. Groups without one get ? and their own name."""
    rows = rows.join(labels, group, "left")
    return rows.withColumns({"group_letter": F.coalesce("group_letter", F.lit("?")), "group_label": F.coalesce("group_label", group)})


def without_charts(pages: Column, images: Column) -> tuple[Column, Column]:
    """Pages other than colour charts, and the images in the same places. Pages beyond the last image have none."""
    at = F.filter(F.sequence(F.lit(1), F.size(pages)), lambda i: (i <= F.size(pages)) & ~F.get(pages, i - 1).getField("type").eqNullSafe("color_chart"))
    at = F.when(F.size(pages) > 0, at).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.get(pages, i - 1)), F.transform(F.filter(at, lambda i: i <= F.size(images)), lambda i: F.get(images, i - 1))


def opening_page(pages: DataFrame, key: str, pos: str, kind: str) -> DataFrame:
    """The place (from 0) at which an object opens: its first content page, or the first page if it has none."""
    content = F.coalesce(F.col(kind), F.lit("")).isin("", "content")
    return pages.groupBy(key).agg(F.coalesce(F.min(F.when(content, F.col(pos))), F.lit(0)).cast("long").alias("opens_at"))


def valid_ids(rows: DataFrame, key: str, pattern: str, collections: list[str]) -> DataFrame:
    return rows.where(F.col(key).rlike(pattern) & F.col("collection").isin(collections))


def drafts_with_objects(drafts: DataFrame, objects: DataFrame, order: str) -> DataFrame:
    """drafts: object_id. Adds id: the first object whose id starts with object_id and an underscore, or object_id itself. A prefix join as an equality: each id meets its own prefixes."""
    parts = F.split("id", "_")
    starts = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "_"))
    prefixes = objects.where(F.size(parts) > 1).select("id", order, F.explode(starts).alias("object_id"))
    first = prefixes.groupBy("object_id").agg(F.min_by("id", order).alias("id"))
    return drafts.join(first, "object_id", "left").withColumn("id", F.coalesce("id", "object_id"))


def with_truth(rows: DataFrame, drafts: DataFrame) -> DataFrame:
    """Adds has_gt, and gt_verified where there is one. drafts: id, expert_verified."""
    found = drafts.groupBy("id").agg(F.coalesce(F.bool_or("expert_verified"), F.lit(False)).alias("gt_verified"))
    return rows.join(found, "id", "left").withColumn("has_gt", F.col("gt_verified").isNotNull())


def verification(pages: DataFrame, key: str, text: str) -> DataFrame:
    """Marks of doubt, characters and empty pages of each object; the average is over pages that are not empty, halves to even."""
    t = F.coalesce(F.col(text), F.lit(""))
    some = F.regexp_replace(t, r"(?U)[\s\x1c-\x1f]+", "") != ""
    marks = lambda p: F.sum(F.when(some, F.size(F.regexp_extract_all(t, F.lit(p), F.lit(0)))).otherwise(0)).cast("long")
    out = pages.groupBy(key).agg(
        marks(r"\[\?\]").alias("uncertain"), marks(r"\[\.\.\..*?\]").alias("illegible"), F.sum(F.when(some, F.length(t)).otherwise(0)).cast("long").alias("total_chars"), F.count_if(~some).alias("empty_pages"), F.count("*").alias("pages")
    )
    filled = F.col("pages") - F.col("empty_pages")
    return out.withColumn("avg_chars_per_page", F.when(filled > 0, F.bround(F.col("total_chars") / filled)).otherwise(0).cast("long"))


def build_order(rows: DataFrame, tie: str) -> DataFrame:
    return rows.orderBy("collection", "group_letter", tie)


def first_n(rows: DataFrame, n: int, order: list[Column | str]) -> DataFrame:
    return rows.orderBy(*order).limit(n)


def united(*collections: DataFrame) -> DataFrame:
    """The collections' lists one after the other; a column that one lacks is null."""
    out = collections[0]
    for more in collections[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def reading_order(docs: DataFrame, sections: DataFrame) -> DataFrame:
    """docs: slug; sections: slug, place. Adds nth: by place in the sections, then all others by name. A slug in two places has two rows."""
    rows = docs.join(sections, "slug", "left").withColumn("out_", F.col("place").isNull())
    return numbered(rows, ["out_", "place", "slug"], "nth").drop("out_", "place")


def statistics_page(rows: DataFrame) -> DataFrame:
    """section, key, n: every tally of the statistics page in one pass over the catalogue. rows: collection, group, content_pages,
    blank_pages, page_count, total_chars, gt_verified, review_status, needs_review, reasons (array), confidence, dwr, consensus_category, consensus_cer."""
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    needs, truth = F.coalesce("needs_review", F.lit(False)), F.coalesce("gt_verified", F.lit(False))
    tier = F.when(truth, "gt_verified").when(F.col("review_status") == "approved", "approved").when(F.col("review_status") == "agent_verified", "agent_verified").when(~needs, "llm_ok")
    cer = F.col("consensus_cer") * 100
    group = F.coalesce(F.nullif("group", F.lit("")), F.lit("?"))
    one = F.lit(1).cast("long")
    tally = lambda section, key, k=one: F.struct(F.lit(section).alias("section"), key.cast("string").alias("key"), k.alias("n"))
    all_ = F.lit("")
    tallies = [
        tally("objects", all_),
        tally("content_pages", all_, n("content_pages")),
        tally("blank_pages", all_, n("blank_pages")),
        tally("pages", all_, n("page_count")),
        tally("chars", all_, n("total_chars")),
        tally("needs_review", all_, needs.cast("long")),
        tally("dwr", F.when(F.col("dwr") > 0, F.least(F.lit(7), F.floor(F.col("dwr") * 10)))),
        tally("collection", F.col("collection")),
        tally("collection_content", F.col("collection"), n("content_pages")),
        tally("collection_blank", F.col("collection"), n("blank_pages")),
        tally("collection_other", F.col("collection"), n("page_count") - n("content_pages") - n("blank_pages")),
        tally("tier", tier),
        tally("confidence", F.when(F.col("confidence").isin("high", "medium", "low"), F.col("confidence"))),
        tally("consensus", F.nullif("consensus_category", F.lit(""))),
        tally("consensus_cer", F.when(cer < 3, 0).when(cer < 5, 1).when(cer < 10, 2).when(cer < 20, 3).when(cer.isNotNull(), 4)),
        tally("group", group),
    ]
    reasons = F.flatten(F.transform(F.coalesce("reasons", F.array().cast("array<string>")), lambda r: F.array(tally("reason", r), tally("group_reason", F.concat(group, F.lit("/"), r)))))
    return rows.select(F.inline(F.concat(F.array(*tallies), reasons))).where("key is not null").groupBy("section", "key").agg(F.sum("n").alias("n"))


def density(rows: DataFrame, group: str, label: str | None = None) -> DataFrame:
    """Objects, content pages and the spread of characters a page of each group (by group and label, if one is given); objects without text don't enter the latter. The median is the upper one of two."""
    if label is not None:
        rows = rows.withColumn(group, F.when(F.coalesce(group, F.lit("")) != "", F.concat(group, F.lit(" \u2013 "), F.coalesce(label, F.lit("")))))
    filled = F.when(F.col("avg_chars") > 0, F.col("avg_chars"))
    return rows.groupBy(F.coalesce(F.nullif(group, F.lit("")), F.lit("Unbekannt")).alias(group)).agg(F.count("*").alias("objects"), F.sum(F.coalesce("content_pages", F.lit(0))).cast("long").alias("pages"), F.count(filled).alias("with_text"), F.avg(filled).alias("mean_chars"), F.min(filled).alias("least_chars"), F.max(filled).alias("most_chars"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY CASE WHEN avg_chars > 0 THEN avg_chars END DESC)").alias("median_chars"))


def consensus_rate(rows: DataFrame, category: str) -> DataFrame:
    """One row: how many of each outcome, failed ones (null) among them, and the percentage verified, halves to even."""
    names = ("verified", "moderate", "review", "divergent")
    kind = F.regexp_replace(category, "^consensus_", "")
    out = rows.agg(*(F.count_if(kind == k).alias(k) for k in names), F.count_if(F.col(category).isNull()).alias("failed"), F.count("*").alias("total"))
    return out.withColumn("verified_percent", F.when(F.col("total") > 0, F.bround(F.col("verified") / F.col("total") * 100)).cast("long"))


def layout_quality(pages: DataFrame, key: str) -> DataFrame:
    """The worst page decides; and the pages that need correction, in order. pages: page, overall."""
    bad = F.col("overall") == "needs_correction"
    worst = F.when(F.bool_or(bad), "needs_correction").when(F.bool_or(F.col("overall") == "acceptable"), "acceptable").otherwise("good")
    return pages.groupBy(key).agg(worst.alias("overall"), F.array_sort(F.collect_list(F.when(bad, F.col("page")))).alias("pages_needing_review"))


def coverage(objects: DataFrame, results: DataFrame, key: str, by: str) -> DataFrame:
    """Objects with a result, of all, for each value of `by`."""
    marked = objects.join(results.select(key).distinct().withColumn("has", F.lit(True)), key, "left")
    return marked.groupBy(by).agg(F.count_if("has").alias("have"), F.count("*").alias("total"))


def changed_values(rows: DataFrame, stored: Column, fresh: Column) -> DataFrame:
    """How often a stored value becomes which fresh one; same tells those that stay."""
    pairs = rows.select(stored.alias("old"), fresh.alias("new"))
    return pairs.groupBy("old", "new").agg(F.count("*").alias("n")).withColumn("same", F.col("old").eqNullSafe(F.col("new")))


def edits_by_object(keys: DataFrame, key: str) -> DataFrame:
    """Edits are kept under object:page; how many each object has."""
    return keys.groupBy(F.substring_index(key, ":", 1).alias("object_id")).agg(F.count("*").alias("edits"))


def route(hash_: Column) -> Column:
    """What a location's fragment shows: view, slug, object_id, page (from 0) and catalogue parameters; unknown ones show the catalogue."""
    part = lambda p, k: F.nullif(F.regexp_extract(hash_, p, k), F.lit(""))
    slug, object_id, page = part(r"^knowledge/(.+)$", 1), part(r"^view/(.+?)(?:/(\d+))?$", 1), part(r"^view/(.+?)(?:/(\d+))?$", 2)
    view = F.when(hash_.isin(*VIEWS), hash_).when(slug.isNotNull(), "knowledge-doc").when(object_id.isNotNull(), "viewer").otherwise("catalog")
    value = lambda p: F.when(view == "catalog", F.nullif(F.try_url_decode(F.regexp_extract(hash_, rf"\?(?:.*&)?{p}=([^&]*)", 1)), F.lit("")))
    found = {p: value(p) for p in PARAMETERS}
    # An older form of the link.
    found["review_status"] = F.when(value("review") == "1", "needs_review").otherwise(found["review_status"])
    return F.struct(view.alias("view"), slug.alias("slug"), object_id.alias("object_id"), F.when(view == "viewer", F.coalesce(page.cast("int") - 1, F.lit(0))).when(view == "catalog", 0).alias("at"), *(c.alias(p) for p, c in found.items()))

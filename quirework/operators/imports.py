"""Reviews that come back from the viewer, and what is computed anew over stored results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def export_format(expert_verified: Column, models: Column, source: Column, viewer: str, strict: bool = True) -> Column:
    """gt, edit, or an error (null if not strict)."""
    found = F.when(expert_verified.isNotNull() & models.isNotNull(), "gt").when(source == viewer, "edit")
    return F.coalesce(found, F.raise_error(F.lit("unknown export format")).cast("string")) if strict else found


def last_of(exports: DataFrame, key: list[str], order: str = "nth") -> DataFrame:
    """One row a key: the last by its place in the export, or, where exports have no such column, by all their values."""
    by = [order] if order in exports.columns else sorted(set(exports.columns) - set(key))
    return exports.groupBy(*key).agg(F.max_by(F.struct("*"), F.struct(*by)).alias("e_")).select("e_.*")


def import_truth(drafts: DataFrame, exports: DataFrame) -> DataFrame:
    """drafts and exports: object_id, page, text, source; exports also approved, expert_edited, and nth where pages may come twice (the last counts). Drafts whose page
    is in the export take its text, flags and source; others keep their flags, which are null if drafts have none. updated: the text differed; imported: the page is in the export."""
    new = last_of(exports, ["object_id", "page"])
    new = new.select("object_id", "page", F.col("text").alias("new_text"), F.col("source").alias("new_source"), F.coalesce("approved", F.lit(False)).alias("new_approved"), F.coalesce("expert_edited", F.lit(False)).alias("new_edited"), F.lit(True).alias("found"))
    rows = drafts.join(new, ["object_id", "page"], "left")
    hit = F.coalesce("found", F.lit(False))
    flag = lambda name, fresh: F.coalesce(fresh, F.col(name)) if name in drafts.columns else F.col(fresh)
    rows = rows.withColumns({"updated": hit & ~F.col("new_text").eqNullSafe(F.col("text")), "imported": hit, "approved": flag("approved", "new_approved"), "expert_edited": flag("expert_edited", "new_edited")})
    rows = rows.withColumns({"text": F.when(hit, F.col("new_text")).otherwise(F.col("text")), "source": F.coalesce("new_source", "source")})
    return rows.drop("new_text", "new_source", "new_approved", "new_edited", "found")


def truth_states(imported: DataFrame, reviews: DataFrame, reviewer: str) -> DataFrame:
    """What an import did to each draft. imported: as of import_truth, with type; reviews: object_id, expert_verified, reviewed_by, reviewed_at, one an export.

    The export says whether the draft is verified, not the flags of its pages. Approved pages are those of the export; pages in all are those with content.
    """
    rows = imported.groupBy("object_id").agg(F.count_if(F.col("imported") & F.col("approved")).alias("approved"), F.count_if("updated").alias("updated"), F.count_if(F.col("type") == "content").alias("content_pages"))
    verified = F.coalesce("expert_verified", F.lit(False))
    out = rows.join(reviews, "object_id").withColumns({"expert_verified": verified, "reviewed_by": F.coalesce("reviewed_by", F.lit(reviewer)), "state": F.when(verified, "VERIFIZIERT").otherwise("TEILWEISE")})
    return out.select("object_id", "approved", "updated", "content_pages", "expert_verified", "reviewed_by", "reviewed_at", "state")


def import_edits(pages: DataFrame, exports: DataFrame, reviews: DataFrame) -> tuple[DataFrame, DataFrame]:
    """pages: object_id, page, text, notes; exports: the same with edited, and nth where pages may come twice (the last edit counts); reviews: object_id, reviewed, reviewed_by, reviewed_at. The pages with the edits; and for each
    review its edited pages that exist, approved if it says so or has any, else reviewed."""
    edits = last_of(exports.where("edited"), ["object_id", "page"]).select("object_id", "page", F.coalesce("text", F.lit("")).alias("new_text"), F.coalesce("notes", F.lit("")).alias("new_notes"), F.lit(True).alias("found"))
    rows = pages.join(edits, ["object_id", "page"], "left")
    rows = rows.withColumns({"text": F.coalesce("new_text", "text"), "notes": F.coalesce("new_notes", "notes"), "edited": F.coalesce("found", F.lit(False))}).drop("new_text", "new_notes", "found")
    done = rows.where("edited").groupBy("object_id").agg(F.array_sort(F.collect_list("page")).alias("edited_pages"))
    states = reviews.join(done, "object_id", "left").withColumn("edited_pages", F.coalesce("edited_pages", F.array().cast("array<long>")))
    approved = F.coalesce("reviewed", F.lit(False)) | (F.size("edited_pages") > 0)
    return rows, states.withColumn("status", F.when(approved, "approved").otherwise("reviewed"))


def earlier_versions(pages: DataFrame, before: DataFrame, reviews: DataFrame) -> DataFrame:
    """History of agent-verified objects: pages named as edited whose text before differs from now. reviews: object_id, status, edited_pages."""
    edited = reviews.where("status = 'agent_verified'").select("object_id", F.explode("edited_pages").alias("page"))
    now = pages.select("object_id", "page", F.col("text").alias("text_now"))
    return edited.join(now, ["object_id", "page"]).join(before.select("object_id", "page", F.col("text").alias("text_before")), ["object_id", "page"]).where("text_now != text_before")


def original_text(pages: DataFrame, history: DataFrame) -> DataFrame:
    """pages: object_id, page, text; history: object_id, page, at, text. Adds original: the oldest text that is kept, or the present one."""
    oldest = history.groupBy("object_id", "page").agg(F.min_by("text", "at").alias("oldest"))
    return pages.join(oldest, ["object_id", "page"], "left").withColumn("original", F.coalesce("oldest", "text")).drop("oldest")

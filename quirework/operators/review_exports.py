"""What the viewer hands out for review: objects with their edits, and drafts of ground truth with the reviews of their pages. One row an object, nested as the files are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _in_order(pages: DataFrame, key: str, *fields: Column) -> DataFrame:
    """key, pages: the fields of an object's pages, by place."""
    each = F.array_sort(F.collect_list(F.struct("pos", F.struct(*fields).alias("p"))))
    return pages.groupBy(key).agg(F.transform(each, lambda x: x["p"]).alias("pages"))


def edit_export(objects: DataFrame, pages: DataFrame, edits: DataFrame, approvals: DataFrame, at: Column, source: str, model: str = "gemini") -> DataFrame:
    """objects: object_id, pid, signature, collection, title, model; pages: object_id, pos (from 0), page_no, text, notes; edits: object_id, pos, text, notes, one a page;
    approvals: object_id, reviewed_by, reviewed_at, one an object. Adds pages, reviewed, reviewed_by, reviewed_at, exported_at and source to the objects.

    An edit takes the place of both text and notes. A page without a number, or with number 0, has its place. Edits of pages that do not exist are left out, objects without pages have an empty
    list. Ids lose the model's name at their end, after the joins.
    """
    new = edits.select("object_id", "pos", F.col("text").alias("new_text"), F.col("notes").alias("new_notes"), F.lit(True).alias("edited_"))
    rows = pages.join(new, ["object_id", "pos"], "left")
    edited = F.coalesce("edited_", F.lit(False))
    number = F.coalesce(F.nullif("page_no", F.lit(0)), F.col("pos") + 1).cast("int")
    pick = lambda a, b: F.when(edited, F.col(a)).otherwise(F.col(b))
    listed = _in_order(rows, "object_id", number.alias("page"), pick("new_text", "text").alias("transcription"), pick("new_notes", "notes").alias("notes"), edited.alias("edited"))
    done = approvals.select("object_id", "reviewed_by", "reviewed_at", F.lit(True).alias("reviewed"))
    out = objects.join(listed, "object_id", "left").join(done, "object_id", "left")
    none = F.array().cast(listed.schema["pages"].dataType)
    return out.select(
        F.regexp_replace("object_id", f"_{model}.*$", "").alias("object_id"), "pid", "signature", "collection", "title", "model", F.coalesce("pages", none).alias("pages"),
        F.coalesce("reviewed", F.lit(False)).alias("reviewed"), "reviewed_by", "reviewed_at", at.alias("exported_at"), F.lit(source).alias("source"),
    )


def truth_export(drafts: DataFrame, pages: DataFrame, reviews: DataFrame, reviewer: str, at: Column) -> DataFrame:
    """drafts: object_id, collection, group, title, models; pages: object_id, pos (from 0), text, type, source; reviews: object_id, pos, text, source, approved, one a page.
    Adds pages, expert_verified, reviewed_by and reviewed_at.

    Pages are numbered by place. A reviewed page takes the review's text, source and approval and counts as edited by an expert; others are not approved. A page without a type has content.
    expert_verified: all pages with content are approved, also where there are none.
    """
    new = reviews.select("object_id", "pos", F.col("text").alias("new_text"), F.col("source").alias("new_source"), "approved", F.lit(True).alias("found_"))
    rows = pages.join(new, ["object_id", "pos"], "left")
    found = F.coalesce("found_", F.lit(False))
    kind = F.coalesce(F.nullif("type", F.lit("")), F.lit("content"))
    pick = lambda a, b: F.when(found, F.col(a)).otherwise(F.col(b))
    fields = (
        (F.col("pos") + 1).cast("int").alias("page"), pick("new_text", "text").alias("transcription"), kind.alias("type"), pick("new_source", "source").alias("source"),
        F.coalesce("approved", F.lit(False)).alias("approved"), found.alias("expert_edited"),
    )
    listed = _in_order(rows, "object_id", *fields)
    out = drafts.join(listed, "object_id", "left")
    out = out.withColumn("pages", F.coalesce("pages", F.array().cast(listed.schema["pages"].dataType)))
    verified = F.forall("pages", lambda p: (p["type"] != "content") | p["approved"])
    return out.select("object_id", "collection", "group", "title", "models", "pages", verified.alias("expert_verified"), F.lit(reviewer).alias("reviewed_by"), at.alias("reviewed_at"))

"""Objects that are read in chunks of pages, put together again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What stands for pages that could not be read.
FAILED = "Chunk-Fehler: API-Aufruf fehlgeschlagen."
EMPTY = "Chunk-Fehler: Keine Pages im Ergebnis."
UNPARSED = "Chunk-Fehler: JSON nicht parsebar."
SUB = "Chunk-Fehler: Sub-Chunk fehlgeschlagen."
#: Pages of a smaller chunk.
SMALL = 5


def filled(chunks: DataFrame) -> DataFrame:
    """chunks: object_id, first, last, ok, pages (array of structs with text, notes and what else a page has), and parsed and sub where they apply.

    Pages are numbered on from the chunk's first and keep all their fields. A chunk that failed, could not be parsed (parsed is false) or came back empty has a placeholder for each of its pages,
    and one that is part of another (sub) a note of its own.
    """
    has = lambda c, default: F.coalesce(c, F.lit(default)) if c in chunks.columns else F.lit(default)
    note = F.when(has("sub", False), SUB).when(~F.col("ok"), FAILED).when(~has("parsed", True), UNPARSED).otherwise(EMPTY)
    fields = chunks.schema["pages"].dataType.elementType.fields
    own = [f for f in fields if f.name not in ("page", "text", "notes")]
    blank = F.transform(F.sequence("first", "last"), lambda n: F.struct(n.cast("int").alias("page"), F.lit("").alias("text"), note.alias("notes"), *(F.lit(None).cast(f.dataType).alias(f.name) for f in own)))
    numbered = F.transform("pages", lambda p, i: F.struct((F.col("first") + i).cast("int").alias("page"), p["text"].alias("text"), p["notes"].alias("notes"), *(p[f.name].alias(f.name) for f in own)))
    good = F.col("ok") & (F.size("pages") > 0)
    return chunks.withColumns({"good": good, "pages": F.when(good, numbered).otherwise(blank)})


def recovered(chunks: DataFrame, subs: DataFrame, small: int = SMALL) -> DataFrame:
    """chunks with those replaced that came back without pages and have more than `small` pages, by the smaller ones that were tried in their place. subs: as chunks; those
    within no such chunk are left. A chunk whose call failed has no smaller ones. The smaller ones carry no confidence."""
    bad = F.col("ok") & (F.coalesce(F.size("pages"), F.lit(0)) <= 0) & (F.col("last") - F.col("first") + 1 > small)
    holes = chunks.where(bad).select("object_id", F.col("first").alias("from_"), F.col("last").alias("to_"))
    fit = (F.col("first") >= F.col("from_")) & (F.col("last") <= F.col("to_"))
    parts = subs.join(holes, "object_id").where(fit)
    replaced = parts.select("object_id", "from_").distinct()
    kept = chunks.join(replaced.withColumnRenamed("from_", "first"), ["object_id", "first"], "left_anti")
    parts = parts.drop("from_", "to_").withColumns({"sub": F.lit(True)} | {c: F.lit(None).cast("string") for c in ("confidence", "confidence_notes") if c in chunks.columns})
    return kept.unionByName(parts, allowMissingColumns=True)


def pages_of(chunks: DataFrame) -> DataFrame:
    """object_id, page, text, notes of all chunks."""
    return filled(chunks).select("object_id", F.inline("pages"))


def merged(chunks: DataFrame) -> DataFrame:
    """chunks as above, with confidence and confidence_notes. One row an object: the worst confidence of its good chunks (high if none says so), their notes in order, and page counts."""
    rows = filled(chunks)
    rank = F.when(F.col("confidence") == "low", 0).when(F.col("confidence") == "high", 2).when(F.coalesce("confidence", F.lit("")) != "", 1)
    said = F.col("good") & (F.coalesce("confidence_notes", F.lit("")) != "")
    note = F.when(said, F.struct("first", F.concat(F.lit("S."), "first", F.lit("-"), "last", F.lit(": "), "confidence_notes").alias("note")))
    out = rows.groupBy("object_id").agg(F.min(F.when(F.col("good"), rank)).alias("rank"), F.array_sort(F.collect_list(note)).alias("notes"), F.sum(F.size("pages")).cast("long").alias("pages"), F.sum(F.when(F.col("good"), 0).otherwise(F.size("pages"))).cast("long").alias("placeholders"))
    worst = F.when(F.col("rank") == 0, "low").when(F.col("rank") == 1, "medium").otherwise("high")
    return out.select("object_id", worst.alias("confidence"), F.array_join(F.col("notes.note"), "; ").alias("confidence_notes"), "pages", "placeholders")

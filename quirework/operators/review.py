"""Review and edits as an append-only log; states are aggregations over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(events: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """The last event of each key, with all columns: one aggregation, no sort of whole groups."""
    best = events.groupBy(key).agg(F.max_by(F.struct("*"), F.struct(ts, tie)).alias("e"))
    return best.select("e.*")


def as_of(versions: DataFrame, probes: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """For each probe (key, at) the last version not after it; versions: key, ts, tie, others. Left join.

    Both sides meet in one sort by key and time, and the last version seen is carried forward.
    """
    others = [c for c in versions.columns if c not in (key, ts, tie)]
    v = versions.select(F.col(key), F.col(ts).alias("at"), F.col(tie).alias("tie_"), F.lit(0).alias("probe_"), F.struct(ts, *others).alias("v_"))
    p = probes.select(F.col(key), "at", F.lit(None).cast(dict(versions.dtypes)[tie]).alias("tie_"), F.lit(1).alias("probe_"), F.lit(None).cast(v.schema["v_"].dataType).alias("v_"))
    w = Window.partitionBy(key).orderBy("at", "probe_", "tie_").rowsBetween(Window.unboundedPreceding, 0)
    met = v.unionByName(p).withColumn("v_", F.last("v_", ignorenulls=True).over(w)).where("probe_ = 1")
    return met.select(key, "at", F.col(f"v_.{ts}").alias(ts), *(F.col(f"v_.{c}").alias(c) for c in others))


def apply_edits(pages: DataFrame, edits: DataFrame) -> DataFrame:
    """pages: object_id, page_no, text, history (array of structs text, by, at); edits: object_id, page_no, new_text, by, at, one a page.

    History grows by the old text only where the text differs. Adds edited. Edits of pages that do not exist change nothing; see unmatched().
    """
    rows = pages.join(edits, ["object_id", "page_no"], "left")
    differs = F.col("new_text").isNotNull() & (F.col("new_text") != F.col("text"))
    old = F.array(F.struct(F.col("text").alias("text"), F.col("by").alias("by"), F.col("at").alias("at")))
    return rows.select("object_id", "page_no", F.coalesce("new_text", "text").alias("text"), F.when(differs, F.concat("history", old)).otherwise(F.col("history")).alias("history"), F.col("new_text").isNotNull().alias("edited"))


def unmatched(pages: DataFrame, edits: DataFrame) -> DataFrame:
    return edits.join(pages, ["object_id", "page_no"], "left_anti")


def reason_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Objects whose sets of reasons differ, those of one side only too: their other side is null. Both: object_id, reasons."""
    bag = lambda c: F.array_sort(F.array_distinct(c))
    rows = old.select("object_id", F.col("reasons").alias("before")).join(new.select("object_id", F.col("reasons").alias("after")), "object_id", "full")
    return rows.where(~bag("before").eqNullSafe(bag("after")))


def progress(pages: DataFrame) -> DataFrame:
    """pages: object_id, type, approved. An object is verified if all its content pages are approved, also where it has none."""
    content = F.col("type") == "content"
    rows = pages.groupBy("object_id").agg(F.count_if(content).alias("content_pages"), F.count_if(content & F.col("approved")).alias("approved_pages"))
    return rows.withColumn("expert_verified", F.col("content_pages") == F.col("approved_pages"))


def ranks(rows: DataFrame, value: str, parts: int = 200) -> DataFrame:
    """value, rank: each value's place among all rows in rising order, from 1; equal values share their mean place. Null and NaN have none.

    Values fall into at most `parts` ranges, cut at approximate quantiles; places within a range are counted there, and the counts of the ranges below are added. No task sees more than its range
    of distinct values.
    """
    counts = rows.select(F.col(value).cast("double").alias("v")).where("v is not null and not isnan(v)").groupBy("v").agg(F.count("*").alias("n"))
    cuts = counts.agg(F.percentile_approx("v", [i / parts for i in range(1, parts)], 10_000)).first()[0]
    cuts = sorted(set(cuts or []))
    bounds = F.array(*map(F.lit, cuts)).cast("array<double>")
    counts = counts.withColumn("part", F.size(F.filter(bounds, lambda b: b < F.col("v"))))
    total, below = 0, []
    for part, n in sorted(counts.groupBy("part").agg(F.sum("n")).collect()):  # at most `parts` rows
        below += [F.lit(part), F.lit(total)]
        total += n
    start = F.element_at(F.create_map(*below), F.col("part")) if below else F.lit(0)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.select(F.col("v").alias(value), (start + before + (F.col("n") + 1) / 2).alias("rank"))


def spearman(rows: DataFrame, a: str, b: str, parts: int = 200) -> DataFrame:
    """rho, n: the correlation of the ranks of two columns, over rows that have both; rho is null if one of them does not vary."""
    both = rows.select(F.col(a).cast("double").alias("a_"), F.col(b).cast("double").alias("b_")).where("a_ is not null and b_ is not null and not isnan(a_) and not isnan(b_)")
    met = both.join(ranks(both, "a_", parts).withColumnRenamed("rank", "x"), "a_").join(ranks(both, "b_", parts).withColumnRenamed("rank", "y"), "b_")
    rho = F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y"))
    return met.agg(rho.alias("rho"), F.count("*").alias("n"))


def signal_quality(rows: DataFrame, flag: str, truth: str) -> DataFrame:
    """Precision, recall and F1 of a flag."""
    f, t = F.col(flag), F.col(truth)
    rows = rows.agg(F.count_if(f & t).alias("tp"), F.count_if(f & ~t).alias("fp"), F.count_if(~f & t).alias("fn"))
    rows = rows.withColumns({"precision": F.try_divide("tp", F.col("tp") + F.col("fp")), "recall": F.try_divide("tp", F.col("tp") + F.col("fn"))})
    return rows.withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))

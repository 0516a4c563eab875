"""The faceted catalogue: filter, search, sort, page, statistics, sampling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def review_filter(status: str) -> Column:
    """The objects that a review status lets through; needs_review and agent_verified overlap with the others. Rows: gt_verified, review_status, needs_review."""
    truth, needs, state = F.coalesce("gt_verified", F.lit(False)), F.col("needs_review"), F.coalesce("review_status", F.lit(""))
    known = {
        "gt_verified": truth,
        "human_verified": (state == "approved") & ~truth,
        "agent_verified": state == "agent_verified",
        "llm_ok": F.coalesce(~needs, F.lit(False)) & ~truth & ~state.isin("approved", "agent_verified"),
        "needs_review": F.coalesce(needs, F.lit(False)),
    }
    return known[status]


@dataclass(frozen=True)
class Query:
    """Parameters of a catalogue query; None leaves a filter out."""

    collection: str | None = None
    group: str | None = None
    confidence: str | None = None
    status: str | None = None
    search: str | None = None
    sort: str | None = None
    descending: bool = False
    page: int = 1
    per_page: int = 50
    search_in: tuple[str, ...] = ("title", "signature", "pid")
    tie: str = "id"
    locale: str | None = "de_CI"


def filtered(rows: DataFrame, q: Query) -> DataFrame:
    """Conjunction of the filters that are set; group matches the classification, or where that is empty the group's label."""
    if q.collection is not None:
        rows = rows.where(F.col("collection") == q.collection)
    if q.group is not None:
        rows = rows.where(F.coalesce(F.nullif("classification", F.lit("")), "group_label") == q.group)
    if q.confidence is not None:
        rows = rows.where(F.col("confidence") == q.confidence)
    if q.status is not None:
        rows = rows.where(review_filter(q.status))
    if q.search:
        found = F.lit(False)
        for c in q.search_in:
            found = found | F.lower(F.coalesce(F.col(c), F.lit(""))).contains(q.search.lower())
        rows = rows.where(found)
    return rows


def ordered(rows: DataFrame, q: Query) -> DataFrame:
    """Sorted by one column, text by locale and without case, ties by the tie column."""
    if q.sort is None:
        return rows.orderBy(q.tie)
    c: Column = F.col(q.sort)
    if dict(rows.dtypes)[q.sort].startswith("string") and q.locale:
        c = F.collate(c, q.locale)
    return rows.orderBy(c.desc() if q.descending else c.asc(), q.tie)


def paged(rows: DataFrame, q: Query, total: int | None = None) -> DataFrame:
    """One page of ordered rows; with `total`, page numbers beyond the last give the last."""
    page = max(1, q.page if total is None else min(q.page, max(1, -(-total // q.per_page))))
    return rows.offset((page - 1) * q.per_page).limit(q.per_page)


def run(rows: DataFrame, q: Query) -> DataFrame:
    return paged(ordered(filtered(rows, q), q), q)


def statistics(rows: DataFrame, keys: list[str], flags: dict[str, Column], sums: dict[str, Column]) -> DataFrame:
    """One pass: a row a key with counts, counted flags and sums."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), *(F.count_if(c).alias(k) for k, c in flags.items()), *(F.sum(c).alias(k) for k, c in sums.items()))


def heatmap(rows: DataFrame, group: str, reasons: dict[str, Column]) -> DataFrame:
    """Percent of each group's objects with each reason, halves up."""
    return rows.groupBy(group).agg(*(F.floor(F.count_if(c) * 100 / F.count("*") + 0.5).cast("long").alias(k) for k, c in reasons.items()))


def shares(rows: DataFrame, key: str) -> DataFrame:
    """key, n, share of all."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))))


def upper_median(value: str) -> Column:
    """The middle value, of two the upper: element n // 2 in order. Values are counted, not collected."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {value} DESC)")


def neighbours(rows: DataFrame, order: list[Column | str], key: str, within: list[str]) -> DataFrame:
    w = Window.partitionBy(*within).orderBy(*order)
    return rows.withColumns({"previous": F.lag(key).over(w), "next": F.lead(key).over(w)})


def first_needed(rows: DataFrame, group: str, order: str, need: DataFrame, most: int | None = None) -> DataFrame:
    """The first rows of each group, as many as it needs. need: group, need. With `most`, a bound on need, each task passes on that many of a group only."""
    nth = F.row_number().over(Window.partitionBy(group).orderBy(order))
    ranked = rows.withColumn("nth", nth)
    ranked = ranked if most is None else ranked.where(F.col("nth") <= most)
    return ranked.join(need, group).where(F.col("nth") <= F.col("need")).drop("nth", "need")


def alternating_sample(rows: DataFrame, group: str, flag: str, order: str, n: int) -> DataFrame:
    """Up to n of each group: clean, flagged, clean, flagged, ... while both last, then the rest, clean first. Only n of each kind of a group are sorted together."""
    nth = F.row_number().over(Window.partitionBy(group, flag).orderBy(order))
    counts = rows.groupBy(group).agg(F.least(F.count_if(~F.col(flag)), F.count_if(F.col(flag))).alias("shorter"))
    rows = rows.withColumn("nth", nth).where(F.col("nth") <= n).join(counts, group)
    rows = rows.withColumn("slot", F.when(F.col("nth") <= F.col("shorter"), F.col("nth") * 2 - F.when(F.col(flag), 0).otherwise(1)).otherwise(F.lit(1 << 40) + F.when(F.col(flag), F.lit(1 << 40)).otherwise(0) + F.col("nth")))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy("slot"))).where(F.col("place") <= n).drop("nth", "slot", "shorter")


def choose(rows: DataFrame, key: list[str], order: list[Column | str], unique: bool = False) -> DataFrame:
    """The first candidate of each key; with `unique`, only where it is the only one."""
    w = Window.partitionBy(*key)
    rows = rows.withColumns({"nth": F.row_number().over(w.orderBy(*order)), "of": F.count("*").over(w)})
    return rows.where((F.col("nth") == 1) & ((F.col("of") == 1) if unique else F.lit(True))).drop("nth", "of")


def missing(rows: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is not done yet: what a sink appends unless told to write anew."""
    return rows.join(done.select(*key).distinct(), key, "left_anti")

"""Mixing sources to target weights, by Pareto order sampling. DataFrame functions only.

Sources get targets in words: their weights share `share` of all words, a target stops at `most` times its source, and
the excess is shared again by weight. Within a source a document's expected copies are proportional to its weight, at
most `most`, and add up to the target. The whole part of the expectation is certain; for the fraction p each document
draws u and documents are ranked by (u / (1 - u)) / (p / (1 - p)); the sample is the head of that order whose words come
nearest to the words still due. Draws come from a hash of doc_id and seed, so reruns agree.

The order of a source is cut into 4096 ranges of the rank with a word sum each, and only running sums within a range
need a sort, so a source that holds a third of all rows is spread over thousands of groups.
A null text has 0 words and is never taken; null is a source of its own, the last. Rows that are equal in all respects may be taken singly. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, documents, written

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 17
RANGES = 4096
SHORT = 64


def n_words(text="text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def filled(rows: DataFrame, by: list[str], cap: str, weight: str, total: str, name: str) -> DataFrame:
    """Adds `name`: least(cap, level * weight), with one level for each `by` such that the amounts add up to `total` (or all caps, if they are less)."""
    ratio = F.when(F.col(weight) > 0, F.col(cap) / F.col(weight)).otherwise(F.lit(0.0))
    order = Window.partitionBy(*by).orderBy("ratio_", cap, weight)
    spent = F.coalesce(F.sum(F.col(cap).cast("double")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum(F.col(weight).cast("double")).over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("ratio_", ratio).withColumn("level_", F.when(rest > 0, (F.col(total) - spent) / rest))
    level = F.min(F.when(F.col("level_") <= F.col("ratio_"), F.struct("ratio_", "level_"))).over(Window.partitionBy(*by))["level_"]
    return rows.withColumn(name, F.coalesce(F.least(F.col(cap).cast("double"), level * F.col(weight)), F.col(cap).cast("double"))).drop("ratio_", "level_")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: int = MOST) -> DataFrame:
    """source, source_size, target, one row a source. sizes: source, size. Weights repeat over the sources by code point, null last."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights) + 1).cast("int"))
    total = F.sum("source_size").over(Window.partitionBy(F.lit(0))) * F.lit(float(share))
    rows = by_source.withColumns({"weight": weight, "total": total, "cap": F.col("source_size") * most, "all": F.lit(0)})
    return filled(rows, ["all"], "cap", "weight", "total", "target").select("source", "source_size", "target")


def uniform(*columns: Column, seed: int) -> Column:
    """In (0, 1), from 52 bits of a hash."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns), F.lit(str(seed)))), 1, 13), 16, 10)
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def pareto_mix(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: int = MOST, seed: int = SEED) -> DataFrame:
    """rows: doc_id, source, size, weight (a few distinct values), and others, which pass. Adds source_size, target, copies."""
    same = lambda a, b: a.eqNullSafe(b)
    targets = source_targets(rows, weights, share, most)
    levels = rows.groupBy("source", "weight").agg(F.sum("size").alias("mass")).withColumnRenamed("source", "s")
    levels = levels.join(targets, same(F.col("s"), F.col("source"))).drop("s")
    levels = levels.withColumns({"cap": F.col("mass") * most, "pull": F.col("mass") * F.col("weight")})
    levels = filled(levels, ["source"], "cap", "pull", "target", "words").withColumn("expected", F.when(F.col("mass") > 0, F.col("words") / F.col("mass")).otherwise(0.0))
    whole = F.floor("expected")
    levels = levels.withColumns({"whole": whole, "p": F.col("expected") - whole})
    levels = levels.withColumn("due", F.sum(F.col("p") * F.col("mass")).over(Window.partitionBy("source")))
    levels = levels.select(F.col("source").alias("s"), F.col("weight").alias("w"), "source_size", "target", "whole", "p", "due")

    rows = rows.join(levels, same(F.col("source"), F.col("s")) & (F.col("weight") == F.col("w"))).drop("s", "w")
    u = uniform(F.col("doc_id"), seed=seed)
    odds = (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))
    rows = rows.withColumn("rank", F.when((F.col("p") > 0) & (F.col("size") > 0), odds))
    rows = rows.withColumn("range", F.when(F.col("rank").isNotNull(), F.least(F.floor(F.col("rank") / (1 + F.col("rank")) * RANGES), F.lit(RANGES - 1))))
    ranges = rows.where("range is not null").groupBy("source", "range").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("source").alias("s"), F.col("range").alias("r"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    rows = rows.join(ranges, same(F.col("source"), F.col("s")) & (F.col("range") == F.col("r")), "left").drop("s", "r")
    within = Window.partitionBy("source", "range").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.col("earlier") + F.coalesce(F.sum("size").over(within), F.lit(0))
    chosen = F.when(F.col("range").isNotNull() & (reached + F.col("size") / 2 <= F.col("due")), 1).otherwise(0)
    return rows.withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + chosen).otherwise(0)).drop("whole", "p", "due", "rank", "range", "earlier")


def document_weight() -> Column:
    """Documents of under 64 words count half: their copies teach little."""
    return F.when(F.col("size") < SHORT, F.lit(0.5)).otherwise(F.lit(1.0))


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The documents, each as often as the mix takes it. doc_id and all other columns as they were."""
    same = ["doc_id", "source", "k64", "k32"]
    nth = F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0)))
    key = {"k64": F.xxhash64("text"), "k32": F.hash("text")}
    narrow = docs.select("doc_id", "source", "text").withColumns(key).withColumn("size", n_words()).drop("text")
    narrow = written(narrow.withColumn("weight", document_weight()), "mix-sizes")
    copies = pareto_mix(narrow, weights, share, most, seed).where("copies > 0").withColumn("nth", nth)
    copies = copies.select(*(F.col(c).alias(f"c_{c}") for c in (*same, "nth")), F.col("copies").alias("c_copies"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "source", *(x.alias(n) for n, x in key.items())).withColumn("nth", nth)
    met = [F.col("doc_id").eqNullSafe(F.col("c_doc_id")), F.col("source").eqNullSafe(F.col("c_source")), *(F.col(c) == F.col(f"c_{c}") for c in ("k64", "k32", "nth"))]
    repeated = rows.join(copies, met).select("row", F.explode(F.sequence(F.lit(1), F.col("c_copies").cast("int"))))
    return repeated.select("row.*")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("doc_id", "source", n_words().alias("size"))
    rows = written(rows.withColumn("weight", document_weight()), "mix-sizes")
    return pareto_mix(rows).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def _fill_sql(rows: str, by: str, cap: str, weight: str, total: str, name: str) -> str:
    return f"""(SELECT * EXCLUDE (ratio_, level_, lv_), coalesce(least(CAST({cap} AS DOUBLE), lv_ * {weight}), CAST({cap} AS DOUBLE)) AS {name} FROM (
  SELECT *, first_value(level_) OVER (PARTITION BY {by} ORDER BY CASE WHEN level_ <= ratio_ THEN 0 ELSE 1 END, ratio_, level_) AS lv_ FROM (
    SELECT *, ({total} - coalesce(sum(CAST({cap} AS DOUBLE)) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / nullif(sum(CAST({weight} AS DOUBLE)) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS level_
    FROM (SELECT *, CASE WHEN {weight} > 0 THEN {cap} / {weight} ELSE 0.0 END AS ratio_ FROM {rows})
    WINDOW o AS (PARTITION BY {by} ORDER BY ratio_, {cap}, {weight}))))"""


OP3_SQL = rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
d1 AS (SELECT *, CASE WHEN size < {SHORT} THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d1 GROUP BY source),
s1 AS (SELECT *, CAST([{', '.join(map(str, WEIGHTS))}][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} AS BIGINT) + 1] AS DOUBLE) AS weight,
  CAST(sum(source_size) OVER () AS DOUBLE) AS total, source_size * {MOST} AS cap, 0 AS one FROM s),
t AS (SELECT source, source_size, target FROM {_fill_sql('s1', 'one', 'cap', 'weight', 'total', 'target')}),
l AS (SELECT source, weight, CAST(sum(size) AS BIGINT) AS mass FROM d1 GROUP BY source, weight),
l1 AS (SELECT t.*, l.weight, mass, mass * {MOST} AS cap, mass * l.weight AS pull FROM l JOIN t ON l.source IS NOT DISTINCT FROM t.source),
l2 AS (SELECT *, CASE WHEN mass > 0 THEN words / mass ELSE 0.0 END AS expected FROM {_fill_sql('l1', 'source', 'cap', 'pull', 'target', 'words')}),
l3 AS (SELECT *, expected - floor(expected) AS p, sum((expected - floor(expected)) * mass) OVER (PARTITION BY source) AS due FROM l2),
u AS (SELECT d1.*, source_size, target, floor(expected) AS whole, p, due,
  (CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{SEED}'), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / {float(1 << 52)!r} AS u
  FROM d1 JOIN l3 ON d1.source IS NOT DISTINCT FROM l3.source AND d1.weight = l3.weight),
r AS (SELECT *, CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank FROM u),
c AS (SELECT *, coalesce(sum(CASE WHEN rank IS NOT NULL THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reached FROM r)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN size > 0 THEN whole + CASE WHEN rank IS NOT NULL AND reached + size / 2.0 <= due THEN 1 ELSE 0 END ELSE 0 END * size AS BIGINT) AS taken FROM c
"""

"""Connected components of a graph whose edges and labels stay in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Parts into which the neighbours of each node are dealt for joins.
SALT = 16


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node it is connected with), for each node of an edge. edges: a, b of one orderable type.

    Alternating large-star and small-star steps: every node links its larger neighbours, then its smaller ones, to the least node it
    knows. Each step is a grouping with partial sums and a join, salted so that the neighbours of a hub lie in SALT tasks. Each round is written to the shared folder.
    """

    def to_least(rows: DataFrame, least: DataFrame) -> DataFrame:
        """Adds m, the least node known to a."""
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALT)).cast("int"))
        return rows.join(least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))), ["a", "salt"]).drop("salt")

    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    links, before = written(links, "links"), None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = to_least(both.where("b > a"), least).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = to_least(large, small)
        links = ends.select("a", F.col("m").alias("b")).unionByName(ends.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        links = written(links, "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()

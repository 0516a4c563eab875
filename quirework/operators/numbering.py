"""Places in a total order of all rows, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = 20_000  # rows by which ranges are cut; all rows are numbered, whatever falls into it


def numbered(rows: DataFrame, order: list[str], name: str, parts: int = 200) -> DataFrame:
    """rows with their places from 1, as a long, in the rising order of columns; nulls first.

    Rows fall into at most `parts` ranges of the order, cut by a sample of its distinct values drawn by hash, so that a task that runs again cuts alike. Places are counted within a range and
    the counts of the ranges below are added: two reads of the input, one shuffle, at most `parts` counts on the driver. The order should tell rows apart: rows with equal values lie in one
    range, with places next to each other in any order.
    """
    if name in rows.columns:
        raise ValueError(f"the column {name} exists already")
    key = F.struct(*order)
    drawn = rows.select(key.alias("k")).distinct().orderBy(F.xxhash64("k"), "k").limit(SAMPLE)
    at = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(parts - 1)), lambda i: F.floor(i * F.size("ks") / parts).cast("int")))
    cuts = drawn.agg(F.array_sort(F.collect_list("k")).alias("ks")).select(F.when((F.size("ks") > 0) & F.lit(parts > 1), F.transform(at, lambda i: F.get("ks", i))).alias("cuts")).first()[0]
    kind = rows.select(key.alias("k")).schema["k"].dataType
    cuts = [F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(cut, kind.fields, strict=True))) for cut in cuts or []]
    placed = rows.withColumn("part_", F.size(F.filter(F.array(*cuts), lambda c: c <= key)) if cuts else F.lit(0))
    total, starts = 0, []
    for p, n in sorted(placed.groupBy("part_").count().collect()):  # at most `parts` rows
        starts += [F.lit(p), F.lit(total).cast("long")]
        total += n
    start = F.element_at(F.create_map(*starts), F.col("part_")) if starts else F.lit(0)
    nth = F.row_number().over(Window.partitionBy("part_").orderBy(*order)).cast("long")
    return placed.withColumn(name, nth + start).drop("part_")

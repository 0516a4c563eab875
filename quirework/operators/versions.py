"""An append-only table of versions: only rows that differ get a new one, and the state at any time can be read back.

A version is a row with its key, its values, and `version`: 1 for the first of a key, then one more each time. The state is the highest version of each key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import stored


def state(versions: DataFrame, key: list[str], until: Column | None = None) -> DataFrame:
    """The latest version of each key, of those that pass `until`. One aggregation, no sort of a key's versions."""
    rows = versions if until is None else versions.where(until)
    best = rows.groupBy(*key).agg(F.max_by(F.struct("*"), "version").alias("v_"))
    return best.select("v_.*")


def changes(current: DataFrame, rows: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """The rows that current lacks or whose values differ, with the number of their new version. Nulls are values like others; lists are compared in order.

    current: key, values, version; rows: key, values and others that are kept but not compared. Keys are not null, and stand once in rows.
    """
    now = current.select(*key, F.struct(*values).alias("now_"), "version")
    new = F.struct(*values)
    met = rows.drop("version").join(now, key, "left")
    return met.where(F.col("version").isNull() | ~new.eqNullSafe(F.col("now_"))).withColumn("version", F.coalesce("version", F.lit(0)) + 1).drop("now_")


def append(rows: DataFrame, path: str, key: list[str], values: list[str], stamp: Column) -> int:
    """Appends a version of each row that differs from the table's state; returns their number. A second run adds none.

    stamp: the time of these versions, kept in `at`.
    """
    spark = rows.sparkSession
    old = stored(spark, path, kind="parquet")
    fresh = rows.withColumn("version", F.lit(1)) if old is None else changes(state(old, key), rows, key, values)
    fresh = fresh.withColumn("at", stamp).select(*rows.columns, F.col("version").cast("int").alias("version"), "at")
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(path)
    return n


def as_of(versions: DataFrame, key: list[str], at: Column) -> DataFrame:
    """The state at a time."""
    return state(versions, key, F.col("at") <= at)


def history(versions: DataFrame, key: list[str], value: str) -> DataFrame:
    """key and the values of all versions but the last, oldest first. A key has few versions."""
    each = F.transform(F.array_sort(F.collect_list(F.struct("version", F.col(value).alias("v")))), lambda x: x["v"])
    return versions.groupBy(*key).agg(each.alias("each_")).select(*key, F.slice("each_", 1, F.greatest(F.size("each_") - 1, F.lit(0))).alias("before"))

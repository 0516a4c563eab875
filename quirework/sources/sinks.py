"""Batch sinks that can be run again: what a table holds already is not written a second time, and a run that dies leaves what was there.

A table is a folder of JSON or Parquet files, divided by columns of its own. Rows whose keys it lacks are appended; Spark's committer shows their files only when
all tasks are done. With `force`, rows replace those of equal keys: the divisions that they touch are written anew to a staging folder beside the table, read
back, and put in place by a dynamic overwrite, which leaves other divisions alone.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def stored(spark: SparkSession, path: str, schema: StructType | str | None = None, kind: str = "json") -> DataFrame | None:
    """The table at a path; None if there is none yet."""
    reader = spark.read.format(kind)
    try:
        return (reader.schema(schema) if schema else reader).load(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def save(rows: DataFrame, path: str, key: list[str], by: list[str], force: bool = False, kind: str = "json") -> dict[str, int]:
    """Writes rows to a table divided by `by`; returns how many were written and how many were passed over.

    Rows with equal keys must be equal; one is written. Null keys are keys like others. What the table holds beyond its schema in `rows` is kept as it is by appends, and lost
    in divisions that are written anew. An existing row of another division than its new version stays, unless `by` belongs to the key.
    """
    spark = rows.sparkSession
    fresh = rows.dropDuplicates(key)
    total = fresh.count()
    old = stored(spark, path, rows.schema if kind == "json" else None, kind)
    same = lambda a, b: _all(F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in key)
    if old is not None and not force:
        fresh = fresh.alias("n").join(old.select(*key).distinct().alias("o"), same("n", "o"), "left_anti")
    written = fresh.count() if old is not None and not force else total
    if not written:
        return {"written": 0, "skipped": total}
    if old is None or not force:
        fresh.write.partitionBy(*by).mode("append").format(kind).save(path)
        return {"written": written, "skipped": total - written}
    touched = fresh.select(*by).distinct()
    division = _all(F.col(f"o.{b}").eqNullSafe(F.col(f"t.{b}")) for b in by)
    kept = old.alias("o").join(touched.alias("t"), division, "left_semi").alias("o").join(fresh.select(*key).alias("n"), same("o", "n"), "left_anti")
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    kept.select(*rows.columns).unionByName(fresh).write.parquet(staged)
    again = spark.read.schema(rows.schema).parquet(staged)
    again.write.partitionBy(*by).mode("overwrite").option("partitionOverwriteMode", "dynamic").format(kind).save(path)
    return {"written": written, "skipped": 0}


def _all(tests):
    out = F.lit(True)
    for t in tests:
        out = out & t
    return out


def save_results(results: DataFrame, path: str, force: bool = False) -> dict[str, int]:
    """Transcriptions, comparisons, consensus, drafts or layouts: one row an object and model, divided by collection."""
    return save(results, path, ["collection", "object_id", "model"], ["collection"], force)


def save_catalogue(rows: DataFrame, details: DataFrame, path: str) -> dict[str, dict[str, int]]:
    """The build's outputs, each time anew: the light catalogue, and the details of each collection in a division of its own."""
    return {name: save(df, f"{path}/{name}", ["collection", "id"], ["collection"], force=True) for name, df in (("catalog", rows), ("data", details))}


def save_documents(rows: DataFrame, path: str, by: list[str], body: str, force: bool = False) -> dict[str, int]:
    """One text file a row, in a folder of its own named by the columns `by`: page JSON, MODS or METS of objects, PAGE XML of pages.

    Keys stand once in rows and are texts or whole numbers; a null key has Spark's default folder. Documents that exist are passed over or, with `force`, replaced; others stay. What exists
    is told by the names of folders, without reading the files. Rows with a null body have no document.
    """
    spark = rows.sparkSession
    fresh = rows.where(F.col(body).isNotNull()).select(*by, F.col(body).alias("value"))
    total = fresh.count()
    kinds = ", ".join(f"`{b}` {fresh.schema[b].dataType.simpleString()}" for b in by)
    listed = stored(spark, path, f"path string, modificationTime timestamp, length bigint, content binary, {kinds}", "binaryFile")
    if listed is not None and not force:
        same = _all(F.col(f"n.{b}").eqNullSafe(F.col(f"o.{b}")) for b in by)
        fresh = fresh.alias("n").join(listed.select(*by).distinct().alias("o"), same, "left_anti")
        written = fresh.count()
    else:
        written = total
    if written:
        fresh.write.partitionBy(*by).mode("overwrite").option("partitionOverwriteMode", "dynamic").text(path)
    return {"written": written, "skipped": total - written}


def manifest(rows: DataFrame, path: str, issue: str = "issue") -> int:
    """Writes the objects with an issue and returns their number, by which a caller may fail."""
    found = rows.where(F.col(issue).isNotNull() & (F.col(issue) != "none"))
    found.write.mode("overwrite").json(path)
    return found.count()

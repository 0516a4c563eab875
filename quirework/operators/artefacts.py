"""Which of an object's files counts: ladders over file names. names: collection, object_id, name (of a file, with .json), one row a file.

Each ladder is one grouping of the names that belong to an object, whatever their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Endings of files that are made from results.
DERIVED = ("_consensus", "_layout", "_gt_draft", "_judge_data")
#: Marks of files that are no transcriptions.
OTHER = ("_layout", "_consensus", "_page")
KEY = ["collection", "object_id"]


def _stem() -> Column:
    return F.regexp_replace("name", r"\.json$", "")


def _named(*parts: Column | str) -> Column:
    """Whether the file is called as the object, then the parts; false if a part is null or empty."""
    parts = [F.nullif(p, F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.coalesce(F.col("name") == F.concat("object_id", *parts, F.lit(".json")), F.lit(False))


def _of_object() -> Column:
    return F.startswith("name", F.concat("object_id", F.lit("_")))


def _any(tests: list[Column]) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def resolve_transcription(names: DataFrame, family: str) -> DataFrame:
    """collection, object_id, name: the first file of the model family by name, else the first that is neither layout, consensus nor page export."""
    own = names.where(_of_object())
    of_family = F.startswith("name", F.concat("object_id", F.lit(f"_{family}")))
    plain = ~_any([F.contains(_stem(), F.lit(o)) for o in OTHER])
    found = own.groupBy(*KEY).agg(F.coalesce(F.min(F.when(of_family, F.col("name"))), F.min(F.when(plain, F.col("name")))).alias("name"))
    return found.where("name is not null")


def _ladder(names: DataFrame, requests: DataFrame, rungs: list[tuple[str, Column]], derived: tuple[str, ...]) -> DataFrame:
    """Adds name and found (the rung, only, ambiguous or missing) to each request. The last rung is the only file of the object that is not derived."""
    asked = requests.select(*KEY, "model").distinct()
    rows = asked.join(names.select(*KEY, "name"), KEY, "left")
    other = F.coalesce(_of_object() & ~_any([F.endswith(_stem(), F.lit(d)) for d in derived]), F.lit(False))
    by = [F.max(F.when(test, F.col("name"))).alias(f"r{i}_") for i, (_, test) in enumerate(rungs)]
    rows = rows.groupBy(*KEY, "model").agg(*by, F.count_if(other).alias("n_"), F.min(F.when(other, F.col("name"))).alias("only_"))
    only = F.when(F.col("n_") == 1, F.col("only_"))
    found = F.coalesce(*(F.when(F.col(f"r{i}_").isNotNull(), F.lit(rung)) for i, (rung, _) in enumerate(rungs)), F.when(F.col("n_") == 1, "only").when(F.col("n_") > 1, "ambiguous").otherwise("missing"))
    return rows.select(*KEY, "model", F.coalesce(*(F.col(f"r{i}_") for i in range(len(rungs))), only).alias("name"), found.alias("found"))


def resolve_result(names: DataFrame, requests: DataFrame, primary: str) -> DataFrame:
    """requests: collection, object_id, model (may be null or empty). The file of the model asked for, else of the primary model, else the only one; null if none or several are left."""
    return _ladder(names, requests, [("exact", _named("_", F.col("model"))), ("primary", _named("_", primary))], DERIVED)


def resolve_edit(names: DataFrame, requests: DataFrame) -> DataFrame:
    """As resolve_result(), for files that edits go to: the object's own name, then with the model, then the only one."""
    return _ladder(names, requests, [("object", _named()), ("model", _named("_", F.col("model")))], DERIVED[:3])


def first_with_pages(names: DataFrame) -> DataFrame:
    """collection, object_id, name: the first file by name that has pages. names also have pages, a number."""
    return names.where(_of_object() & (F.col("pages") > 0)).groupBy(*KEY).agg(F.min("name").alias("name"))

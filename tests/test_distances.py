"""Edit distances in bits, and what rests on them."""

import random

import psutil
import pytest
from pyspark.sql import functions as F

from quirework.functions import distances, edits, normal_forms
from quirework.operators import readings
from quirework.plans import catalogue


def by_table(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


@pytest.mark.parametrize(("short", "chunk"), [(4_096, 256), (4, 8), (4, 3)])
def test_distance_against_the_table(monkeypatch, short, chunk):
    monkeypatch.setattr(distances, "SHORT", short)
    monkeypatch.setattr(distances, "CHUNK", chunk)
    rng = random.Random(1)
    for _ in range(400):
        a = "".join(rng.choice("ab\u00e9") for _ in range(rng.randint(0, 40)))
        b = "".join(c for c in a if rng.random() < 0.9) if rng.random() < 0.5 else "".join(rng.choice("ab\u00e9") for _ in range(rng.randint(0, 40)))
        d = by_table(a, b)
        assert distances.edit_distance(a, b) == d == distances.edit_distance(list(a), list(b))
        assert all(distances.edit_distance(a, b, k) == (d if d <= k else -1) for k in (0, max(d - 1, 0), d, d + 3))


def test_column_equals_the_built_in_one(spark):
    df = spark.createDataFrame([("", ""), ("a", ""), ("", "\U0001f600\u00e9"), ("kitten", "sitting"), (None, "x"), ("x", None)], "a string, b string")
    rows = df.select(distances.distance(F.col("a"), F.col("b")).alias("d"), F.levenshtein("a", "b").alias("e")).collect()
    assert [r.d for r in rows] == [r.e for r in rows] == [0, 1, 2, 3, None, None]


def test_long_object(spark):
    """the table of distances would have 40 billion cells here."""
    pages = spark.range(400).selectExpr("1 as object_id", "id as pos", "'content' as type", "concat_ws(' ', transform(sequence(1, 80), i -> concat('The', hash(id, i)))) as text_a").withColumn("text_b", F.lower("text_a"))
    row = readings.object_consensus(pages).first()
    n = pages.agg(F.sum(F.length("text_a"))).first()[0] + 399
    assert n > 200_000 and row.cer == 400 * 80 / n


def test_tasks_grow_with_what_is_read(spark, sf, monkeypatch):
    """above a size, adaptive execution made few tasks of many pages."""
    pages = spark.read.parquet(f"{sf}/conversations.parquet").select(F.col("conv_id").alias("object_id"), F.col("turn").alias("pos"), "text")
    monkeypatch.setattr(readings, "SHARE", -(-readings.input_bytes(pages) // 50))
    assert 48 <= readings.spread_out(pages).rdd.getNumPartitions() <= 50


@pytest.mark.parametrize("name", ["sim_page_consensus", "sim_merge3", "sim_diff_words", "sim_evaluate"])
def test_doubled_turns_do_not_meet_themselves(spark, sf, tmp_path, name):
    rows = spark.read.parquet(f"{sf}/conversations.parquet").where("conv_id < 5")
    rows.unionByName(rows).write.parquet(str(tmp_path / "conversations.parquet"))
    assert catalogue.QUERIES[name](spark, str(tmp_path)).count() == 2 * rows.count()


def test_scripts_lie_packed():
    """some 600,000 steps, which took above 200 MB as Python objects."""
    import pyarrow as pa

    a = pa.array([" ".join(f"w{i % 97}" for i in range(k, k + 300)) for k in range(2_000)])
    before = psutil.Process().memory_info().rss
    found = edits.word_script.func(a, a)
    assert len(found) == 2_000 and found.values.nbytes < 40 << 20
    assert psutil.Process().memory_info().rss - before < 150 << 20


def test_class_is_asked_only_beyond_what_never_changes(spark):
    """the long class was tried at every character."""
    plain = spark.createDataFrame([("a\u00e9\u017f" * 9,), ("e\u0301",)], "t string").select(normal_forms.composed("t").alias("t"))
    assert [r.t for r in plain.collect()] == ["a\u00e9\u017f" * 9, "\u00e9"]
    assert "(?=[^" in plain._jdf.queryExecution().optimizedPlan().toString()[:4000]

import random

from quirework.operators import readings
from quirework.operators.numbering import numbered


def test_places_equal_a_sort(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 3]), f"s{rng.randrange(10**6)}é" if rng.random() > 0.02 else None, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b string, i long").repartition(7)
    least = lambda v: (v is not None, v if v is not None else 0)
    text = lambda v: (v is not None, v or "")
    for parts in (1, 2, 50):
        got = numbered(df, ["a", "b", "i"], "nth", parts).orderBy("nth").collect()
        assert [r.nth for r in got] == list(range(1, 3001))
        assert [tuple(r)[:3] for r in got] == sorted(rows, key=lambda r: (least(r[0]), text(r[1]), r[2]))


def test_ties_and_nothing(spark):
    df = spark.createDataFrame([("x",)] * 50 + [("a",)] * 10 + [(None,)], "k string")
    got = numbered(df, ["k"], "nth", 5).orderBy("nth").collect()
    assert [r.k for r in got] == [None] + ["a"] * 10 + ["x"] * 50 and [r.nth for r in got] == list(range(1, 62))
    assert numbered(df.limit(0), ["k"], "nth").collect() == []


def test_no_window_over_all_rows(spark):
    df = numbered(spark.range(1000).withColumnRenamed("id", "k"), ["k"], "nth", 20)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "part_" in plan


def test_pages_are_dealt_by_a_number_only_where_they_are_few(spark, sf, monkeypatch):
    pages = spark.read.parquet(f"{sf}/conversations.parquet").selectExpr("conv_id object_id", "turn pos", "text")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    few = readings.spread_out(pages)
    assert 0 < readings.input_bytes(pages) < readings.SMALL and "RepartitionByExpression" in plan(few)
    monkeypatch.setattr(readings, "SMALL", 0)
    many = readings.spread_out(pages)
    assert "RebalancePartitions" in plan(many) and sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))

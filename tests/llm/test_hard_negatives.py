import math
import random

import pytest
from pyspark.sql import functions as F

from quirework.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, rid string, q string, d string, shard string, chunk string"


def brute(rows, positives=5, negatives=5, least=80):
    sound = [(i, v, (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in rows if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    sound = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in sound]
    out = []
    for a, (i, v, lab) in enumerate(sound):
        if i % 100:
            continue
        near = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j, k == lab) for b, (j, w, k) in enumerate(sound) if b != a and len(w) == len(v))
        for score, j, _ in [x for x in near if x[2]][:positives]:
            fit = [(s, k) for s, k, same in near if not same and least * -score <= 100 * -s <= 100 * -score]
            out += [(i, j, r + 1, k, -score, -s) for r, (s, k) in enumerate(fit[:negatives])]
    return sorted(out)


def mined(df, **sizes):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, label, **sizes)
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got.collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", "x", "x", "x", "x") for i, v, lab in rows], SCHEMA)


@pytest.mark.parametrize("labels", [3, 1, 40])
def test_mining_against_brute_force(spark, labels):
    rng = random.Random(labels)
    rows = [(10 * i, [rng.choice((-1, 0.5, 1, 2)) + rng.random() / 9 for _ in range(7)], rng.randrange(labels) if rng.random() < 0.7 else 0) for i in range(90)]
    rows += [(rows[10][0], rows[10][1], rows[10][2]), (rows[3][0], rows[4][1], 2)]  # repeated rows, ties
    rows += [(100, None, 1), (200, [1.0, None], 1), (300, [float("nan")] * 7, 1), (400, [1.0] * 7, None), (None, [1.0] * 7, 1), (500, [], 1), (600, [0.0] * 7, 1), (700, [float("inf")] * 7, 0)]
    rows += [(100 * i, [1.0, i / 9], i % 2) for i in range(20)]  # another length
    expected = brute(rows)
    assert len(expected) > 20
    assert mined(frame(spark, rows), rows=8, anchors=3, chunk=3) == expected
    assert mined(frame(spark, rows)) == expected


def test_mining_of_nothing(spark):
    assert mined(frame(spark, [])) == []
    assert mined(frame(spark, [(1, [1.0], 1), (100, [1.0], 2)])) == []  # no positive
    assert mined(frame(spark, [(100, [1.0], 1), (101, [1.0], 1)])) == []  # no negative


def test_products_are_exact():
    import numpy as np

    a, b = np.array([[1 << 40, 3]]), np.array([[1 << 20, 7], [-(1 << 20), 1]])
    assert hard_negatives.product(a, b).tolist() == [[(1 << 60) + 21, -(1 << 60) + 3]]
    assert hard_negatives.product(a.astype(np.int32) * 0 + 5, b % 100).tolist() == [[5 * (76 + 7), 5 * (24 + 1)]]

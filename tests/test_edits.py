import random
import time
import tracemalloc
import unicodedata

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quirework.functions import edits, normal_forms


def table_script(a, b):
    """The rule on the whole table of lengths."""
    n = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            n[i + 1][j + 1] = n[i][j] + 1 if x == y else max(n[i][j + 1], n[i + 1][j])
    out, i, j = [], len(a), len(b)
    while i or j:
        if i and j and a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            out.append(("match", a[i], b[j]))
        elif j and (not i or n[i][j - 1] >= n[i - 1][j]):
            j -= 1
            out.append(("insert", None, b[j]))
        else:
            i -= 1
            out.append(("delete", a[i], None))
    return out[::-1], n[-1][-1]


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgh"])
def test_script_against_the_table(letters):
    rng = random.Random(letters)
    for _ in range(400):
        a, b = (rng.choices(letters, k=rng.randint(0, 25)) for _ in range(2))
        expected, common = table_script(a, b)
        assert edits.script(a, b) == expected and edits.common_words(a, b) == common


def test_long_texts_within_memory():
    rng = random.Random(1)
    a = rng.choices([f"w{i}" for i in range(3000)], k=20_000)
    b = [w for w in a if rng.random() < 0.9] + rng.choices(a, k=2000)
    tracemalloc.start()
    began = time.time()
    got = edits.script(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [s[1] for s in got if s[1]] == a and [s[2] for s in got if s[2]] == b
    assert sum(s[0] == "match" for s in got) == edits.common_words(a, b)
    assert peak < 64 << 20 and time.time() - began < 60


def test_columns(spark):
    schema = "id int, text string, history array<struct<original_transcription:string>>"
    rows = spark.createDataFrame([(1, "a b c", [("a c",), ("x",)]), (2, "a", []), (3, "a", None), (4, None, [("a",)]), (5, "", [(None,)])], schema)
    got = {r.id: r.d and [tuple(s) for s in r.d] for r in rows.select("id", edits.edit_diff(F.col("history"), F.col("text")).alias("d")).collect()}
    assert got == {1: [("match", "a", "a"), ("insert", None, "b"), ("match", "c", "c")], 2: None, 3: None, 4: [("delete", "a", None)], 5: []}


def test_composition(spark):
    rng = random.Random(3)
    odd = "aeuäöüéņ̃̈́ΩKÅ가각각豈ộ日ß🙂" + chr(0x2F800) + chr(0x1D15E)
    texts = ["".join(rng.choices(odd, k=rng.randint(0, 12))) for _ in range(500)] + ["", None, "plain", "é"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    for r in rows.select("id", "t", normal_forms.composed("t").alias("c"), F.col("t").rlike(normal_forms.changing()).alias("odd")).collect():
        assert r.c == (None if r.t is None else unicodedata.normalize("NFC", r.t))
        assert r.t not in ("plain", "é") or not r.odd


def test_every_character_that_changes_is_in_the_class(spark):
    """Alone, and after a letter."""
    rows = spark.createDataFrame(pd.DataFrame({"c": [chr(i) for i in range(0x20, 0x30000) if not 0xD800 <= i < 0xE000]}))
    quiet = [r.c for r in rows.where(~F.col("c").rlike(normal_forms.changing())).collect()]
    assert len(quiet) > 100_000 and all(unicodedata.is_normalized("NFC", c) and unicodedata.is_normalized("NFC", "a" + c) for c in quiet)

import json
import random

from pyspark.sql import functions as F

from quirework.functions import letters
from quirework.sources import parsing


def test_ladder_against_its_twin(spark):
    rng = random.Random(4)
    whole = [{"a": 1, "b": [1, {"c": "x } {"}], "d": None, "e": "é \" \\ \n"}, {}, {"n": 1.5, "t": True}, {"text": "a, ] }"}]
    texts = [None, "", "[]", "3", "null", '"x"', "{", '{"a": NaN}', '{"a": 1, "a": 2}', '{"a": {"b": 1, "b": [Infinity]}}', '{"a": 1} x', '{"a": 1}{"b": 2}', '{"a": 1}}', "  {\"a\": 1}\n", '{"a": "}"}', '{"a": "} {"}', "{'a': 1}", '{"a": 01}', '{"a": 1.}', '{"a":"\\x41"}', '{"a": tru}', '{"a": "\ud83d"}'.encode("utf-8", "replace").decode(), "```json\n{\"a\": 1}\n```", '{"a": "\t"}', "// c\n{}", "﻿{}"]
    for _ in range(300):
        t = json.dumps(rng.choice(whole), ensure_ascii=rng.random() < 0.5)
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(t))
            t = rng.choice([t[:at], t[:at] + rng.choice([",", "}", "\\q", "\n", "]", '"', " x"]) + t[at:], f"```\n{t}\n```", "Answer: " + t])
        texts.append(t)
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string").select("id", "t", parsing.ladder("t").alias("p"))
    clean = lambda o: {k: clean(v) for k, v in o.items()} if isinstance(o, dict) else [clean(v) for v in o] if isinstance(o, list) else None if isinstance(o, float) and o - o != 0 else o
    for r in rows.select("id", "t", "p.step", F.to_json("p.value").alias("json")).collect():
        value, step = parsing.parse(r.t)
        assert (r.step, None if r.json is None else json.loads(r.json)) == (step, None if value is None else clean(value)), r.t


def test_table_function_equals_the_column(spark):
    letters.register(spark)
    words = ["Haufe", "Fall", "ftaft", "", "ß", "WIHR", "mlih", "Äss", "llll", "f", "Df", None]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    expected = sorted((r.word, *r.v) for r in df.where("word is not null").select("word", F.explode(letters.variants(F.col("word"))).alias("v")).collect())
    got = sorted(tuple(r) for r in spark.sql("SELECT word, v.variant, v.rule, v.at FROM {df}, LATERAL letter_variants(word) v", df=df).collect())
    assert got == expected and len(got) > 15


def test_summary_of_nothing(spark):
    none = spark.createDataFrame([], "object_id string, suggestion string")
    assert tuple(letters.summary(spark.createDataFrame([("a",)], "object_id string"), none).first()) == (1, 0, 0, 0)
    assert tuple(letters.summary(spark.createDataFrame([], "object_id string"), none).first()) == (0, 0, 0, 0)

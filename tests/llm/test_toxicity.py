import random
import zlib

import pytest
from pyspark.sql import functions as F

from quirework.llm import toxicity
from quirework.llm.toxicity import Lexicon, folded


@pytest.fixture(scope="module")
def plain():
    return Lexicon({"scum": 4.0, "idiot": 3.0, "vequ*": 2.0}, ("pond scum", "idiot savant"))


def weights(model, text):
    return [w for *_, w in model.hits(text)[0]]


@pytest.mark.parametrize("text", ["IDIOT", "1d10t", "іdіοt", "ｉｄｉｏｔ", "ídiöt", "i­diot", "id!0t", "idiot!", "idi07", "(idiot)", "idiot55", "x idiot\ty", "𝐢𝐝𝐢𝐨𝐭", "IDI0T.", "$cum"])
def test_disguised_words_are_found(plain, text):
    assert len(weights(plain, text)) == 1


@pytest.mark.parametrize("text", [None, "", "   ", "idiotic", "myidiot", "id iot", "10107", "pond scum", "Pond  Scum!", "an idiot savant", "ve qua", "avequ", "!!! 555", "obscumus"])
def test_other_words_are_not(plain, text):
    assert weights(plain, text) == []


def test_beginnings_count_once(plain):
    model = Lexicon({"vequ*": 2.0, "vequa": 5.0, "vequa*": 1.0})
    assert weights(model, "vequa vequado véqu") == [5.0, 2.0, 2.0]
    assert weights(plain, "pond scum scum") == [4.0]
    assert Lexicon({}).sums("scum") == (0.0, 0.0)


def test_hits_against_plain_search():
    """Against words found by comparing each word with each term."""
    rng = random.Random(5)
    model = Lexicon({"ab": 1.0, "abc*": 2.0, "b*": 0.5, "cab": 3.0}, ("ab b", "cab ab"))
    for _ in range(300):
        text = " ".join("".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(rng.randint(0, 12)))
        ws = text.split()
        spared = {i + j for i in range(len(ws) - 1) if f"{ws[i]} {ws[i + 1]}" in ("ab b", "cab ab") for j in (0, 1)}
        expected = []
        for i, w in enumerate(ws):
            fit = [v for t, v in model.terms.items() if (w.startswith(t[:-1]) if t.endswith("*") else w == t)]
            if fit and i not in spared:
                expected.append(max(fit))
        assert weights(model, text) == expected, text


def test_folding_keeps_places():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choices("aÀß1$ ΑЖ日ﬁIl0!", k=rng.randint(0, 20)))
        a, b = folded(text)
        assert len(a) == len(b)
    assert folded("2024 10 1a a1 $ $$b")[1] == "2024 10 ia ai $ ssb"


def made(spark, n, seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("aeioutrnslm", k=rng.randint(2, 7)))
    rows, labels = [], []
    for i in range(n):
        ws, toxic = [word() for _ in range(rng.randint(5, 300))], rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(1, 4)):
                ws[rng.randrange(len(ws))] = rng.choice(("idiot", "zork", "gurb" + word(), "2ork"))
        elif rng.random() < 0.03:
            ws[0:2] = ["zork", "metal"]
        rows.append((i, " ".join(ws)))
        labels.append((i, 0, int(toxic)))
    copied = " ".join(word() for _ in range(40))  # copies of a toxic text must not make its words toxic
    rows += [(n + i, copied + f" zork {i}") for i in range(200)]
    labels += [(n + i, 0, 1) for i in range(200)]
    return rows, labels, copied


def test_learning(spark, tmp_path):
    rows, labels, copied = made(spark, 1500)
    docs = spark.createDataFrame(rows + [(None, "idiot"), (5000, None), (5001, ""), (5001, "")], "doc_id long, text string").withColumns({c: F.lit("x") for c in ("toxic", "score", "term", "clean", "held_out", "weight")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels + [(None, 0, 1), (5000, 0, 1), (1, 1, None), (77777, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = [r for r in toxicity.op12_toxicity(spark, str(tmp_path)).collect()]
    assert len(got) == len(rows) + 4
    known = {i: t for i, _, t in labels}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(r.predicted, known[r.doc_id]) for r in got if r.held_out and r.doc_id in known]
    assert sum(p == t for p, t in held) >= 0.98 * len(held) and sum(t for _, t in held) > 50
    remainder = F.crc32(F.col("doc_id").cast("string")) % 3
    model = toxicity.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"), remainder != 1)
    assert "zork" in model.terms and "gurb*" in model.terms and "zork metai" in model.exceptions
    assert not set(map(toxicity.fold_term, copied.split())) & set(model.terms)
    direct = {text: model.score(text) for _, text in rows}
    for r in toxicity.scored(docs, model).join(docs, "doc_id").where("text is not null").collect():
        assert abs(r[1] - direct.get(r.text, model.score(r.text))) < 1e-12


def test_nothing_to_learn_from(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert toxicity.op12_toxicity(spark, str(tmp_path)).count() == 0
    docs = spark.createDataFrame([(1, "you idiot"), (2, "fine")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.scored(docs, toxicity.fit(docs, None)).collect()}
    assert got[1] > 0.7 > got[2]

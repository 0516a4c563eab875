import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from quirework.functions import letters, rules, similarity, text
from quirework.operators import readings
from quirework.sources import parsing


def values(spark, expression, rows, schema="t string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]


@pytest.mark.parametrize(
    "raw, plain",
    [
        ("Mar-\nschlacht", "Marschlacht"),
        ("Ge-\ndanken", "Gedanken"),
        ("quasi- \nhistorisch", "quasihistorisch"),
        ("Klard[?]", "Klard"),
        ("[...3...]", ""),
        ("~~Eltern~~", "Eltern"),
        ("{sehr}", "sehr"),
        ("[Stempel: TEXT]", "TEXT"),
        ("a\r\nb\n\nc  d ", "a b\nc d"),
        ("", ""),
    ],
)
def test_normalize(spark, raw, plain):
    assert values(spark, text.normalize("t"), [(raw,)]) == [plain]


def test_normal_forms(spark):
    assert values(spark, text.normalize_flat("t"), [("a  b ,\n\nc",)]) == ["a b, c"]
    assert values(spark, text.normalize_orderless("t"), [("zebra line\n\nab\n\nalpha line",)]) == ["alpha line zebra line"]
    assert values(spark, text.word_count("t"), [(None,), ("",), (" a b ",)]) == [0, 0, 2]
    assert values(spark, text.letter_runs("t"), [("Daß das",)]) == [["da", "das"]]
    assert values(spark, text.strip_fence("t"), [('```json\n{"a": 1}\n```',)]) == ['{"a": 1}']
    assert values(spark, text.first_fenced("t"), [("x\n```\nin\n```\ny",), ("none",)]) == ["in\n", "none"]


def test_language(spark):
    rows = [("der die und",), ("the and of",), ("de des en un",), ("der die",), ("le la des en de un und den in der",)]
    assert values(spark, rules.detect_language(F.col("t")), rows) == ["de", "en", "fr", "", "fr"]
    assert values(spark, text.language_key("t"), [("Deutsch, Englisch",), ("french (x)",), (None,)]) == ["de", "fr", ""]
    assert values(spark, text.language_code("t"), [("Latein",), ("",), ("Jiddisch",)]) == ["lat", "und", "yi"]


def test_rules(spark):
    rows = [("some text here", "Kodak"), ("", ""), ("S. 3", "leer"), ("S. 3", ""), (None, None)]
    assert values(spark, rules.page_type(F.col("t"), F.col("n")), rows, "t string, n string") == ["color_chart", "blank", "blank", "content", "blank"]
    rows = [(["low", "high"],), ([],), (["strange", "high"],)]
    assert values(spark, rules.least_confidence(F.col("t")), rows, "t array<string>") == ["low", "high", "strange"]
    rows = [(0.029, 0.0), (0.03, 0.95), (0.1, 0.90), (0.1, 0.75), (0.5, 0.1)]
    assert values(spark, rules.consensus(F.col("c"), F.col("o")), rows, "c double, o double") == ["verified", "verified", "moderate", "review", "divergent"]


def test_error_rates(spark):
    rng = random.Random(1)
    rows = [("", ""), ("", "x"), ("abc", "abc")] + [("".join(rng.choices("abc de", k=rng.randint(1, 300))), "".join(rng.choices("abc de", k=rng.randint(0, 300)))) for _ in range(30)]
    df = spark.createDataFrame(rows, "a string, b string").select("a", "b", similarity.cer(F.col("a"), F.col("b")).alias("cer"), similarity.cer_blocks("a", "b").alias("blocks"), similarity.edit_breakdown("a", "b").alias("e"))
    for r in df.collect():
        ops = [o for o in difflib.SequenceMatcher(None, r.a, r.b).get_opcodes() if o[0] != "equal"]
        changed = sum(max(j - i, m - k) for _, i, j, k, m in ops)
        assert r.blocks == (changed / len(r.a) if r.a else float(bool(r.b)))
        assert (r.cer == 0) == (r.a == r.b)
        assert r.e.insertions == sum(m - k for o, _, _, k, m in ops if o == "insert")


def test_overlap_of_nothing(spark):
    rows = [("", ""), ("a", ""), ("a b", "b a")]
    assert values(spark, similarity.word_overlap(F.col("a"), F.col("b")), rows, "a string, b string") == [1.0, 0.0, 1.0]


@pytest.mark.parametrize(
    "raw, step",
    [
        ('{"a": 1}', "direct"),
        ('```json\n{"a": 1}\n```', "fence"),
        ('{"a": "x\\jy"}', "escapes"),
        ('{"a": [1, 2,],}', "repair"),
        ('{"a": "line\nbreak"}', "repair"),
        ('Here it is: {"a": {"b": 1}} done', "extract"),
        ('{"a": {"b": "cut', "extract"),
        ("nothing", "raw"),
        (None, "raw"),
    ],
)
def test_ladder(raw, step):
    found, name = parsing.parse(raw)
    assert name == step and (found is None) == (step == "raw")


def test_ladder_column(spark):
    rows = spark.createDataFrame([('{"b": 1, "a": 2}',), ("x",)], "t string").select(parsing.parse_json("t").alias("p")).select("p.*").collect()
    assert [tuple(r) for r in rows] == [('{"a": 2, "b": 1}', "direct"), (None, "raw")]


def test_letter_variants(spark):
    got = values(spark, letters.variants(F.col("t")), [("Hafft",)])[0]
    assert {(v.variant, v.rule, v.at) for v in got} == {("Hasft", "f->s", 2), ("Hafst", "f->s", 3), ("Hafst", "ft->st", 3), ("Liafft", "h->li", 0), ("HNfft", "A->N", 1)}


def test_corrections(spark):
    words = spark.createDataFrame([("gewefen",), ("Mitgebrine",), ("haus",), ("xyzt",)], "word string")
    known = spark.createDataFrame([("gewesen",), ("haus",)], "known string")
    got = {r.word: (r.suggestion, r.rule, r.candidates) for r in letters.corrections(words, known).collect()}
    assert got == {"gewefen": ("gewesen", "f->s", 1), "Mitgebrine": ("Mitbringsel", "known", 1)}


def test_corrections_of_places(spark):
    known = {"gewesen", "haus", "strasse", "war", "diese", "das"}
    texts = [
        "Das ist gewefen. Haut war ein Gewefen hier. Gewefen!",
        "die ge-\nwefen wa-\nren ge=\n  fen-\nwefen gewefen",
        "Mitgebrine GEWEFEN, dafs und gewefen" + " x" * 30,
        "gewefen", "", None, "12 - \n34", "e\u0301 gewefen \U0001f600 gewefen",
    ]
    letter = letters.LETTER
    expected = []
    for i, t in enumerate(texts):
        t = t or ""
        broken = {p for m in re.finditer(rf"({letter}+)[-=]\s*\n\s*({letter}+)", t) for p in (m.start(1), m.start(2))}
        for m in re.finditer(rf"{letter}+", t):
            w, at = m.group(), m.start()
            before = t[max(0, at - 3) : at].rstrip()
            named = w[0].isupper() and not w.isupper() and not (before and before[-1] in ".!?")
            expected.append((i, w, at, t[max(0, at - 20) : at + len(w) + 20], at in broken, named))
    df = spark.createDataFrame(list(enumerate(texts)), "page long, t string")
    assert sorted(map(tuple, letters.occurrences(df, ["page"], "t").collect())) == sorted(expected)
    words = spark.createDataFrame([(w,) for w in known], "known string")
    got = {(r.page, r.at): (r.word, r.suggestion) for r in letters.find_corrections(df, ["page"], words, "t").collect()}
    right = {}
    for i, w, at, _, broken, named in expected:
        if w == "Mitgebrine":
            right[i, at] = (w, "Mitbringsel")
        elif not broken and not named and w.lower() == "gewefen":
            right[i, at] = (w, {"gewefen": "gewesen", "Gewefen": "Gewesen", "GEWEFEN": "GEWESEN"}[w])
    assert {k: (w, s and s.lower()) for k, (w, s) in got.items() if w.lower() in ("gewefen", "mitgebrine")} == {k: (w, s.lower()) for k, (w, s) in right.items()}


def test_corrections_send_no_text_with_a_word(spark):
    page = spark.createDataFrame([(1, "gewefen ift gewefen"), (1, "gewefen ift gewefen"), (None, "gewefen")], "page long, t string")
    words = spark.createDataFrame([("gewesen",), ("ist",)], "known string")
    found = letters.find_corrections(page, ["page"], words, "t")
    assert sorted((r.page or 0, r.at, r.suggestion) for r in found.collect()) == [(0, 0, "gewesen"), *[(1, 0, "gewesen")] * 2, *[(1, 12, "gewesen")] * 2]
    assert "Window" not in letters.occurrences(page, ["page"], "t")._jdf.queryExecution().optimizedPlan().toString()


def test_agreement_by_words(spark):
    def distance(a, b):
        table = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i * j}
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                table[i, j] = min(table[i - 1, j] + 1, table[i, j - 1] + 1, table[i - 1, j - 1] + (x != y))
        return table[len(a), len(b)]

    rng = random.Random(3)
    rows = [(i // 3, i % 3, *(" ".join(rng.choices("abc", k=rng.randint(0, 12))) for _ in "ab")) for i in range(60)] + [(90, 0, "", ""), (91, 0, "", "x"), (92, 0, None, None)]
    got = {r.object_id: r for r in readings.object_agreement(spark.createDataFrame(rows, "object_id long, pos int, text_a string, text_b string").na.fill(""), words=True).collect()}
    for key in {r[0] for r in rows}:
        mine = [((a or ""), (b or ""), p) for k, p, a, b in rows if k == key]
        for name, cut in (("agreement_wer", str.split), ("agreement_cer", list)):
            apart, size = sum(distance(cut(a), cut(b)) for a, b, _ in mine), sum(len(cut(a)) for a, _, _ in mine)
            assert got[key][name] == pytest.approx(apart / size if size else float(apart > 0))
        assert got[key].disagreement_pages == [p for a, b, p in mine if distance(a, b) > 0.05 * len(a)] and got[key].high_agreement == (got[key].agreement_cer < 0.03)


def test_left_out_and_put_in(spark):
    rows = [("", ""), ("", "ab"), ("abcd", ""), ("abcdef", "abef"), ("abef", "abcdef")]
    both = F.array(similarity.omission(F.col("a"), F.col("b")), similarity.hallucination(F.col("a"), F.col("b")))
    assert values(spark, both, rows, "a string, b string") == [[0, 0], [0, 1], [1, 0], [2 / 6, 0], [0, 2 / 6]]


def test_frontmatter(spark):
    from quirework.functions import frontmatter

    rows = [("---\ntitle: A # b\ntags: one\nrelated:\n- [[x]]\n- y\n---\nBody\n",), ("---\nno end",), ("no header",), ("",), (None,), ("------\nx",), ("---\ntitle: ''\ntags: []\n---",)]
    df = spark.createDataFrame(rows, "t string").select(frontmatter.parts("t").alias("p"))
    got = df.select("p.header", "p.body", frontmatter.record("p.header", F.lit("slug")).alias("m")).collect()
    assert [(r.header, r.body) for r in got] == [("title: A # b\ntags: one\nrelated:\n- [[x]]\n- y", "Body"), ("", "---\nno end"), ("", "no header"), ("", ""), (None, None), ("", "x"), ("title: ''\ntags: []", "")]
    assert [(r.m.title, r.m.tags, r.m.related) for r in got] == [("A", ["one"], ["x"]), *[("slug", [], [])] * 6]


def test_split_list(spark):
    df = spark.createDataFrame([("A. B,  C 10 , 1D,,",), (" ",), (None,)], "t string")
    assert [r.x for r in df.select(text.split_list("t").alias("x")).collect()] == [["A. B", "C 10", "1D"], [], []]


def test_headings_have_ids(spark):
    from quirework.sources import files

    body = "# Über `x` & mehr!\n```\n# no heading\n```\n## Same - again ##\n### Same - again\n## Same - again\n#none\ntext\n"
    rows = spark.createDataFrame([("a", body), ("b", "## Same - again"), ("c", None)], "k string, t string")
    got = files.headings(rows, "k", "t").orderBy("k", "line").collect()
    assert [(r.k, r.line, r.level, r.id, r.heading) for r in got] == [
        ("a", 0, 1, "uber-x-mehr", "Über `x` & mehr!"), ("a", 4, 2, "same-again", "Same - again"), ("a", 5, 3, "same-again_1", "Same - again"), ("a", 6, 2, "same-again_2", "Same - again"), ("b", 0, 2, "same-again", "Same - again"),
    ]

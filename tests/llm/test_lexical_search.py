import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quirework.llm import lexical_search

TERM = re.compile(lexical_search.TERM)


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, queries, k):
    held = [(d, Counter(t)) for d, t in ((d, terms(text)) for d, text in docs) if t]
    total, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for q, text in queries:
        asked.setdefault(q, set()).update(terms(text))
    out = []
    for q, words in asked.items():
        scores = []
        for d, c in held:
            m = 50 + 50 * sum(c.values()) * total // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 20 * m)) for w in words if c[w])
            if s:
                scores.append((-s, d is None, d or 0))
        out += [(q, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def found(spark, docs, queries, k):
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("u", "term", "n", "k64", "item_id", "score", "rank", "df")})
    asked = spark.createDataFrame(queries, "item_id long, text string").withColumns({c: F.lit(1) for c in ("doc_id", "term", "item", "word")})
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical_search.search(df, asked, k).collect()), key=repr)


@pytest.mark.parametrize("vocabulary, size, frequent, items", [(1 << 20, 1 << 16, 1 / 64, 512), (5, 3, 0.5, 2)])
def test_search_against_brute_force(spark, monkeypatch, vocabulary, size, frequent, items):
    monkeypatch.setattr(lexical_search, "ITEMS", items)
    monkeypatch.setattr(lexical_search, "BLOCK", 12 if items > 2 else 4)
    monkeypatch.setattr(lexical_search, "VOCABULARY", vocabulary)
    monkeypatch.setattr(lexical_search, "LIST", size)
    monkeypatch.setattr(lexical_search, "FREQUENT", frequent)
    rng = random.Random(size)
    words = [f"w{i}" for i in range(40)] + ["É", "日本", "ÀB", "x9", "The"]
    text = lambda: " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=rng.randint(1, 60)))
    docs = [(i, text()) for i in range(150)]
    docs += [(500 + i, docs[7][1]) for i in range(30)] + [(7, docs[7][1]), (None, docs[7][1]), (None, "the é"), (8, "the")]  # copies, repeated rows, rows without ids
    docs += [(900, None), (901, ""), (902, "... !!"), (903, "the " * 3000), (904, "THE-the\tThE")]
    queries = [(1, docs[7][1]), (2, "the É"), (3, "nothing here"), (4, None), (5, ""), (6, "w1 w1 w2"), (6, "w3"), (None, "w4 w5 日本"), (8, " ".join(words))]
    for k in (5, 50):
        assert found(spark, docs, queries, k) == brute(docs, queries, k)


def test_search_of_nothing(spark):
    assert found(spark, [], [(1, "a")], 5) == []
    assert found(spark, [(1, "a")], [], 5) == []
    assert found(spark, [(1, None)], [(1, "a")], 5) == []


def test_many_queries_share_terms(spark):
    """More asked terms than one row of a term's queries may hold."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(20, 60)))) for i in range(400)]
    queries = [(i, " ".join(rng.choices(words, k=40))) for i in range(130)]
    assert found(spark, docs, queries, 7) == brute(docs, queries, 7)

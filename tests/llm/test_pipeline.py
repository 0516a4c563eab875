"""Each stage of the pipeline against a plain version, on all that the stage before kept."""

import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from test_llm import brute_repeats, docs_of, idf_of, least_of_classes
from tokenizers import Tokenizer

import corpus_pipeline
from quirework.llm import minhash_dedup, mixing, quality
from quirework.llm.vocabularies import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first stage and after each, with the frames to make them of."""
    df = spark.read.parquet(f"{SF}/documents.parquet")
    held = [(df, df.collect())]
    for _, stage in corpus_pipeline.STAGES:
        df = corpus_pipeline.written(stage(spark, df, SF), "stage")
        held.append((df, df.collect()))
    return held


def bayes(model, votes):
    """The odds that a document is bad, by products of each labeller's."""
    like = [math.prod(model.odds[c][k][v] for k, v in enumerate(votes)) for c in (0, 1)]
    return model.prior * like[1] / (model.prior * like[1] + (1 - model.prior) * like[0])


def plain_score(model, scorer, votes, buckets):
    p = min(max(bayes(model, votes), 1e-4), 1 - 1e-4)
    z = sum(scorer[0][b] for b in buckets) + scorer[1]
    return 1 / (1 + math.exp(-(min(max(z, -6), 6) + math.log(p / (1 - p)))))


def test_classifier(spark, stages):
    (df, before), (_, after) = stages[:2]
    model = quality.fit(df, quality.labels_of(spark, SF))
    kept = Counter()
    for r in before:
        data = (r.text or "").encode()
        junk, abuse, row, bucket = quality.votes_of(np.frombuffer(data, np.uint8), np.array([0, len(data)], np.int64), model.lexicon)
        votes = junk[0].tolist(), abuse[0].tolist()
        scores = [plain_score(m, s, v, bucket.tolist()) for m, s, v in ((model.junk, model.junk_scorer, votes[0]), (model.abuse, model.abuse_scorer, votes[1]))]
        nothing = all(v == quality.NONE for v in votes[0])  # no labeller of junk has a view of it
        if (nothing or scores[0] < 0.5) and scores[1] < 0.5:
            kept[r] += 1
    assert kept == Counter(after) and 0 < len(after) < len(before)


def test_near_duplicates(stages):
    (df, before), (_, after) = stages[1:3]
    rows = [(r.doc_id, r.text) for r in before]
    least = least_of_classes(rows, minhash_dedup.weighted_sets([t or "" for _, t in rows], idf_of(df)))
    texts = {}
    for i, t in sorted(rows):
        texts.setdefault(t, i)
    assert all(least[i] == least[texts[t]] for i, t in rows)
    assert Counter(after) == Counter(r for r in before if least[r.doc_id] == r.doc_id) and len(after) < len(before)


def test_repeated_passages(stages):
    (_, before), (_, after) = stages[2:4]
    before = sorted(before, key=lambda r: r.doc_id)
    after = {r.doc_id: r for r in after}
    assert len(after) == len(before)
    for r, words in zip(before, brute_repeats([x.text for x in before], 35), strict=True):
        got = after[r.doc_id]
        assert (got.text or "").encode().split() == words
        assert got.n_chars == len(got.text or "") and all(got[c] == r[c] for c in r.asDict() if c not in ("text", "n_chars"))


def test_mix(stages, tmp_path):
    (df, before), (_, after) = stages[3:5]
    df.write.parquet(f"{tmp_path}/documents")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    copies = {i: taken // size if size else 0 for i, size, taken in con.sql(f"SELECT doc_id, size, taken FROM ({mixing.OP3_SQL})").fetchall()}
    assert Counter(after) == Counter({r: copies[r.doc_id] for r in before if copies[r.doc_id]})


def test_encoding(stages):
    (_, before), (_, after) = stages[4:]
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    expected = Counter()
    for r in before:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        expected[r.doc_id, len(ids), tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, r.n_tokens, tuple(r.ids), r.decoded) for r in after) == expected


def test_nothing_and_clashing_columns(spark, tmp_path):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    df = docs_of(spark, [(1, "a few words here"), (2, None), (None, ""), (2, None)])
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, df, SF)
        assert i == 4 or out.columns == df.columns
        assert out.count() <= 6

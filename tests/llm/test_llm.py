import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import same_rows
from pyspark.sql import functions as F

from quirework.llm import attention_lm, audio_features, bpe, common, components, embedding_dedup, minhash_dedup, mixing, quality, registry, sharding, substring_dedup, token_files, word_ids
from quirework.llm.common import rolling, sliding_min
from quirework.llm.vocabularies import tokenizer_path

ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "one two"), (5, "one two"), (6, "é ß 日本 <|endoftext|> don't"), (7, "w " * 5000), (8, "x" * 5000)]


def docs_of(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("n", "row", "size", "key", "part", "k64", "ids", "bucket", "n_words", "n_removed", "starts", "mine", "copies", "bytes", "kept", "class_id", "score", "decoded", "n_tokens"):  # clashing names
        df = df.withColumn(name, F.lit("other"))
    return df.withColumns({"source": F.lit("a"), **more})


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, sf, name):
    same_rows(registry.QUERIES[name](spark, sf), registry.ORACLE_SQL[name], sf)


def brute_repeats(texts, width):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for j in range(i, i + width)}
        out.append([x for j, x in enumerate(w) if j not in gone])
    return out


def test_substrings_against_brute_force(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abc", k=rng.randint(0, 40))) for _ in range(60)] + [None, "", "a a a a a a a a a"]
    df = docs_of(spark, list(enumerate(texts)))
    got = {r.doc_id: r for r in substring_dedup.dedup_substrings(df, 6).collect()}
    for i, kept in enumerate(brute_repeats(texts, 6)):
        assert (got[i].text or "").split() == [k.decode() for k in kept]
        assert got[i].row == "other"
    assert substring_dedup.dedup_substrings(df.limit(0), 6).count() == 0
    plain = substring_dedup.dedup_substrings(df, 6, counts=False)
    assert plain.columns == df.columns and {r.n_words for r in plain.collect()} == {"other"}
    assert Counter(substring_dedup.dedup_substrings(df, 6).columns) == Counter(df.columns)


def test_substring_query_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert substring_dedup.op1_substring_dedup(spark, str(tmp_path)).count() == 0


def test_pipeline_stage_keeps_clashing_columns(spark):
    import corpus_pipeline

    df = docs_of(spark, [*ODD, (None, "a b c")])
    for _, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, df, "")
        assert out.columns == df.columns and {r.n_words for r in out.collect()} == {"other"}


def test_rolling_hash():
    h = np.random.default_rng(0).integers(0, 9, 500).astype(np.uint64)
    a = rolling(h, 5)
    same = {tuple(h[i : i + 5]): a[i] for i in range(len(a))}
    assert len(set(same.values())) == len(same) and all(same[tuple(h[i : i + 5])] == a[i] for i in range(len(a)))
    assert (sliding_min(h, 7) == [h[i : i + 7].min() for i in range(len(h) - 6)]).all()


def test_best_fit_decreasing_against_single_placement():
    rng = random.Random(2)
    for _ in range(20):
        sizes = sorted((rng.randint(1, 40) for _ in range(60)), reverse=True)
        rooms = []
        for s in sizes:
            fit = [i for i, r in enumerate(rooms) if r >= s]
            if fit:
                rooms[min(fit, key=lambda i: (rooms[i], i))] -= s
            else:
                rooms.append(100 - s)
        used = Counter()
        for size, _, n, where in sharding.best_fit_decreasing(Counter(sizes).items(), 100):
            used[where] += size * n
        assert len(used) == len(rooms) and max(used.values()) <= 100 and sum(used.values()) == sum(sizes)


def test_shards(spark, sf):
    rows = sharding.op2_sharding(spark, sf).collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    shards = {}
    for r in rows:
        assert r["size"] == len(docs[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(docs[r.doc_id].encode())
        shards.setdefault(r.shard, []).append(r)
    for s in shards.values():
        assert sorted(r.slot for r in s) == list(range(len(s)))
    mean = sum(r["size"] for r in rows) / 16
    small = [s for s in shards.values() if len(s) > 1]
    assert max(sum(r["size"] for r in s) for s in small) <= 1.02 * mean


def test_shards_of_odd_rows(spark):
    df = spark.createDataFrame([(i, "same" * 10) for i in range(300)] + [(i, str(i)) for i in range(300, 330)] + [(None, None), (None, None)], "doc_id long, text string")
    rows = df.select(F.struct("doc_id").alias("row"), (F.length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("key"))
    got = sharding.pack_shards(rows).collect()
    sums = Counter()
    for r in got:
        sums[r.shard] += r["size"]
    assert len(got) == 332 and max(sums.values()) < 2 * sum(sums.values()) / 16
    assert sharding.pack_shards(rows.limit(0)).count() == 0


def test_mix(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(0, 200)), s) for i, s in enumerate(rng.choices(["a", "b", "c", None], [6, 3, 2, 1], k=2000))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = df.select("doc_id", "source", mixing.n_words().alias("size")).withColumn("weight", mixing.document_weight())
    got = mixing.pareto_mix(sizes).collect()
    by = {}
    for r in got:
        assert 0 <= r.copies <= 3
        by.setdefault(r.source, []).append(r)
    for rs in by.values():
        assert abs(sum(r.copies * r["size"] for r in rs) - rs[0].target) <= 200
        assert rs[0].target <= 3 * rs[0].source_size
    repeated = Counter(r.doc_id for r in mixing.mix_documents(df).collect())
    assert repeated == Counter({r.doc_id: r.copies for r in got if r.copies})
    assert mixing.mix_documents(df.limit(0)).count() == 0


def test_mix_of_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b c", None)] * 4 + [(None, None, "x")], "doc_id long, text string, source string")
    assert {tuple(r) for r in mixing.mix_documents(df).collect()} <= {(1, "a b c", None)}


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), quality.labels_of(spark, sf)
    model = quality.fit(docs, labels.where("doc_id % 2 = 0"))
    rows = quality.scored(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    assert (model.junk.accuracy() > 0.8).all()
    clean = [r.kept for r in rows if r.quality == 1 and r.toxic == 0]
    junk = [r.kept for r in rows if r.quality == 0]
    assert np.mean(clean) > 0.97 and np.mean(junk) < 0.1
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_quality_of_odd_rows(spark):
    df = docs_of(spark, ODD)
    model = quality.fit(df)
    got = {r.doc_id: r for r in quality.scored(df, model).collect()}
    assert got[1].kept and got[2].kept and got[4].junk_score == got[5].junk_score
    assert quality.scored(df.limit(0), quality.fit(df.limit(0))).count() == 0


def test_label_model_against_enumeration():
    """Expectation-maximisation one document at a time, by products of plain odds, reaches the same posteriors and accuracies."""
    rng = random.Random(11)
    truth = [rng.random() < 0.3 for _ in range(400)]
    votes = [[(2 if bad else 0) if (u := rng.random()) < right else (1 if u < right + 0.15 else (0 if bad else 2)) for right in (0.8, 0.7, 0.6)] for bad in truth]
    patterns = Counter(map(tuple, votes))
    table = sorted(patterns)
    model = quality.LabelModel(quality.pattern_number(np.array(table)), np.array([patterns[t] for t in table]), 3, rounds=25)
    p = []
    for v in votes:
        bad, good = v.count(2), v.count(0)
        p.append(min(max(bad / max(bad + good / 4, 1), 0.05), 0.95) if bad else 0.02)
    for _ in range(25):
        prior = (sum(p) + 0.1) / (len(p) + 1)
        odds = []
        for share in ([1 - x for x in p], p):
            mass = [[0.05 + sum(s for s, v in zip(share, votes, strict=True) if v[k] == kind) for kind in range(3)] for k in range(3)]
            odds.append([[m / sum(ms) for m in ms] for ms in mass])
        like = lambda c, v: math.prod(odds[c][k][kind] for k, kind in enumerate(v))  # noqa: E731,B023
        p = [prior * like(1, v) / (prior * like(1, v) + (1 - prior) * like(0, v)) for v in votes]
    assert model.posterior(np.array(votes)) == pytest.approx(np.array(p), abs=1e-6)
    right = [(1 - prior) * odds[0][k][0] + prior * odds[1][k][2] for k in range(3)]
    wrong = [(1 - prior) * odds[0][k][2] + prior * odds[1][k][0] for k in range(3)]
    assert model.accuracy() == pytest.approx([a / (a + b) for a, b in zip(right, wrong, strict=True)])
    assert np.mean([(x > 0.5) == t for x, t in zip(p, truth, strict=True)]) > 0.85


def test_quality_without_ids(spark):
    rows = [(None, "you stupid idiot " * 9), (None, None), (3, "plain words here " * 9), (3, "plain words here " * 9)]
    got = quality.scored(df := docs_of(spark, rows), quality.fit(df)).collect()
    assert Counter(r.doc_id for r in got) == Counter([None, None, 3, 3])


def test_quality_trains_once_on_a_hot_text(spark, monkeypatch):
    """A third of all rows are one text, and all ids are null: the sample holds each distinct text once, and none too long."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    texts = [" ".join(word() for _ in range(30)) for _ in range(300)] + ["same words again " * 9] * 150 + [None, ""]
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    seen = []
    keep = quality.train_scorer
    monkeypatch.setattr(quality, "train_scorer", lambda row, bucket, target: (seen.append((row, len(target))), keep(row, bucket, target))[1])
    quality.fit(df)
    assert [n for _, n in seen] == [302, 302]
    seen.clear()
    quality.fit(df, sample=60)
    assert all(30 < n < 90 for _, n in seen)
    long = np.arange(20_000)
    few = quality.fewer(long)
    assert len(few) == quality.FEATURES and abs(few.mean() - 10_000) < 500 and quality.fewer(long[:9]).tolist() == list(range(9))


def test_token_query_equals_the_library(spark, sf):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    rows = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    ids = [reference.encode(t, add_special_tokens=False).ids + [1] for _, t in rows]
    starts = [0, *itertools.accumulate(map(len, ids))]
    expected = [(i, at, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (i, _), at, x in zip(rows, starts, ids, strict=False)]
    got = token_files.op5_token_files(spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == expected


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    reference = Tokenizer.from_file(path)
    df = docs_of(spark, ODD + [(9, "THE Same"), (9, "THE Same"), (None, "no id")])
    files, lengths = token_files.write_token_files(token_files.written(token_files.token_ids(df, path), "t"), token_files.width_of(path))
    got = token_files.read_token_files(files, lengths).orderBy("start").collect()
    expected = Counter((i, tuple(reference.encode(t or "", add_special_tokens=False).ids + [1])) for i, t in [*ODD, (9, "THE Same"), (9, "THE Same"), (None, "no id")])
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, np.uint32).tolist())) for r in got) == expected
    assert [r.start for r in got] == [0, *itertools.accumulate(r.n_tokens for r in got[:-1])]
    assert [r.doc_id for r in got] == [None, *sorted(r.doc_id for r in got[1:])]
    files, lengths = token_files.write_token_files(token_files.written(token_files.token_ids(df.limit(0), path), "t"), token_files.width_of(path))
    assert token_files.read_token_files(files, lengths).count() == 0


def test_huffman():
    rng = np.random.default_rng(3)
    for n, limit in ((1, 16), (2, 16), (300, 9), (5000, 16)):
        counts = rng.zipf(1.3, n).clip(0, 10**9).astype(np.int64)
        lengths = token_files.code_lengths(counts, limit)
        used = lengths[counts > 0].astype(float)
        assert used.max() <= max(limit, math.ceil(math.log2(n))) and abs((2.0**-used).sum() - (1 if n > 1 else 0.5)) < 1e-9
        ids = rng.choice(n, 3001, p=counts / counts.sum()).astype(np.uint32)
        payload, checkpoints = token_files.encode_bits(ids, lengths, token_files.canonical_codes(lengths))
        decoder = token_files.Decoder(lengths)
        assert (decoder.decode(payload, checkpoints, len(ids)) == ids).all()
        assert (decoder.decode(payload, checkpoints[3:4], 256) == ids[768:1024]).all()  # a block by itself


def fuzz(rng, letters, n, most):
    return ["".join(rng.choices(letters, k=rng.randint(0, most))) for _ in range(n)]


def test_word_units_equal_the_library():
    texts = fuzz(random.Random(5), "abcABÀÿßöÖ×÷'’,.-!0129²ªµ_#<|>日本 \n\té̈Σς\x1c\x00\x7f", 1500, 40) + ["<|endoftext|>", "a<|startoftext|>b 0 0 10", "it's", ""]
    texts += ["ab" * 400 + "the" * 300, "theand " * 50] + fuzz(random.Random(6), "thean dingreouéß", 1500, 60)
    raw = [t.encode() for t in texts]
    for own in (False, True):
        encoder = word_ids.UnitIds(tokenizer_path("word_bpe_49k.json"), own)
        ids, counts = encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64), 1)
        for text, part in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
            assert part.tolist() == encoder.library(text) + [1]


def test_bpe_equals_the_library():
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    reference, merges = Tokenizer.from_file(path), bpe.Merges(path)
    texts = fuzz(random.Random(7), "abc deé ß'stl\n\t\r  123,.!|日本   're\U0001f600", 1500, 60) + ["  a", " a  ", "a <|endoftext|> b", "", "a" * 3000, "ab" * 900 + "xyz" * 300, "\x1c a \x1d"]
    words = sorted({w.encode() for t in texts[:800] for w in merges.words(t) if len(w) < 200})
    image = bpe.compile_lexicon(words, merges.merge(words))
    lexicon = bpe.Lexicon(image)
    assert (lexicon.find(words) == np.arange(len(words))).all() and (lexicon.find([w + b"\xff" for w in words]) == -1).all()
    encoder, raw = bpe.Encoder(path, image), [t.encode() for t in texts]
    for some in (raw, raw[:700], raw[-1:], [b""], []):  # again, with what is known
        ids, counts = encoder.encode(np.frombuffer(b"".join(some), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in some])]).astype(np.int64))
        parts = np.split(ids, np.cumsum(counts)[:-1]) if some else []
        for text, part, shown, decoded in zip(some, parts, encoder.shown(ids, counts), encoder.decode(ids, counts), strict=True):
            assert part.tolist() == reference.encode(text.decode(), add_special_tokens=False).ids
            assert shown.decode() == ",".join(map(str, part.tolist())) and decoded == text
    broken = np.array([merges.byte_id[0xC3], merges.byte_id[0x28]])
    assert encoder.decode(broken, np.array([2]))[0].decode() == reference.decode(broken.tolist(), skip_special_tokens=False)


def test_bpe_query_equals_the_library(spark, sf):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = reference.encode(r.text or "", add_special_tokens=False).ids
        expected.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(reference.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, bpe.op6_bpe(spark, sf).collect())) == sorted(expected)


def test_bpe_counts_every_word(spark):
    texts = ["a b  c\td", "the the cat", " lead", "x\u00a0y z ", None, "", "a <|endoftext|> b"]
    df, path = spark.createDataFrame([(t,) for t in texts], "text string"), tokenizer_path("byte_bpe_50k.json")
    got = {r.word: r.n for r in df.mapInArrow(bpe._count_words(path), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()}
    assert got == Counter(w for t in texts if t for w in bpe.merges_of(path).words(t))


def test_lexicon_shares_suffixes():
    words = sorted(w.encode() for w in ("tapping", "napping", "mapping", "sapping", "zapping"))
    image = bpe.compile_lexicon(words, [np.array([i]) for i in range(5)])
    assert len(bpe.Lexicon(image).final) < 10  # one chain of states for the common ending


def test_bpe_of_odd_rows(spark):
    got = {r.doc_id: r for r in bpe.bpe_documents(docs_of(spark, ODD)).collect()}
    assert all(got[i].decoded == (t or "") and got[i].n_tokens == len(got[i].ids) for i, t in ODD)
    assert bpe.bpe_documents(docs_of(spark, ODD).limit(0)).count() == 0


def test_language_model(spark):
    got = {r.doc_id: r for r in attention_lm.op7_lm_scores(spark, "/root/testdata/sf0.001").collect()}
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    words = {i: t.encode().translate(lower).split() for i, t in rows.items()}
    train = [i for i in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for i in train for w in words[i])
    total, size = sum(counts.values()) + len(train), len(counts) + 1
    for i, ws in words.items():
        base = sum(math.log10((counts[w] + 1) / (total + size + 1)) for w in ws) + math.log10((len(train) + 1) / (total + size + 1))
        assert got[i].base_score == pytest.approx(base) and got[i].n_tokens == len(ws) + 1 and got[i].n_known == sum(w in counts for w in ws) + 1
        assert got[i].held_out == (i not in train) and got[i].train_tokens == total and got[i].score < 0


def test_tail_odds_add_up_to_one():
    rng = np.random.default_rng(3)
    share = rng.random(50)
    keys = np.unique(rng.integers(0, 20, 60) << 16 | rng.integers(1, 51, 60)).astype(np.uint32)
    tails = attention_lm.TailPairs(keys, rng.integers(1, 9, len(keys)), np.log(share / share.sum()))
    for before in (-1, 3, 7, 40):
        assert np.exp(tails(np.full(50, before), np.arange(50))).sum() == pytest.approx(1, abs=1e-5)


def test_pair_counts(spark, monkeypatch):
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 49_000, rng.integers(0, 30)).astype(np.uint16) for _ in range(200)] * 2
    expected = Counter()
    for t in texts:
        expected.update(itertools.pairwise([-1, *t.tolist(), -1]))
    monkeypatch.setattr(attention_lm, "HELD_PAIRS", 1_000)
    df = spark.createDataFrame([(bytearray(t.tobytes()),) for t in texts], "ids binary")
    got = Counter()
    for r in attention_lm.pair_counts(df).collect():
        x = np.frombuffer(bytes(r.pairs), np.uint32).astype(int)
        got.update(dict(zip(zip(((x >> 16) - 1).tolist(), ((x & 0xFFFF) - 1).tolist(), strict=True), np.frombuffer(bytes(r.n), np.int64).tolist(), strict=True)))
    # An end between two texts is one symbol: it closes one and opens the next.
    assert {k: n for k, n in got.items() if -1 not in k} == {k: n for k, n in expected.items() if -1 not in k}
    assert sum(n for k, n in got.items() if k[1] == -1) == len(texts)


def test_language_model_beats_its_base_and_ignores_partitions(spark):
    path = tokenizer_path("word_bpe_49k.json")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").where("doc_id % 2 = 0")
    rows = attention_lm.lm_scores(docs, path).collect()
    held = [r for r in rows if r.held_out]
    per = sum(r.n_tokens for r in held)
    assert sum(r.score for r in held) / per > sum(r.base_score for r in held) / per
    docs = docs.where("doc_id % 40 = 0")
    rows = attention_lm.lm_scores(docs, path).collect()
    again = {r.doc_id: r.score for r in attention_lm.lm_scores(docs.repartition(7), path).collect()}
    assert all(r.score == pytest.approx(again[r.doc_id], rel=1e-3, abs=1e-2) for r in rows)


def test_language_model_of_odd_rows(spark):
    path = tokenizer_path("word_bpe_49k.json")
    got = attention_lm.lm_scores(docs_of(spark, [*ODD, (None, "no id"), (9, "one two")]), path).collect()
    assert len(got) == 10 and all(r.score < 0 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[4].score == by[5].score == by[9].score and by[1].score == by[2].score and by[1].n_tokens == 1
    assert attention_lm.lm_scores(docs_of(spark, ODD).limit(0), path).count() == 0
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2]
    none = attention_lm.lm_scores(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string"), path).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score < 0 for r in none)


def test_windows_score_each_symbol_once():
    rng = np.random.default_rng(0)
    counts = np.array([0, 5, 31, 32, 33, 100])
    flat = rng.integers(2, 1024, counts.sum()).astype(np.int32)
    inputs, targets, text = attention_lm.windows_of(flat, counts)
    assert [int((targets[text == i] >= 0).sum()) for i in range(6)] == (counts + 1).tolist()
    model = attention_lm.Model(rng.integers(0, 9, (1024, 1024)).astype(float))
    model.train(inputs, targets, 1e-2, 5)
    a, b = model.run(inputs, targets)[0], model.score(inputs, targets)
    assert np.abs(a - b).max() < 1e-4
    # Odds over all next symbols add up to one.
    one, goal = np.repeat(inputs[-1:], 1024, axis=0), np.repeat(np.full((1, 32), -1), 1024, axis=0)
    goal[:, 0] = np.arange(1024)
    assert np.exp(model.score(one, goal)[:, 0]).sum() == pytest.approx(1, abs=1e-4)
    # No look ahead: a later input changes nothing earlier.
    changed = inputs[-1:].copy()
    changed[0, -1] = 7
    assert np.abs(model.score(inputs[-1:], targets[-1:]) - model.score(changed, targets[-1:]))[0, :31].max() < 1e-5


def test_pieces_hold_every_window(monkeypatch):
    rng = np.random.default_rng(2)
    counts = np.array([0, 5, 31, 32, 33, 400, 0, 64])
    flat = rng.integers(2, 1024, counts.sum()).astype(np.int32)
    monkeypatch.setattr(attention_lm, "PIECE", 3)
    text, nth, data = attention_lm.pieces(flat, counts)
    assert len(set(zip(text.tolist(), nth.tolist(), strict=True))) == len(data) > len(counts)
    inputs, targets, _ = attention_lm.windows_of(flat, counts)
    got = attention_lm.unpacked(data)
    assert np.array_equal(got[0], inputs) and np.array_equal(got[1], targets)


def test_each_window_is_seen_once_in_a_pass():
    rng = np.random.default_rng(4)
    inputs, targets, _ = attention_lm.windows_of(rng.integers(2, 1024, 20_000).astype(np.int32), np.full(200, 100))
    model = attention_lm.Model(np.ones((1024, 1024)))
    assert model.train(inputs, targets, 1e-3, -(-len(inputs) // attention_lm.BATCH)) == (targets >= 0).sum()


def test_language_model_trains_on_every_window(spark):
    rng = np.random.default_rng(6)
    texts = [rng.integers(0, 3_000, n).astype(np.uint16) for n in rng.integers(0, 200, 300)] + [np.arange(5_000, dtype=np.uint16)] * 100
    rows = [(i * 0x9E3779B97F4A7C15 % (1 << 63), bytearray(t.tobytes())) for i, t in enumerate(texts)]
    ids = spark.createDataFrame(rows, "deal long, ids binary").repartition(3)
    flat, counts = np.concatenate(texts), np.array([len(t) for t in texts])
    vocabulary = attention_lm.Vocabulary(np.bincount(flat, minlength=6_000))
    model = attention_lm.Model(vocabulary.place(np.zeros((1024, 1024))))
    before, windows = model.get(), int((counts // 32 + 1).sum())
    assert attention_lm.train_on_all(model, vocabulary, ids, windows) == windows
    assert np.isfinite(model.get()).all() and not np.array_equal(model.get(), before)
    # In rounds and replicas, too, each window is dealt once, and copies of a text part.
    held = spark.sparkContext.broadcast(vocabulary.placed)
    dealt = [(r, x.replica, bytes(x.data)) for r in range(attention_lm.ROUNDS) for x in attention_lm.deal(ids, held, r, 4).collect()]
    assert sum(len(attention_lm.unpacked([d])[0]) for _, _, d in dealt) == windows
    whole = attention_lm.pieces(vocabulary.placed[flat], counts)[2]
    assert Counter(d for _, _, d in dealt) == Counter(whole)
    most = max(Counter(d for _, _, d in dealt).items(), key=lambda x: x[1])[0]
    assert len({(r, replica) for r, replica, d in dealt if d == most}) > 16


def test_gradients():
    rng = np.random.default_rng(1)
    inputs, targets, _ = attention_lm.windows_of(rng.integers(2, 1024, 90).astype(np.int32), np.array([90]))
    model = attention_lm.Model(np.ones((1024, 1024)))
    model.train(inputs, targets, 1e-2, 3)
    w = model.get().astype(np.float64)
    _, g = model.run(inputs, targets, learn=True)
    loss = lambda v: (model.put(v), -model.run(inputs, targets)[0].sum() / (targets >= 0).sum())[1]
    for at in np.argsort(-np.abs(g))[[0, 5, 50, 500]]:
        step = np.zeros_like(w)
        step[at] = 3e-3
        assert (loss(w + step) - loss(w - step)) / 6e-3 == pytest.approx(g[at], rel=0.1, abs=1e-4)


def test_language_model_scores_symbol_by_symbol():
    rng = np.random.default_rng(7)
    counts = np.array([0, 3, 31, 32, 70])
    inputs, targets, _ = attention_lm.windows_of(rng.integers(2, 1024, counts.sum()).astype(np.int32), counts)
    m = attention_lm.Model(rng.integers(0, 9, (1024, 1024)).astype(float))
    m.train(inputs, targets, 1e-2, 5)
    softmax_log = lambda z, at: z[at] - np.log(np.exp(z).sum())
    for got, x, goals in zip(m.score(inputs, targets), inputs, targets, strict=True):
        for t, goal in enumerate(goals):
            if goal < 0:
                assert got[t] == 0
                continue
            p, c = 16 + t, goal // 32
            seen = [j for j in range(p + 1) if x[j] >= 0]
            w = np.array([np.exp(m.q[x[p]].astype(float) @ m.k[x[j]] / 4 + m.far[p - j]) for j in seen])
            u = w @ m.v[x[seen]] / w.sum()
            h = np.maximum((u + m.x[x[p]]) @ m.w1 + m.b1, 0)
            expected = softmax_log(h @ m.wc + m.bc[x[p]], c) + softmax_log(h @ m.wm[c] + m.bm[x[p], c], goal % 32)
            assert got[t] == pytest.approx(expected, abs=1e-4)


def test_sums_by_symbol():
    rng = np.random.default_rng(8)
    at, rows = np.append(rng.zipf(1.3, 500) % 1024, [0, 1023]).astype(np.uint16), rng.standard_normal((502, 6)).astype(np.float32)
    expected = np.zeros((1024, 6))
    np.add.at(expected, at, rows)
    assert np.allclose(attention_lm._summed_rows(at, rows), expected, atol=1e-4)


def test_sums_by_symbol_of_several_parts():
    rng = np.random.default_rng(9)
    at = (rng.zipf(1.3, 300) % 1024).astype(np.uint16)
    parts = [rng.standard_normal((300, n)).astype(np.float32) for n in (3, 5)]
    for rows, got in zip(parts, attention_lm._summed_rows(at, *parts), strict=True):
        expected = np.zeros((1024, rows.shape[1]))
        np.add.at(expected, at, rows)
        assert np.allclose(got, expected, atol=1e-4)
    assert not attention_lm._summed_rows(at[:0], parts[0][:0])[0].any()


def test_places_of_hashes():
    rng = np.random.default_rng(10)
    top = ~np.uint64(0)
    even = rng.integers(0, 1 << 64, 5_000, dtype=np.uint64)
    for keys in (even, even[:1], even[:0], np.append(even, np.array([0, top], np.uint64)), np.arange(300, dtype=np.uint64)):
        keys = np.unique(keys)
        h = np.concatenate([keys, keys + np.uint64(1), rng.integers(0, 1 << 64, 500, dtype=np.uint64), np.array([0, top], np.uint64)])
        at, there = common.Lookup(keys)(h)
        assert np.array_equal(at, np.searchsorted(keys, h)) and np.array_equal(there, np.isin(h, keys))


def test_a_round_reads_only_its_rows(spark):
    rng = np.random.default_rng(11)
    rows = [(int(x), bytearray(rng.integers(0, 3_000, 40).astype(np.uint16).tobytes())) for x in rng.integers(-(1 << 63), 1 << 63, 200)]
    plain = spark.createDataFrame(rows, "deal long, ids binary").withColumn("round", attention_lm.round_of("deal"))
    ids = common.written(plain, "ids", ("round",))
    held = spark.sparkContext.broadcast(attention_lm.Vocabulary(np.ones(6_000)).symbol)
    for r in range(attention_lm.ROUNDS):
        dealt = attention_lm.deal(ids, held, r, 4)
        filters = dealt._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
        assert "round#" in filters and f" = {r})" in filters
        assert Counter(map(tuple, dealt.collect())) == Counter(map(tuple, attention_lm.deal(plain.drop("round"), held, r, 4).collect()))


def test_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((300, 32))
    vs = [*base, *(base[:80] + 0.1 * rng.standard_normal((80, 32))), base[0], base[0], base[0] * 1e-30, base[1] * 1e30]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vs)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 32), (1003, [float("nan")] * 32), (1004, [None] * 32), (1005, [1.0] * 5), (1006, [float("inf")] * 32)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicate_vectors(df, tile=16).collect()}
    x = np.array([r[1] for r in rows[: len(vs)]], np.float32).astype(np.float64)
    x = embedding_dedup.unit(x)
    near = (x @ x.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    found = np.array([got[i].n_links for i in range(len(vs))])
    assert (found <= near.sum(axis=1)).all() and found.sum() >= 0.99 * near.sum()
    assert got[380].component_id == 0 and not got[380].kept
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(1000, 1007))
    assert embedding_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


def test_vectors_without_ids_and_in_double_precision(spark):
    rng = np.random.default_rng(6)
    a = rng.standard_normal(16)
    far = np.append(np.zeros(15), 1e200) + np.append(1e199, np.zeros(15))  # beyond the range of float
    rows = [(1, a.tolist()), (2, (a * (1 + 1e-12)).tolist()), (None, a.tolist()), (None, None), (3, far.tolist()), (4, (far * 1e-300).tolist())]
    got = Counter(map(tuple, embedding_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    assert got == Counter([(1, 1, 1, True), (2, 1, 1, False), (None, 0, None, True), (None, 0, None, True), (3, 1, 3, True), (4, 1, 3, False)])


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    d = 64
    a = embedding_dedup.unit(rng.standard_normal((4000, d)))
    b = embedding_dedup.unit(a + rng.standard_normal((4000, d)) * 0.1)
    turn = embedding_dedup.rotation(d, 0)
    ra, rb = a @ turn, b @ turn
    f = np.abs(ra).sum(axis=1) / math.sqrt(d)
    guess = (np.sign(ra) * rb).sum(axis=1) / math.sqrt(d) / f
    true = (a * b).sum(axis=1)
    slack = embedding_dedup.EPS * np.sqrt((1 - f**2) / f**2 / (d - 1))
    assert abs((guess - true).mean()) < 0.01 and (np.abs(guess - true) <= slack).mean() > 0.999


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1050)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(x, x) == find(x) for e in edges for x in e)


def test_audio(spark):
    df = docs_of(spark, [*ODD, (9, "one two")])
    media = audio_features.store_media(df)
    for r in media.collect():
        text = next(t for i, t in [*ODD, (9, "one two")] if i == r.doc_id) or ""
        rate, samples = audio_features.from_wav(bytes(r.media))
        assert rate == 16_000 and samples == audio_features.payload_of(text.encode()) and len(samples) % 576 == 0 and r.n_bytes == len(text.encode())
    rows = media.mapInArrow(audio_features._digest, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames long, n_segments long, active_s double").collect()
    by = {r.doc_id: r for r in rows}
    assert by[4].feature == by[5].feature == by[9].feature and by[1].feature == by[2].feature != by[8].feature
    assert by[1].payload_sha256 == hashlib.sha256(b"\xff" * 576).hexdigest()
    table = audio_features.as_tensors(audio_features.audio_tensors(media).toArrow())
    assert table.column("log_mel").type.shape == [16, 32]
    assert all(a < b for a, b in zip(table.column("start_s").to_pylist(), table.column("end_s").to_pylist(), strict=True))


def test_audio_query_stores_tensors(spark, sf, monkeypatch):
    names, keep = [], audio_features.written
    monkeypatch.setattr(audio_features, "written", lambda df, name: (names.append(name), keep(df, name))[1])
    got = audio_features.op9_audio_features(spark, sf)
    assert names == ["media", "tensors"]
    media = audio_features.store_media(audio_features.documents(spark, sf))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, media.mapInArrow(audio_features._digest, got.schema).collect()))
    text = "one two three " * 5000
    kept = audio_features.stored_tensors(audio_features.store_media(docs_of(spark, [(1, text)]))).first()
    assert all(len(x.log_mel) == 16 * 32 and x.start_s < x.end_s for x in kept.tensors) and len(kept.tensors) == -(-len(kept.energy) // 16) > 20


def test_log_mel_is_kept_in_steps(monkeypatch):
    samples = bytes(random.Random(3).randbytes(20_000))
    bands, energy = audio_features.log_mel(samples)
    monkeypatch.setattr(audio_features, "STEPS", 1 << 20)
    fine, same = audio_features.log_mel(samples)
    assert bands.dtype == np.float32 and (energy == same).all() and ((bands * 256) % 1 == 0).all()
    assert 0 < np.abs(bands - fine).max() <= 1 / 512 + 1e-6


def plain_feature(samples):
    """The feature by the plain formulas: each output of the filter, each bin of the transform and each frame's state by itself."""
    up, down, taps, frame, hop, fft, mels = 3, 4, 16, 432, 144, 512, 32
    n = up * taps
    h = [np.sinc((i - (n - 1) / 2) / down) * np.kaiser(n, 8.0)[i] for i in range(n)]
    h = [v * up / sum(h) for v in h]
    x = [(b - 128) / 128 for b in samples]
    y = [sum(h[j * up + m * down % up] * x[m * down // up - j] for j in range(taps) if m * down // up >= j) for m in range(len(x) * up // down)]
    mel = lambda f: 2595 * math.log10(1 + f / 700)
    edges = [700 * (10 ** (mel(6000) * i / (mels + 1) / 2595) - 1) for i in range(mels + 2)]
    turn = np.exp(-2j * np.pi * np.outer(np.arange(fft // 2 + 1), np.arange(frame)) / fft)
    bands, energy = [], []
    for at in range(0, len(y) - frame + 1, hop):
        f = np.array(y[at : at + frame])
        energy.append(10 * math.log10((f * f).sum() / frame + 1e-8))
        power = np.abs(turn @ (f * np.hanning(frame))) ** 2
        bands.append([math.log10(sum(p * max(0, min((k * 12000 / fft - edges[b]) / (edges[b + 1] - edges[b]), (edges[b + 2] - k * 12000 / fft) / (edges[b + 2] - edges[b + 1]))) for k, p in enumerate(power)) + 1e-8) for b in range(mels)])
    middle, on, runs, active = np.median(energy), False, 0, 0
    for e in energy:
        was, on = on, e >= middle + 3 or (on and e >= middle + 1)
        runs, active = runs + (on and not was), active + on
    return [*np.mean(bands, axis=0), np.mean(energy), runs, round(active * hop / 12000, 3)]


def test_audio_query_against_plain_python(spark, tmp_path):
    rng = random.Random(7)
    texts = [None, "", "x", "é" * 288, "quiet " * 150, "".join(chr(rng.randint(33, 126)) for _ in range(1500)), ("a" * 700 + "~!" * 300) * 2]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "x"), (2, "x")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = audio_features.op9_audio_features(spark, str(tmp_path)).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        raw = ("x" if r.doc_id is None else texts[r.doc_id] or "").encode()
        payload = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        size = len(payload)
        head = b"RIFF" + (36 + size).to_bytes(4, "little") + b"WAVEfmt " + bytes([16, 0, 0, 0, 1, 0, 1, 0]) + (16_000).to_bytes(4, "little") * 2 + bytes([1, 0, 8, 0]) + b"data" + size.to_bytes(4, "little")
        assert (r.n_bytes, r.payload_bytes, r.tail_crc32, r.media_bytes) == (len(raw), size, zlib.crc32(payload[-32:]), size + 44)
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.media_sha256 == hashlib.sha256(head + payload).hexdigest()
        assert [float(v) for v in r.feature.split()] == pytest.approx(plain_feature(payload), abs=0.02)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert audio_features.op9_audio_features(spark, f"{tmp_path}/none").count() == 0


def test_resampling_keeps_tones_and_drops_aliases():
    t = np.arange(16_000) / 16_000
    low = audio_features.resample(np.sin(2 * np.pi * 1000 * t).astype(np.float32))[200:-200]
    high = audio_features.resample(np.sin(2 * np.pi * 7500 * t).astype(np.float32))[200:-200]
    assert len(low) + 400 == 12_000 and abs(np.abs(low).max() - 1) < 0.05 and np.abs(high).max() < 0.05


def test_hysteresis():
    energy = np.array([0, 0, 0, 4, 2, 2, 0, 2, 0, 0, 5, 0], float)
    assert audio_features.segments(energy).tolist() == [[3, 6], [10, 11]]


def test_weighted_sampling_agrees_with_weighted_jaccard():
    rng = np.random.default_rng(8)
    values = np.sort(rng.integers(0, 1 << 63, 400).astype(np.uint64))
    wa, wb = rng.uniform(0.5, 4, 400), rng.uniform(0.5, 4, 400)
    true = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    a = minhash_dedup.icws(values, wa, np.array([0]), 3000)
    b = minhash_dedup.icws(values, wb, np.array([0]), 3000)
    assert abs((a == b).mean() - true) < 0.03
    assert minhash_dedup.weighted_jaccard((values, wa), (values, wb)) == pytest.approx(true)


def test_near_duplicates(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    base = [[word() for _ in range(200)] for _ in range(40)]
    rows, n = [], 0
    for i, b in enumerate(base):
        for k in range(4 if i % 2 else 1):
            copy = list(b)
            for _ in range(k):
                copy[rng.randrange(200)] = word()
            rows.append((n, " ".join(copy), i))
            n += 1
    rows += [(900, None, 100), (901, None, 101), (902, "", 102), (903, "", 102), (904, "one two", 103), (905, " one  two ", 103), (906, "one", 104)]
    df = spark.createDataFrame(rows, "doc_id long, text string, truth int")
    sets = minhash_dedup.weighted_sets([t or "" for _, t, _ in rows], idf_of(df))
    root = {i: i for i, _, _ in rows}

    def find(x):
        return x if root[x] == x else find(root[x])

    for (i, a, x), (j, b, y) in itertools.combinations([(r[0], r[1], s) for r, s in zip(rows, sets, strict=True)], 2):
        if a is not None and (a == b or minhash_dedup.weighted_jaccard(x, y) >= 0.8):
            i, j = find(i), find(j)
            root[max(i, j)] = min(i, j)
    got = {r.doc_id: r for r in minhash_dedup.near_duplicates(df).collect()}
    for i, _, _ in rows:
        assert got[i].class_id == find(i) and got[i].kept == (i == find(i)), i
    assert len({find(i) for i, _, t in rows if t < 40}) < 60  # there are classes
    kept = minhash_dedup.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted({find(i) for i in root})
    assert minhash_dedup.near_duplicates(df.limit(0)).count() == 0


def drifting(seed, chains, steps):
    """doc_id, text: chains of texts of 200 words, each with one or two words other than the one before."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    rows = []
    for _ in range(chains):
        text = [word() for _ in range(200)]
        for _ in range(steps):
            rows.append((len(rows), " ".join(text)))
            for at in rng.sample(range(200), rng.choice((1, 2))):
                text[at] = word()
    return rows


def idf_of(df):
    return minhash_dedup.corpus_idf(minhash_dedup.distinct_texts(df), df.count())


def least_of_classes(rows, sets, threshold=0.8):
    """The least doc_id of each row's class, by comparing all pairs."""
    root = list(range(len(rows)))

    def find(x):
        return x if root[x] == x else find(root[x])

    for i, j in itertools.combinations(range(len(rows)), 2):
        if minhash_dedup.weighted_jaccard(sets[i], sets[j]) >= threshold:
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    return {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}


def test_classes_of_drifting_copies(spark, monkeypatch):
    rows = drifting(4, 3, 40)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    least = least_of_classes(rows, minhash_dedup.weighted_sets([t for _, t in rows], idf_of(df)))
    for tile in (512, 4):  # whatever the size of a tile
        monkeypatch.setattr(minhash_dedup, "TILE", tile)
        assert {r.doc_id: r.class_id for r in minhash_dedup.near_duplicates(df, bands=24).collect()} == least


def partners(n):
    """n pairs of texts: about 0.93 within a pair, 0.65 to 0.79 beyond."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    common, rows = [word() for _ in range(800)], []
    for _ in range(n):
        own = [word() for _ in range(17)]
        for _ in range(2):
            text = common + own
            text[rng.randrange(800)] = word()
            rows.append((len(rows), " ".join(text)))
    return rows


def test_partners_within_a_large_group_below_the_threshold(spark, monkeypatch):
    rows = partners(200)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = minhash_dedup.weighted_sets([t for _, t in rows], idf_of(df))
    likeness = [[minhash_dedup.weighted_jaccard(x, y) for y in sets[i + 1 : i + 40]] for i, x in enumerate(sets[:60])]
    assert all(x[0] > 0.8 for x in likeness[::2]) and max(max(x[1:]) for x in likeness[::2]) < 0.8 and min(min(x) for x in likeness) > 0.6
    for tile in (512, 64):
        made = []
        keep = minhash_dedup.written
        monkeypatch.setattr(minhash_dedup, "TILE", tile)
        monkeypatch.setattr(minhash_dedup, "written", lambda d, name, made=made, keep=keep: (made.append((name, out := keep(d, name))), out)[1])
        got = {r.doc_id: r.class_id for r in minhash_dedup.near_duplicates(df).collect()}
        assert got == {i: i - i % 2 for i in range(len(rows))}
        assert sum(out.count() for name, out in made if name == "edges") <= 12 * 2 * len(rows)  # edges of forests, never pairs
        monkeypatch.undo()


def test_shared_weights_equal_pair_by_pair():
    rng = np.random.default_rng(4)
    n, idf = 30, minhash_dedup.Idf(30, 1, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(n)]
    counts = [rng.integers(1, 5, len(s)) for s in sets]
    both = minhash_dedup.shared_weights(np.repeat(np.arange(n), [len(s) for s in sets]), np.concatenate(sets), np.concatenate(counts), idf, n)
    for i, j in itertools.combinations(range(n), 2):
        a, b = (dict(zip(sets[k].tolist(), (counts[k] * idf(sets[k])).tolist(), strict=True)) for k in (i, j))
        assert both[i, j] == pytest.approx(sum(min(w, b[v]) for v, w in a.items() if v in b), rel=1e-5)


def test_near_duplicates_of_odd_rows(spark):
    rows = [*ODD, (None, "one two"), (None, "x" * 5000), (8, "x" * 5000), (None, None), (None, "alone here")]
    got = Counter((r.doc_id, r.class_id, r.kept) for r in minhash_dedup.near_duplicates(docs_of(spark, rows)).collect())
    assert got == Counter([(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (6, 6, True), (7, 7, True), (8, 8, True), (8, 8, True), (None, 4, False), (None, 8, False), (None, None, True), (None, None, True)])
    df = docs_of(spark, rows)
    kept = minhash_dedup.keep_one(df)
    assert kept.columns == df.columns and Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, 4, 6, 7, 8, None, None])


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.written(stage(spark, docs, sf), "stage")
        assert i == 4 or docs.columns == columns
    assert docs.count() > 0
    texts = Counter((r.doc_id, r.decoded) for r in docs.collect())
    assert Counter((r.doc_id, r.decoded) for r in corpus_pipeline.run(spark, sf).collect()) == texts

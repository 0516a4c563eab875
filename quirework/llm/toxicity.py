"""Toxicity by a weighted lexicon.

Texts are folded: letters that look like Latin ones, accented, full-width and styled letters become plain small letters, and digits and signs next to
letters become the letters they stand for. Characters that hide within words (joiners, combining marks) go first. An Aho-Corasick automaton finds
words and word beginnings of the lexicon, which count only where a word begins and, for words, ends; trailing digits and signs count as either letters or ends. A word counts once, by its heaviest
term, and not at all within an exception phrase. The sum of weights and the sum by length give the score, by a logistic curve.

The lexicon starts from a short fixed list and fixed exceptions, and learns from labels, where there are some: a bounded sample of at most about `labelled` rows of
the table of labels, drawn by hash. Terms that occur in a share of the toxic texts and hardly in others get their log odds as weights; texts count once however often they
are repeated, and as often only as their contexts differ, so that copies of one toxic text do not make its words toxic; a beginning must not owe more than half of them to one word. Two-word phrases around a term
that occur in clean texts only become exceptions, and no longer count against their words. The curve is fitted to counts of (sum, sum by length) over the sample. Scores use whole texts and nothing else.

Null and empty texts have no matches and get the score of such texts. Repeated rows get equal scores. Labels that are null, rows without a doc_id, and
labels of documents that do not exist teach nothing; if a document has several labels, the highest counts. Without labels the fixed list and curve are used. Other columns play no part.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, written
from .quality import ABUSE, SEED

LABELLED = 20_000
TOXIC_AT = 0.7
#: A learned term occurs in this share of the toxic texts, at least FEWEST, and ODDS times as often as in clean texts, by more than the standard error.
SHARE, FEWEST, ODDS = 0.005, 5, 16
#: Terms kept, by weight; phrases need FEWEST clean texts.
TERMS = 4_096
#: Lengths of word beginnings that can be terms.
BEGINNINGS = (4, 5, 6)
WEIGHT = 4.0
#: Words to which a text's length is raised.
SHORT = 10

#: Letters that look like Latin ones.
LOOKALIKES = {
    "a": "аαɑ", "b": "вьβ", "c": "сϲ", "d": "ԁɗ", "e": "еєεҽ", "f": "ғ", "g": "ɡց", "h": "һн", "i": "іιıɩ", "j": "јϳ", "k": "кκ", "l": "ӏⅼ",
    "m": "мⅿ", "n": "пηո", "o": "оοσօ", "p": "рρ", "q": "ԛ", "r": "гɾ", "s": "ѕʂ", "t": "тτ", "u": "υսц", "v": "νѵ", "w": "ѡωԝ", "x": "хχ", "y": "уγү", "z": "ʐᴢ",
}
#: Digits and signs that stand for letters. i and l, which share signs, are one letter here.
STANDS_FOR = {"0": "o", "1": "i", "2": "z", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i"}
#: Phrases in which words of the fixed list are meant otherwise.
EXCEPTIONS = ("trash can", "trash bag", "trash bin", "clown fish", "stupid mistake", "pathetic fallacy", "sore loser", "pond scum")

_HIDDEN = re.compile("[­̀-ͯ​-‏⁠-⁤﻿]")
_SIGNS = re.compile(r"[0-9@$!|]+")
_PLAIN = re.compile("[a-z0-9@$!|]*")


@lru_cache(1)
def _letters() -> dict[int, str]:
    """Each letter's plain one: the first letter of its compatibility form, looked up among lookalikes, with l as i."""
    like = {c: plain for plain, many in LOOKALIKES.items() for c in many}
    out = {}
    for code in range(sys.maxunicode + 1):
        c = chr(code)
        if not (c.isalpha() or c in "ⅼⅿ") or 0x3400 <= code < 0xFB00 and code < 0xA000 or 0xAC00 <= code < 0xD7B0:
            continue
        small = c.lower()
        base = like.get(small) or like.get(unicodedata.normalize("NFKD", small)[0]) or unicodedata.normalize("NFKD", small)[0].lower()
        plain = like.get(base, base)
        plain = "i" if plain == "l" else plain
        if plain != c:
            out[code] = plain
    return out


_SIGN_LETTERS = {ord(k): v for k, v in STANDS_FOR.items()}


def folded(text: str | None) -> tuple[str, str]:
    """The text with small plain letters, and the same with digits and signs next to letters replaced; of one length."""
    plain = _HIDDEN.sub("", text or "").translate(_letters())
    cut = len(plain)

    def letters(m: re.Match) -> str:
        a, b = m.span()
        return m[0].translate(_SIGN_LETTERS) if a and plain[a - 1].isalpha() or b < cut and plain[b].isalpha() else m[0]

    return plain, _SIGNS.sub(letters, plain)


def fold_term(term: str) -> str:
    return folded(term)[1]


def words(plain: str) -> list[tuple[str, int, int]]:
    return [(m[0], *m.span()) for m in _WORD.finditer(plain)]


_WORD = re.compile(r"[^\W\d_]+")
_SPACE = re.compile(r"\S+")


class Lexicon:
    """terms: word (or beginning with *) and weight; exceptions: phrases of whole words. All are folded."""

    def __init__(self, terms: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS, curve: tuple[float, float, float] = (-4.0, 3.0, 0.5)):
        self.terms, self.exceptions, self.curve = terms, tuple(sorted(exceptions)), curve
        self.automaton = None

    def __getstate__(self):
        return self.terms, self.exceptions, self.curve

    def __setstate__(self, state):
        self.__init__(*state)

    def _built(self) -> ahocorasick.Automaton:
        if self.automaton is None:
            entries: dict[str, list] = {}
            for term, weight in self.terms.items():
                key = fold_term(term.rstrip("*"))
                if key:
                    entries.setdefault(key, []).append((len(key), weight, not term.endswith("*"), False))
            for phrase in self.exceptions:
                key = " ".join(fold_term(phrase).split())
                if key:
                    entries.setdefault(key, []).append((len(key), 0.0, True, True))
            self.automaton = ahocorasick.Automaton()
            for key, values in entries.items():
                self.automaton.add_word(key, values)
            if entries:
                self.automaton.make_automaton()
        return self.automaton

    def hits(self, text: str | None) -> tuple[list[tuple[int, int, float]], str]:
        """Start, end and weight of each word that counts, in order, and the folded text, in which white space is single."""
        plain, low = folded(" ".join((text or "").split()))
        automaton, n, best, spared = self._built(), len(low), {}, []
        if not len(automaton):
            return [], low
        for last, values in automaton.iter(low):
            for size, weight, whole, exception in values:
                a, b = last + 1 - size, last + 1
                if a and plain[a - 1].isalpha() or whole and b < n and plain[b].isalpha():
                    continue  # within a word
                if a and low[a - 1].isalpha() and a < n and not plain[a].isalpha() or not any(map(str.isalpha, plain[a:b])):
                    continue  # begins amid digits and signs, or has no letter of its own
                if exception:
                    spared.append((a, b))
                elif a not in best or weight > best[a][2]:
                    best[a] = (a, b, weight)
        if spared:
            best = {a: h for a, h in best.items() if not any(c <= a and h[1] <= d for c, d in spared)}
        return [best[a] for a in sorted(best)], low

    def sums(self, text: str | None) -> tuple[float, float]:
        """Sum of weights, and the same for a hundred words."""
        found, low = self.hits(text)
        if not found:
            return 0.0, 0.0
        total = sum(w for _, _, w in found)
        return total, 100 * total / max(SHORT, low.count(" ") + 1)

    def score(self, text: str | None) -> float:
        return float(_curve(self.curve, *features(*self.sums(text))))


def features(total, by_length):
    return np.log1p(total), np.log1p(by_length)


def _curve(c: tuple[float, float, float], x, y):
    return 1 / (1 + np.exp(-np.clip(c[0] + c[1] * x + c[2] * y, -30, 30)))


def fit_curve(x: np.ndarray, y: np.ndarray, toxic: np.ndarray, clean: np.ndarray, rounds: int = 100, decay: float = 0.1) -> tuple[float, float, float]:
    """Logistic regression on counts, by Newton's method with halved steps. A slope below 0 is taken out, so that more matches never lower a score."""
    if not (toxic[x > 0].sum() and clean.sum()):
        return (-4.0, 3.0, 0.5)
    n, used = toxic + clean, [0, 1, 2]
    while True:
        design, ridge = np.stack([np.ones_like(x), x, y], axis=1)[:, used], decay * np.array([0, 1, 1])[used]
        loss = lambda c: float((np.logaddexp(0, design @ c) * n - design @ c * toxic).sum() + (ridge * c * c).sum() / 2)  # noqa: B023, E731
        c = np.zeros(len(used))
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(design @ c, -30, 30)))
            step = np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + np.diag(ridge + 1e-6), design.T @ (toxic - n * p) - ridge * c)
            size = 1.0
            while size > 1e-6 and loss(c + size * step) > loss(c):
                size /= 2
            c = c + size * step
        if len(used) == 1 or (c[1:] >= 0).all():
            return tuple(float(c[used.index(i)]) if i in used else 0.0 for i in range(3))
        used = [u for u, v in zip(used, c, strict=True) if u == 0 or v >= 0]


def _terms_of(text: str | None) -> set[str]:
    out = set()
    for w, *_ in words(fold_term(text or "")):
        if len(w) > 2:
            out.add(w)
        for k in BEGINNINGS:
            if len(w) > k:
                out.add(w[:k] + "*")
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str | None, bool]]:
    for batch in batches:
        yield from zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True)


def _counted(of, key: str):
    """A mapInArrow function that counts of(text) by label, once a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()
        for text, label in _rows(batches):
            (toxic if label else clean).update(set(of(text)))
            if len(toxic) + len(clean) > 500_000:
                yield _counts(toxic, clean, key)
                toxic, clean = Counter(), Counter()
        yield _counts(toxic, clean, key)

    return run


def _counts(toxic: Counter, clean: Counter, key: str) -> pa.RecordBatch:
    keys = list(toxic | clean)
    return pa.record_batch([pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()), pa.array([clean[k] for k in keys], pa.int64())], names=[key, "toxic", "clean"])


def _summed(texts: DataFrame, of, key: str) -> DataFrame:
    return texts.mapInArrow(_counted(of, key), f"{key} string, toxic long, clean long").groupBy(key).agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def training_texts(docs: DataFrame, labels: DataFrame, learn: Column, labelled: int = LABELLED) -> DataFrame:
    """Distinct texts and labels of at most about `labelled` rows of labels whose doc_id passes `learn`."""
    n = labels.where(learn).count()
    part = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, labelled / max(n, 1)))
    some = labels.where(learn & part & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    pairs = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(some), "doc_id")  # some: about `labelled` rows of 9 bytes
    return written(pairs.groupBy("text").agg(F.max("toxic").alias("toxic")), "toxicity-texts")


def learned(texts: DataFrame, keep: int = TERMS) -> Lexicon:
    """A lexicon and its curve from texts (text, toxic)."""
    t, c = texts.agg(F.count_if("toxic"), F.count_if(~F.col("toxic"))).first()
    least = max(FEWEST, int(SHARE * t))
    frequent = _summed(texts.where("toxic"), _terms_of, "term").where(F.col("toxic") >= least)
    known = {r.term for r in frequent.select("term").collect()}  # terms in SHARE of the texts: the terms of 1 / SHARE texts at most
    rate = lambda a, n: (a + 0.5) / (n + 1)
    counts = {r.term: (r.toxic, r.clean) for r in _summed(texts, lambda x: _terms_of(x) & known, "term").collect()} if known else {}
    weigh = lambda term: float(np.log(rate(counts[term][0], t) / rate(counts[term][1], c)))
    base = {w: WEIGHT for w in map(fold_term, ABUSE)}
    base |= {w: max(0.5, weigh(w)) for w in base if w in counts and sum(counts[w]) >= least}
    unsure = lambda term: float(np.sqrt(sum(1 / (v + 0.5) for v in counts[term])))
    odd = {w: weigh(w) for w in counts if weigh(w) - unsure(w) >= np.log(ODDS) and w not in base}
    first = Lexicon(base | dict(sorted(odd.items(), key=lambda x: (-x[1], x[0]))[:keep]), ())

    def around(text: str | None) -> Iterator[str]:
        """The contexts of all hits: term, the word before, the word after."""
        found, low = first.hits(text)
        for a, b, _ in found:
            before = low[:a].rsplit(None, 1)[-1] if low[:a].strip() else ""
            end = _WORD.match(low, a)
            after = _WORD.search(low, end.end() if end else b)
            word = low[a : end.end() if end else b]
            yield f"{word}\t{before}\t{after[0] if after else ''}"

    rows = _summed(texts, around, "context")
    words_of = rows.select(F.split("context", "\t").alias("c"), "toxic", "clean").select(F.element_at("c", 1).alias("word"), F.element_at("c", 2).alias("before"), F.element_at("c", 3).alias("after"), "toxic", "clean")
    spread, most = {}, {}
    for r in words_of.where("toxic > 0").groupBy("word").agg(F.countDistinct("before").alias("n"), F.countDistinct("after").alias("m")).collect():  # at most the lexicon's words in the sample
        for term in (r.word, *(r.word[:k] + "*" for k in BEGINNINGS if len(r.word) > k)):
            spread[term], most[term] = spread.get(term, 0) + max(r.n, r.m), max(most.get(term, 0), r.n, r.m)
    counts |= {w: (min(counts[w][0], spread.get(w, 0)), counts[w][1]) for w in odd}
    sound = lambda w: counts[w][0] >= least and weigh(w) - unsure(w) >= np.log(ODDS) and (w[-1] != "*" or 2 * most[w] <= spread[w])
    terms = {w: v if w in base else weigh(w) for w, v in first.terms.items() if w in base or sound(w)}
    pairs = words_of.select("toxic", "clean", F.explode(F.array(F.concat_ws(" ", "before", "word"), F.concat_ws(" ", "word", "after"))).alias("phrase")).where(F.col("phrase").rlike("^\\S+ \\S+$"))
    phrases = pairs.groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(f"clean >= {FEWEST} and toxic * 10 < clean")
    spared = {r.phrase: r.clean for r in phrases.orderBy(F.col("clean").desc(), "phrase").limit(keep).collect()}
    for phrase, n in spared.items():
        for w in set(phrase.split()) & set(terms) & set(counts):
            counts[w] = (counts[w][0], max(0, counts[w][1] - n))
            terms[w] = max(terms[w], weigh(w))
    model = Lexicon(terms, (*map(fold_term, EXCEPTIONS), *spared))

    def cell(text: str | None) -> Iterator[str]:
        x, y = features(*model.sums(text))
        yield f"{round(10 * x)} {round(10 * y)}"

    cells = _summed(texts, cell, "cell").collect()  # tenths of logarithms: some thousands at most
    at = np.array([[int(v) / 10 for v in r.cell.split()] for r in cells]).reshape(-1, 2)
    model.curve = fit_curve(at[:, 0], at[:, 1], *(np.array([getattr(r, k) for r in cells], float) for k in ("toxic", "clean")))
    return model


def fit(docs: DataFrame, labels: DataFrame | None, learn: Column | None = None, labelled: int = LABELLED) -> Lexicon:
    """learn: which doc_ids may teach."""
    if labels is not None:
        texts = training_texts(docs, labels, F.lit(True) if learn is None else learn, labelled)
        if texts.where("toxic").limit(1).count():
            return learned(texts)
    return Lexicon({w: WEIGHT for w in map(fold_term, ABUSE)}, tuple(map(fold_term, EXCEPTIONS)))


def scored(docs: DataFrame, model: Lexicon) -> DataFrame:
    """doc_id, score, matches (words that count)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [held.value.sums(t) for t in batch.column("text").to_pylist()]
            x, y = features(*np.array(found).reshape(-1, 2).T)
            yield pa.record_batch([batch.column("doc_id"), _curve(held.value.curve, x, y), pa.array([f[0] for f in found])], names=["doc_id", "score", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, weight double")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A doc_id that is null has no remainder: its row is not held out and teaches nothing."""
    docs = documents(spark, sf_dir)
    remainder = F.crc32(F.col("doc_id").cast("string")) % 3
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"), remainder != 1)
    out = scored(docs, model)
    return out.select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"), "weight")

"""A quality classifier from weak labels.

Overlapping heuristic labellers vote on each document (good, bad or no opinion) about two questions: is it junk, and is it abusive?
Expectation-maximisation over the counts of vote patterns of all documents estimates how often each labeller
gives each vote on good and on bad documents (its accuracy), and so each pattern's posterior. Posteriors of a bounded sample
train linear scorers over hashed features (words, word beginnings, levels of the text's statistics), one for each question. A document is kept if
neither scorer, with the posterior as prior evidence, finds it bad.

Terms of abuse are a short fixed list and terms learned from at most LABELLED rows of a table of labels, where there is one: words and
word beginnings that occur in several documents marked toxic and hardly elsewhere. The sample that trains the scorers has at most about SAMPLE
distinct texts, drawn by a hash of the text, so neither copies nor rows with null or equal ids weigh more or gather; of a text with more than FEATURES features, those with the least
hash train (they come from all of it). A null text counts as empty. Votes, their counts, posteriors and scores cover all documents and whole texts.

Null and empty texts, and texts of fewer than MIN_WORDS words, get no votes but those on abuse, and are kept on the first question. Repeated rows get equal scores. No step needs more than a slice of a partition in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, mix, text_slices, word_hashes, word_spans

GOOD, NONE, BAD = 0, 1, 2
MIN_WORDS = 20
BUCKETS = 1 << 18
SAMPLE = 6_000
FEATURES = 8_192  # of a text, in training only
LABELLED = 20_000
TERMS = 4_096
SEED = 23

#: Statistic, share from which it speaks for junk, share up to which it speaks against. Listed so that more is worse.
JUNK = (
    ("repeats", 0.10, 0.04),  # words equal to the one before
    ("few_distinct", 0.68, 0.50),  # 1 - distinct words / words
    ("top_word", 0.20, 0.12),  # share of the most frequent word
    ("shouting", 0.40, 0.10),  # capitals among ASCII letters
    ("symbol_ends", 0.10, 0.02),  # words that end in two symbols or more
    ("lone_symbols", 0.06, 0.02),  # words of one symbol
    ("symbols", 0.08, 0.05),  # symbols among characters
    ("same_lines", 0.60, 0.30),  # lines that repeat another
)
#: Words of abuse.
ABUSE = ("idiot", "moron", "loser", "scum", "stupid", "trash", "worthless", "pathetic", "disgusting", "clown")
N_ABUSE = 4

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[[*range(65, 91), *range(97, 123)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_LINE = np.ones(256, bool)
_LINE[10] = False


def _sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[off])


def _distinct(row: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, value), and for each row their number and the greatest count."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    cut = np.flatnonzero(new)
    count = np.diff(np.append(cut, len(row)))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, row[cut], count)
    return row[cut], value[cut], np.bincount(row[cut], minlength=n), most


def spans(data: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As word_spans, for other characters."""
    return word_spans(np.where(inside[data], np.uint8(65), np.uint8(32)), off)


def statistics(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of each row, and its share by each line of JUNK."""
    n = len(off) - 1
    starts, ends, counts = word_spans(data, off)
    row = np.repeat(np.arange(n), counts)
    h = word_hashes(data, starts, ends)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    _, _, distinct, most = _distinct(row, h, n)
    last = _SYMBOL[data[ends - 1]] if len(ends) else again
    size = ends - starts
    two = last & (size > 2) & _SYMBOL[data[np.maximum(ends - 2, 0)]] if len(ends) else again
    total, chars = np.maximum(counts, 1), np.maximum(np.diff(off), 1)
    a, b, n_lines = spans(data, off, _LINE)
    filled = np.repeat(np.arange(n), n_lines)
    _, _, distinct_lines, _ = _distinct(filled, word_hashes(data, a, b), n)
    of_words = lambda x: np.bincount(row, weights=x, minlength=n) / total
    shares = [of_words(again), 1 - distinct / total, most / total, _sums(_UPPER[data], off) / np.maximum(_sums(_ALPHA[data], off), 1), of_words(two), of_words(last & (size == 1)), _sums(_SYMBOL[data], off) / chars, 1 - distinct_lines / np.maximum(n_lines, 1)]
    return counts, np.stack(shares, axis=1)


def lowered(data: np.ndarray) -> np.ndarray:
    return np.where(_UPPER[data], data + np.uint8(32), data)


def terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of lower-case words (runs of letters and digits) and of their first 4, 5 and 6 bytes; not distinct."""
    low = lowered(data)
    starts, ends, counts = spans(data, off, _LETTER)
    row = np.repeat(np.arange(len(counts)), counts)
    rows, values = [row], [word_hashes(low, starts, ends)]
    for k in (4, 5, 6):
        long = ends - starts > k
        rows.append(row[long])
        values.append(word_hashes(low, starts[long], starts[long] + k) + np.uint64(k))
    return np.concatenate(rows), np.concatenate(values)


def hashes_of(words: tuple[str, ...]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw])
    return word_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(w) for w in raw], ends)


def _in(value: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(value), bool)
    at = np.minimum(np.searchsorted(known, value), len(known) - 1)
    return known[at] == value


def votes_of(data: np.ndarray, off: np.ndarray, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Votes on junk and on abuse, and the hashed features as (row, bucket)."""
    counts, shares = statistics(data, off)
    high, low = np.array([j[1] for j in JUNK]), np.array([j[2] for j in JUNK])
    junk = np.where(shares >= high, BAD, np.where(shares <= low, GOOD, NONE)).astype(np.int8)
    junk[counts < MIN_WORDS] = NONE
    row, value, _, _ = _distinct(*terms(data, off), len(counts))
    per_row = lambda hit: np.bincount(row[hit], minlength=len(counts))
    fixed, learned = per_row(_in(value, np.sort(hashes_of(ABUSE)))), per_row(_in(value, lexicon))
    abuse = np.stack([np.where(fixed > 0, BAD, GOOD), np.where(fixed > 1, BAD, NONE), np.where(learned > 0, BAD, GOOD if len(lexicon) else NONE), np.where(learned > 1, BAD, NONE)], axis=1).astype(np.int8)
    level = np.round(2 * np.log2(shares + 2.0**-8)).astype(np.int64) + 64
    seen = np.repeat(np.arange(len(counts)), len(JUNK))
    levels = mix((np.arange(len(JUNK)) * 1024 + level).astype(np.uint64).ravel() + np.uint64(1 << 40))
    keep = np.repeat(counts >= MIN_WORDS, len(JUNK))
    rows = np.concatenate([row, seen[keep]])
    bucket = (mix(np.concatenate([value, levels[keep]])) % np.uint64(BUCKETS)).astype(np.int64)
    return junk, abuse, rows, bucket


def pattern_number(votes: np.ndarray) -> np.ndarray:
    return votes.astype(np.int64) @ (3 ** np.arange(votes.shape[1]))


class LabelModel:
    """Two classes, labellers independent given the class: a prior, and for each labeller the odds of each vote in each class."""

    def __init__(self, numbers: np.ndarray, counts: np.ndarray, labellers: int, rounds: int = 100):
        votes = (numbers[:, None] // 3 ** np.arange(labellers)) % 3
        hot = np.eye(3)[votes]  # pattern, labeller, vote
        bad, good = (votes == BAD).sum(axis=1), (votes == GOOD).sum(axis=1)
        p = np.where(bad > 0, np.clip(bad / np.maximum(bad + good / 4, 1), 0.05, 0.95), 0.02)
        self.labellers = labellers
        for _ in range(rounds):
            mass = np.stack([(1 - p) * counts, p * counts])
            self.prior = np.clip((mass[1].sum() + 0.1) / (mass.sum() + 1), 1e-6, 1 - 1e-6)
            self.odds = np.einsum("cp,plv->clv", mass, hot) + 0.05  # class, labeller, vote
            self.odds /= self.odds.sum(axis=2, keepdims=True)
            p = self._of(votes)

    def _of(self, votes: np.ndarray) -> np.ndarray:
        at = np.arange(self.labellers)
        log = np.log(self.odds)[:, at, votes].sum(axis=2)
        return 1 / (1 + np.exp(np.clip(log[0] - log[1] + np.log((1 - self.prior) / self.prior), -40, 40)))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Odds of the bad class."""
        return self._of(votes.astype(np.int64)) if len(votes) else np.zeros(0)

    def accuracy(self) -> np.ndarray:
        """For each labeller, the odds that an opinion is right."""
        right = (1 - self.prior) * self.odds[0, :, GOOD] + self.prior * self.odds[1, :, BAD]
        wrong = (1 - self.prior) * self.odds[0, :, BAD] + self.prior * self.odds[1, :, GOOD]
        return right / (right + wrong)


def train_scorer(row: np.ndarray, bucket: np.ndarray, target: np.ndarray, rounds: int = 60, rate: float = 0.5, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by AdaGrad over all rows; features weigh 1 / sqrt of their frequency in the sample."""
    w, bias, seen, seen_bias = np.zeros(BUCKETS), 0.0, np.full(BUCKETS, 1e-8), 1e-8
    if not len(target):
        return w.astype(np.float32), bias
    share = np.bincount(bucket, minlength=BUCKETS) / len(target)
    scale = np.where(share * len(target) >= 3, 1.0, 0.0) * np.minimum(1.0, 0.1 / np.sqrt(np.maximum(share, 1e-9)))
    x = scale[bucket]
    weight = np.where(target > 0.5, 0.5 / max(target.mean(), 1e-3), 0.5 / max(1 - target.mean(), 1e-3))
    for _ in range(rounds):
        z = np.bincount(row, weights=w[bucket] * x, minlength=len(target)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * weight / len(target)
        grad = np.bincount(bucket, weights=error[row] * x, minlength=BUCKETS) + decay * w / len(target)
        seen += grad**2
        seen_bias += error.sum() ** 2
        w -= rate * grad / np.sqrt(seen)
        bias -= rate * error.sum() / np.sqrt(seen_bias)
    return (w * scale).astype(np.float32), float(bias)


def learn_terms(docs: DataFrame, labels: DataFrame | None, labelled: int = LABELLED, keep: int = TERMS) -> np.ndarray:
    """Hashes of terms that mark abuse, from at most about `labelled` rows of labels (doc_id, toxic)."""
    if labels is None:
        return np.zeros(0, np.uint64)
    n = labels.count()
    part = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000)) < int(1_000_000 * min(1.0, labelled / max(n, 1)))
    some = labels.where(part & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, "text"):
                toxic = rows.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
                row, value, _, _ = _distinct(*terms(data, off), len(toxic))
                keys, inverse = np.unique(value, return_inverse=True)
                yield pa.record_batch([keys.view(np.int64), np.bincount(inverse, weights=toxic[row], minlength=len(keys)).astype(np.int64), np.bincount(inverse, weights=1 - toxic[row], minlength=len(keys)).astype(np.int64)], names=["h", "toxic", "clean"])

    pairs = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("text", "toxic").mapInArrow(count, "h long, toxic long, clean long")
    sums = pairs.groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where("toxic >= 6 and clean * 40 < toxic")
    found = sums.orderBy(F.col("toxic").desc(), "h").limit(keep).collect()
    return np.sort(np.array([r.h for r in found], np.int64).view(np.uint64))


class Classifier:
    """What the executors need: a few MB, whatever the corpus."""

    def __init__(self, lexicon, junk: LabelModel, abuse: LabelModel, junk_scorer=None, abuse_scorer=None):
        self.lexicon, self.junk, self.abuse, self.junk_scorer, self.abuse_scorer = lexicon, junk, abuse, junk_scorer, abuse_scorer

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """For each row: posterior and score (odds of being bad) on junk, then on abuse."""
        junk, abuse, row, bucket = votes_of(data, off, self.lexicon)
        out = []
        for model, votes, scorer in ((self.junk, junk, self.junk_scorer), (self.abuse, abuse, self.abuse_scorer)):
            p = np.clip(model.posterior(votes), 1e-4, 1 - 1e-4)
            z = np.bincount(row, weights=scorer[0][bucket], minlength=len(p)) + scorer[1]
            both = np.clip(z, -6, 6) + np.log(p / (1 - p))
            out += [p, 1 / (1 + np.exp(-both))]
        out = np.stack(out, axis=1)
        out[(junk == NONE).all(axis=1), :2] = 0.0
        return out


def fewer(bucket: np.ndarray, most: int = FEATURES) -> np.ndarray:
    """A text's features or, where there are more than `most`, those with the least hash."""
    return bucket if len(bucket) <= most else bucket[np.argsort(mix(bucket.astype(np.uint64)), kind="stable")[:most]]


def fit(docs: DataFrame, labels: DataFrame | None = None, sample: int = SAMPLE) -> Classifier:
    lexicon = learn_terms(docs, labels)

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, off in text_slices(batch, "text"):
                junk, abuse, _, _ = votes_of(data, off, lexicon)
                keys, counts = np.unique(np.stack([pattern_number(junk), pattern_number(abuse)], axis=1), axis=0, return_counts=True)
                yield pa.record_batch([np.ascontiguousarray(keys[:, 0]), np.ascontiguousarray(keys[:, 1]), counts], names=["junk", "abuse", "n"])

    found = docs.select("text").mapInArrow(patterns, "junk long, abuse long, n long").groupBy("junk", "abuse").agg(F.sum("n").alias("n")).collect()  # at most 3**12 patterns
    table = np.array([tuple(r) for r in found], np.int64).reshape(-1, 3)
    models = LabelModel(table[:, 0], table[:, 2], len(JUNK)), LabelModel(table[:, 1], table[:, 2], N_ABUSE)
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("k", F.xxhash64("text", F.lit(SEED + 1)))
    total = texts.agg(F.approx_count_distinct("k")).first()[0]
    part = F.pmod("k", F.lit(10_000_000)) < int(10_000_000 * min(1.0, sample / max(total, 1)))
    drawn = texts.where(part).groupBy("k").agg(F.first("text").alias("text")).select("text")  # copies go before the shuffle

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, "text"):
                junk, abuse, row, bucket = votes_of(data, off, lexicon)
                order = np.argsort(row, kind="stable")
                cuts = np.searchsorted(row[order], np.arange(rows.num_rows + 1))
                packed = [fewer(bucket[order[a:b]]).astype(np.int32).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.record_batch([pa.array(packed, pa.binary()), models[0].posterior(junk), models[1].posterior(abuse)], names=["buckets", "junk", "abuse"])

    rows = drawn.mapInArrow(features, "buckets binary, junk double, abuse double").collect()  # at most about SAMPLE * FEATURES buckets
    rows.sort(key=lambda r: (r.buckets, r.junk, r.abuse))
    held = [np.frombuffer(r.buckets, np.int32).astype(np.int64) for r in rows]
    row = np.repeat(np.arange(len(held)), [len(b) for b in held])
    bucket = np.concatenate([*held, np.zeros(0, np.int64)])
    scorers = [train_scorer(row, bucket, np.array([getattr(r, c) for r in rows], np.float64)) for c in ("junk", "abuse")]
    return Classifier(lexicon, *models, *scorers)


def scored(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, junk_posterior, junk_score, abuse_posterior, abuse_score, kept."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, "text"):
                s = held.value.score(data, off)
                yield pa.record_batch([rows.column("doc_id"), *(np.ascontiguousarray(s[:, i]) for i in range(4)), pa.array((s[:, 1] < 0.5) & (s[:, 3] < 0.5))], names=["doc_id", "junk_posterior", "junk_score", "abuse_posterior", "abuse_score", "kept"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, junk_posterior double, junk_score double, abuse_posterior double, abuse_score double, kept boolean")


def keep_good(docs: DataFrame, model: Classifier) -> DataFrame:
    """The documents that the classifier keeps, as they are."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, "text"):
                s = held.value.score(data, off)
                yield rows.filter(pa.array((s[:, 1] < 0.5) & (s[:, 3] < 0.5)))

    return docs.mapInArrow(run, docs.schema)


def labels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scored(docs, fit(docs, labels_of(spark, sf_dir)))

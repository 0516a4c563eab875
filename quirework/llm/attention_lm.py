"""Language-model scoring: a causal self-attention model, trained in numpy, over subword ids.

Symbols are the 1022 most frequent subword ids of the training texts, the end of a text, and one for all other ids, which then are told apart
by the id before: counts of pairs over all training texts, smoothed by the ids' own counts. A layer of attention with a learned bias by distance looks
back over a window; its sum, the current symbol and a hidden layer adjust a two-step softmax (32 classes, 32 symbols each) that starts from the
counts of symbol pairs in all training texts. Windows of 48 symbols overlap by 16, and each scores its last 32 (the first one all), so every symbol is
scored once, with at least 16 of context where the text has them; windows of many texts are computed together, masked.

Training: every window of every training text is trained on. Rows are dealt to ROUNDS rounds by a hash of doc_id and text, so that copies of a text part, and within a
round in pieces of PIECE windows to replicas of about REPLICA windows. All replicas of a round start from the same weights, go once through their windows (more often, where these are few) and are averaged by what they
saw. So the outcome depends on the rows, not on how the table is partitioned (but for the order in which numbers are added up). Word, id and pair counts cover
every training text; of pairs whose second id is no symbol, the most frequent, at most PAIRS, are sent to the tasks, the others fall back to the ids' own counts.
The base model is add-one smoothed word counts. Words are counted by 64-bit hash; the most frequent, at most HOT of them, are broadcast, the
others joined.

Null texts are empty: one token, the end. Repeated rows score alike. An empty training set gives even odds. A null doc_id counts as the empty text when it
is dealt to a fold.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Lookup, documents, mix, shuffle_partitions, spread, text_slices, word_hashes, word_spans, written
from .quality import lowered
from .token_files import SLICE
from .vocabularies import tokenizer_path
from .word_ids import unit_ids

SYMBOLS, CLASSES = 1024, 32
PER_CLASS = SYMBOLS // CLASSES
END, TAIL = 0, 1
WINDOW, SCORED = 48, 32
BACK = WINDOW - SCORED
WIDTH, HIDDEN = 16, 24
HOT = 1 << 20
PAIRS = 1 << 20
BLOCKS, HELD_PAIRS = 1_024, 4 << 20
ROUNDS, REPLICA, PIECE = 8, 16_384, 64
BATCH, STEPS = 128, 100
FAST, SLOW = 8e-3, 2e-3
WEIGHTS = 1 << 13
PART = 500
SEED = 5
FOLDS, HELD = 7, 2


def is_held_out():
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")), F.lit(FOLDS)) == HELD


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, "text", SLICE):
                ids, counts = unit_ids(path, own=True).encode(lowered(data), off, 0)
                ids, cuts = ids.astype(np.uint16), np.concatenate([[0], np.cumsum(counts)])
                packed = [ids[a : b - 1].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.record_batch([rows.column("k64"), rows.column("k32"), rows.column("held_out"), rows.column("deal"), pa.array(packed, pa.binary())], names=["k64", "k32", "held_out", "deal", "ids"])

    return run


def _words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, counts = word_spans(data, off)
    return word_hashes(lowered(data), starts, ends), counts


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, data, off in text_slices(batch, "text"):
            keys, n = np.unique(_words(data, off)[0], return_counts=True)
            yield pa.record_batch([keys.view(np.int64), n], names=["h", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    return written(docs.select("text").mapInArrow(_count_words, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "word-counts")


def hottest(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The words that occur n times or more, for the least n with at most `most` of them."""
    by_count = counts.groupBy("n").agg(F.count("*").alias("words"))
    least = by_count.withColumn("up", F.sum("words").over(Window.partitionBy(F.lit(0)).orderBy(F.col("n").desc()))).where(F.col("up") <= most).agg(F.min("n")).first()[0]
    table = counts.where(F.col("n") >= (least if least is not None else 1 << 62)).select("h", "n").toArrow()
    keys, n = (table.column(c).to_numpy() for c in ("h", "n"))
    keys = keys.astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], n[order].astype(np.int64)


def base_scores(docs: DataFrame, counts: DataFrame, n_train_docs: int, hot: int = HOT) -> tuple[DataFrame, DataFrame, int]:
    """docs: doc_id, held_out, k64, k32, text. Its rows with n_tokens, n_known and base_score as far as frequent words go; what other words add for each text that has some; and the number of training tokens."""
    spark = docs.sparkSession
    words, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    total = (words or 0) + n_train_docs
    size = total + (distinct or 0) + (n_train_docs > 0) + 1
    keys, n_hot = hottest(counts, hot)
    held = spark.sparkContext.broadcast((Lookup(keys), n_hot))  # bounded by `hot`
    floor = float(np.log10(size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, n = held.value
        logs = np.log10(n + 1.0) - floor
        for batch in batches:
            for rows, data, off in text_slices(batch, "text"):
                h, per = _words(data, off)
                row = np.repeat(np.arange(len(per)), per)
                at, hit = places(h)
                known = np.bincount(row[hit], minlength=len(per)) + (n_train_docs > 0)
                score = np.bincount(row[hit], weights=logs[at[hit]], minlength=len(per)) + np.log10(n_train_docs + 1.0) - floor
                r, v = row[~hit], h[~hit]
                order = np.lexsort((v, r))
                r, v = r[order], v[order]
                new = np.ones(len(r), bool)
                new[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
                cut = np.flatnonzero(new)
                tf = np.diff(np.append(cut, len(r)))
                cuts = np.searchsorted(r[cut], np.arange(len(per) + 1)).astype(np.int32)
                rare = pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays([pa.array(v[cut].view(np.int64)), pa.array(tf.astype(np.int32))], ["h", "tf"]))
                yield pa.record_batch([*(rows.column(c) for c in ("doc_id", "held_out", "k64", "k32")), pa.array(per + 1), pa.array(known.astype(np.int64)), pa.array(score), rare], names=["doc_id", "held_out", "k64", "k32", "n_tokens", "known", "hot_score", "rare"])

    rows = written(docs.mapInArrow(run, "doc_id long, held_out boolean, k64 long, k32 int, n_tokens long, known long, hot_score double, rare array<struct<h:bigint,tf:int>>"), "base-rows")
    rare = rows.select("k64", "k32", F.explode("rare").alias("r")).select("k64", "k32", "r.h", "r.tf").repartition(shuffle_partitions(spark), "h").dropDuplicates(["h", "k64", "k32"])
    n = F.coalesce("n", F.lit(0))
    rare = rare.join(counts, "h", "left").groupBy("k64", "k32").agg(F.sum(F.when(n > 0, F.col("tf")).otherwise(0)).alias("rare_known"), F.sum(F.col("tf") * (F.log10(n + 1.0) - floor)).alias("rare_score"))
    return rows.drop("rare"), rare, total


class Vocabulary:
    """Symbols of ids: END, TAIL, then frequent ids, in an order that puts ids with like neighbours in one class."""

    def __init__(self, counts: np.ndarray):
        self.size = len(counts)
        self.frequent = np.sort(np.argsort(-counts, kind="stable")[: SYMBOLS - 2])
        self.symbol = np.full(self.size, TAIL, np.int32)
        self.symbol[self.frequent] = np.arange(2, 2 + len(self.frequent))
        rest = counts + 1.0
        rest[self.frequent] = 0
        rest_ids = np.flatnonzero(self.symbol == TAIL)
        self.rare = int(rest_ids[0]) if len(rest_ids) else None  # an id that TAIL stands for
        with np.errstate(divide="ignore"):
            self.tail_log = np.where(rest > 0, np.log(rest / max(rest.sum(), 1.0)), 0.0)

    def place(self, pairs: np.ndarray) -> np.ndarray:
        """Puts symbols in the order of reorder(); returns the pair counts in it. END stays symbol 0, so that it can stand for what is missing."""
        place = self.reorder(pairs)
        swap = np.flatnonzero(place == 0)[0]
        place[swap], place[END] = place[END], 0
        back = np.argsort(place)
        self.placed = place[self.symbol].astype(np.int32)
        return pairs[np.ix_(back, back)]

    def reorder(self, pairs: np.ndarray) -> np.ndarray:
        """Balanced halving along the main directions of the pair counts; returns the new place of each symbol."""
        x = np.sqrt(pairs.T / np.maximum(pairs.sum(axis=0)[:, None], 1))
        x = np.concatenate([x, np.sqrt(pairs / np.maximum(pairs.sum(axis=1)[:, None], 1))], axis=1)

        def halve(at: np.ndarray, size: int) -> list[np.ndarray]:
            if len(at) <= size:
                return [at]
            y = x[at] - x[at].mean(axis=0)
            v = np.random.default_rng(0).standard_normal(y.shape[1])
            for _ in range(8):
                v = y.T @ (y @ v)
                v /= max(np.linalg.norm(v), 1e-30)
            order = at[np.argsort(y @ v, kind="stable")]
            return halve(order[: len(order) // 2], size) + halve(order[len(order) // 2 :], size)

        place = np.empty(SYMBOLS, np.int64)
        place[np.concatenate(halve(np.arange(SYMBOLS), PER_CLASS))] = np.arange(SYMBOLS)
        return place


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    out, place = np.unique(np.concatenate([*keys, np.zeros(0, np.uint32)]), return_inverse=True)
    return out, np.bincount(place, weights=np.concatenate([*counts, np.zeros(0, np.int64)]), minlength=len(out)).astype(np.int64)


def _packed_pairs(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    cuts = np.searchsorted(keys, np.arange(BLOCKS + 1, dtype=np.uint64) * ((1 << 32) // BLOCKS))
    at = np.flatnonzero(np.diff(cuts))
    parts = [slice(cuts[b], cuts[b + 1]) for b in at]
    return pa.record_batch([pa.array(at, pa.int32()), pa.array([keys[p].tobytes() for p in parts], pa.binary()), pa.array([counts[p].tobytes() for p in parts], pa.binary())], names=["block", "pairs", "n"])


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of ids that follow each other, as (first + 1) * 2**16 + second + 1, 0 for a text's ends; in blocks, packed."""
    keys, counts, held = [], [], 0
    for batch in batches:
        for i in range(0, batch.num_rows, PART):
            flat, n = _flat(batch.column("ids").slice(i, PART))
            s = np.zeros(len(flat) + len(n) + 1, np.uint32)  # 0, a text, 0, a text, ... 0
            s[spread(np.cumsum(n + 1) - n, n)] = flat.astype(np.uint32) + np.uint32(1)
            some, k = np.unique((s[:-1] << np.uint32(16)) | s[1:], return_counts=True)
            keys.append(some)
            counts.append(k)
            held += len(some)
            if held > HELD_PAIRS:
                keys, counts = ([x] for x in _merged(keys, counts))
                held = len(keys[0])
                if held > HELD_PAIRS // 2:
                    yield _packed_pairs(keys[0], counts[0])
                    keys, counts, held = [], [], 0
    if held:
        yield _packed_pairs(*_merged(keys, counts))


def _sum_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block: one row a block."""
    block, keys, counts = None, [], []
    for batch in batches:
        for b, x, n in zip(batch.column("block").to_pylist(), batch.column("pairs").to_pylist(), batch.column("n").to_pylist(), strict=True):
            if b != block and keys:
                yield _packed_pairs(*_merged(keys, counts))
                keys, counts = [], []
            block = b
            keys.append(np.frombuffer(x, np.uint32))
            counts.append(np.frombuffer(n, np.int64))
            if sum(map(len, keys)) > HELD_PAIRS + 2 * len(keys[0]):  # as many as there are distinct ones, and some
                keys, counts = ([x] for x in _merged(keys, counts))
    if keys:
        yield _packed_pairs(*_merged(keys, counts))


def _over_pairs(fn):
    """fn(first id, second id, n; -1 for an end) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, n in zip(batch.column("pairs").to_pylist(), batch.column("n").to_pylist(), strict=True):
                x = np.frombuffer(x, np.uint32).astype(np.int64)
                if (out := fn((x >> 16) - 1, (x & 0xFFFF) - 1, np.frombuffer(n, np.int64))) is not None:
                    yield out

    return run


def _summed(index: np.ndarray, n: np.ndarray, names: list[str]) -> pa.RecordBatch:
    at, place = np.unique(index, return_inverse=True)
    return pa.record_batch([at.astype(np.int64), np.bincount(place, weights=n, minlength=len(at)).astype(np.int64)], names=names)


class TailPairs:
    """Log odds of an id that is no symbol, given that it is none, by the id before: (c + d u) / (C + d), with c of C kept pairs of the first id, d distinct ones, and u the id's share among such ids."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, tail_log: np.ndarray):
        self.tail_log = tail_log
        first, second = (keys >> np.uint32(16)).astype(np.int64), (keys & np.uint32(0xFFFF)).astype(np.int64) - 1
        total, kinds = np.bincount(first, weights=counts, minlength=1 << 16), np.bincount(first, minlength=1 << 16)
        with np.errstate(divide="ignore"):
            self.back = np.where(kinds > 0, np.log(np.maximum(kinds, 1) / np.maximum(total + kinds, 1)), 0.0).astype(np.float32)
        self.keys, self.log = keys, np.log((counts + kinds[first] * np.exp(tail_log[second])) / (total + kinds)[first]).astype(np.float32)

    def __call__(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """before: ids before, -1 for none."""
        first = (before + 1).astype(np.uint32)
        out = self.back[first] + self.tail_log[ids]
        if len(self.keys):
            key = (first << np.uint32(16)) | (ids + 1).astype(np.uint32)
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            out[hit] = self.log[at[hit]]
        return out


def windows_of(flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (n, WINDOW; -1 where there is none), targets (n, SCORED; -1) and the text of each window. flat: symbols of texts, `counts` each. A text's symbols lie between two ENDs."""
    n = counts + 1
    blocks = -(-n // SCORED)
    first = np.cumsum(blocks) - blocks
    here = np.full((int(blocks.sum()), SCORED), -1, np.int32)
    targets = here.copy()
    at = spread(first * SCORED, counts)
    here.reshape(-1)[at + 1] = flat
    here.reshape(-1)[first * SCORED] = END
    targets.reshape(-1)[at] = flat
    targets.reshape(-1)[first * SCORED + counts] = END
    before = np.full((len(here), BACK), -1, np.int32)
    before[1:] = here[:-1, SCORED - BACK :]
    before[first] = -1
    return np.concatenate([before, here], axis=1), targets, np.repeat(np.arange(len(n)), blocks)


_DISTANCE = np.arange(BACK, WINDOW)[:, None] - np.arange(WINDOW)[None, :]
_MASK = np.where(_DISTANCE >= 0, 0, -1e9).astype(np.float32)
_BACKWARD = np.maximum(_DISTANCE, 0)


def _summed_rows(at: np.ndarray, *parts: np.ndarray) -> list[np.ndarray]:
    """For each symbol the sum of the rows at it, for each of the parts: rows in the order of symbols, added run by run."""
    order = np.argsort(at, kind="stable")
    at = at.take(order)
    cuts = np.flatnonzero(np.append(True, at[1:] != at[:-1])[: len(at)])
    out = []
    for rows in parts:
        out.append(np.zeros((SYMBOLS, rows.shape[1]), np.float32))
        out[-1][at[cuts]] = np.add.reduceat(rows.take(order, axis=0), cuts, axis=0)
    return out


class Model:
    """Attention over a window, then classes and their symbols, as changes to the log odds of pair counts."""

    NAMES = ("q", "k", "v", "x", "far", "w1", "b1", "wc", "wm")

    def __init__(self, pairs: np.ndarray, seed: int = SEED):
        rng = np.random.default_rng(seed)
        r = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float32)
        self.q, self.k, self.v, self.x = (r(SYMBOLS, WIDTH, by=0.3) for _ in range(4))
        self.far = (-0.1 * np.arange(WINDOW)).astype(np.float32)
        self.w1, self.b1 = r(WIDTH, HIDDEN, by=WIDTH**-0.5), np.zeros(HIDDEN, np.float32)
        self.wc, self.wm = np.zeros((HIDDEN, CLASSES), np.float32), np.zeros((CLASSES, HIDDEN, PER_CLASS), np.float32)
        p = (pairs.sum(axis=0) + 0.5) / (pairs.sum() + 0.5 * SYMBOLS)
        p = ((pairs + 5 * p) / (pairs.sum(axis=1, keepdims=True) + 5)).reshape(SYMBOLS, CLASSES, PER_CLASS)
        by_class = p.sum(axis=2)
        self.bc, self.bm = np.log(by_class).astype(np.float32), np.log(p / by_class[:, :, None]).astype(np.float32)

    def get(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """The parts of what get() returns."""
        out, at = {}, 0
        for n in self.NAMES:
            old = getattr(self, n)
            out[n] = flat[at : at + old.size].reshape(old.shape)
            at += old.size
        return out

    def put(self, flat: np.ndarray) -> None:
        self.__dict__.update(self.views(flat.astype(np.float32, copy=False)))

    def score(self, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
        return self.run(inputs, targets)[0]

    def run(self, inputs: np.ndarray, targets: np.ndarray, learn: bool = False):
        """Natural-log odds of each target (0 where there is none), and with `learn` the gradients of their mean loss. Scores are small, so powers need no shift. Inputs that lack stand before a text or after it,
        where none looks. Attention is divided by its sum late, so gradients of a weight s are s (du v - du u) over that sum. Odds of classes and of a class's symbols lie side by side, so that a class takes one product."""
        n, scale = len(inputs), np.float32(WIDTH**-0.5)
        i = np.maximum(inputs, END).astype(np.intp)
        here = np.ascontiguousarray(i[:, BACK:])
        # The last column sums the weights.
        kv = np.concatenate([self.k * scale, self.v, np.ones((SYMBOLS, 1), np.float32)], axis=1).take(i, axis=0)
        q, k, v = self.q.take(here, axis=0), kv[:, :, :WIDTH], kv[:, :, WIDTH:]
        s = np.matmul(q, k.transpose(0, 2, 1), out=np.empty((n, SCORED, WINDOW), np.float32))
        s += self.far[_BACKWARD] + _MASK
        np.exp(s, out=s)
        s[inputs[:, BACK - 1] < 0, :, :BACK] = 0
        u = np.matmul(s, v).reshape(-1, WIDTH + 1)
        goal = targets.reshape(-1)
        live = np.flatnonzero(goal >= 0)
        order = live.take(np.argsort((goal.take(live) // PER_CLASS).astype(np.uint8), kind="stable"))  # symbols of a class together
        goal, prev = goal.take(order), here.reshape(-1).take(order)
        cls = goal // PER_CLASS
        cuts = np.searchsorted(cls, np.arange(CLASSES + 1)).tolist()
        parts = [(c, slice(x, y)) for c, (x, y) in enumerate(pairwise(cuts)) if x < y]
        u = u.take(order, axis=0)
        over = 1 / u[:, WIDTH:]
        u = u[:, :WIDTH] * over
        x = self.x.take(prev, axis=0)
        x += u
        h = x @ self.w1
        h += self.b1
        np.maximum(h, 0, out=h)
        w = np.concatenate([np.broadcast_to(self.wc, (CLASSES, HIDDEN, CLASSES)), self.wm], axis=2)
        z = np.empty((len(order), CLASSES + PER_CLASS), np.float32)
        for c, part in parts:
            np.matmul(h[part], w[c], out=z[part])
        z[:, :CLASSES] += self.bc.take(prev, axis=0)
        z[:, CLASSES:] += self.bm.reshape(-1, PER_CLASS).take(prev * CLASSES + cls, axis=0)
        flat, at = z.reshape(-1), np.arange(0, z.size, CLASSES + PER_CLASS)
        at_class, at_member = at + cls, at + (CLASSES + goal % PER_CLASS)
        logp = flat.take(at_class).astype(np.float64) + flat.take(at_member)
        np.exp(z, out=z)
        halves = z.reshape(-1, PER_CLASS)  # as wide as the classes are many
        sums = (halves @ np.ones(PER_CLASS, np.float32)).reshape(-1, 2)
        logp -= np.log(sums[:, 0] * sums[:, 1].astype(np.float64))
        out = np.zeros(targets.size)
        out[order] = logp
        if not learn:
            return out.reshape(targets.shape), None
        m = np.float32(max(len(order), 1))
        sums *= m
        halves *= (1 / sums).reshape(-1, 1)
        flat[at_class] -= 1 / m
        flat[at_member] -= 1 / m
        w, dw, dh = np.ascontiguousarray(w.transpose(0, 2, 1)), np.zeros_like(w), np.empty_like(h)
        for c, part in parts:
            np.matmul(h[part].T, z[part], out=dw[c])
            np.matmul(z[part], w[c], out=dh[part])
        dh *= h > 0
        found = np.empty(sum(getattr(self, x).size for x in self.NAMES), np.float32)
        g = self.views(found)
        g["wc"][:], g["wm"][:] = dw[:, :, :CLASSES].sum(axis=0), dw[:, :, CLASSES:]
        g["w1"][:], g["b1"][:] = x.T @ dh, np.ones(len(dh), np.float32) @ dh
        # By place: du over the sum of weights and that of the sum, and du as such; zeros where there is no target.
        dx, du = np.zeros((len(order) + 1, WIDTH), np.float32), np.zeros((len(order) + 1, WIDTH + 1), np.float32)
        np.matmul(dh, self.w1.T, out=dx[:-1])
        np.multiply(dx[:-1], over, out=du[:-1, :WIDTH])
        u *= du[:-1, :WIDTH]
        np.matmul(u, np.full(WIDTH, -1, np.float32), out=du[:-1, WIDTH])
        back = np.full(targets.size, len(order))
        back[order] = np.arange(len(order))
        dx, du = dx.take(back, axis=0), du.take(back, axis=0).reshape(n, SCORED, WIDTH + 1)
        dkv = np.empty((n, WINDOW, 2 * WIDTH), np.float32)
        np.matmul(s.transpose(0, 2, 1), du[:, :, :WIDTH], out=dkv[:, :, WIDTH:])
        ds = np.matmul(du, v.transpose(0, 2, 1), out=np.empty_like(s))
        ds *= s
        by_pair = np.ones(n, np.float32) @ ds.reshape(n, -1)
        g["far"][:] = np.bincount(_BACKWARD.ravel(), weights=by_pair, minlength=WINDOW)
        dq = ds @ k
        np.matmul(ds.transpose(0, 2, 1), q, out=dkv[:, :, :WIDTH])
        i = i.astype(np.uint16)
        (sums,) = _summed_rows(i.reshape(-1), dkv.reshape(-1, 2 * WIDTH))
        np.multiply(sums[:, :WIDTH], scale, out=g["k"])
        g["v"][:] = sums[:, WIDTH:]
        g["q"][:], g["x"][:] = _summed_rows(i[:, BACK:].reshape(-1), dq.reshape(-1, WIDTH), dx)
        return out.reshape(targets.shape), found

    def train(self, inputs: np.ndarray, targets: np.ndarray, rate: float, steps: int, seed: int = SEED) -> int:
        """Adam over batches in random order, no window again before all others; the number of symbols seen."""
        if not len(inputs):
            return 0
        rng, w = np.random.default_rng(seed), self.get()
        self.put(w)  # views, so that steps change the weights in place
        m, v, part, seen, left = np.zeros_like(w), np.zeros_like(w), np.empty_like(w), 0, np.zeros(0, np.int64)
        symbols = (targets >= 0).sum(axis=1)
        for t in range(1, steps + 1):
            left = left if len(left) else rng.permutation(len(inputs))
            pick, left = left[:BATCH], left[BATCH:]
            seen += int(symbols[pick].sum())
            _, g = self.run(inputs.take(pick, axis=0), targets.take(pick, axis=0), learn=True)
            m *= 0.9
            m += np.multiply(g, 0.1, out=part)
            v *= 0.99
            g *= g
            g *= 0.01
            v += g
            np.sqrt(v, out=g)
            g *= (1 - 0.99**t) ** -0.5
            g += 1e-8
            np.divide(m, g, out=g)
            g *= rate * min(1.0, 2 * (1 - t / (steps + 1))) / (1 - 0.9**t)
            w -= g
        return seen


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of packed ids, and how many each row has."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint16)[ends[0] // 2 : ends[-1] // 2] if data is not None else np.zeros(0, np.uint16), np.diff(ends) // 2


def pieces(flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """All windows of all texts, packed: the text of each piece, its number within the text, and its symbols, those that its first window looks back to and the one after its last window included; -1 where there is none."""
    blocks = counts // SCORED + 1
    size = BACK + blocks * SCORED + 1
    start = np.cumsum(size) - size
    line = np.full(int(size.sum()), -1, np.int16)
    line[start + BACK] = END
    line[spread(start + BACK + 1, counts)] = flat
    n = -(-blocks // PIECE)
    text = np.repeat(np.arange(len(counts)), n)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    a = start[text] + nth * PIECE * SCORED
    b = a + BACK + np.minimum(blocks[text] - nth * PIECE, PIECE) * SCORED + 1
    return text, nth, [line[x:y].tobytes() for x, y in zip(a.tolist(), b.tolist(), strict=True)]


def unpacked(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and targets of the windows of pieces, as windows_of() has them."""
    both = np.concatenate([np.lib.stride_tricks.sliding_window_view(np.frombuffer(x, np.int16), WINDOW + 1)[::SCORED] for x in data]).astype(np.int32)
    inputs, after = both[:, :WINDOW], both[:, BACK + 1 :]
    return inputs, np.where((after < 0) & (inputs[:, BACK:] >= 0), END, after)


def round_of(deal: str):
    return F.pmod(deal, F.lit(ROUNDS)).cast("int")


def deal(ids: DataFrame, held, round_: int, replicas: int) -> DataFrame:
    """replica, h, data: all windows of a round's rows. ids: deal, ids, and round where the table has a folder for each; held: a broadcast of the symbols of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, PART):
                part = batch.slice(i, PART)
                flat, n = _flat(part.column("ids"))
                text, nth, data = pieces(held.value[flat], n)
                h = mix(part.column("deal").to_numpy()[text].view(np.uint64) ^ mix(nth.astype(np.uint64) + np.uint64(SEED)))
                yield pa.record_batch([((h >> np.uint64(32)) % np.uint64(replicas)).astype(np.int32), h.view(np.int64), pa.array(data, pa.binary())], names=["replica", "h", "data"])

    of_round = ids.where((F.col("round") if "round" in ids.columns else round_of("deal")) == round_)
    return of_round.select("deal", "ids").mapInArrow(run, "replica int, h long, data binary")


def _train_replicas(held, weights, rate: float):
    """Rows sorted by replica: the sum of the replicas' weights, times what each saw, in blocks; what they saw, and the windows that they have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen, windows, replica, data = 0.0, 0, 0, None, []

        def learn():
            model = Model.__new__(Model)
            model.__dict__.update(held.value.__dict__)
            model.put(weights.value)
            inputs, targets = unpacked(data)
            n = model.train(inputs, targets, rate, max(-(-len(inputs) // BATCH), STEPS))
            return total + model.get().astype(np.float64) * n, seen + n, windows + len(inputs)

        for batch in batches:
            for r, x in zip(batch.column("replica").to_pylist(), batch.column("data").to_pylist(), strict=True):
                if r != replica and data:
                    total, seen, windows = learn()
                    data = []
                replica = r
                data.append(x)
        if data:
            total, seen, windows = learn()
            at = range(0, len(total), WEIGHTS)
            yield pa.record_batch([pa.array([i // WEIGHTS for i in at], pa.int32()), pa.array([total[i : i + WEIGHTS].tobytes() for i in at], pa.binary()), np.full(len(at), seen), np.full(len(at), windows)], names=["block", "w", "seen", "windows"])

    return run


def _sum_weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _train_replicas, all of a block in one task: one row a block."""
    sums: dict[int, list] = {}
    for batch in batches:
        for r in batch.to_pylist():
            new = [np.frombuffer(r["w"], np.float64), r["seen"], r["windows"]]
            sums[r["block"]] = [a + b for a, b in zip(sums[r["block"]], new, strict=True)] if r["block"] in sums else new
    for b, (w, seen, windows) in sums.items():
        yield pa.record_batch([pa.array([b], pa.int32()), pa.array([w.tobytes()], pa.binary()), np.array([seen]), np.array([windows])], names=["block", "w", "seen", "windows"])


def train_on_all(model: Model, vocabulary: Vocabulary, ids: DataFrame, windows: float) -> int:
    """Trains the model on every window of ids (deal, ids), about `windows`; the number of windows that it trained on."""
    spark, done = ids.sparkSession, 0
    replicas = max(1, round(windows / ROUNDS / REPLICA))
    placed, held = spark.sparkContext.broadcast(vocabulary.placed), spark.sparkContext.broadcast(model)
    schema = "block int, w binary, seen long, windows long"
    for r in range(ROUNDS):
        rate = FAST * (SLOW / FAST) ** (r / (ROUNDS - 1))
        dealt = deal(ids, placed, r, replicas).repartition(min(shuffle_partitions(spark), replicas), "replica").sortWithinPartitions("replica", "h", "data")
        trained = dealt.mapInArrow(_train_replicas(held, spark.sparkContext.broadcast(model.get()), rate), schema)
        blocks = -(-len(model.get()) // WEIGHTS)
        found = sorted(trained.repartition(min(shuffle_partitions(spark), blocks), "block").mapInArrow(_sum_weights, schema).collect())  # one row a block of weights
        if found:
            model.put(np.concatenate([np.frombuffer(x.w, np.float64) for x in found]) / found[0].seen)
            done += found[0].windows
    return done


def pair_counts(ids: DataFrame) -> DataFrame:
    """block, pairs, n: all pairs of ids that follow each other, one row a block."""
    found = ids.select("ids").mapInArrow(_count_pairs, "block int, pairs binary, n binary")
    n_parts = min(shuffle_partitions(ids.sparkSession), BLOCKS)
    return written(found.repartition(n_parts, "block").sortWithinPartitions("block").mapInArrow(_sum_pairs, "block int, pairs binary, n binary"), "pair-counts")


def fit(ids: DataFrame, size: int, most: int = PAIRS) -> tuple[Vocabulary, Model, TailPairs]:
    """ids: deal, ids (binary uint16) of the training texts."""
    pairs = pair_counts(ids)

    def by_index(fn, name: str) -> pa.Table:
        return pairs.mapInArrow(_over_pairs(fn), f"{name} long, n long").groupBy(name).agg(F.sum("n").alias("n")).toArrow()

    found = by_index(lambda a, b, n: _summed(b, n, ["id", "n"]), "id")  # at most the vocabulary
    id_of, n = found.column("id").to_numpy(), found.column("n").to_numpy()
    counts = np.zeros(size, np.int64)
    counts[id_of[id_of >= 0]] = n[id_of >= 0]
    texts, total = int(n[id_of < 0].sum()), int(n.sum())
    vocabulary = Vocabulary(counts)
    symbol = np.append(vocabulary.symbol, END)  # at -1, an end
    found = by_index(lambda a, b, n: _summed(symbol[a].astype(np.int64) * SYMBOLS + symbol[b], n, ["pair", "n"]), "pair")  # at most SYMBOLS ** 2
    table = np.zeros(SYMBOLS * SYMBOLS)
    table[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    model = Model(vocabulary.place(table.reshape(SYMBOLS, SYMBOLS)))

    tail = lambda b: symbol[b] == TAIL
    by_count = by_index(lambda a, b, n: _summed(n[tail(b)], np.ones(int(tail(b).sum())), ["count", "n"]), "count").sort_by([("count", "descending")])  # one row a distinct count
    fits = np.flatnonzero(np.cumsum(by_count.column("n").to_numpy()) <= most)
    least = int(by_count.column("count").to_numpy()[fits[-1]]) if len(fits) else None

    def frequent(a, b, n):
        stay = tail(b) & (n >= least)
        return pa.record_batch([pa.array([(((a[stay] + 1) << 16) | (b[stay] + 1)).astype(np.uint32).tobytes()], pa.binary()), pa.array([n[stay].tobytes()], pa.binary())], names=["pairs", "n"])

    kept = pairs.mapInArrow(_over_pairs(frequent), "pairs binary, n binary").collect() if least else []  # at most `most` pairs
    keys, n = (np.frombuffer(b"".join(bytes(r[c]) for r in kept), t) for c, t in (("pairs", np.uint32), ("n", np.int64)))
    order = np.argsort(keys)
    tails = TailPairs(keys[order], n[order], vocabulary.tail_log)

    windows = max(1.0, total / SCORED + texts / 2)  # about as many
    train_on_all(model, vocabulary, ids, windows)
    return vocabulary, model, tails


def score_texts(model: Model, vocabulary: Vocabulary, tails: TailPairs, flat: np.ndarray, counts: np.ndarray, batch: int = 128) -> np.ndarray:
    """log10 of each text's probability, its end included. flat: the ids of all texts, `counts` each."""
    symbols = vocabulary.placed[flat]
    inputs, targets, text = windows_of(symbols, counts)
    sums = np.concatenate([model.score(inputs[i : i + batch], targets[i : i + batch]).sum(axis=1) for i in range(0, len(inputs), batch)])
    out = np.bincount(text, weights=sums, minlength=len(counts))
    rare = np.flatnonzero(symbols == vocabulary.placed[vocabulary.rare]) if vocabulary.rare is not None else np.zeros(0, np.int64)
    first = np.zeros(len(flat) + 1, bool)
    first[np.cumsum(counts) - counts] = True
    before = np.where(first[rare], -1, flat[np.maximum(rare - 1, 0)].astype(np.int64))
    row = np.searchsorted(np.cumsum(counts), rare, side="right")
    return (out + np.bincount(row, weights=tails(before, flat[rare].astype(np.int64)), minlength=len(counts))) / np.log(10)


def _score(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, model, tails = held.value
        for batch in batches:
            for i in range(0, batch.num_rows, PART):
                part = batch.slice(i, PART)
                yield pa.record_batch([part.column("k64"), part.column("k32"), score_texts(model, vocabulary, tails, *_flat(part.column("ids")))], names=["k64", "k32", "score"])

    return run


def lm_scores(docs: DataFrame, path: str) -> DataFrame:
    """docs: doc_id, text. doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))  # for the keys, too, so that a null text scores as an empty one does
    docs = docs.select("doc_id", is_held_out().alias("held_out"), F.xxhash64(text).alias("k64"), F.hash(text).alias("k32"), text.alias("text"))
    keyed = docs.select("k64", "k32", "held_out", F.xxhash64("doc_id", "k64").alias("deal"), "text")
    counts = word_counts(docs.where("not held_out"))
    rows, rare, total = base_scores(docs, counts, docs.where("not held_out").count())
    ids = written(keyed.mapInArrow(_encode(path), "k64 long, k32 int, held_out boolean, deal long, ids binary").withColumn("round", round_of("deal")), "subword-ids", ("round",))
    held = spark.sparkContext.broadcast(fit(ids.where("not held_out"), unit_ids(path).size))
    scores = ids.select("k64", "k32", "ids").mapInArrow(_score(held), "k64 long, k32 int, score double").groupBy("k64", "k32").agg(F.max("score").alias("score"))
    texts = written(scores.join(rare, ["k64", "k32"], "left"), "text-scores")  # one row a text, so that copies meet in a plain join
    rows = rows.join(texts, ["k64", "k32"])
    known, base = F.col("known") + F.coalesce("rare_known", F.lit(0)), F.col("hot_score") + F.coalesce("rare_score", F.lit(0.0))
    return rows.select("doc_id", "held_out", "n_tokens", known.cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))

"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its five-word shingles: weight tf * ln(1 + N / max(df, T / 2**15)), where N documents
hold T distinct (document, shingle) pairs. A shingle is frequent if it makes up 2**-15 of these pairs; there are at most 2**15 such, whatever
the corpus, and all others share one inverse document frequency. So exact weights need only the document counts of frequent
shingles: each partition keeps a Misra-Gries summary of bounded size, whose sums, with their known errors, leave a bounded list of
candidates; a second pass counts those exactly over all documents.

ICWS draws (shingle, level) samples that agree between two documents with the odds of their weighted Jaccard similarity.
Twelve bands of four samples make a pair of similarity 0.8 meet in a bucket with odds of 0.998, and all texts of a bucket are compared
exactly, on their whole texts. Buckets of several bands with the same members count once. A bucket is dealt to tiles of about TILE texts (or
TILE_BYTES) by hash; a task gets whole tiles, compares all their pairs by blocked products of incidence matrices, and returns only the edges of a
spanning forest: never pairs. First every tile is compared within itself and with two leaders of its bucket. Where a bucket of
several tiles then still holds several classes, a second round compares what is left: every text outside its largest class meets all texts of
other classes, tile by tile. So whatever the size of a bucket, each of its pairs is compared, or lies within one class already.
Documents linked by pairs of 0.8 or more, directly or through others, are one class.

Equal texts are one node from the start. Texts of one to four words have one shingle of all their words. Null texts, and texts without words, are in no
class but their own, apart from equal ones of the latter. Repeated rows are copies. A class is named by its least doc_id; null ids come last, and
name a class only if it has no others. Very long texts are compared whole. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, documents, mix, shuffle_partitions, spread, text_slices, word_hashes, word_spans, written
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 12, 4
FREQUENT = 15
COUNTERS = 1 << 17
TILE, TILE_BYTES = 512, 4 << 20
COLUMNS = 2_048


def shingles(data: np.ndarray, off: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, in order of (row, hash): row, hash, how often."""
    starts, ends, counts = word_spans(data, off)
    h = word_hashes(data, starts, ends)
    n = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    first = np.cumsum(counts) - counts
    row = np.repeat(np.arange(len(counts)), n)
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    size = np.minimum(counts, width)[row]
    value = np.zeros(len(row), np.uint64)
    for k in range(width):  # Horner over words, all shingles together
        has = size > k
        step = h[np.minimum(at + k, len(h) - 1)] if len(h) else value
        value = np.where(has, mix(value * np.uint64(0xD1342543DE82EF95) + step + np.uint64(k + 1)), value)
    order = np.argsort(value)
    order = order[np.argsort(row.astype(np.uint16 if len(counts) < 1 << 16 else np.uint32)[order], kind="stable")]
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    cut = np.flatnonzero(new)
    return row[cut], value[cut], np.diff(np.append(cut, len(row)))


def _merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    return keys, np.bincount(inverse, weights=np.concatenate([a[1], b[1]]), minlength=len(keys)).astype(np.int64)


def _summaries(counters: int):
    """Misra-Gries over a partition of distinct texts, `copies` of each: (hash, least count) for at most `counters` shingles, and with hash null the number of pairs, and the most that any count lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        pairs = lack = 0

        def prune(held, lack):
            if len(held[0]) <= counters:
                return held, lack
            cut = int(np.partition(held[1], len(held[1]) - counters - 1)[len(held[1]) - counters - 1])
            stay = held[1] > cut
            return (held[0][stay], held[1][stay] - cut), lack + cut

        for batch in batches:
            for rows, data, off in text_slices(batch, "text"):
                row, value, _ = shingles(data, off)
                more = rows.column("copies").to_numpy()[row] - 1
                pairs += len(value) + int(more.sum())
                held = _merge(held, np.unique(value, return_counts=True))
                held, lack = prune(_merge(held, (value[more > 0], more[more > 0])), lack)
        yield pa.record_batch([pa.array([None], pa.int64()), pa.array([0], pa.int64()), pa.array([pairs], pa.int64()), pa.array([lack], pa.int64())], names=["h", "n", "pairs", "lack"])
        for i in range(0, len(held[0]), 50_000):
            h, n = held[0][i : i + 50_000].view(np.int64), held[1][i : i + 50_000]
            yield pa.record_batch([h, n, np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)], names=["h", "n", "pairs", "lack"])

    return run


def _count(candidates: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(candidates, np.uint64)
        counts = np.zeros(len(known), np.int64)
        for batch in batches:
            for rows, data, off in text_slices(batch, "text"):
                row, value, _ = shingles(data, off)
                at = np.minimum(np.searchsorted(known, value), max(len(known) - 1, 0))
                hit = np.flatnonzero(known[at] == value) if len(known) else np.zeros(0, np.int64)
                counts += np.bincount(at[hit], weights=rows.column("copies").to_numpy()[row[hit]], minlength=len(known)).astype(np.int64)
        hit = np.flatnonzero(counts)
        if len(hit):
            yield pa.record_batch([known[hit].view(np.int64), counts[hit]], names=["h", "n"])

    return run


class Idf:
    """ln(1 + N / df), df from below by T / 2**FREQUENT."""

    def __init__(self, n: int, pairs: int, keys: np.ndarray, counts: np.ndarray):
        self.rest = float(np.log1p(n / max(1.0, pairs / (1 << FREQUENT))))
        self.keys, self.values = keys, np.log1p(n / np.maximum(counts, 1))

    def __call__(self, value: np.ndarray) -> np.ndarray:
        out = np.full(len(value), self.rest)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, value), len(self.keys) - 1)
            hit = self.keys[at] == value
            out[hit] = self.values[at[hit]]
        return out


def corpus_idf(texts: DataFrame, n: int, counters: int = COUNTERS) -> Idf:
    """texts: text, copies (how many documents have it); n: all documents. What comes to the driver is bounded by the number of frequent shingles."""
    texts = texts.select("text", "copies")
    some = written(texts.mapInArrow(_summaries(counters), "h long, n long, pairs long, lack long"), "shingle-summaries")
    pairs, lack = some.where("h is null").agg(F.sum("pairs"), F.sum("lack")).first()
    pairs, least = pairs or 0, (pairs or 0) / (1 << FREQUENT)
    # The summaries miss at most pairs / counters in all, a quarter of the bound: no more than 4/3 * 2**FREQUENT can pass.
    found = some.where("h is not null").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= max(least - (lack or 0), 1)).where(F.col("n") >= least * 0.7).collect()
    known = np.sort(np.array([r.h for r in found], np.int64).view(np.uint64))
    exact = texts.mapInArrow(_count(known.tobytes()), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > least).collect()
    keys = np.array([r.h for r in exact], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Idf(n, pairs, keys[order], np.array([r.n for r in exact], np.int64)[order])


def _gamma_table() -> np.ndarray:
    """Quantiles of the Gamma(2, 1) law, whose distribution is 1 - (1 + x) e^-x, at 2**16 even steps."""
    x = np.linspace(0, 40, 400_001)
    p = (np.arange(1 << 16) + 0.5) / (1 << 16)
    return np.interp(p, 1 - (1 + x) * np.exp(-x), x)


_TABLES: list[np.ndarray] = []


def icws(value: np.ndarray, weight: np.ndarray, starts: np.ndarray, samples: int) -> np.ndarray:
    """Improved consistent weighted sampling: for each run of (value, weight) from starts, `samples` hashes of the (value, level) drawn."""
    if not _TABLES:
        g = _gamma_table()
        _TABLES.extend([g.astype(np.float32), (1 / g).astype(np.float32), np.log(g).astype(np.float32)])
    gamma, inverse, log_gamma = _TABLES
    log_w = np.log(weight).astype(np.float32)
    size = np.diff(np.append(starts, len(value)))
    out = np.empty((samples, len(starts)), np.uint64)
    for k in range(samples):
        z = mix(value ^ mix(np.full(1, 0x51ED27 + k, np.uint64)))
        r = (z & np.uint64(0xFFFF)).astype(np.int32)
        c = ((z >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int32)
        beta = (z >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
        level = np.floor(log_w * inverse[r] + beta)
        a = log_gamma[c] - gamma[r] * (level - beta + np.float32(1))
        least = np.minimum.reduceat(a, starts)
        hit = np.flatnonzero(a == np.repeat(least, size))
        run = np.searchsorted(starts, hit, side="right") - 1
        hit = hit[np.concatenate([[True], run[1:] != run[:-1]])]  # the first of equals: least hash
        out[k] = mix(value[hit] ^ mix((level[hit].astype(np.int64)).view(np.uint64) + np.uint64(k)))
    return out


def _signatures(idf: Idf, bands: int, rows_in: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, "text", 1 << 20):
                row, value, tf = shingles(data, off)
                if not len(row):
                    continue
                new = np.ones(len(row), bool)
                new[1:] = row[1:] != row[:-1]
                starts = np.flatnonzero(new)
                drawn = icws(value, tf * idf(value), starts, bands * rows_in)
                keys = np.zeros((len(starts), bands), np.uint64)
                for b in range(bands):
                    for k in range(rows_in):
                        keys[:, b] = mix(keys[:, b] * np.uint64(0x9E3779B97F4A7C15) + drawn[b * rows_in + k])
                at = row[starts]
                values = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * bands), pa.array(keys.ravel().view(np.int64)))
                yield pa.record_batch([*(rows.column(c).take(pa.array(at)) for c in ("k64", "k32")), pa.array(np.diff(off)[at]), values], names=["k64", "k32", "bytes", "keys"])

    return run


def weighted_sets(texts: list[str], idf: Idf) -> list[tuple[np.ndarray, np.ndarray]]:
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
    row, value, tf = shingles(np.frombuffer(b"".join(raw), np.uint8), off)
    weight, cuts = tf * idf(value), np.searchsorted(row, np.arange(len(texts) + 1))
    return [(value[a:b], weight[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of lesser weights over sum of greater ones; both sets in ascending order."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    hit = a[0][at] == b[0]
    both = np.minimum(a[1][at[hit]], b[1][hit]).sum()
    return float(both / (a[1].sum() + b[1].sum() - both))


def shared_weights(member: np.ndarray, value: np.ndarray, tf: np.ndarray, idf: Idf, n: int) -> np.ndarray:
    """For all pairs of n weighted sets, the sum of the lesser weights. A shingle's counts are steps: step k adds to a pair if both have at least that many."""
    order = np.lexsort((tf, value))
    member, value, tf = member[order], value[order], tf[order]
    first = np.ones(len(value), bool)
    first[1:] = value[1:] != value[:-1]
    size = np.diff(np.append(np.flatnonzero(first), len(value)))
    stay = np.repeat(size > 1, size)  # what one set alone has is shared with none
    member, value, tf, first = member[stay], value[stay], tf[stay], first[stay]
    out = np.zeros((n, n), np.float32)
    if not len(value):
        return out
    step = first.copy()
    step[1:] |= tf[1:] != tf[:-1]
    feature = np.cumsum(step) - 1  # (shingle, count)
    low = feature[first][np.cumsum(first) - 1]  # the shingle's least count
    at = np.flatnonzero(step)
    weight = ((tf[at] - np.where(first[at], 0, np.append(0, tf[at][:-1]))) * idf(value[at])).astype(np.float32)
    has = feature - low + 1
    member, feature = np.repeat(member, has), spread(low, has)
    order = np.argsort(feature, kind="stable")
    member, feature = member[order], feature[order]
    cuts = np.searchsorted(feature, np.arange(0, len(weight) + COLUMNS, COLUMNS))
    for i, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        if a < b:
            w = weight[i * COLUMNS : (i + 1) * COLUMNS]
            held = np.zeros((n, len(w)), np.float32)
            held[member[a:b], feature[a:b] - i * COLUMNS] = 1
            out += (held * w) @ held.T
    return out


def _links(member: np.ndarray, value: np.ndarray, tf: np.ndarray, n: int, idf: Idf, threshold: float) -> np.ndarray:
    """Which pairs of n sets are alike; close calls are settled in double precision."""
    weight = tf * idf(value)
    total = np.bincount(member, weights=weight, minlength=n)
    cuts = np.searchsorted(member, np.arange(n + 1))
    exact = lambda i, j: weighted_jaccard(*((value[cuts[k] : cuts[k + 1]], weight[cuts[k] : cuts[k + 1]]) for k in (i, j)))
    near = np.zeros((n, n), bool)
    if n < 4:
        close = np.triu(np.ones((n, n), bool), 1)
    else:
        both = shared_weights(member, value, tf, idf, n).astype(np.float64)
        alike = both / np.maximum(total[:, None] + total[None, :] - both, 1e-30)
        near, close = alike >= threshold, np.triu(np.abs(alike - threshold) < 1e-4, 1)
    for i, j in zip(*np.nonzero(close), strict=True):
        near[i, j] = near[j, i] = exact(i, j) >= threshold
    return near


def _forest(near: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join what `near` links, beyond what one root holds together already: the first member of each joined class with one of every other."""
    left, right = [], []
    todo = np.ones(len(near), bool)
    for i in range(len(near)):
        if not todo[i]:
            continue
        found = root == root[i]
        todo &= ~found
        new = found
        while new.any():
            met = np.isin(root, np.unique(root[near[new].any(axis=0) & todo]))
            new = met & todo
            todo &= ~new
            if new.any():
                at = np.flatnonzero(new)[np.unique(root[new], return_index=True)[1]]
                left.append(np.full(len(at), i))
                right.append(at)
    return np.concatenate([*left, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([*right, np.zeros(0, np.int64)]).astype(np.int64)


NODE = "struct<k64:bigint,k32:int>"
_EDGES = "a64 long, a32 int, b64 long, b32 int"
_GROUP = ("key", "low", "high")  # a bucket and two of its tiles, or one


def _compare(idf: Idf, threshold: float):
    """Rows sorted by bucket and tiles: edges that join classes (roots) with alike members in different tiles, or in the same where there is but one."""

    def cuts_of(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for c in _GROUP:
            v = table.column(c).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new)

    def edges(table: pa.Table) -> Iterator[pa.RecordBatch]:
        ends = np.append(cuts_of(table), table.num_rows)
        size = np.cumsum(pc.binary_length(table.column("text")).to_numpy())
        size = np.concatenate([[0], size])[ends]
        i = 0
        while i + 1 < len(ends):  # whole groups, some MB of them
            j = max(i + 1, int(np.searchsorted(size, size[i] + TILE_BYTES, side="right")) - 1)
            yield some(table.slice(ends[i], ends[j] - ends[i]).combine_chunks(), ends[i : j + 1] - ends[i])
            i = j

    def some(table: pa.Table, ends: np.ndarray) -> pa.RecordBatch:
        part = table.to_batches()[0]
        k64, k32, r64, r32, mine, low, high = (part.column(c).to_numpy() for c in ("k64", "k32", "r64", "r32", "mine", "low", "high"))
        sets = [(row, value, tf, rows.num_rows) for rows, data, off in text_slices(part, "text") for row, value, tf in [shingles(data, off)]]
        shift = np.cumsum([0, *(n for *_, n in sets)])
        row = np.concatenate([r + s for (r, *_), s in zip(sets, shift[:-1], strict=True)])
        value, tf = (np.concatenate([x[k] for x in sets]) for k in (1, 2))
        root = np.unique(np.stack([r64, r32.astype(np.int64)]), axis=1, return_inverse=True)[1].reshape(-1)
        cuts = np.searchsorted(row, ends)
        left, right = [], []
        for i in range(len(ends) - 1):
            a, b = ends[i], ends[i + 1]
            of, inside = root[a:b], slice(cuts[i], cuts[i + 1])
            near = _links(row[inside] - a, value[inside], tf[inside], b - a, idf, threshold)
            if low[a] != high[a]:
                near &= mine[a:b, None] != mine[None, a:b]
            x, y = _forest(near, of)
            left.append(x + a)
            right.append(y + a)
        left, right = np.concatenate(left), np.concatenate(right)
        return pa.record_batch([r64[left], r32[left], r64[right], r32[right]], names=["a64", "a32", "b64", "b32"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.table(batch) if held is None else pa.concat_tables([held, pa.table(batch)])
            last = cuts_of(table)[-1]
            held = table.slice(last)
            if last:
                yield from edges(table.slice(0, last))
        if held is not None and held.num_rows:
            yield from edges(held)

    return run


def _as_edges(found: DataFrame) -> DataFrame:
    return found.select(F.struct(F.col("a64").alias("k64"), F.col("a32").alias("k32")).alias("a"), F.struct(F.col("b64").alias("k64"), F.col("b32").alias("k32")).alias("b"))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """Each text that is not null, once: k64, k32, text, copies. Partial sums keep many copies out of one task."""
    keyed = docs.where("text is not null").select("text", F.xxhash64("text").alias("k64"), F.hash("text").alias("k32"))
    return written(keyed.groupBy("k64", "k32").agg(F.first("text").alias("text"), F.count("*").alias("copies")), "distinct-texts")


def alike(texts: DataFrame, n: int, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """texts: as of distinct_texts(); n: the number of documents. Edges (a, b: text keys) that join all texts linked by `threshold` or more."""
    idf = corpus_idf(texts, n)
    n_parts = shuffle_partitions(texts.sparkSession)
    marks = written(texts.select("k64", "k32", "text").mapInArrow(_signatures(idf, bands, rows), "k64 long, k32 int, bytes long, keys array<long>"), "signatures")
    members = marks.select("k64", "k32", "bytes", F.explode("keys").alias("key"))
    same = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("k64", "k32")).alias("x"), F.bit_xor(F.xxhash64("k32", "k64")).alias("y"), F.min("k64").alias("least"), F.max("k64").alias("most")]
    buckets = members.groupBy("key").agg(*same, F.sum("bytes").alias("bytes")).where("n > 1")
    buckets = buckets.groupBy("n", "x", "y", "least", "most").agg(F.min("key").alias("key"), F.max("bytes").alias("bytes"))
    tiles = lambda n, size: F.ceil(F.greatest(F.col(n) / TILE, F.col(size) / TILE_BYTES)).cast("int")
    buckets = written(buckets.select("key", "least", "most", tiles("n", "bytes").alias("tiles")), "buckets")
    placed = written(members.join(buckets, "key"), "members")
    whole = texts.select(F.col("k64").alias("t64"), F.col("k32").alias("t32"), "text")

    def compared(dealt: DataFrame) -> DataFrame:
        dealt = dealt.join(whole, (F.col("k64") == F.col("t64")) & (F.col("k32") == F.col("t32"))).select("k64", "k32", "r64", "r32", *_GROUP, "mine", "text")
        return _as_edges(written(dealt.repartition(n_parts, *_GROUP).sortWithinPartitions(*_GROUP, "k64", "k32").mapInArrow(_compare(idf, threshold), _EDGES), "edges"))

    salt = F.xxhash64("key", "k64", "k32")
    own = F.pmod(salt, F.col("tiles")).cast("int")
    leads = (F.col("k64") == F.col("least")) | (F.col("k64") == F.col("most"))
    first = placed.select("k64", "k32", F.col("k64").alias("r64"), F.col("k32").alias("r32"), "key", F.explode(F.when(leads, F.sequence(F.lit(0), F.col("tiles") - 1)).otherwise(F.array(own))).alias("mine"))
    edges = compared(first.withColumns({"low": F.col("mine"), "high": F.col("mine")}))

    large = placed.where("tiles > 1")
    if large.isEmpty():
        return edges
    roots = written(components(edges).select("node.*", F.col("root.k64").alias("r64"), F.col("root.k32").alias("r32")), "roots")
    large = large.select("k64", "k32", "bytes", "key").join(roots, ["k64", "k32"], "left")
    large = written(large.withColumns({"r64": F.coalesce("r64", "k64"), "r32": F.coalesce("r32", "k32")}), "large-buckets")
    held = large.groupBy("key", "r64", "r32").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    held = held.groupBy("key").agg(F.count("*").alias("classes"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.max(F.struct("n", "bytes", "r64", "r32")).alias("top")).where("classes > 1")
    held = held.select("key", F.col("top.r64").alias("x64"), F.col("top.r32").alias("x32"), F.col("top.n").alias("n_top"), F.col("top.bytes").alias("b_top"), (F.col("n") - F.col("top.n")).alias("n_rest"), (F.col("bytes") - F.col("top.bytes")).alias("b_rest"))
    held = written(held.select("key", "x64", "x32", tiles("n_top", "b_top").alias("top"), tiles("n_rest", "b_rest").alias("rest")), "open-buckets")
    # Tiles of the largest class meet those of the others; tiles of the others meet all, themselves included.
    more = large.join(held, "key").withColumn("is_top", (F.col("r64") == F.col("x64")) & (F.col("r32") == F.col("x32")))
    more = more.withColumn("mine", F.when(F.col("is_top"), F.pmod(salt, F.col("top"))).otherwise(F.col("top") + F.pmod(salt, F.col("rest"))).cast("int"))
    beside = F.when(F.col("is_top"), F.sequence("top", F.col("top") + F.col("rest") - 1)).otherwise(F.sequence(F.lit(0), F.col("top") + F.col("rest") - 1))
    more = more.withColumn("beside", F.explode(beside)).withColumns({"low": F.least("mine", "beside"), "high": F.greatest("mine", "beside")})
    return edges.unionByName(compared(more))


def classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """docs: doc_id, text. For each text that is not null: k64, k32 and best, the (is null, doc_id, k64, k32) that comes first in its class."""
    keyed = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("k64"), F.hash("text").alias("k32"))
    roots = components(alike(distinct_texts(docs), docs.count(), threshold, bands, rows))
    roots = roots.select("node.*", F.col("root.k64").alias("r64"), F.col("root.k32").alias("r32"))
    own = keyed.groupBy("k64", "k32").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("first"))
    own = own.select("k64", "k32", F.struct("first.none", "first.doc_id", "k64", "k32").alias("first")).join(roots, ["k64", "k32"], "left")
    own = written(own.withColumns({"r64": F.coalesce("r64", "k64"), "r32": F.coalesce("r32", "k32")}), "nodes")
    best = written(own.groupBy("r64", "r32").agg(F.min("first").alias("best"), F.count("*").alias("texts")).where("texts > 1").drop("texts"), "classes")
    return written(own.join(best, ["r64", "r32"], "left").select("k64", "k32", F.coalesce("best", "first").alias("best")), "classes-of-texts")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """docs: doc_id, text. One row a document: doc_id, class_id (least doc_id of its class), kept (it is that one)."""
    docs = docs.select("doc_id", "text")
    found = classes(docs, threshold, bands, rows).select("k64", "k32", F.col("best.doc_id").alias("class_id"))
    keyed = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("k64"), F.hash("text").alias("k32"))
    out = keyed.join(found, ["k64", "k32"]).select("doc_id", "class_id")
    out = out.unionByName(docs.where("text is null").select("doc_id", F.col("doc_id").alias("class_id")))
    return out.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, one of each class (that with the least doc_id) and those without a text, with all columns."""
    best = classes(docs.select("doc_id", "text"), threshold).where("best.k64 = k64 and best.k32 = k32")
    best = best.select(F.col("best.doc_id").alias("best_id"), F.col("k64").alias("b64"), F.col("k32").alias("b32"))
    rows = docs.where("text is not null").select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("k64"), F.hash("text").alias("k32"))
    rows = rows.join(best, F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("k64") == F.col("b64")) & (F.col("k32") == F.col("b32")), "left_semi")
    nth = F.row_number().over(Window.partitionBy("doc_id", "k64", "k32").orderBy(F.lit(0)))  # repeated rows
    return rows.withColumn("nth", nth).where("nth = 1").select("row.*").unionByName(docs.where("text is null"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


OP10_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, text, regexp_extract_all(text, '{WORD}') AS ws FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, array_to_string(ws[i : i + {SHINGLE - 1}], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {SHINGLE - 1}, least(len(ws), 1)) + 1)) AS i FROM w)),
tf AS (SELECT doc_id, s, count(*) AS tf FROM p GROUP BY doc_id, s),
t AS (SELECT (SELECT count(*) FROM documents) AS n, count(*) / {float(1 << FREQUENT)!r} AS low FROM tf),
idf AS (SELECT s, ln(1 + n / CASE WHEN count(*) > low THEN count(*) ELSE greatest(low, 1) END) AS idf FROM tf, t GROUP BY s, n, low),
x AS (SELECT doc_id, s, tf * idf AS wt FROM tf JOIN idf USING (s)),
total AS (SELECT doc_id, sum(wt) AS wt FROM x GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.wt, b.wt)) AS m FROM x a JOIN x b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN total ta ON a = ta.doc_id JOIN total tb ON b = tb.doc_id WHERE m / (ta.wt + tb.wt - m) >= {THRESHOLD}
  UNION SELECT d.doc_id, e.doc_id FROM documents d JOIN documents e ON d.text = e.text AND d.doc_id <> e.doc_id),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
c AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(low, doc_id)) AS class_id, doc_id = least(doc_id, coalesce(low, doc_id)) AS kept FROM documents LEFT JOIN c ON a = doc_id
"""

"""Removal of passages that occur more than once, at the grain of words.

Every window of `width` words gets a Rabin-Karp hash. Windows go to the task that counts them by the least hash of the
eight-word runs inside (their anchor): equal windows have equal anchors, and neighbours mostly share theirs, so some
fourteen windows travel as one run with one reference, whatever the number of tasks. Each mapper resolves repeats it
sees itself and sends each hash once, so a passage that fills a third of the corpus reaches its counter as one hash a
mapper slice. Repeated windows come back as intervals, which merge into maximal removal intervals for each text.

Exact as far as 64-bit hashes are: n windows give about n**2 / 2**65 false repeats (5e-4 at 1.3e8 windows).
Null and empty texts have no words. Equal rows count as separate places, so all copies of a text of `width` words or
more go entirely. Shorter texts stay whole. Other columns play no part, and pass through; dedup_substrings() puts its counts in the place of columns
named n_words and n_removed, if it is asked for counts. A text is joined with its removals by its key in a plain join of two exchanges, which
adaptive execution can split where a text is very common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, documents, lists, mix, rolling, shuffle_partitions, sliding_min, spread, text_slices, word_hashes, word_spans, written

WIDTH = 35
ANCHOR = 8

_RUNS = pa.schema([("bucket", pa.int32()), ("k64", pa.binary()), ("k32", pa.binary()), ("start", pa.binary()), ("n", pa.binary()), ("hashes", pa.binary()), ("known", pa.bool_())])
_FOUND = pa.schema([("k64", pa.int64()), ("k32", pa.int32()), ("start", pa.int32()), ("n", pa.int32())])


def _breaks(*columns: np.ndarray) -> np.ndarray:
    """Indices at which any column changes, 0 included."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _runs_of(positions: np.ndarray, row: np.ndarray, bucket: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of consecutive positions of one row (and bucket): index of the first, and length."""
    step = positions - np.arange(len(positions))
    at = _breaks(step, row, *(() if bucket is None else (bucket,)))
    return at, np.diff(np.append(at, len(positions)))


def _map_windows(width: int, buckets: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, "text", 4 << 20):
                starts, ends, counts = word_spans(data, off)
                h = word_hashes(data, starts, ends)
                if len(h) < width:
                    continue
                row = np.repeat(np.arange(len(counts)), counts)
                first = np.repeat(np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
                whole = np.flatnonzero(row[: len(h) - width + 1] == row[width - 1 :])
                if not len(whole):
                    continue
                hashes = rolling(h, width)[whole]
                least = sliding_min(rolling(h, anchor), width - anchor + 1)[whole]
                bucket = (mix(least) % np.uint64(buckets)).astype(np.int32)
                row, pos = row[whole], (np.arange(len(h)) - first)[whole].astype(np.int64)
                k64 = rows.column("k64").to_numpy(zero_copy_only=False)
                k32 = rows.column("k32").to_numpy(zero_copy_only=False)

                order = np.argsort(hashes)
                same = hashes[order][1:] == hashes[order][:-1]
                again = np.zeros(len(hashes), bool)
                again[order[1:][same]] = True
                again[order[:-1][same]] = True
                out = {n: [] for n in _RUNS.names}

                def put(b, r, start, n, hh, known, k64=k64, k32=k32, out=out):
                    for name, x in zip(_RUNS.names, (b, k64[r].tobytes(), k32[r].astype(np.int32).tobytes(), start.astype(np.uint32).tobytes(), n.astype(np.uint32).tobytes(), hh.tobytes(), known), strict=True):
                        out[name].append(x)

                if again.any():
                    at, n = _runs_of(pos[again], row[again])
                    put(int(k64[0] % buckets), row[again][at], pos[again][at], n, np.zeros(0, np.uint64), True)
                once = ~again
                at, n = _runs_of(pos[once], row[once], bucket[once])
                run_bucket, run_row, run_pos = bucket[once][at], row[once][at], pos[once][at]
                by = np.argsort(run_bucket, kind="stable")
                cuts = np.searchsorted(run_bucket[by], np.arange(buckets + 1))
                only = hashes[once]
                witness = order[1:][same & ~np.concatenate([[False], same[:-1]])] if len(same) else order[:0]
                witness = witness[np.argsort(bucket[witness], kind="stable")]
                seen = np.searchsorted(bucket[witness], np.arange(buckets + 1))
                for b in range(buckets):
                    mine, more = by[cuts[b] : cuts[b + 1]], witness[seen[b] : seen[b + 1]]
                    if len(mine) or len(more):
                        put(b, run_row[mine], run_pos[mine], n[mine], np.concatenate([only[spread(at[mine], n[mine])], hashes[more], hashes[more]]), False)
                yield pa.record_batch([pa.array(out[f.name], f.type) for f in _RUNS], schema=_RUNS)

    return run


def _count_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over all rows of some buckets: which referenced windows have a hash that occurs again. Hashes beyond the runs' lengths are witnesses without a reference, each given twice."""
    refs, hashes, bare = [], [], []
    for batch in batches:
        get = {n: batch.column(n) for n in _RUNS.names}
        for i in range(batch.num_rows):
            k64, k32, start, n = (np.frombuffer(get[c][i].as_py(), t) for c, t in (("k64", np.int64), ("k32", np.int32), ("start", np.uint32), ("n", np.uint32)))
            if get["known"][i].as_py():
                yield pa.record_batch([k64, k32, start.astype(np.int32), n.astype(np.int32)], schema=_FOUND)
                continue
            h = np.frombuffer(get["hashes"][i].as_py(), np.uint64)
            total = int(n.sum())
            refs.append((k64, k32, start, n))
            hashes.append(h[:total])
            bare.append(h[total:])
    if not refs:
        return
    k64, k32, start, n = (np.concatenate(x) for x in zip(*refs, strict=True))
    own = np.concatenate(hashes)
    every = np.concatenate([own, *bare])
    del refs, hashes, bare
    order = np.argsort(every)
    same = every[order][1:] == every[order][:-1]
    again = np.zeros(len(every), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    hit = np.flatnonzero(again[: len(own)])
    if len(hit):
        run = np.repeat(np.arange(len(n)), n)
        pos = start[run].astype(np.int64) + (np.arange(len(own)) - np.repeat(np.cumsum(n, dtype=np.int64) - n, n))
        at, length = _runs_of(pos[hit], run[hit])
        r = run[hit][at]
        for i in range(0, len(at), 100_000):
            s = slice(i, i + 100_000)
            yield pa.record_batch([k64[r[s]], k32[r[s]], pos[hit][at[s]].astype(np.int32), length[s].astype(np.int32)], schema=_FOUND)


def keyed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns, and the text with a 96-bit key of it, under names that cannot clash with theirs."""
    return docs.select(F.struct(*(docs[c] for c in keep)).alias("row"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("k64"), F.hash("text").alias("k32"))


def repeated_windows(texts: DataFrame, width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """(k64, k32, start, n): for each text key, runs of window starts whose window occurs again. texts: k64, k32, text."""
    n = shuffle_partitions(texts.sparkSession)
    runs = texts.select("k64", "k32", "text").where("text is not null").mapInArrow(_map_windows(width, n, min(anchor, width)), "bucket int, k64 binary, k32 binary, start binary, n binary, hashes binary, known boolean")
    return runs.repartitionById(n, "bucket").mapInArrow(_count_windows, "k64 long, k32 int, start int, n int")


def removals(rows: DataFrame, width: int = WIDTH, fn=None, schema: str = "") -> DataFrame:
    """Joins each text with its repeated windows and applies fn(row struct array, texts, kept word lists, n_words, n_removed)."""
    found = repeated_windows(rows, width).groupBy("k64", "k32", "start").agg(F.max("n").alias("n"))
    found = written(found.groupBy("k64", "k32").agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("ns")), "removals")
    return rows.join(found, ["k64", "k32"], "left").select("row", "text", "starts", "ns").mapInArrow(fn, schema)


def kept_words(batch: pa.RecordBatch, width: int) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """For each row, all words and those that no repeated window covers."""
    soff, starts = lists(batch.column("starts"))
    _, ns = lists(batch.column("ns"))
    for i, text in enumerate(batch.column("text")):
        words = (text.as_py() or "").encode().split()
        a, b = soff[i], soff[i + 1]
        if a == b:
            yield words, words
            continue
        edge = np.zeros(len(words) + 1, np.int32)
        np.add.at(edge, starts[a:b], 1)
        np.add.at(edge, starts[a:b] + ns[a:b] + (width - 1), -1)
        stay = np.cumsum(edge)[:-1] == 0
        yield words, [words[k] for k in np.flatnonzero(stay)]


def dedup_substrings(docs: DataFrame, width: int = WIDTH, counts: bool = True) -> DataFrame:
    """All columns of docs, the text cut to the words that no repeated window covers (joined by one space where anything was cut, else unchanged), and with `counts` n_words, n_removed."""
    if counts:
        docs = docs.drop("n_words", "n_removed")
    columns = [c for c in docs.columns if c != "text"]
    kind = docs.select(*columns).schema.simpleString() if columns else "struct<>"

    def cut(batches):
        for batch in batches:
            texts, total, gone = [], [], []
            for text, (words, kept) in zip(batch.column("text"), kept_words(batch, width), strict=True):
                texts.append(text.as_py() if len(words) == len(kept) else b" ".join(kept).decode())
                total.append(len(words))
                gone.append(len(words) - len(kept))
            yield pa.record_batch([batch.column("row"), pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())], names=["row", "text", "n_words", "n_removed"])

    out = removals(keyed(docs, columns), width, cut, f"row {kind}, text string, n_words long, n_removed long")
    return out.select(*(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns), *(["n_words", "n_removed"] if counts else []))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digest(batches):
        for batch in batches:
            total, left, sums = [], [], []
            for words, kept in kept_words(batch, WIDTH):
                total.append(len(words))
                left.append(len(words) - len(kept))
                sums.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.record_batch([batch.column("row").field("doc_id"), pa.array(total, pa.int64()), pa.array(left, pa.int64()), pa.array(sums, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return removals(keyed(documents(spark, sf_dir), ["doc_id"]), WIDTH, digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


OP1_SQL = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {WIDTH} + 2)) AS s FROM w WHERE len(ws) >= {WIDTH}),
x AS (SELECT doc_id, s, sha256(array_to_string(ws[s : s + {WIDTH - 1}], ' ')) AS h FROM p),
r AS (SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY h) AS c FROM x) WHERE c > 1),
g AS (SELECT DISTINCT doc_id, s + o AS i FROM r, (SELECT unnest(range(0, {WIDTH})) AS o)),
gone AS (SELECT doc_id, list(i) AS cut FROM g GROUP BY doc_id),
k AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(len(cut), 0) AS n_removed,
  CASE WHEN cut IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(cut, i)) END AS kept
  FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""

"""Token ids in files: canonical length-limited Huffman codes, blocks that decode on their own.

Format: a Parquet table of segments, each a run of whole documents: `part`, `seq` (their order), `first` (ids before it
in the part), `doc_ids` (int64) with `has_id` (uint8), `doc_counts` (uint32), `checkpoints` (uint64: bit offset of each block of 256 ids) and
`payload` (the codes, most significant bit first, padded to bytes). The code table is the bit length of every id, kept in a
second table; codes follow from lengths in the canonical way. Lengths are optimal for the counts of all ids of all
documents under the limit (package-merge), and the decoder's table has one entry for each bit string of that length.
A block decodes from its checkpoint alone, and a decoder steps through all blocks of a segment at once.

Null and empty texts hold the end id alone. An empty table gives empty files and an empty result. Equal doc_ids follow
one another in an order set by a hash of their ids. Very long documents make one segment each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, packed, shuffle_partitions, spread, text_slices, written
from .vocabularies import tokenizer_path
from .word_ids import unit_ids

BLOCK = 256
LIMIT = 16
SEGMENT = 1 << 19
END_ID = 1
SLICE = 4 << 20

_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("n", pa.int64())])
_SEGMENTS = "part int, seq int, first long, doc_ids binary, has_id binary, doc_counts binary, checkpoints binary, payload binary"


def width_of(path: str, end_id: int = END_ID) -> type:
    """The unsigned type that holds a tokenizer's ids."""
    return np.uint16 if max(unit_ids(path).size - 1, end_id) < 1 << 16 else np.uint32


def _encode_texts(path: str, end_id: int, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, "text", SLICE):
                ids, counts = unit_ids(path).encode(data, off, end_id)
                ids, cuts = ids.astype(kind), np.concatenate([[0], np.cumsum(counts)])
                texts = [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.record_batch([rows.column("doc_id"), pa.array(texts, pa.binary()), pa.array(counts)], schema=_IDS)

    return run


def token_ids(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, ids (little-endian, of width_of()), n."""
    return docs.select("doc_id", "text").mapInArrow(_encode_texts(path, end_id, width_of(path, end_id)), "doc_id long, ids binary, n long")


def _count_ids(kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            flat, _ = packed(batch.column("ids"), kind)
            for i in range(0, len(flat), SEGMENT):
                more = np.bincount(flat[i : i + SEGMENT])
                if len(more) > len(counts):
                    counts = np.concatenate([counts, np.zeros(len(more) - len(counts), np.int64)])
                counts[: len(more)] += more
        at = np.flatnonzero(counts)
        if len(at):
            yield pa.record_batch([at, counts[at]], names=["id", "n"])

    return run


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Bits of each id's code: optimal among prefix codes of at most `limit` bits. Ids that do not occur get 0."""
    out = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        out[used] = 1
        return out
    limit = max(limit, int(np.ceil(np.log2(len(used)))))
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.float64)
    levels, packages = [], np.zeros(0)
    for _ in range(limit):
        merged = np.concatenate([leaves, packages])
        order = np.argsort(merged, kind="stable")
        levels.append(order < len(leaves))
        merged = merged[order]
        packages = merged[0 : len(merged) // 2 * 2 : 2] + merged[1 : len(merged) // 2 * 2 : 2]
    take, lengths = 2 * len(leaves) - 2, np.zeros(len(leaves), np.uint8)
    for is_leaf in reversed(levels):
        mine = int(is_leaf[:take].sum())
        lengths[:mine] += 1
        take = 2 * (take - mine)
    out[used] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then id."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    if len(used):
        most = int(lengths[used[-1]])
        space = np.uint64(1) << (np.uint64(most) - lengths[used].astype(np.uint64))
        codes[used] = (np.cumsum(space) - space) >> (np.uint64(most) - lengths[used].astype(np.uint64))
    return codes


def encode_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, block: int = BLOCK) -> tuple[bytes, np.ndarray]:
    """The bits of all codes, and the bit offset of each block."""
    n = lengths[ids].astype(np.int64)
    ends = np.cumsum(n)
    starts = ends - n
    words = int(ends[-1] + 31) // 32 + 1 if len(ids) else 0
    placed = codes[ids] << (64 - n - (starts & 31)).astype(np.uint64)
    at = starts >> 5
    # Codes share no bits, so sums are unions; they stay below 2**32 and so are exact in doubles.
    high = np.bincount(at, weights=(placed >> np.uint64(32)).astype(np.float64), minlength=words).astype(np.uint64)
    low = np.bincount(at + 1, weights=(placed & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=words + 1).astype(np.uint64)[: words + 1]
    both = (high + low[: len(high)]).astype(">u4").tobytes()
    return both[: (int(ends[-1]) + 7) // 8 if len(ids) else 0], starts[::block].astype(np.uint64)


class Decoder:
    """A table with an entry for every string of as many bits as the longest code has."""

    def __init__(self, lengths: np.ndarray):
        self.bits = int(lengths.max()) if len(lengths) else 0
        used = np.flatnonzero(lengths)
        used = used[np.argsort(lengths[used], kind="stable")]
        span = np.int64(1) << (self.bits - lengths[used].astype(np.int64))
        self.ids = np.repeat(used.astype(np.uint32), span)
        self.lengths = np.repeat(lengths[used].astype(np.int64), span)
        if len(self.ids) < 1 << self.bits:
            self.ids = np.concatenate([self.ids, np.zeros((1 << self.bits) - len(self.ids), np.uint32)])
            self.lengths = np.concatenate([self.lengths, np.ones((1 << self.bits) - len(self.lengths), np.int64)])

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
        b = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint64)
        five = b[:-4] << np.uint64(32) | b[1:-3] << np.uint64(24) | b[2:-2] << np.uint64(16) | b[3:-1] << np.uint64(8) | b[4:]
        at = checkpoints.astype(np.int64)
        out = np.zeros((block, len(at)), np.uint32)
        mask, end = (1 << self.bits) - 1, len(payload) * 8
        for k in range(block):
            at = np.minimum(at, end)
            key = (five[at >> 3] >> (40 - self.bits - (at & 7)).astype(np.uint64)).astype(np.int64) & mask
            out[k] = self.ids[key]
            at = at + self.lengths[key]
        return out.T.reshape(-1)[:n]


def _write_segments(lengths: bytes, segment: int, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(lengths, np.uint8)
        codes = canonical_codes(bits)
        state = {"seq": 0, "first": 0}

        def put(part, docs, ids):
            flat = np.concatenate(ids)
            payload, checkpoints = encode_bits(flat, bits, codes)
            known = np.array([d is not None for d in docs], np.uint8)
            row = (part, state["seq"], state["first"], np.array([d or 0 for d in docs], np.int64).tobytes(), known.tobytes(), np.array([len(x) for x in ids], np.uint32).tobytes(), checkpoints.tobytes(), payload)
            state["seq"] += 1
            state["first"] += len(flat)
            kinds = (pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5)
            return pa.record_batch([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=[c.split()[0] for c in _SEGMENTS.split(", ")])

        docs, ids, held, part = [], [], 0, 0
        for batch in batches:
            for p, d, x in zip(batch.column("part"), batch.column("doc_id"), batch.column("ids"), strict=True):
                part = p.as_py()
                docs.append(d.as_py())
                ids.append(np.frombuffer(x.as_py(), kind))
                held += len(ids[-1])
                if held >= segment:
                    yield put(part, docs, ids)
                    docs, ids, held = [], [], 0
        if docs:
            yield put(part, docs, ids)

    return run


def _read_segments(lengths: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(np.frombuffer(lengths, np.uint8))
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name, batch=batch, i=i: batch.column(name)[i].as_py()
                counts = np.frombuffer(get("doc_counts"), np.uint32).astype(np.int64)
                ids = decoder.decode(get("payload"), np.frombuffer(get("checkpoints"), np.uint64), int(counts.sum()))
                ends = np.cumsum(counts)
                known = np.frombuffer(get("has_id"), np.uint8) == 0
                yield pa.record_batch(
                    [pa.array(np.full(len(counts), get("part"), np.int32)), pa.array(np.frombuffer(get("doc_ids"), np.int64), mask=known), pa.array(get("first") + ends - counts), pa.array(counts), pa.array([ids[a:b].tobytes() for a, b in zip(ends - counts, ends, strict=True)], pa.binary())],
                    names=["part", "doc_id", "at", "n_tokens", "ids"],
                )

    return run


def write_token_files(ids: DataFrame, kind: type, limit: int = LIMIT, segment: int = SEGMENT) -> tuple[DataFrame, bytes]:
    """Writes ids (of token_ids(), in a table; kind: width_of() its tokenizer) as segments in ascending doc_id order: the file table and the code lengths."""
    spark = ids.sparkSession
    found = ids.select("ids").mapInArrow(_count_ids(kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # at most the vocabulary
    counts = np.zeros(max((r.id for r in found), default=-1) + 1, np.int64)
    for r in found:
        counts[r.id] = r.n
    lengths = code_lengths(counts, limit).tobytes()
    rows = ids.select("doc_id", "ids", F.xxhash64("ids").alias("tie"))
    rows = rows.repartitionByRange(shuffle_partitions(spark), F.col("doc_id").asc_nulls_first(), "tie").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
    return written(rows.select(F.spark_partition_id().alias("part"), "doc_id", "ids").mapInArrow(_write_segments(lengths, segment, kind), _SEGMENTS), "token-files"), lengths


def read_token_files(files: DataFrame, lengths: bytes) -> DataFrame:
    """doc_id, start, n_tokens, ids, from the files alone."""
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    rows = files.mapInArrow(_read_segments(lengths), "part int, doc_id long, at long, n_tokens long, ids binary")
    ids_in = files.select("part", F.col("first"), "doc_counts").mapInArrow(_part_ends, "part int, n long").groupBy("part").agg(F.max("n").alias("n"))
    parts = ids_in.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    # One row a file, and there are as many files as shuffle partitions: small enough to send, so that ids need not be shuffled.
    return rows.join(F.broadcast(parts), "part").select("doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids")


def _part_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [f.as_py() + int(np.frombuffer(c.as_py(), np.uint32).sum(dtype=np.int64)) for f, c in zip(batch.column("first"), batch.column("doc_counts"), strict=True)]
        yield pa.record_batch([batch.column("part"), pa.array(n, pa.int64())], names=["part", "n"])


def _crc_of_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = [zlib.crc32(x.as_buffer()) for x in batch.column("ids")]
        yield pa.record_batch([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("word_bpe_49k.json")
    ids = written(token_ids(documents(spark, sf_dir), path), "token-ids")
    files, lengths = write_token_files(ids, width_of(path))
    return read_token_files(files, lengths).mapInArrow(_crc_of_ids, "doc_id long, start long, n_tokens long, ids_crc32 long")

"""What the training-data operators share: shared folders, word spans and hashes over Arrow buffers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than these (space, tab to carriage return).
WORD = r"[^\x20\x09-\x0D]+"
U64 = np.uint64


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset, a new local one, on one machine only (tests)."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if found.isDefined():
            return found.get()
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        place = tempfile.mkdtemp(prefix="quirework-")
        spark.sparkContext.setCheckpointDir(place)
    return place


def written(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The rows, kept as a Parquet table in the shared folder: later jobs read them from there, and a lost executor costs nothing but its tasks. by: columns with a folder for each value, so that a job that asks for one reads no other."""
    spark = df.sparkSession
    place = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*by).parquet(place)
    return spark.read.schema(df.schema).parquet(place)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text="text"):
    """96 bits that stand for a text: at 3e10 texts the odds of any clash are about 1 in 1e8."""
    return F.struct(F.xxhash64(text).alias("k64"), F.hash(text).alias("k32"))


def text_slices(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cuts a batch into runs of whole rows of about `limit` bytes of text: the rows, the UTF-8 bytes and the row offsets. A null text is empty."""
    texts = batch.column(batch.schema.get_field_index(column))
    if texts.type != pa.large_binary():
        texts = texts.cast(pa.large_string()) if texts.type == pa.string() else texts
    texts = texts.fill_null("" if pa.types.is_large_string(texts.type) else b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + limit, side="right")) - 1)
        j = min(j, len(texts))
        yield batch.slice(i, j - i), data[ends[i] : ends[j]], ends[i : j + 1] - ends[i]
        i = j


SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in the bytes of several rows, and how many words each row has."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off) - 1, np.int64)
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    at = off[:-1][off[:-1] < len(data)]
    first[at] = inside[at]
    at = off[1:][off[1:] > 0] - 1
    last[at] = inside[at]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.diff(np.searchsorted(starts, off))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight bytes a step over all words together."""
    left = ends - starts
    out = left.astype(np.uint64) * U64(0x9E3779B97F4A7C15)
    if not len(starts):
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.lib.stride_tricks.as_strided(padded, shape=(len(data), 8), strides=(1, 1))
    at, todo, step = starts, np.arange(len(starts)), 0
    while len(todo):
        part = np.ascontiguousarray(eights[at]).view(np.uint64).ravel() & _MASKS[np.minimum(left, 8)]
        out[todo] = mix(out[todo] ^ part) + U64(step)
        more = left > 8
        todo, at, left, step = todo[more], at[more] + 8, left[more] - 8, step + 1
    return out


class Lookup:
    """Places of 64-bit hashes in a sorted table of such hashes. The first bits tell where to look; as hashes are spread evenly, few steps are left from there."""

    def __init__(self, keys: np.ndarray):
        bits = len(keys).bit_length() + 1
        self.n, self.shift, self.keys = len(keys), U64(64 - bits), np.append(keys, ~U64(0))
        self.first = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def __call__(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash stands, as np.searchsorted has it, and whether it is there."""
        at = self.first.take((h >> self.shift).view(np.int64))
        todo = np.flatnonzero(self.keys.take(at) < h)
        left = h.take(todo)
        while len(todo):
            next_ = at.take(todo) + 1
            at[todo] = next_
            on = self.keys.take(next_) < left
            todo, left = todo[on], left[on]
        return at, (self.keys.take(at) == h) & (at < self.n)


def rolling(h: np.ndarray, width: int, base: int = 0xD1342543DE82EF95) -> np.ndarray:
    """Rabin-Karp: the polynomial hash, modulo 2**64, of each run of `width` values of h; one prefix sum serves all runs."""
    n = len(h)
    if n < width:
        return np.zeros(0, np.uint64)
    power = np.full(n, base, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(h * power, out=total[1:])
    back = np.full(n - width + 1, pow(base, -1, 1 << 64), np.uint64)
    back[0] = 1
    return mix((total[width:] - total[:-width]) * np.multiply.accumulate(back))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of `width` values, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out, have = np.minimum(out[: len(out) - step], out[step:]), have + step
    return out


def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and flat values of a list column; a null list is empty."""
    column = column.fill_null(pa.scalar([], column.type)) if column.null_count else column
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return off, column.values.to_numpy(zero_copy_only=False)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices starts[0], starts[0]+1, ... counts[0] of them, then those of the next."""
    total = int(counts.sum())
    base = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else starts, counts)
    return base + np.arange(total)


class Table(dict):
    """Numbers for keys as they come, and an array of ids for each."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.new: list = []
        self.flat, self.starts, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __missing__(self, key):
        self[key] = at = len(self)
        self.new.append(key)
        return at

    def learn(self, flat: np.ndarray, counts: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
        self.counts, self.flat, self.new = np.concatenate([self.counts, counts]), np.concatenate([self.flat, flat.astype(np.int32)]), []

    def ids(self, at: np.ndarray) -> np.ndarray:
        return self.flat[spread(self.starts[at], self.counts[at])]


def packed(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of packed ones, and how many each row has; without copies."""
    large = pa.types.is_large_binary(column.type)
    ends = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    size = np.dtype(kind).itemsize
    return (np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(kind) if data is not None else np.zeros(0, kind)), np.diff(ends) // size

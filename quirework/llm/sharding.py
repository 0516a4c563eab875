"""Sharding by best-fit-decreasing bin packing.

Indivisible groups (rows of equal text) enter, largest first, the shard with the tightest remaining capacity that still
holds them; a balanced tree over the remaining capacities finds it. Groups of equal size are alike to the packer, so
it works on (size, count) classes: the driver holds one entry for each distinct group size, at most sqrt(2 * bytes) of
them and in practice no more than the largest text has bytes, however many groups there are. Rows learn their place
from their group's rank among equals, which is counted in parts, so no task sees a whole class, group or shard.

A group above half of a shard's even share would spoil the balance and may hold a third of all rows: it is split by
row into pieces of about a sixteenth of a share (at most 2 * n_shards groups are so large; only their keys are broadcast). A single row
above the even share gets a shard of its own and the others divide the rest.
Null texts count as empty ones; an empty table gives an empty result; repeated rows are rows like others; with more shards than groups some stay empty.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, shuffle_partitions, written

N_SHARDS = 16
PARTS = 64


class CapacityTree:
    """An AA tree (balanced) of (remaining capacity, bin)."""

    def __init__(self) -> None:
        self.root = None

    @staticmethod
    def _skew(t):
        if t and t[2] and t[2][1] == t[1]:
            left = t[2]
            t[2], left[3] = left[3], t
            return left
        return t

    @staticmethod
    def _split(t):
        if t and t[3] and t[3][3] and t[3][3][1] == t[1]:
            right = t[3]
            t[3], right[2] = right[2], t
            right[1] += 1
            return right
        return t

    def add(self, key: tuple[int, int]) -> None:
        def put(t):
            if t is None:
                return [key, 1, None, None]
            side = 2 if key < t[0] else 3
            t[side] = put(t[side])
            return self._split(self._skew(t))

        self.root = put(self.root)

    def remove(self, key: tuple[int, int]) -> None:
        def cut(t, key):
            if t is None:
                return None
            if key < t[0]:
                t[2] = cut(t[2], key)
            elif key > t[0]:
                t[3] = cut(t[3], key)
            elif t[2] is None and t[3] is None:
                return None
            elif t[2] is None:
                low = t[3]
                while low[2]:
                    low = low[2]
                t[0] = low[0]
                t[3] = cut(t[3], low[0])
            else:
                high = t[2]
                while high[3]:
                    high = high[3]
                t[0] = high[0]
                t[2] = cut(t[2], high[0])
            level = min(t[2][1] if t[2] else 0, t[3][1] if t[3] else 0) + 1
            if level < t[1]:
                t[1] = level
                if t[3] and level < t[3][1]:
                    t[3][1] = level
            t = self._skew(t)
            if t[3]:
                t[3] = self._skew(t[3])
                if t[3][3]:
                    t[3][3] = self._skew(t[3][3])
            t = self._split(t)
            if t[3]:
                t[3] = self._split(t[3])
            return t

        self.root = cut(self.root, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The least (remaining, bin) with remaining >= size."""
        t, best = self.root, None
        while t:
            if t[0][0] >= size:
                best, t = t[0], t[2]
            else:
                t = t[3]
        return best


def best_fit_decreasing(classes: Iterable[tuple[int, int]], capacity: int, most_bins: int | None = None) -> list[tuple[int, int, int, int]] | None:
    """Packs `count` groups of each `size` into bins of one capacity: (size, first, n, bin), where groups first to first+n-1 of that size go to the bin.

    Same bins as placing the groups singly: the bin that took a group is still the tightest for the next of that size while it fits. A group above
    the capacity fills a bin alone. None if it takes more than most_bins.
    """
    tree, out, bins = CapacityTree(), [], 0
    for size, count in sorted(classes, reverse=True):
        first = 0
        while first < count:
            if found := tree.tightest(size):
                tree.remove(found)
                room, where = found
            else:
                if bins == most_bins:
                    return None
                room, where, bins = max(capacity, size), bins, bins + 1
            n = min(count - first, room // size) if size else count - first
            out.append((size, first, n, where))
            tree.add((room - n * size, where))
            first += n
    return out


def even_shards(classes: list[tuple[int, int]], n_shards: int) -> list[tuple[int, int, int, int]]:
    """Best-fit-decreasing at the least capacity, to the byte or nearly, for which n_shards suffice."""
    left = sorted(classes, reverse=True)
    total, free, out = sum(s * n for s, n in left), n_shards, []
    while left and free > 1 and left[0][0] * free > total:  # a group above the even share of what is left
        size, n = left[0]
        alone = min(n, free - 1)
        out += [(size, i, 1, n_shards - free + i) for i in range(alone)]
        total, free = total - size * alone, free - alone
        left = ([(size, n - alone)] if n > alone else []) + left[1:]
    if not left:
        return out
    low = max(-(-total // free), left[0][0])
    high, found = low, None
    step = max(1, low >> 12)
    while (found := best_fit_decreasing(left, high, free)) is None:
        low, high, step = high + 1, high + step, step * 2
    for _ in range(12):
        if low >= high:
            break
        mid = (low + high) // 2
        if (better := best_fit_decreasing(left, mid, free)) is None:
            low = mid + 1
        else:
            found, high = better, mid
    shift = {s: sum(1 for x in out if x[0] == s) for s, *_ in found}
    return out + [(s, f + shift[s], n, b + n_shards - free) for s, f, n, b in found]


def ranked(rows: DataFrame, by: list[str], order: list[Column], name: str, parts: int) -> DataFrame:
    """Adds `name`: 0, 1, 2, ... within `by`, gapless, from a rank within each of `parts` parts and the sizes of the parts before."""
    rows = rows.withColumn("part_", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    before = Window.partitionBy(*by).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*by, "part_").agg(F.count("*").alias("n_")).withColumn("from_", F.coalesce(F.sum("n_").over(before), F.lit(0))).drop("n_")
    rank = F.row_number().over(Window.partitionBy(*by, "part_").orderBy(*order))
    return rows.withColumn("rank_", rank).join(starts, [*by, "part_"]).withColumn(name, F.col("from_") + F.col("rank_") - 1).drop("part_", "rank_", "from_")


def pack_shards(rows: DataFrame, n_shards: int = N_SHARDS, parts: int = PARTS) -> DataFrame:
    """rows: row (a struct that identifies the row), size, key (of its group). Adds shard, and slot, gapless from 0 within the shard."""
    spark = rows.sparkSession
    rows = written(rows, "shard-rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    large = rows.groupBy("key").agg(F.sum("size").alias("group_size"), F.count("*").alias("n")).where((F.col("group_size") * 2 * n_shards > total) & (F.col("n") > 1))
    large = large.select("key", F.ceil(F.col("group_size") * 16 * n_shards / F.lit(max(total, 1))).alias("pieces"))
    rows = rows.join(F.broadcast(large), "key", "left").withColumn("piece", F.coalesce(F.pmod(F.xxhash64("row"), F.col("pieces")), F.lit(0))).drop("pieces")
    groups = rows.groupBy("key", "piece").agg(F.sum("size").alias("group_size"))
    groups = written(ranked(groups, ["group_size"], [F.col("key"), F.col("piece")], "nth", parts), "shard-groups")
    classes = [tuple(r) for r in groups.groupBy("group_size").count().collect()]
    plan = spark.createDataFrame(even_shards(classes, n_shards), "group_size long, first long, n long, shard int")
    placed = groups.join(plan, "group_size").where("nth >= first and nth < first + n").select("key", "piece", "shard")
    out = rows.join(placed, ["key", "piece"]).drop("key", "piece")
    return ranked(out, ["shard"], [F.col("row")], "slot", max(parts, shuffle_partitions(spark) // n_shards))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    size, crc = F.octet_length(text).cast("long") + 1, F.crc32(F.encode(text, "UTF-8"))
    rows = documents(spark, sf_dir).select(F.struct("doc_id", crc.alias("text_crc32")).alias("row"), size.alias("size"), F.unhex(F.sha2(text, 256)).alias("key"))
    return pack_shards(rows).select("row.doc_id", "size", "row.text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))

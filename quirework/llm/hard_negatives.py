"""Hard negatives by a two-dimensional block matrix multiply.

Rows are cut into shards of at most ROWS vectors, anchors into shards of at most ANCHORS, and both into chunks of CHUNK dimensions. Each pair of
an anchor shard and a row shard meets once for each chunk and gives a partial tile of 64-bit scores; the partial tiles of a pair are
shuffled together, added, and the sum is reduced at once to a few rows for each anchor, so that no tile outlives its task. The product is taken twice:
first for pairs of shards that share a label, which gives each anchor's positives, then for all pairs, which gives the
negatives within the windows that the positives' scores set. Every anchor meets every row; the anchors are a stated set of queries.

Components become floor(scale * x); scores are exact 64-bit inner products (in 64-bit arithmetic that wraps around, for components beyond all use). Higher scores
come first, ties by smaller vec_id. Rows with a null label, a null vector or a null or non-finite component take no part; neither do rows without a vec_id and
empty vectors. Vectors of different lengths have no inner product and do not meet. Repeated rows are rows like others: a copy of an anchor
can be its positive, and equal ids come once for each row. Anchors without positives, and positives without negatives in their window, have no rows. Other columns play no part.
Shards are cut from rows in order of label, so one label may hold all rows: its shards are as small as any.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from .common import lists, shuffle_partitions, written

SCALE = 256
ROWS, ANCHORS, CHUNK = 1024, 256, 32
POSITIVES = NEGATIVES = 5
#: A negative's score lies between this share of its positive's score, in per cent, and the score itself.
LEAST = 80

_SHARDS = "shard long, d int, chunk int, rids binary, ids binary, labels binary, x binary, width int, names array<long>, members array<long>"
_FOUND = "rid long, anchor_id long, id long, score long"
_WINDOWS = "rid long, anchor_id long, place int, positive_id long, positive_score long, id long, score long"


def sound_rows(vectors: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """vec_id, label and q, the quantised vector, of the rows that take part. Components are cut off at 2**62."""
    sound = F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound & (F.size("embedding") > 0))
    far = float(1 << 62)
    q = F.transform("embedding", lambda x: F.floor(F.greatest(F.lit(-far), F.least(F.lit(far), x.cast("double") * float(scale)))).cast("long"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), q.alias("q"))


def _shard(limit: int, chunk: int, members: bool):
    """Rows of one length that follow each other, at most `limit` of them, as one row for each chunk of their dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            off, flat = lists(batch.column("q"))
            size = np.diff(off)
            rid, ids, labels = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("rid", "vec_id", "label"))
            cuts = np.flatnonzero(size[1:] != size[:-1]) + 1
            for a, b in zip([0, *cuts], [*cuts, len(size)], strict=True):
                for i in range(a, b, limit):
                    j, d = min(b, i + limit), int(size[i])
                    order = i + np.argsort(ids[i:j], kind="stable")
                    x = flat[off[i] : off[j]].reshape(j - i, d)[order - i]
                    most = int(np.abs(x).max())
                    kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
                    names = np.unique(labels[i:j]).tolist()
                    for c in range(0, d, chunk):
                        held = [v[order].tobytes() if c == 0 else b"" for v in (rid, ids, labels)]
                        yield pa.RecordBatch.from_pylist([{"shard": number, "d": d, "chunk": c // chunk, "rids": held[0], "ids": held[1], "labels": held[2], "x": x[:, c : c + chunk].astype(kind).tobytes(), "width": np.dtype(kind).itemsize, "names": names if c == 0 else [], "members": rid[order].tolist() if members and c == 0 else []}], schema=_ARROW)
                    number += 1

    return run


_ARROW = pa.schema([("shard", pa.int64()), ("d", pa.int32()), ("chunk", pa.int32()), ("rids", pa.binary()), ("ids", pa.binary()), ("labels", pa.binary()), ("x", pa.binary()), ("width", pa.int32()), ("names", pa.list_(pa.int64())), ("members", pa.list_(pa.int64()))])


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b transposed, exactly: in doubles where no sum can leave their whole numbers, else in 64-bit integers."""
    most = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * a.shape[1]
    if most < 2.0**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


_META = ("a_rids", "a_ids", "a_labels", "rids", "ids", "labels")
_KEPT = ("a_shard", "shard", *_META, "windows")
_WINDOW = "array<struct<rid: long, windows: array<struct<place: int, positive_id: long, score: long>>>>"
_TILES = f"a_shard long, shard long, {', '.join(f'{c} binary' for c in _META)}, windows {_WINDOW}, tile binary"


def _multiply(chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, r in enumerate(batch.select(["d", "chunk", "a_x", "a_width", "x", "width"]).to_pylist()):
                wide = min(chunk, r["d"] - chunk * r["chunk"])
                a, b = (np.frombuffer(r[x], f"i{r[w]}").reshape(-1, wide) for x, w in (("a_x", "a_width"), ("x", "width")))
                yield pa.record_batch([*(batch.column(c).slice(i, 1) for c in _KEPT), pa.array([product(a, b).tobytes()], pa.binary())], names=[*_KEPT, "tile"])

    return run


def added(table: pa.Table) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The sum of a pair's partial tiles, and what the shards' rows are called."""
    tiles = [np.frombuffer(t, np.int64) for t in table.column("tile").to_pylist()]
    total = tiles[0].copy()
    for t in tiles[1:]:
        total += t
    meta = {c: np.frombuffer(max(table.column(c).to_pylist(), key=len), np.int64) for c in _META}
    return total.reshape(len(meta["a_ids"]), len(meta["ids"])), meta


def first_positives(score: np.ndarray, meta: dict[str, np.ndarray], keep: int) -> list[np.ndarray]:
    """For each anchor of a tile, its `keep` best other rows of the same label. Rows lie in order of their ids."""
    fit = (meta["a_labels"][:, None] == meta["labels"]) & (meta["a_rids"][:, None] != meta["rids"])
    out = []
    for i in np.flatnonzero(fit.any(axis=1)):
        rows = np.flatnonzero(fit[i])
        rows = rows[np.argsort(-score[i, rows], kind="stable")[:keep]]
        out.append(np.stack([np.full(len(rows), meta["a_rids"][i]), np.full(len(rows), meta["a_ids"][i]), meta["ids"][rows], score[i, rows]]))
    return list(np.concatenate(out, axis=1)) if out else [np.zeros(0, np.int64)] * 4


def first_negatives(score: np.ndarray, meta: dict[str, np.ndarray], windows: dict[int, list], keep: int, least: int) -> list[np.ndarray]:
    """For each anchor and positive, its `keep` best rows of other labels within the window."""
    out, rids, ids = [], meta["a_rids"].tolist(), meta["a_ids"].tolist()
    tops = [[top for *_, top in windows.get(rid, ())] for rid in rids]
    low = np.array([min(t, default=1) * least for t in tops])
    high = np.array([max(t, default=0) for t in tops])
    at, row = np.nonzero((meta["a_labels"][:, None] != meta["labels"]) & (100 * score >= low[:, None]) & (score <= high[:, None]))
    value = score[at, row]
    order = np.lexsort((row, -value, at))
    at, row, value = at[order], row[order], value[order]
    for i in np.unique(at).tolist():
        a, b = np.searchsorted(at, [i, i + 1])
        for place, positive, top in windows[rids[i]]:
            c = a + int(np.searchsorted(-value[a:b], -top))
            n = int((100 * value[c : min(b, c + keep)] >= least * top).sum())
            if n:
                out.append(np.stack([np.full(n, v) for v in (rids[i], ids[i], place, positive, top)] + [meta["ids"][row[c : c + n]], value[c : c + n]]))
    return list(np.concatenate(out, axis=1)) if out else [np.zeros(0, np.int64)] * 7


def mine(vectors: DataFrame, anchor: Column, label: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, scale: int = SCALE, rows: int = ROWS, anchors: int = ANCHORS, chunk: int = CHUNK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    vectors: vec_id (whole numbers), label, embedding. anchor: which rows are anchors. label: the label that counts. Both are expressions over vectors; anchor
    reads vec_id and label only.
    """
    spark = vectors.sparkSession
    n = shuffle_partitions(spark)
    sound = sound_rows(vectors, label, scale).withColumn("d", F.size("q"))
    kept = sound.repartitionByRange(n, "d", "label", "vec_id").sortWithinPartitions("d", "label", "vec_id")
    kept = written(kept.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", "q", "d"), "mine-rows")
    asked = kept.where(anchor)
    many = asked.count()
    asked = asked.repartitionByRange(max(1, -(-many // (16 * anchors))), "d", "label", "vec_id").sortWithinPartitions("d", "label", "vec_id")
    a_shards = written(asked.select("rid", "vec_id", "label", "q").mapInArrow(_shard(anchors, chunk, True), _SHARDS), "mine-anchors")
    r_shards = written(kept.select("rid", "vec_id", "label", "q").mapInArrow(_shard(rows, chunk, False), _SHARDS), "mine-shards")
    a_shards = a_shards.select(*(F.col(c).alias(c if c in ("d", "chunk") else f"a_{c}") for c in a_shards.columns))

    def multiplied(pairs: DataFrame, asked: DataFrame) -> DataFrame:
        """Partial tiles of the pairs (a_shard, shard), one for each chunk."""
        met = pairs.join(r_shards.drop("names", "members"), "shard").join(asked.drop("d", "a_names", "a_members"), ["a_shard", "chunk"])
        return met.repartition(n, "a_shard", "shard", "chunk").mapInArrow(_multiply(chunk), _TILES)

    def keep_positives(table: pa.Table) -> pa.Table:
        return pa.table(first_positives(*added(table), positives), names=["rid", "anchor_id", "id", "score"])

    share = a_shards.select("a_shard", "d", F.explode("a_names").alias("label")).join(r_shards.select("shard", "d", F.explode("names").alias("label")), ["d", "label"])
    tiles = multiplied(share.select("a_shard", "shard").distinct(), a_shards.withColumn("windows", F.lit(None).cast(_WINDOW)))
    found = tiles.groupBy("a_shard", "shard").applyInArrow(keep_positives, _FOUND)
    found = written(found.withColumn("place", F.row_number().over(_first("rid"))).where(F.col("place") <= positives), "mine-positives")

    windows = found.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("place", F.col("id").alias("positive_id"), "score"))).alias("windows"))  # at most `positives` each
    windows = a_shards.select("a_shard", F.explode("a_members").alias("rid")).join(windows, "rid")
    windows = windows.groupBy("a_shard").agg(F.collect_list(F.struct("rid", "windows")).alias("windows")).withColumn("chunk", F.lit(0))  # at most `anchors` each
    with_windows = written(a_shards.join(windows, ["a_shard", "chunk"], "left"), "mine-windows")

    def keep_negatives(table: pa.Table) -> pa.Table:
        mine = {w["rid"]: [tuple(v.values()) for v in w["windows"]] for w in next((v for v in table.column("windows").to_pylist() if v), ())}
        cols = first_negatives(*added(table), mine, negatives, least)
        return pa.table([pa.array(c, pa.int32() if i == 2 else pa.int64()) for i, c in enumerate(cols)], names=["rid", "anchor_id", "place", "positive_id", "positive_score", "id", "score"])

    ends = with_windows.where("windows is not null").groupBy("d").agg(F.collect_list("a_shard").alias("a_shards"))  # 8 bytes for each `anchors` anchors
    every = r_shards.where("chunk = 0").select("shard", "d").join(F.broadcast(ends), "d").select("shard", F.explode("a_shards").alias("a_shard"))
    best = multiplied(every, with_windows).groupBy("a_shard", "shard").applyInArrow(keep_negatives, _WINDOWS)
    best = best.withColumn("rank", F.row_number().over(_first("rid", "place"))).where(F.col("rank") <= negatives)
    return best.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _first(*by: str) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(F.col("score").desc(), "id")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine(vectors, F.col("vec_id") % 100 == 0, label)


OP13_SQL = f"""
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.rid, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.rid <> b.rid AND len(a.q) = len(b.q)),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, id) AS place FROM s WHERE same) WHERE place <= {POSITIVES}),
n AS (SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.rid, p.place ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
    s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON s.rid = p.rid AND NOT s.same AND {LEAST} * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT * FROM n WHERE rank <= {NEGATIVES}
"""

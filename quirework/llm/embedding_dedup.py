"""Near-duplicate embeddings by randomised-rotation binary codes.

Each vector is rotated at random and kept as sign bits with a correction factor f, the inner product of the unit vector
and its code. For a code o and a rotated vector q, <code(o), q> / f estimates the cosine without bias, and the cosine
lies within EPS * sqrt((1 - f^2) / f^2 / (D - 1)) of it, up to odds that EPS sets. Only pairs whose bound reaches the threshold are computed
again, exactly, in double precision; none is linked on an estimate.

Pairs to look at come from bits of further rotations: `tables` keys of `bits` bits each. The number of bits grows with
the logarithm of the table, so the expected bucket of unrelated vectors stays constant, and the number of tables is the least that
gives a pair at the threshold a chance of 99 % (more above it; the work grows as n to the power 1.2). A pair counts in the first table where it meets.
Equal vectors are one node with a multiplicity; buckets above TILE nodes are cut into tiles that are paired, so no task holds a whole one.
Tasks return sums for each node and at most one edge a node (a spanning forest), never pairs.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing and are their own component. Vectors of
different lengths do not link. Repeated rows are vectors like others; a vec_id with several vectors has a row for each. Vectors without a
vec_id link with nothing and are kept, in a component without a name. Other columns play no part. Vectors keep their type, and cosines are taken in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lists, shuffle_partitions, written
from .components import components

THRESHOLD = 0.9
EPS = 4.0
SEED = 11
RECALL = 0.99
TILE = 1024

_FOUND = "vec_id long, k64 long, links long, root_id long, root_k64 long"


def plan_tables(n: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """Bits a key and tables for n vectors."""
    bits = int(min(30, max(6, round(math.log2(max(n, 2))) - 4)))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


_ROTATIONS: dict[tuple[int, int], np.ndarray] = {}


def rotation(d: int, nth: int) -> np.ndarray:
    """The nth random rotation of d dimensions."""
    if (d, nth) not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.default_rng([SEED, d, nth]).standard_normal((d, d)))
        _ROTATIONS[d, nth] = (q * np.sign(np.diag(r))).astype(np.float32)
    return _ROTATIONS[d, nth]


def unit(v: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so that squares neither vanish nor overflow."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _codes(bits: int, tables: int):
    """Adds code (sign bits), factor, and keys (one int a table)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, flat = lists(batch.column("embedding"))
            flat = flat[off[0] : off[-1]]
            codes, factors, keys = [None] * batch.num_rows, np.zeros(batch.num_rows), [None] * batch.num_rows
            size = np.diff(off)
            for d in np.unique(size):
                rows = np.flatnonzero(size == d)
                v = unit(flat[(off[rows] - off[0])[:, None] + np.arange(d)].astype(np.float64))
                turned = v.astype(np.float32) @ rotation(int(d), 0)
                factors[rows] = np.abs(turned).sum(axis=1) / math.sqrt(d)
                packed = np.packbits(turned > 0, axis=1)
                need = -(-bits * tables // int(d))
                more = np.concatenate([v.astype(np.float32) @ rotation(int(d), 1 + i) for i in range(need)], axis=1)[:, : bits * tables] > 0
                key = (more.reshape(len(rows), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))).astype(np.int32)
                for i, r in enumerate(rows):
                    codes[r], keys[r] = packed[i].tobytes(), key[i]
            yield pa.record_batch([batch.column("vec_id"), batch.column("k64"), batch.column("n"), batch.column("embedding"), pa.array(codes, pa.binary()), pa.array(factors.astype(np.float32)), pa.array(keys, pa.list_(pa.int32()))], names=["vec_id", "k64", "n", "embedding", "code", "factor", "keys"])

    return run


def _compare(threshold: float, eps: float):
    """Rows sorted by (d, t, key, low, high): links within each such group."""

    def block(cols: dict[str, np.ndarray], vectors: np.ndarray, codes: np.ndarray, keys: np.ndarray, cuts: np.ndarray):
        d = vectors.shape[1]
        size = np.diff(np.append(cuts, len(vectors)))
        left = np.repeat(cuts + size, size) - np.arange(len(vectors)) - 1
        exact = unit(vectors.astype(np.float64))
        turned = exact.astype(np.float32) @ rotation(d, 0)
        signs = np.unpackbits(codes, axis=1)[:, :d].astype(np.float32) * 2 - 1
        f = cols["factor"].astype(np.float64)
        slack = eps * np.sqrt(np.maximum(0, 1 - f * f) / (f * f) / max(d - 1, 1)) + 1e-4
        cross = cols["low"] != cols["high"]
        links, parent = np.zeros(len(vectors), np.int64), np.arange(len(vectors))

        def root(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        i, step = np.flatnonzero(left > 0), 1
        while len(i):
            for part in np.array_split(i, max(1, len(i) * d >> 22)):
                a, b = part, part + step
                fit = ~cross[a] | (cols["mine"][a] != cols["mine"][b])
                a, b = a[fit], b[fit]
                guess = np.einsum("ij,ij->i", signs[a], turned[b]) / (math.sqrt(d) * f[a])
                near = guess + slack[a] >= threshold
                a, b = a[near], b[near]
                a, b = (x[np.einsum("ij,ij->i", exact[a], exact[b]) >= threshold] for x in (a, b))
                if len(a):
                    earlier = np.arange(keys.shape[1]) < cols["t"][a][:, None]
                    fresh = ~((keys[a] == keys[b]) & earlier).any(axis=1)
                    a, b = a[fresh], b[fresh]
                    np.add.at(links, a, cols["n"][b])
                    np.add.at(links, b, cols["n"][a])
                    for x, y in zip(a.tolist(), b.tolist(), strict=True):
                        x, y = root(x), root(y)
                        if x != y:
                            parent[max(x, y)] = min(x, y)
            step += 1
            i = i[left[i] >= step]
        hit = np.flatnonzero(links)
        top = np.array([root(h) for h in hit], np.int64)
        return pa.record_batch([cols["vec_id"][hit], cols["k64"][hit], links[hit], cols["vec_id"][top], cols["k64"][top]], names=["vec_id", "k64", "links", "root_id", "root_k64"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def groups(table: pa.Table):
            by = [table.column(c).to_numpy() for c in ("d", "t", "key", "low", "high")]
            new = np.zeros(table.num_rows, bool)
            new[:1] = True
            for c in by:
                new[1:] |= c[1:] != c[:-1]
            return np.flatnonzero(new), by[0]

        def compare(table: pa.Table):
            cuts, dims = groups(table)
            for d in np.unique(dims):  # sorted by d first
                a, b = np.searchsorted(dims, [d, d + 1])
                part = table.slice(a, b - a).combine_chunks()
                cols = {c: part.column(c).to_numpy() for c in ("vec_id", "k64", "n", "t", "low", "high", "mine", "factor")}
                flat = lambda c, part=part: lists(part.column(c).chunk(0))
                off, vectors = flat("embedding")
                koff, keys = flat("keys")
                codes = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(b - a, -1)
                yield block(cols, vectors[off[0] : off[-1]].reshape(b - a, d), codes, keys[koff[0] : koff[-1]].reshape(b - a, -1), cuts[(cuts >= a) & (cuts < b)] - a)

        for batch in batches:
            table = pa.table(batch) if held is None else pa.concat_tables([held, pa.table(batch)])
            last = groups(table)[0][-1]
            held = table.slice(last)
            if last:
                yield from compare(table.slice(0, last))
        if held is not None and held.num_rows:
            yield from compare(held)

    return run


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, eps: float = EPS, tile: int = TILE) -> DataFrame:
    """vectors: vec_id (long), embedding (array of float or double). Returns vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    sound = F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    sound = sound & F.col("vec_id").isNotNull()
    kind = vectors.schema["embedding"].dataType.simpleString()
    rows = vectors.select("vec_id", "embedding", F.coalesce(F.xxhash64("embedding"), F.lit(0)).alias("k64"), sound.alias("sound"))
    nodes = written(rows.where("sound").groupBy("embedding", "k64").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n")), "vec-nodes")
    bits, tables = plan_tables(nodes.count(), threshold, recall)
    coded = nodes.select("vec_id", "k64", "n", "embedding").mapInArrow(_codes(bits, tables), f"vec_id long, k64 long, n long, embedding {kind}, code binary, factor float, keys array<int>")
    coded = written(coded, "vec-codes").withColumn("d", F.size("embedding"))
    keyed = coded.select("*", F.posexplode("keys").alias("t", "key"))
    sizes = keyed.groupBy("d", "t", "key").agg(F.count("*").alias("c")).where("c > 1")
    tiles = F.ceil(F.col("c") / tile).cast("int")
    mine = F.pmod(F.xxhash64("vec_id", "k64"), F.col("tiles")).cast("int")
    keyed = keyed.join(sizes.withColumn("tiles", tiles), ["d", "t", "key"]).withColumn("mine", mine)
    keyed = keyed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")})
    group = ["d", "t", "key", "low", "high"]
    keyed = keyed.select("vec_id", "k64", "n", "embedding", "code", "factor", "keys", "mine", *group).repartition(shuffle_partitions(spark), *group).sortWithinPartitions(*group, "vec_id", "k64")
    found = written(keyed.mapInArrow(_compare(threshold, eps), _FOUND), "vec-links")
    links = found.groupBy("vec_id", "k64").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.struct("vec_id", "k64").alias("a"), F.struct(F.col("root_id").alias("vec_id"), F.col("root_k64").alias("k64")).alias("b")))
    nodes = nodes.select("vec_id", "k64", "n", "embedding").join(links, ["vec_id", "k64"], "left").join(roots.select("node.*", F.col("root.vec_id").alias("root_id")), ["vec_id", "k64"], "left")
    nodes = nodes.select(F.col("k64").alias("c64"), F.col("embedding").alias("same"), "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root_id", "vec_id").alias("root_id"))
    nodes = written(nodes, "vec-classes")  # one row a vector, so that copies meet in a plain join
    out = rows.join(nodes, F.col("sound") & (F.col("k64") == F.col("c64")) & (F.col("embedding") == F.col("same")), "left")
    component = F.coalesce("root_id", "vec_id")
    return out.select("vec_id", F.coalesce(F.col("links") + F.col("n") - 1, F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP8_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reach AS (SELECT a, b FROM pairs UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a),
c AS (SELECT a, min(b) AS low FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS links FROM pairs GROUP BY a)
SELECT vec_id, CAST(coalesce(links, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id
"""

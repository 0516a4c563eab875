"""Ranked lexical search by TPUT over term-partitioned postings.

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z in lower case. The terms that the queries ask for are found
in the texts in one scan for each VOCABULARY of them; equal texts are one text with a number of copies. A term's postings (text, impact) are kept in
lists of at most LIST, sorted by impact, that stay together by term; the lists of frequent terms are dealt to all partitions.

The three phases: (1) the heads of all lists give each query partial sums; the texts with the largest are looked up, and the k-th of their scores is a
bound from below; (2) one threshold for all lists of a query is set so that a text below it everywhere stays below the bound: the bound is shared
out evenly, and what lists with small impacts cannot use goes to the others. All entries that reach the threshold come, once for all queries of a part, and are
added up by blocks of texts; texts that cannot reach the bound, even with the largest entries that the other lists kept back, go, as do those that cannot reach the k-th sum; (3) the scores of those left are looked up exactly. No text in the first k is ever lost, ties included.

Scores are whole numbers throughout, but for the logarithm in a term's weight. Null texts and
texts without terms count nowhere. Repeated rows are documents like others, each with a rank of its own. Documents without a doc_id come after others of equal
score. Queries are told apart by item_id; the texts of rows with one item_id (null included) are one query, its terms once each. Other columns play
no part. Terms are told apart by 64 bits of hash: with 1e6 asked terms and 1e11 others the odds of a clash are about 1 in 200.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, lists, shuffle_partitions, spread, text_key, text_slices, word_hashes, word_spans, written

BEST = 50
#: The share of a document's length in its weight, in per cent, and the saturation of counts.
SHARE, SATURATION = 50, 20
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Terms looked for in one scan: 8 bytes each for the broadcast hashes and as many for their numbers.
VOCABULARY = 1 << 20
#: Postings in one list, and the share of a batch's texts from which a term's postings are dealt to all partitions.
LIST, FREQUENT = 1 << 16, 1 / 64
#: Texts looked up after the first phase, times k.
LOOKED_UP = 4
#: The second phase fetches down to this part of the threshold: the less the lists keep back, the fewer texts are looked up.
DEEPER = 8
#: Texts of a block (bits) and queries of a part, whose sums a task holds: 16 bytes for each pair.
BLOCK, ITEMS = 12, 512
#: Rows of (query, term) up to which they are broadcast, some 40 bytes each; more are joined in a shuffle.
ASKED = 1 << 18

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PIECES = "term long, df long, entries int, deal int, us array<long>, gs array<int>"
_LISTS = "term long, df long, us array<long>, gs array<int>, head_us array<long>, head_gs array<int>"


def query_terms(queries: DataFrame) -> DataFrame:
    """item_id, term, once each."""
    text = F.translate("text", _UPPER, _UPPER.lower())
    return queries.select("item_id", F.explode(F.regexp_extract_all(text, F.lit(f"({TERM})"), F.lit(1))).alias("term")).distinct()


def term_hashes(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    size = np.array([len(w) for w in raw], np.int64)
    ends = np.cumsum(size)
    return word_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - size, ends)


def _scan(hashes: np.ndarray, numbers: np.ndarray):
    """Length of each text in terms, and the asked terms it holds with their counts. hashes: sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, off in text_slices(batch, "text"):
                low = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
                starts, ends, n = word_spans(np.where(_LETTER[data], np.uint8(65), np.uint8(32)), off)
                h = word_hashes(low, starts, ends)
                at = np.minimum(np.searchsorted(hashes, h), max(len(hashes) - 1, 0))
                hit = np.flatnonzero(hashes[at] == h) if len(hashes) else np.zeros(0, np.int64)
                pair, tf = np.unique(np.repeat(np.arange(len(n)), n)[hit] * max(len(hashes), 1) + at[hit], return_counts=True)
                row, term = np.divmod(pair, max(len(hashes), 1))
                cut = pa.array(np.searchsorted(row, np.arange(len(n) + 1)), pa.int32())
                yield pa.record_batch([*(rows.column(c) for c in ("doc_id", "k64", "k32")), pa.array(n), pa.ListArray.from_arrays(cut, pa.array(numbers[term])), pa.ListArray.from_arrays(cut, pa.array(tf.astype(np.int32)))], names=["doc_id", "k64", "k32", "n", "terms", "tfs"])

    return run


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + SATURATION * m)


def _list_batch(term: np.ndarray, u: np.ndarray, g: np.ndarray, copies: np.ndarray, limit: int):
    """Postings sorted by term, falling impact and text, cut into lists of at most `limit`: starts, ends, copies, and the order."""
    order = np.lexsort((u, -g, term))
    t = term[order]
    first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(t)))
    pieces = -(-size // limit)
    starts = np.repeat(first, pieces) + limit * spread(np.zeros(len(first), np.int64), pieces)
    ends = np.minimum(starts + limit, np.repeat(first + size, pieces))
    total = np.concatenate([[0], np.cumsum(copies[order])])
    return starts, ends, total[ends] - total[starts], order


def _pieces(n: int):
    """Lists of what each batch of texts holds; those of frequent terms are dealt by task, others stay together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() % n
        for batch in batches:
            off, term = lists(batch.column("terms"))
            _, tf = lists(batch.column("tfs"))
            row = np.repeat(np.arange(batch.num_rows), np.diff(off))
            u, m, copies = (batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("u", "m", "copies"))
            term, tf = term[off[0] : off[-1]], tf[off[0] : off[-1]].astype(np.int64)
            g = impact(tf, m)
            starts, ends, df, order = _list_batch(term, u, g, copies, LIST)
            cut = pa.array(np.append(starts, len(order)), pa.int32())
            size = ends - starts
            deal = np.where(size >= max(2, FREQUENT * batch.num_rows), task, -1).astype(np.int32)
            yield pa.record_batch([pa.array(term[order][starts]), pa.array(df), pa.array(size.astype(np.int32)), pa.array(deal), pa.ListArray.from_arrays(cut, pa.array(u[order])), pa.ListArray.from_arrays(cut, pa.array(g[order].astype(np.int32)))], names=["term", "df", "entries", "deal", "us", "gs"])

    return run


def _merge(k: int):
    """Merges the pieces of a term that lie in a batch; rows are sorted by term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, u = lists(batch.column("us"))
            _, g = lists(batch.column("gs"))
            u, g = u[off[0] : off[-1]], g[off[0] : off[-1]]
            size = np.diff(off)
            term = np.repeat(batch.column("term").to_numpy(), size)
            share = np.zeros(len(u), np.int64)  # a piece's copies stay with its first posting: only their sum for each term counts
            share[off[:-1][size > 0] - off[0]] = batch.column("df").to_numpy()[size > 0]
            starts, ends, df, order = _list_batch(term, u, g, share, LIST)
            u, g = u[order], g[order]
            cut = pa.array(np.append(starts, len(order)), pa.int32())
            head = np.minimum(ends - starts, k)
            at = spread(starts, head)
            head = pa.array(np.concatenate([[0], np.cumsum(head)]), pa.int32())
            yield pa.record_batch([pa.array(term[order][starts]), pa.array(df), pa.ListArray.from_arrays(cut, pa.array(u)), pa.ListArray.from_arrays(cut, pa.array(g)), pa.ListArray.from_arrays(head, pa.array(u[at])), pa.ListArray.from_arrays(head, pa.array(g[at]))], names=["term", "df", "us", "gs", "head_us", "head_gs"])

    return run


def _asked(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
    """Offsets of each row's queries, and what each asks: part, item, least impact."""
    ask = batch.column("ask")
    off = np.frombuffer(ask.buffers()[1], np.int32)[ask.offset : ask.offset + len(ask) + 1]
    return off, [ask.values.field(c).to_numpy(zero_copy_only=False) for c in ("part", "item", "least")]


def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each list and query that asks for it, the largest impact below the query's threshold; 0 where the list holds none."""
    for batch in batches:
        off, g = lists(batch.column("gs"))
        first, (_, item, least) = _asked(batch)
        rests = [np.zeros(0, np.int64)]
        for i in range(batch.num_rows):
            own = g[off[i] : off[i + 1]].astype(np.int64)
            at = np.searchsorted(-own, -least[first[i] : first[i + 1]], side="right")
            rests.append(np.append(own, 0)[at])
        yield pa.record_batch([np.repeat(batch.column("term").to_numpy(), np.diff(first)), item[first[0] : first[-1]], np.concatenate(rests)], names=["term", "item", "rest"])


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each list, the entries that reach the threshold of some query of a part, by blocks of texts."""
    for batch in batches:
        off, u = lists(batch.column("us"))
        _, g = lists(batch.column("gs"))
        first, (part, _, least) = _asked(batch)
        term = batch.column("term").to_numpy()
        for i in range(batch.num_rows):
            a, b, asked = off[i], off[i + 1], slice(first[i], first[i + 1])
            for p in np.unique(part[asked]):
                n = a + int(np.searchsorted(-g[a:b].astype(np.int64), -least[asked][part[asked] == p].min(), side="right"))
                if n == a:
                    continue
                block = u[a:n] >> BLOCK
                order = np.argsort(block, kind="stable")
                block = block[order]
                cut = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
                ends = pa.array(np.append(cut, len(block)), pa.int32())
                yield pa.record_batch([np.full(len(cut), p), block[cut], np.full(len(cut), term[i]), pa.ListArray.from_arrays(ends, pa.array((u[a:n][order] & ((1 << BLOCK) - 1)).astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(g[a:n][order]))], names=["part", "block", "term", "at", "gs"])


def _candidates(entries: pa.Table, asks: pa.Table, k: int) -> pa.Table:
    """Of a block of texts, those that can reach a query's bound and the k-th sum of the block: what is seen of them (s), and that with the most that is unseen."""
    items, item = np.unique(asks.column("item").to_numpy(), return_inverse=True)
    term, w, least, rest, low = (asks.column(c).to_numpy() for c in ("term", "w", "least", "rest", "low"))
    order = np.argsort(term, kind="stable")
    item, term, w, least, rest = item[order], term[order], w[order], least[order], rest[order]
    bound, unseen = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
    bound[item] = low[order]
    np.add.at(unseen, item, rest)
    total, most = np.zeros((len(items), 1 << BLOCK), np.int64), np.repeat(unseen[:, None], 1 << BLOCK, axis=1)
    wanted = entries.column("term").to_numpy()
    ends = np.stack([np.searchsorted(term, wanted), np.searchsorted(term, wanted, side="right")], axis=1)
    for (a, b), at, g in zip(ends.tolist(), *(entries.column(c).to_numpy() for c in ("at", "gs")), strict=True):
        fit = g >= least[a:b, None]
        cells = np.ix_(item[a:b], at)
        total[cells] += fit * (w[a:b, None] * g)
        most[cells] -= fit * rest[a:b, None]
    bound = np.maximum(bound, np.partition(total, -k, axis=1)[:, -k]) if k <= total.shape[1] else bound
    most += total
    found, at = np.nonzero((total > 0) & (most >= bound[:, None]))
    return pa.table([pa.array(items[found]), pa.array((entries.column("block")[0].as_py() << BLOCK) + at if entries.num_rows else at), pa.array(total[found, at]), pa.array(most[found, at])], names=["item", "u", "s", "most"])


def bounded(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Broadcast if it has few enough rows."""
    return F.broadcast(df) if rows <= limit else df


def _nth(sums: DataFrame, k: int, name: str) -> DataFrame:
    """item and its k-th largest sum, for items that have so many."""
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.col("s").desc()))
    return sums.select("item", "s", place.alias("place")).where(F.col("place") <= k).where(F.col("place") == k).select("item", F.col("s").alias(name))


def texts_and_terms(docs: DataFrame, vocabulary: DataFrame, many: int) -> tuple[DataFrame, DataFrame]:
    """All rows with a text (doc_id, k64, k32, n), and the distinct texts (u, k64, k32, n, copies, terms, tfs), with a row for each VOCABULARY."""
    sources = docs.where("text is not null").select("doc_id", "text", text_key().alias("k")).select("doc_id", "text", "k.k64", "k.k32")
    kind = docs.schema["doc_id"].dataType.simpleString()
    first = texts = None
    parts = max(1, -(-many // VOCABULARY))
    for part in range(parts):
        words = vocabulary.where(F.pmod(F.xxhash64("word"), F.lit(parts)) == part).collect()  # at most about VOCABULARY
        hashes, numbers = term_hashes([r.word for r in words]), np.array([r.term for r in words], np.int64)
        order = np.argsort(hashes)
        found = sources.mapInArrow(_scan(hashes[order], numbers[order]), f"doc_id {kind}, k64 long, k32 int, n long, terms array<long>, tfs array<int>")
        found = written(found.where("n > 0"), "search-docs")
        same = found.groupBy("k64", "k32").agg(F.count("*").alias("copies"), F.first("n").alias("n"), F.first("terms").alias("terms"), F.first("tfs").alias("tfs"))
        if part == 0:
            first = found.select("doc_id", "k64", "k32", "n")
            texts = numbered = written(same.select(F.monotonically_increasing_id().alias("u"), "*"), "search-texts")
        else:
            texts = texts.unionByName(numbered.select("u", "k64", "k32").join(same, ["k64", "k32"]))
    return first, texts


def search(docs: DataFrame, queries: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score. docs: doc_id, text; queries: item_id, text."""
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    asked = query_terms(queries)
    items = written(asked.select("item_id").distinct().select(F.monotonically_increasing_id().alias("item"), "item_id"), "search-items")
    vocabulary = written(asked.select(F.col("term").alias("word")).distinct().select(F.monotonically_increasing_id().alias("term"), "word"), "search-words")
    asked = asked.withColumnRenamed("term", "word").join(vocabulary, "word").alias("a").join(items.alias("i"), F.col("a.item_id").eqNullSafe(F.col("i.item_id"))).select("item", "term")
    rows, texts = texts_and_terms(docs, vocabulary, vocabulary.count())
    count, length = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(1))).first()

    m = F.expr(f"cast({100 - SHARE} + (cast({SHARE} as decimal(38, 0)) * n * {count}L) div {length}L as bigint)")
    pieces = texts.select("u", m.alias("m"), "copies", "terms", "tfs").mapInArrow(_pieces(n), _PIECES)
    pieces = pieces.repartition(n, "term", "deal").sortWithinPartitions("term")
    found = written(pieces.select("term", "df", "us", "gs").mapInArrow(_merge(k), _LISTS), "search-lists")
    w = F.floor(1000 * F.log((F.lit(2.0) * count + 2) / (2.0 * F.sum("df") + 1))).cast("long")
    weights = found.groupBy("term").agg(w.alias("w"), F.max(F.element_at("head_gs", 1)).alias("g")).where("w > 0").select("term", "w", (F.col("w") * F.col("g")).alias("most"))
    asked = written(asked.join(weights, "term"), "search-asked")
    many = asked.count()
    by_text = texts.select("u", m.alias("m"), F.arrays_zip("terms", "tfs").alias("e"))

    def exact(pairs: DataFrame) -> DataFrame:
        """Scores of (item, u)."""
        held = pairs.join(by_text, "u").select("item", "u", "m", F.explode("e").alias("e")).select("item", "u", "m", F.col("e.terms").alias("term"), F.col("e.tfs").cast("long").alias("tf"))
        score = F.sum(F.col("w") * F.expr(f"(1000000000L * tf) div (1000L * tf + {SATURATION}L * m)"))
        return held.join(bounded(asked, many, ASKED), ["item", "term"]).groupBy("item", "u").agg(score.alias("s"))

    heads = found.select("term", F.explode(F.arrays_zip("head_us", "head_gs")).alias("e")).select("term", F.col("e.head_us").alias("u"), F.col("e.head_gs").alias("g"))
    heads = heads.withColumn("place", F.row_number().over(Window.partitionBy("term").orderBy(F.col("g").desc(), "u"))).where(F.col("place") <= k)
    sums = heads.join(asked, "term").groupBy("item", "u").agg(F.sum(F.col("w") * F.col("g")).alias("s"))
    seen = sums.withColumn("place", F.row_number().over(Window.partitionBy("item").orderBy(F.col("s").desc(), "u"))).where(F.col("place") <= LOOKED_UP * k)
    low = _nth(exact(seen.select("item", "u")), k, "low")

    below = Window.partitionBy("item").orderBy("most", "term").rowsBetween(Window.unboundedPreceding, -1)
    share = asked.join(low, "item", "left").withColumns({"under": F.coalesce(F.sum("most").over(below), F.lit(0)), "before": F.count("*").over(below), "lists": F.count("*").over(Window.partitionBy("item"))})
    share = share.groupBy("item").agg(F.greatest(F.max((F.coalesce("low", F.lit(0)) - F.col("under")) / (F.col("lists") - F.col("before"))), F.lit(0.0)).alias("share"), F.first("low").alias("low"))
    asked = written(asked.join(share.withColumn("share", F.col("share") * (1 - 1e-9)), "item"), "search-shares")

    parts = -(-items.count() // ITEMS) or 1
    ask = asked.select("term", F.pmod(F.xxhash64("item"), F.lit(parts)).alias("part"), "item", F.floor(F.col("share") / DEEPER / F.col("w")).alias("least"), "w", "low")
    by_term = ask.groupBy("term", "part").agg(F.collect_list(F.struct("part", "item", "least")).alias("ask"))  # about ITEMS at most; a list's entries go to a part once
    by_term = bounded(written(by_term.drop("part"), "search-ask"), many, ASKED)
    rest = found.select("term", "gs").join(by_term, "term").mapInArrow(_rest, "term long, item long, rest long").groupBy("term", "item").agg(F.max("rest").alias("rest"))
    ask = ask.join(rest, ["term", "item"]).select("part", "item", "term", "w", "least", (F.col("w") * F.col("rest")).alias("rest"), F.coalesce("low", F.lit(0)).alias("low"))
    blocks = texts.select(F.shiftright("u", BLOCK).alias("block")).distinct().select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"))
    ask = blocks.join(ask, "part").repartition(n, "part", "block")
    entries = found.select("term", "us", "gs").join(by_term, "term").mapInArrow(_fetch, "part long, block long, term long, at array<int>, gs array<int>").repartition(n, "part", "block")
    left = entries.groupBy("part", "block").cogroup(ask.groupBy("part", "block")).applyInArrow(lambda x, y: _candidates(x, y, k), "item long, u long, s long, most long")
    left = written(left, "search-seen")
    left = left.join(_nth(left, k, "better"), "item", "left").where(F.col("most") >= F.coalesce("better", F.lit(0))).select("item", "u")
    exact_scores = exact(written(left, "search-left")).withColumnRenamed("s", "score").where("score > 0")

    least = rows.groupBy("k64", "k32").agg(F.min("doc_id").alias("least"))
    keys = texts.select("u", "k64", "k32").distinct()
    scores = exact_scores.join(keys, "u").join(least, ["k64", "k32"])
    order = [F.col("score").desc(), F.col("least").asc_nulls_last()]
    top = written(scores.withColumn("place", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("place") <= k).select("item", "k64", "k32", "score"), "search-top")
    member = F.row_number().over(Window.partitionBy("k64", "k32").orderBy(F.col("doc_id").asc_nulls_last()))
    members = rows.join(top.select("k64", "k32").distinct(), ["k64", "k32"], "left_semi").withColumn("member", member).where(F.col("member") <= k)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    out = top.join(members.select("k64", "k32", "doc_id"), ["k64", "k32"]).withColumn("rank", rank).where(F.col("rank") <= k)
    return out.join(items, "item").select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{TERM}') AS t FROM documents WHERE text IS NOT NULL),
l AS (SELECT r, doc_id, len(t) AS n, t FROM d WHERE len(t) > 0),
a AS (SELECT count(*) AS n_docs, sum(n) AS n_terms FROM l),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '{TERM}')) AS term FROM benchmark),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM l) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM p, a GROUP BY term, n_docs),
s AS (SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + {SATURATION} * (100 - {SHARE} + CAST(({SHARE} * n * n_docs) // n_terms AS BIGINT))))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN l USING (r), a GROUP BY item_id, r)
SELECT * FROM (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s JOIN l USING (r) WHERE score > 0)
WHERE rank <= {BEST}
"""

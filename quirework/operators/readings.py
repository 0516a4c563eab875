"""Several readings of one page: alignment, agreement, consensus of objects, merging of three."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules, similarity
from ..functions.normal_forms import normalized
from ..functions.rules import DEFAULT, Thresholds
from ..functions.text import flat_of, normalize, orderless_of, word_count

SMALL = 1 << 40  # bytes read, up to which pages are dealt to a stated number of tasks
SHARE = 1 << 20  # bytes read, as files have them, for which there is a task
MOST = 20_000  # tasks


def align(a: DataFrame, b: DataFrame, outer: bool = False) -> DataFrame:
    """Pages at the same position: object_id, pos, type (of a), text_a, text_b. Pages beyond the shorter reading are left out, or with `outer` met by empty ones."""
    x = a.select("object_id", "pos", "type", F.col("text").alias("text_a"))
    rows = x.join(b.select("object_id", "pos", F.col("text").alias("text_b")), ["object_id", "pos"], "full" if outer else "inner")
    return rows.withColumns({c: F.coalesce(c, F.lit("")) for c in ("text_a", "text_b")} | {"type": F.coalesce("type", F.lit("content"))})


def input_bytes(rows: DataFrame) -> int:
    """Bytes of the tables that rows are read from, by the optimiser's figures; where it has none, more than any table's."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def spread_out(pages: DataFrame, keys: tuple[str, ...] = ("object_id", "pos")) -> DataFrame:
    """Pages dealt to all tasks by the keys that they have: few bytes of them are much work, and files or joins may leave them in few tasks.

    That is as many partitions as shuffles have or, where more is read, one for each SHARE bytes: a task's work stays the same whatever the size of the tables. Beyond SMALL there is
    work enough for all tasks anyway, and a hint to rebalance leaves the number to adaptive execution, which splits partitions above its advisory size.
    """
    keys = [c for c in keys if c in pages.columns]
    if not keys:
        return pages
    size = input_bytes(pages)
    if size > SMALL:
        return pages.hint("rebalance", *keys)
    least = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pages.repartition(max(least, min(MOST, -(-size // SHARE))), *keys)


def page_agreement(pages: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """Adds cer, cer_orderless, effective_cer (the lesser) and agreement; pages without content are skipped."""
    content = F.col("type") == "content"
    rows = spread_out(pages).withColumns({f"n_{x}": F.when(content, normalize(f"text_{x}")) for x in "ab"})  # once for each text: columns that are used again stay columns
    rows = rows.withColumns({f"{k}_{x}": f(f"n_{x}") for x in "ab" for k, f in (("f", flat_of), ("o", orderless_of))})
    rows = rows.withColumn("cer", F.when(content, similarity.cer(F.col("f_a"), F.col("f_b"))))
    same = (F.col("f_a") == F.col("o_a")) & (F.col("f_b") == F.col("o_b"))
    rows = rows.withColumn("cer_orderless", F.when(content & same, F.col("cer")).when(content, similarity.cer(F.col("o_a"), F.col("o_b"))))
    rows = rows.withColumn("effective_cer", F.when(content & same, F.col("cer")).when(content, F.least("cer", similarity.cer_up_to(F.col("o_a"), F.col("o_b"), F.col("cer"))))).drop(*(f"{k}_{x}" for x in "ab" for k in "nfo"))
    return rows.withColumn("agreement", F.when(content, rules.agreement(F.col("effective_cer"), th)).otherwise("skipped"))


def object_consensus(pages: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """One row an object over its content pages in order: cer, overlap, category, content_pages, skipped_pages."""
    content = F.col("type") == "content"
    joined = lambda c: F.array_join(F.transform("each", lambda p: p[c]), " ")
    rows = spread_out(pages, ("object_id",)).groupBy("object_id").agg(F.count_if(content).alias("content_pages"), F.count_if(~content).alias("skipped_pages"), F.array_sort(F.collect_list(F.when(content, F.struct("pos", "text_a", "text_b")))).alias("each"))
    rows = rows.withColumns({"a": joined("text_a"), "b": joined("text_b")}).drop("each")  # both in one order, even where a place is doubled
    rows = rows.withColumns({"n_a": normalize("a"), "n_b": normalize("b")})
    rows = rows.withColumns({f"{k}_{x}": f(f"n_{x}") for x in "ab" for k, f in (("f", flat_of), ("o", orderless_of))})
    rows = rows.withColumn("plain", similarity.cer(F.col("f_a"), F.col("f_b")))
    same = (F.col("f_a") == F.col("o_a")) & (F.col("f_b") == F.col("o_b"))
    free = F.when(same, F.col("plain")).otherwise(similarity.cer_up_to(F.col("o_a"), F.col("o_b"), F.col("plain")))
    rows = rows.withColumns({"cer": F.least("plain", free), "overlap": similarity.word_overlap(F.col("a"), F.col("b"))})
    return rows.withColumn("category", rules.consensus(F.col("cer"), F.col("overlap"), th)).drop("a", "b", "plain", *(f"{k}_{x}" for x in "ab" for k in "nfo"))


def merge_three(pages: DataFrame, th: Thresholds = DEFAULT) -> DataFrame:
    """text_a, text_b, text_c (the strongest): adds merged and source. All pairs alike: c. Else the closest pair, if close: c if it is in it, or else b. Else c alone."""
    pages = spread_out(pages).withColumns({f"n_{x}": normalize(f"text_{x}") for x in "abc"})
    far = F.lit(float("inf"))
    pages = pages.withColumns({x + y: F.coalesce(similarity.cer_within(F.col(f"n_{x}"), F.col(f"n_{y}"), th.merge_near), far) for x, y in ("ab", "ac", "bc")})  # beyond that limit no pair counts
    ab, ac, bc = F.col("ab"), F.col("ac"), F.col("bc")
    none = (F.trim("text_a") == "") & (F.trim("text_b") == "") & (F.trim("text_c") == "")
    same = (ab < th.merge_same) & (ac < th.merge_same) & (bc < th.merge_same)
    first = (ab <= ac) & (ab <= bc)
    close = F.least("ab", "ac", "bc") < th.merge_near
    merged = F.when(none, "").when(~same & close & first, F.col("text_b")).otherwise(F.col("text_c"))
    source = F.when(none | same, "consensus_3of3").when(close, "majority_2of3").otherwise("strongest_only")
    return pages.withColumns({"merged": merged, "source": source}).drop("ab", "ac", "bc", "n_a", "n_b", "n_c")


def merge_statistics(pages: DataFrame) -> DataFrame:
    kinds = ["consensus_3of3", "majority_2of3", "strongest_only", "skipped"]
    return pages.groupBy("object_id").agg(*(F.count_if(F.col("source") == k).alias(k) for k in kinds))


def evaluate(pairs: DataFrame) -> DataFrame:
    """reference, other: adds error rates over normalised texts (edit distance, and by matching blocks), breakdown and overlap."""
    pairs = spread_out(pairs).withColumns({"normal_a": normalized("reference"), "normal_b": normalized("other")})
    a, b = F.col("normal_a"), F.col("normal_b")
    blocks, edits = similarity.matched(a, b)
    return pairs.withColumns({"cer": similarity.cer(a, b), "cer_blocks": blocks, "wer": similarity.wer_blocks(a, b), "edits": edits, "overlap": similarity.word_overlap(F.col("reference"), F.col("other")), "reference_chars": F.length(a), "other_chars": F.length(b)}).drop("normal_a", "normal_b")


def object_agreement(pages: DataFrame, words: bool = False, page_limit: float = 0.05, high: float = 0.03) -> DataFrame:
    """object_id, agreement_cer, disagreement_pages (positions above page_limit), high_agreement; with words agreement_wer too.

    Rates of an object are its pages' distances over the lengths of text_a; of an object without any text_a 0 if text_b has none either, else 1.
    """
    rows = spread_out(pages).withColumns({f"n_{x}": flat_of(normalize(f"text_{x}")) for x in "ab"})
    a, b = F.col("n_a"), F.col("n_b")
    rows = rows.withColumns({"apart": similarity.distance(a, b).cast("long"), "size": F.length(a).cast("long")})
    rows = rows.withColumn("rate", F.when(F.col("size") > 0, F.col("apart") / F.col("size")).otherwise(F.when(F.length(b) == 0, 0.0).otherwise(1.0)))
    over = lambda d, n: F.when(F.sum(n) > 0, F.sum(d) / F.sum(n)).otherwise(F.when(F.sum(d) > 0, 1.0).otherwise(0.0))
    more = []
    if words:
        rows = rows.withColumns({"words_apart": similarity.word_distance("n_a", "n_b"), "n_words": word_count("n_a")})
        more = [over("words_apart", "n_words").alias("agreement_wer")]
    rows = rows.groupBy("object_id").agg(over("apart", "size").alias("agreement_cer"), F.sort_array(F.collect_list(F.when(F.col("rate") > page_limit, F.col("pos")))).alias("disagreement_pages"), *more)
    return rows.withColumn("high_agreement", F.col("agreement_cer") < high)


def positional(readings: dict[str, DataFrame], value: str = "text") -> DataFrame:
    """object_id, pos, and a column for each name: the readings side by side by place, with empty texts where one has none.

    All readings meet in one grouping, however many they are. Where a reading has a place twice, its greatest value counts. Null counts as empty.
    """
    tagged = None
    for name, df in readings.items():
        one = df.select("object_id", "pos", F.lit(name).alias("name"), F.coalesce(value, F.lit("")).alias("value"))
        tagged = one if tagged is None else tagged.unionByName(one)
    each = [F.coalesce(F.max(F.when(F.col("name") == name, F.col("value"))), F.lit("")).alias(name) for name in readings]
    return tagged.groupBy("object_id", "pos").agg(*each)

"""How alike two texts are: built-in expressions where they exist, Arrow-batched functions where sequences must be matched.

Two error rates, never mixed: `cer` is the edit distance by characters over the reference's length; `cer_blocks` follows
matching blocks as difflib finds them, with its heuristic against frequent elements, and is kept for comparison with figures made so.
"""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .distances import distance, edit_distance
from .edits import word_script
from .text import normalize_flat, word_set


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays; 0 if either is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))).otherwise(0.0)


def word_overlap(a: Column, b: Column) -> Column:
    """Of two texts' words; 1 if both have none."""
    x, y = word_set(normalize_flat(a)), word_set(normalize_flat(b))
    return F.when((F.size(x) == 0) & (F.size(y) == 0), 1.0).otherwise(jaccard(x, y))


def cer(reference: Column, other: Column) -> Column:
    """Edit distance by characters over the reference's length; of an empty reference 0 for an empty text, else 1."""
    n = F.length(reference)
    return F.when((n > 0) & (reference == other), 0.0).when(n > 0, distance(reference, other) / n).otherwise(F.when(F.length(other) == 0, 0.0).otherwise(1.0))


def cer_within(reference: Column, other: Column, share: float) -> Column:
    """cer(...) where it is below share, else null: the distance is not followed beyond what the share allows, and equal texts need none."""
    n = F.length(reference)
    most = F.floor(n * share).cast("int")
    apart = distance(reference, other, most)
    rate = F.when(n > 0, F.when(apart >= 0, apart / n)).when(F.length(other) == 0, 0.0)
    return F.when(rate < share, rate)


def cer_up_to(reference: Column, other: Column, rate: Column) -> Column:
    """cer(...) where it is at most rate, else null or something above it."""
    n = F.length(reference)
    apart = distance(reference, other, F.floor(n * rate) + 1)
    return F.when(n > 0, F.when(apart >= 0, apart / n)).otherwise(F.when(F.length(other) == 0, 0.0).otherwise(1.0))


@F.pandas_udf(T.StringType())
def nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def _blocks(a, b):
    subs = ins = dels = changed = 0
    for kind, i, j, k, m in difflib.SequenceMatcher(None, a, b).get_opcodes():
        if kind != "equal":
            changed += max(j - i, m - k)
            subs += max(j - i, m - k) if kind == "replace" else 0
            ins += m - k if kind == "insert" else 0
            dels += j - i if kind == "delete" else 0
    return changed, subs, ins, dels


def _rate_of(changed: Column, reference: Column, other: Column) -> Column:
    n = F.length(F.coalesce(reference, F.lit("")))
    return F.when(n > 0, changed / n).otherwise((F.length(F.coalesce(other, F.lit(""))) > 0).cast("double"))


def _rate(a, b) -> float:
    return _blocks(a, b)[0] / len(a) if len(a) else float(len(b) > 0)


@F.pandas_udf(T.DoubleType())
def cer_blocks(reference: pd.Series, other: pd.Series) -> pd.Series:
    return pd.Series([_rate(a or "", b or "") for a, b in zip(reference, other, strict=True)])


@F.pandas_udf(T.DoubleType())
def wer_blocks(reference: pd.Series, other: pd.Series) -> pd.Series:
    return pd.Series([_rate((a or "").split(), (b or "").split()) for a, b in zip(reference, other, strict=True)])


@F.pandas_udf(T.StructType([T.StructField(n, T.IntegerType()) for n in ("changed", "substitutions", "insertions", "deletions")]))
def _matched(reference: pd.Series, other: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_blocks(a or "", b or "") for a, b in zip(reference, other, strict=True)], columns=["changed", "substitutions", "insertions", "deletions"])


def matched(reference: Column, other: Column) -> tuple[Column, Column]:
    """cer_blocks and edit_breakdown of the same two texts, matched once."""
    m = _matched(reference, other)
    return _rate_of(m["changed"], reference, other), F.struct(*(m[n].alias(n) for n in ("substitutions", "insertions", "deletions")))


@F.pandas_udf(T.StructType([T.StructField(n, T.IntegerType()) for n in ("substitutions", "insertions", "deletions")]))
def edit_breakdown(reference: pd.Series, other: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_blocks(a or "", b or "")[1:] for a, b in zip(reference, other, strict=True)], columns=["substitutions", "insertions", "deletions"])


@F.pandas_udf(T.LongType())
def word_distance(reference: pd.Series, other: pd.Series) -> pd.Series:
    """Edit distance by words between white space; see distances."""
    return pd.Series([edit_distance((a or "").split(), (b or "").split()) for a, b in zip(reference, other, strict=True)], dtype="int64")


def omission(reference: Column, other: Column) -> Column:
    """Share of the reference's characters that are left out; 0 of an empty one."""
    return F.when(F.length(reference) > 0, edit_breakdown(reference, other)["deletions"] / F.length(reference)).otherwise(0.0)


def hallucination(reference: Column, other: Column) -> Column:
    """Share of the other text's characters that were put in; 0 of an empty one."""
    return F.when(F.length(other) > 0, edit_breakdown(reference, other)["insertions"] / F.length(other)).otherwise(0.0)


#: Words matched on a longest common subsequence.
word_diff = word_script


def diff_statistics(diff: Column) -> Column:
    """Matches, others, and agreement in percent (100 for nothing at all)."""
    same = F.size(F.filter(diff, lambda d: d["kind"] == "match"))
    return F.struct(same.alias("matches"), (F.size(diff) - same).alias("divergent"), F.when(F.size(diff) > 0, same * 100 / F.size(diff)).otherwise(100.0).alias("agreement"))


def register(spark) -> None:
    """The functions that SQL cannot express, by name."""
    for name, f in (("nfc", nfc), ("cer_blocks", cer_blocks), ("wer_blocks", wer_blocks), ("edit_breakdown", edit_breakdown), ("word_diff", word_diff)):
        spark.udf.register(name, f)

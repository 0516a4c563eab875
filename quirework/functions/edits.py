"""Edit scripts by words on a longest common subsequence, in bits.

A row of the table of common lengths is one whole number: bit j is 0 where the length grows from column j to j + 1. A row follows from the one before by one addition and
two masks over all columns together. For the way back only every k-th row is kept, k the root of their number; the rows between are made again block by block, so that memory is
that of some 2 * sqrt(n) rows of m bits. The way back needs one bit a step: whether the length grew there.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

STEP = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("kind", "a", "b")]))


def _rows(row: int, words: Iterable[str], places: dict[str, int], whole: int):
    """The row after each word."""
    for w in words:
        here = row & places.get(w, 0)
        row = ((row + here) | (row - here)) & whole
        yield row


def script(a: list[str], b: list[str]) -> list[tuple[str, str | None, str | None]]:
    """match, insert or delete steps from a to b. Walking back from the ends, equal words match; else an insertion goes before a deletion of equal worth."""
    places: dict[str, int] = {}
    for j, w in enumerate(b):
        places[w] = places.get(w, 0) | 1 << j
    whole = (1 << len(b)) - 1
    size = max(1, math.isqrt(len(a)))
    kept, row = [whole], whole
    for i in range(0, len(a) - size, size):
        for row in _rows(row, a[i : i + size], places, whole):
            pass
        kept.append(row)
    out, i, j = [], len(a), len(b)
    while i:
        block = (i - 1) // size
        first = block * size
        rows = list(_rows(kept[block], a[first:i], places, whole))
        while i > first:
            if j and a[i - 1] == b[j - 1]:
                i, j = i - 1, j - 1
                out.append(("match", a[i], b[j]))
            elif j and rows[i - 1 - first] >> (j - 1) & 1:
                j -= 1
                out.append(("insert", None, b[j]))
            else:
                i -= 1
                out.append(("delete", a[i], None))
    out += [("insert", None, b[k]) for k in range(j - 1, -1, -1)]
    return out[::-1]


def _packed(x: str, y: str) -> pa.Array:
    kinds, left, right = zip(*script(x.split(), y.split()), strict=True) if x.strip() or y.strip() else ((), (), ())
    return pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in (kinds, left, right)], ["kind", "a", "b"])


@F.arrow_udf(STEP)
def word_script(a: pa.Array, b: pa.Array) -> pa.Array:
    """Scripts lie packed, row by row: as Python objects those of a batch would take some hundred bytes a step."""
    each = [_packed(x.as_py() or "", y.as_py() or "") for x, y in zip(a, b, strict=True)]
    cuts = pa.array([0, *accumulate(map(len, each))], pa.int32())
    return pa.ListArray.from_arrays(cuts, pa.concat_arrays(each or [_packed("", "")]))


def common_words(a: list[str], b: list[str]) -> int:
    """The length of a longest common subsequence."""
    places: dict[str, int] = {}
    for j, w in enumerate(b):
        places[w] = places.get(w, 0) | 1 << j
    row = whole = (1 << len(b)) - 1
    for row in _rows(row, a, places, whole):
        pass
    return len(b) - row.bit_count()


@F.pandas_udf(T.LongType())
def words_in_common(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([common_words((x or "").split(), (y or "").split()) for x, y in zip(a, b, strict=True)], dtype="int64")


def edit_diff(history: Column, text: Column) -> Column:
    """The script from the oldest text of a history (structs with original_transcription, oldest first) to the present one; null without a history."""
    oldest = F.get(history, F.lit(0))["original_transcription"]
    return F.when(F.size(history) > 0, word_script(oldest, text))

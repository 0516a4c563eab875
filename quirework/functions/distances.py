"""Edit distance of two sequences, exact, in bits: a column of the table of distances is two whole numbers, the steps up and down between its rows.

A column follows from the one before by a few operations over all rows together. Long sequences are followed in a band along the diagonal, some columns at a time: a band as wide as a
limit holds every way that costs no more, and the limit grows until the distance lies within it. So memory is that of some columns of bits, and time grows with the length times the distance.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHORT = 4_096  # rows that are followed all together
CHUNK = 256  # columns of a band before it moves, at least


def _columns(vp: int, vn: int, places: dict, items: Sequence, whole: int) -> tuple[int, int]:
    """The column after items; above the first row, distances grow by one a column."""
    for c in items:
        eq = places.get(c, 0)
        d0 = ((((eq & vp) + vp) ^ vp) | eq | vn) & whole
        hp = (((vn | (whole ^ (d0 | vp))) << 1) | 1) & whole
        vp = (((d0 & vp) << 1) & whole) | (whole ^ (d0 | hp))
        vn = hp & d0
    return vp, vn


def _all_rows(a: Sequence, b: Sequence) -> int:
    places: dict = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    whole = (1 << len(a)) - 1
    vp, vn = _columns(whole, 0, places, b, whole)
    return len(b) + vp.bit_count() - vn.bit_count()


def _bits(x: int, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(x.to_bytes(-(-n // 8), "little"), np.uint8), count=n, bitorder="little").astype(np.int32)


def _banded(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """The distance if it is at most limit, else something above it."""
    m, n = len(a), len(b)
    step = max(CHUNK, limit // 2)
    low = high = base = 0  # rows low to high are held; base: the distance above them
    vp = vn = 0
    for j in range(0, n, step):
        end = min(n, j + step)
        first, last = max(low, min(m, j - limit)), min(m, end + limit)
        if first > low:
            cut = (1 << (first - low)) - 1
            base += (vp & cut).bit_count() - (vn & cut).bit_count()
            vp, vn, low = vp >> (first - low), vn >> (first - low), first
        if last > high:
            vp |= ((1 << (last - high)) - 1) << (high - low)
            high = last
        window, items = a[low:high], b[j:end]
        places = {int(c): int.from_bytes(np.packbits(window == c, bitorder="little").tobytes(), "little") for c in np.unique(items)}
        vp, vn = _columns(vp, vn, places, items.tolist(), (1 << (high - low)) - 1)
        base += end - j
        if end < n:
            at = base + np.concatenate([[0], np.cumsum(_bits(vp, high - low) - _bits(vn, high - low))])
            if (at + np.abs(m - n + end - np.arange(low, high + 1))).min() > limit:
                return limit + 1
    return base + vp.bit_count() - vn.bit_count()


def edit_distance(a: Sequence, b: Sequence, most: int | None = None) -> int:
    """Least number of insertions, deletions and changes from a to b; with `most`, -1 if it is above that."""
    if a == b:
        return 0 if most is None or most >= 0 else -1
    m, n = len(a), len(b)
    if most is not None and abs(m - n) > most:
        return -1
    if min(m, n) <= SHORT:
        found = _all_rows(*((a, b) if m <= n else (b, a))) if min(m, n) else max(m, n)
        return found if most is None or found <= most else -1
    number = {c: i for i, c in enumerate(set(a) | set(b))}
    x, y = (np.fromiter((number[c] for c in s), np.int32, len(s)) for s in (a, b))
    more, less = Counter(a), Counter(b)
    least = max((more - less).total(), (less - more).total())  # whatever the order
    top = max(m, n) if most is None else min(most, max(m, n))
    if least > top:
        return -1
    limit = min(top, least + least // 8 + 64)
    while True:
        found = _banded(x, y, limit)
        if found <= limit:
            return found
        if limit == top:
            return -1
        limit = min(top, 2 * limit)


@F.arrow_udf(T.IntegerType())
def _distance(a: pa.Array, b: pa.Array, most: pa.Array) -> pa.Array:
    return pa.array([None if x is None or y is None else edit_distance(x, y, k) for x, y, k in zip(a.to_pylist(), b.to_pylist(), most.to_pylist(), strict=True)], pa.int32())


def distance(a: Column, b: Column, most: Column | None = None) -> Column:
    """Edit distance by characters; with `most`, -1 if it is above that."""
    return _distance(a, b, F.lit(None).cast("int") if most is None else most.cast("int"))

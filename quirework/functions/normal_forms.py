"""Canonical composition (NFC) that leaves texts which have it in the JVM: only those with characters that may change go to Python."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .similarity import nfc
from .text import normalize

#: Vowels and final consonants of Korean, which join what is before them; marks of any kind may, too.
_JOINING = r"\p{M}\x{1161}-\x{1175}\x{11A8}-\x{11C2}"


#: Nothing before U+0300 changes or joins, which is told at once; the class has some hundred ranges.
_LATER = r"(?=[^\x{0}-\x{2FF}])"


@lru_cache(1)
def changing() -> str:
    """A character class of all that composition may change: what it replaces even if it stands alone, and what may join the character before."""
    codes = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and not unicodedata.is_normalized("NFC", chr(c))]
    ranges: list[list[int]] = []
    for c in codes:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return f"[{_JOINING}{''.join(rf'\x{{{a:X}}}' + (rf'-\x{{{b:X}}}' if b > a else '') for a, b in ranges)}]"


def composed(c: Column | str) -> Column:
    """The text in NFC; null stays null. Python sees null in place of all texts that cannot change."""
    c = F.col(c) if isinstance(c, str) else c
    odd = c.rlike(_LATER + changing())
    return F.when(odd, nfc(F.when(odd, c))).otherwise(c)


def normalized(c: Column | str) -> Column:
    """text.normalize() of a text in any form."""
    return normalize(composed(c))

"""Confusions of blackletter print: variants of a word by one substitution, and corrections that a dictionary of words supports."""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What is misread, and what stands in print.
CONFUSIONS = (("f", "s"), ("ft", "st"), ("D", "W"), ("W", "D"), ("w", "m"), ("m", "w"), ("ih", "l"), ("l", "ih"), ("A", "N"), ("N", "A"), ("h", "li"), ("ss", "s"), ("ll", "l"))
#: Fixed value: the pair that holds within a word only, never at its start.
WITHIN = ("f", "s")
#: Whole words.
KNOWN = {"Mitgebrine": "Mitbringsel"}


def variants(word: Column) -> Column:
    """Array of (variant, rule, at): every place where one confusion applies, found without regard to case; capitals carry over."""
    return F.concat(*(_variants_by(word, wrong, right) for wrong, right in CONFUSIONS))


def _variants_by(word: Column, wrong: str, right: str) -> Column:
    n = len(wrong)
    first = F.lit(2 if (wrong, right) == WITHIN else 1)
    last = F.length(word) - n + 1
    places = F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    def variant(p: Column) -> Column:
        old = F.substring(word, p, F.lit(1))
        capital = (F.upper(old) == old) & (F.lower(old) != old)
        new = F.when(capital, F.lit(right[0].upper() + right[1:])).otherwise(F.lit(right))
        whole = F.concat(F.substring(word, F.lit(1), p - 1), new, F.substring(word, p + n, F.length(word)))
        return F.struct(whole.alias("variant"), F.lit(f"{wrong}->{right}").alias("rule"), (p - 1).alias("at"))

    return F.transform(F.filter(places, lambda p: F.lower(F.substring(word, p, F.lit(n))) == wrong.lower()), variant)


@F.udtf(returnType="variant string, rule string, at int")
class LetterVariants:
    """The rows of variants(word), for SQL: SELECT ... FROM words, LATERAL letter_variants(word)."""

    def eval(self, word: str | None):
        low = (word or "").lower()
        for wrong, right in CONFUSIONS:
            n = len(wrong)
            for at in range(1 if (wrong, right) == WITHIN else 0, len(word or "") - n + 1):
                if low[at : at + n] == wrong.lower():
                    new = right[0].upper() + right[1:] if word[at].isupper() else right
                    yield word[:at] + new + word[at + n :], f"{wrong}->{right}", at


def register(spark) -> None:
    """letter_variants as a table function of a session."""
    spark.udtf.register("letter_variants", LetterVariants)


def corrections(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """words: word (distinct). dictionary: known (lower case, distinct). word, suggestion, rule, candidates.

    Words of under four letters and known ones are left, and a variant of under four letters counts as known; one known variant is a suggestion, several are ambiguous. Joins on the variant, so neither side needs to be small.
    """
    words = words.where(F.length("word") >= 4)
    fixed = F.element_at(F.create_map(*(F.lit(x) for kv in KNOWN.items() for x in kv)), F.col("word"))
    words = words.join(dictionary, (F.lower("word") == F.col("known")) & ~F.col("word").isin(*KNOWN), "left_anti")
    v = F.when(F.col("word").isin(*KNOWN), F.array(F.struct(fixed.alias("variant"), F.lit("known").alias("rule"), F.lit(0).alias("at")))).otherwise(variants(F.col("word")))
    each = words.select("word", F.posexplode(v).alias("nth", "v")).select("word", "nth", "v.variant", "v.rule")
    short = (F.length("variant") <= 3) | (F.col("rule") == "known")
    met = each.where(~short).join(dictionary, F.lower("variant") == F.col("known"), "left_semi").unionByName(each.where(short))  # so short a word is taken as known
    first = F.row_number().over(Window.partitionBy("word", F.lower("variant")).orderBy("nth"))
    met = met.withColumn("first", first).where("first = 1").groupBy("word").agg(F.count("*").alias("candidates"), F.min_by(F.struct("variant", "rule"), "nth").alias("b"))
    one = F.col("candidates") == 1
    return met.select("word", F.when(one, F.col("b.variant")).alias("suggestion"), F.when(one, F.col("b.rule")).otherwise("ambiguous").alias("rule"), "candidates")


#: Fixed value: letters of words in print.
LETTER = "[A-Za-zÄÖÜäöüßàâéèêëïîôùûç]"
AROUND = 20
#: White space as Unicode has it, which Python's own class exceeds.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_RUN = re.compile(f"{LETTER}+")
_DIVIDES = re.compile(f"[-=][{_SPACE}]*\n[{_SPACE}]*")
_ENDS = re.compile(f"[.!?][{_SPACE}]*\\Z")


def _runs(whole: str) -> list[tuple[str, int, bool, bool]]:
    """word, at, broken, named of each run of letters."""
    found = list(_RUN.finditer(whole))
    out, second = [], False
    for m, n in zip(found, [*found, None][1:], strict=True):
        run, at = m.group(), m.start()
        divided = n is not None and _DIVIDES.fullmatch(whole, m.end(), n.start()) is not None
        capital = run[0].upper() == run[0] != run[0].lower() and run.upper() != run
        out.append((run, at, second or divided, capital and not _ENDS.search(whole[max(at - 3, 0) : at])))
        second = divided and not second  # pairs from the left
    return out


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("at", T.IntegerType()), T.StructField("broken", T.BooleanType()), T.StructField("named", T.BooleanType())])))
def _places(texts: pa.Array) -> pa.Array:
    each = [_runs(t or "") for t in texts.to_pylist()]
    columns = zip(*chain.from_iterable(each), strict=True) if any(each) else ((),) * 4
    values = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.bool_(), pa.bool_()), strict=True)], ["word", "at", "broken", "named"])
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, each))], pa.int32()), values)


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("ats", T.ArrayType(T.IntegerType()))])))
def _doubtful(texts: pa.Array) -> pa.Array:
    """Each word of a text that corrections() may ask for, once, with its places."""
    words, cuts, ats, ends = [], [0], [], [0]
    for t in texts.to_pylist():
        by = defaultdict(list)
        for word, at, broken, named in _runs(t or ""):
            if not broken and len(word) >= 4 and (not named or word in KNOWN):
                by[word].append(at)
        for word, found in by.items():
            words.append(word)
            ats += found
            ends.append(len(ats))
        cuts.append(len(words))
    values = pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ats, pa.int32()))], ["word", "ats"])
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values)


def _context(whole: str, at: Column, n: Column) -> Column:
    start = F.greatest(at - AROUND, F.lit(0))
    return F.substring(whole, start + 1, at - start + n + AROUND)


def occurrences(pages: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, word, at (0-based), context, broken, named: every run of letters of each page.

    broken: part of a word that a hyphen or = divides at the end of a line; such pairs are taken from the left and do not overlap.
    named: likely a name, i.e. a capital (not all capitals) other than after the end of a sentence.
    """
    found = pages.where(F.col(text).isNotNull()).select(*keys, F.col(text).alias("whole"), F.explode(_places(F.col(text))).alias("p"))
    return found.select(*keys, "p.word", "p.at", _context("whole", F.col("p.at"), F.length("p.word")).alias("context"), "p.broken", "p.named")


def find_corrections(pages: DataFrame, keys: list[str], dictionary: DataFrame, text: str = "text") -> DataFrame:
    """keys, word, at, context, suggestion, rule, candidates: places where corrections() has something to say, but for parts of divided words and likely names (words that are known to be wrong always count).

    Only words and places are sent to meet their corrections; each text is sent once, to meet what was found in it. Repeated pages are one until the end.
    """
    pages = pages.where(F.col(text).isNotNull()).select(*keys, F.col(text).alias("whole"))
    pages = pages.withColumns({"k64": F.xxhash64(*keys, "whole"), "k32": F.hash(*keys, "whole")})
    said = pages.select("k64", "k32", F.explode(_doubtful(F.col("whole"))).alias("p")).select("k64", "k32", "p.word", "p.ats")
    met = said.join(corrections(said.select("word").distinct(), dictionary), "word").dropDuplicates(["k64", "k32", "word"])
    once = pages.groupBy("k64", "k32").agg(*(F.first(c).alias(c) for c in (*keys, "whole")), F.count("*").cast("int").alias("copies"))
    found = once.join(met, ["k64", "k32"]).withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).withColumn("at", F.explode("ats"))
    return found.select("word", *keys, "at", _context("whole", F.col("at"), F.length("word")).alias("context"), "suggestion", "rule", "candidates")


def summary(objects: DataFrame, found: DataFrame, key: str = "object_id") -> DataFrame:
    """One row: files (objects checked), files_with_corrections, suggestions, ambiguous. objects: key, once each; found: as of find_corrections()."""
    by = found.groupBy(key).agg(F.count("suggestion").alias("s"), F.count_if(F.col("suggestion").isNull()).alias("a"))
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for c, n in (("s", "suggestions"), ("a", "ambiguous"))]
    return objects.join(by, key, "left").agg(F.count("*").alias("files"), F.count("s").alias("files_with_corrections"), *sums)

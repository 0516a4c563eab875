"""Model output as JSON, however broken: a ladder of repairs, each tried where the ones before failed."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ESCAPE = re.compile(r'\\(?:(["\\bfnrtu/])|([\s\S]))')
_STRING = re.compile(r'"(?:[^"\\]|\\[\s\S])*(?:"|\Z)')
_CONTROL = {"\n": "\\n", "\r": "\\r", "\t": "\\t"}


def strip_fence(text: str) -> str:
    found = re.match(r"\s*```\w*\s*\n?([\s\S]*?)\n?```\s*\Z", text)
    return (found[1] if found else re.sub(r"\A\s*```\w*\s*\n?", "", text)).strip()


def fix_escapes(text: str) -> str:
    """A backslash before what JSON cannot escape goes; pairs are read from the left."""
    return _ESCAPE.sub(lambda m: m[0] if m[1] else m[2], text)


def repair(text: str) -> str:
    """Commas before a closing bracket go, and line breaks and tabs inside strings are escaped."""
    text = re.sub(r",(\s*[}\]])", r"\1", text)
    return _STRING.sub(lambda m: re.sub("[\n\r\t]", lambda c: _CONTROL[c[0]], m[0]), text)


def outermost(text: str) -> str | None:
    """The first object to its closing brace; if the text ends before, closed as far as that goes."""
    start = text.find("{")
    if start < 0:
        return None
    bare, end = _STRING.sub(lambda m: " " * len(m[0]), text[start:]), 0
    depth = 0
    for m in re.finditer("[{}]", bare):
        depth += 1 if m[0] == "{" else -1
        if depth == 0:
            end = start + m.end()
            break
    if end:
        return text[start:end]
    open_string = any(not m[0].endswith('"') or len(m[0]) == 1 for m in _STRING.finditer(text[start:]))
    tail = text[start:] + '"' * open_string + "}" * depth
    return tail + "]" * max(0, tail.count("[") - tail.count("]"))


def parse(text: str | None) -> tuple[dict | None, str]:
    """The object, and the step that gave it; (None, 'raw') if none did."""
    if text is None:
        return None, "raw"
    steps = [("direct", lambda t: t), ("fence", strip_fence), ("escapes", lambda t: fix_escapes(strip_fence(t))), ("repair", lambda t: repair(fix_escapes(strip_fence(t)))), ("extract", lambda t: outermost(repair(fix_escapes(strip_fence(t)))))]
    for name, step in steps:
        try:
            found = json.loads(step(text) or "")
        except ValueError:
            continue
        if isinstance(found, dict):
            return found, name
    return None, "raw"


@F.pandas_udf(T.StructType([T.StructField("json", T.StringType()), T.StructField("step", T.StringType())]))
def parse_json(texts: pd.Series) -> pd.DataFrame:
    """The repaired JSON (null if hopeless), and the step of the ladder that gave it."""
    got = [parse(t) for t in texts]
    return pd.DataFrame({"json": [None if o is None else json.dumps(o, ensure_ascii=False, sort_keys=True) for o, _ in got], "step": [s for _, s in got]})


@F.pandas_udf(T.StructType([T.StructField("json", T.StringType()), T.StructField("step", T.StringType())]))
def _repaired(texts: pd.Series) -> pd.DataFrame:
    """As parse_json(), for what a variant can hold: NaN and infinities become null. Null texts have neither."""
    plain = lambda o: {k: plain(v) for k, v in o.items()} if isinstance(o, dict) else [plain(v) for v in o] if isinstance(o, list) else None if isinstance(o, float) and o - o != 0 else o
    got = [(None, None) if t is None else parse(t) for t in texts]
    return pd.DataFrame({"json": [None if o is None else json.dumps(plain(o), ensure_ascii=False) for o, _ in got], "step": [s for _, s in got]})


def ladder(c: Column | str) -> Column:
    """A struct of value (a variant, null if hopeless) and step, the rung that gave it: direct, fence, escapes, repair, extract or raw.

    Sound objects are parsed in the JVM and never reach Python, which sees only the others. Of equal names within an object the last counts. A null text is raw.
    """
    c = F.col(c) if isinstance(c, str) else c
    sound = F.try_parse_json(c)
    whole = c.rlike(r"(?s)\A\s*\{.*\}\s*\z") & F.coalesce(F.schema_of_variant(sound).startswith("OBJECT"), F.lit(False)) & ~c.rlike(r"\}\s*[\{\}\w\"]")
    other = _repaired(F.when(~F.coalesce(whole, F.lit(False)), c))
    return F.struct(F.when(whole, sound).otherwise(F.try_parse_json(other["json"])).alias("value"), F.when(whole, "direct").otherwise(F.coalesce(other["step"], F.lit("raw"))).alias("step"))

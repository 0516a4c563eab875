"""The header of a Markdown text, between lines of three dashes, and its fields: one-line texts, and lists on one line or on a line for each item.

Values may stand in single or double quotes; a comment begins after a space and #. Nested maps, anchors and texts over several lines are not read: such a field is null or its first line.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def parts(c: Column | str) -> Column:
    """(header, body), trimmed. A text that doesn't begin with three dashes, or lacks the closing ones, is all body, as it is."""
    c = _col(c)
    end = F.locate("---", c, 4)
    has = F.startswith(c, F.lit("---")) & (end > 0)
    return F.when(c.isNotNull(), F.struct(F.when(has, _strip(F.substr(c, F.lit(4), end - 4))).otherwise("").alias("header"), F.when(has, _strip(F.substr(c, end + 3))).otherwise(c).alias("body")))


def _plain(v: Column) -> Column:
    """A value without its quotes or its comment; null if nothing is left."""
    double, single = r'(?s)\A"((?:[^"\\]|\\.)*)"[ \t]*(?:#.*)?\z', r"(?s)\A'((?:[^']|'')*)'[ \t]*(?:#.*)?\z"
    in_double = F.regexp_replace(F.regexp_extract(v, double, 1), r'\\(["\\])', "$1")
    in_single = F.replace(F.regexp_extract(v, single, 1), F.lit("''"), F.lit("'"))
    bare = F.rtrim(F.regexp_replace(v, r"(?:\A|[ \t])#.*\z", ""))
    return F.nullif(F.when(v.rlike(double), in_double).when(v.rlike(single), in_single).otherwise(bare), F.lit(""))


def field(header: Column | str, key: str) -> Column:
    """The text of a field; null where it is missing or empty. Of equal keys the first counts."""
    return _plain(F.regexp_extract(_col(header), rf"(?m)^{re.escape(key)}:[ \t]*(.*?)[ \t\r]*$", 1))


def items(header: Column | str, key: str) -> Column:
    """The items of a list, in order; none where the field is missing. A single text is a list of one."""
    header, name = _col(header), re.escape(key)
    inline = rf"(?m)^{name}:[ \t]*\[(.*)\][ \t]*(?:#.*)?$"
    below = F.regexp_extract(header, rf"(?m)^{name}:[ \t\r]*\n((?:[ \t]*-[ \t]+.*(?:\n|\z))+)", 1)
    lines = F.regexp_extract_all(below, F.lit(r"(?m)^[ \t]*-[ \t]+(.*?)[ \t\r]*$"), F.lit(1))
    each = F.regexp_extract_all(F.regexp_extract(header, inline, 1), F.lit(r"""(?:[^,"']|"(?:[^"\\]|\\.)*"|'(?:[^']|'')*')+"""), F.lit(0))
    found = F.when(header.rlike(inline), F.transform(each, lambda x: F.trim(x))).when(below != "", lines).otherwise(F.array(F.coalesce(field(header, key), F.lit(""))))
    return F.coalesce(F.filter(F.transform(found, _plain), lambda v: v.isNotNull()), F.array().cast("array<string>"))


def record(header: Column | str, slug: Column | str) -> Column:
    """What a document says of itself: title (the slug, if it has none), type, status, tags, created, updated, and the documents that its related links name."""
    text = lambda k: F.coalesce(field(header, k), F.lit(""))
    linked = F.filter(F.transform(items(header, "related"), lambda r: F.regexp_extract(r, r"\[\[(.+?)\]\]", 1)), lambda s: s != "")
    return F.struct(
        F.coalesce(field(header, "title"), _col(slug)).alias("title"), text("type").alias("type"), text("status").alias("status"), items(header, "tags").alias("tags"),
        text("created").alias("created"), text("updated").alias("updated"), linked.alias("related"),
    )

"""Text as columns: normalisation for comparison, tokens, markers, identifiers, languages. Built-in expressions throughout.

White space and letters follow Unicode ((?U)) as in the rules these functions implement; a null text gives null unless said otherwise.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of languages as metadata spells them.
LANGUAGE_KEYS = {
    "deutsch": "de", "german": "de", "de": "de",
    "französisch": "fr", "franzoesisch": "fr", "french": "fr", "fr": "fr",
    "englisch": "en", "english": "en", "en": "en",
}
#: Names of languages in interchange exports.
LANGUAGE_CODES = {
    "deutsch": "de", "deutsch?": "de", "german": "de",
    "englisch": "en", "english": "en",
    "französisch": "fr", "franzoesisch": "fr", "french": "fr",
    "italienisch": "it", "italian": "it",
    "spanisch": "es", "spanish": "es",
    "jiddisch": "yi", "yiddish": "yi",
    "unbekannt": "und", "unknown": "und",
}
#: Labels of a context block, in order.
CONTEXT_FIELDS = (
    ("Titel", "title"),
    ("Signatur", "signature"),
    ("Datum", "date"),
    ("Sprache", "language"),
    ("Objekttyp", "objecttyp"),
    ("Umfang", "extent"),
    ("Schreibinstrument", "writing_instrument"),
    ("Hand", "hand"),
    ("Anmerkungen", "notes"),
)

_PARAGRAPH = "\x01"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(key: Column, table: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), key)


#: Unicode's white space other than space and line feed.
_OTHER = "\t\x0b\f\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _strip(c: Column) -> Column:
    return F.btrim(c, F.lit(" \n"))


def _even(c: Column, other: str) -> Column:
    """The other white space as spaces, and runs of spaces as one."""
    return F.regexp_replace(F.translate(c, other, " " * len(other)), "  +", " ")


def join_lines(c: Column) -> Column:
    """Words cut by a hyphen at a line's end are joined, lines run on, and blank lines become one line break."""
    c = _even(F.replace(c, F.lit("\r\n"), F.lit("\n")), _OTHER)
    c = F.rtrim(F.replace(c, F.lit(" \n"), F.lit("\n")))
    c = F.replace(c, F.lit("-\n"), F.lit(""))
    return F.translate(F.replace(c, F.lit("\n\n"), F.lit(_PARAGRAPH)), "\n" + _PARAGRAPH, " \n")


def drop_markup(c: Column) -> Column:
    """Keeps what is struck out, inserted or stamped; removes marks of marginalia, gaps and doubt. Each rule sees what the one before left."""
    # The marks of a diplomatic transcription.
    for pattern, kept in ((r"~~(.*?)~~", "$1"), (r"\{(.*?)\}", "$1"), (r"(?U)\[Stempel:\s*(.+?)\]", "$1"), (r"\[Marginalie:\]", ""), (r"\[\.\.\.(?:\d+\.\.\.)?\]", ""), (r"\[\?\]", "")):
        c = F.regexp_replace(c, pattern, kept)
    return c


def normalize(c: Column | str) -> Column:
    """A diplomatic transcription as plain text, paragraphs on lines of their own. Input in NFC (see similarity.nfc)."""
    c = F.regexp_replace(drop_markup(join_lines(_col(c))), "  +", " ")
    return _strip(F.replace(F.replace(c, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n")))


def _tight(c: Column) -> Column:
    return _strip(F.regexp_replace(c, " ([.,;:!?])", "$1"))  # single spaces only are left by now


def normalize_flat(c: Column | str) -> Column:
    """As normalize(), on one line, without space before punctuation: layout does not count."""
    return flat_of(normalize(c))


def normalize_orderless(c: Column | str) -> Column:
    """As normalize_flat(), with paragraphs of five characters or more in code-point order: reading order does not count."""
    return orderless_of(normalize(c))


def flat_of(normal: Column | str) -> Column:
    """normalize_flat() of a text that is normalised already."""
    return _tight(_even(_col(normal), "\n"))


def orderless_of(normal: Column | str) -> Column:
    """normalize_orderless() of a text that is normalised already."""
    lines = F.transform(F.split(_col(normal), "\n"), lambda x: _strip(F.regexp_replace(x, "  +", " ")))
    return _tight(F.array_join(F.array_sort(F.filter(lines, lambda x: F.length(x) >= 5)), " "))


def words(c: Column | str) -> Column:
    """Words between white space; none for a null or blank text."""
    return F.filter(F.split(F.coalesce(_col(c), F.lit("")), r"(?U)\s+"), lambda x: x != "")


def word_set(c: Column | str) -> Column:
    return F.array_distinct(words(F.lower(_col(c))))


def word_count(c: Column | str) -> Column:
    return F.size(words(c))


def letter_runs(c: Column | str) -> Column:
    """Distinct lower-case runs of letters by which languages are told apart (the class has no sharp s, by rule)."""
    return F.array_distinct(F.regexp_extract_all(F.lower(_col(c)), F.lit("([a-zäöüàâéèêëïîôùûç]+)"), F.lit(1)))


def doubtful_marks(c: Column | str) -> Column:
    return F.regexp_count(_col(c), F.lit(r"\[\?\]"))


def illegible_marks(c: Column | str) -> Column:
    return F.regexp_count(_col(c), F.lit(r"\[\.\.\..*?\]"))


def marker_density(c: Column | str) -> Column:
    return F.coalesce(F.try_divide(doubtful_marks(c) + illegible_marks(c), word_count(c)), F.lit(0.0))


def split_signature(title: Column | str, prefix: str) -> Column:
    """(title, signature): the part after the last comma, if it starts with the prefix of the archive's signatures."""
    title, start = _col(title), re.escape(prefix)
    tail = F.regexp_extract(title, rf"(?s),\s*({start}[^,]*)\z", 1)
    head = F.regexp_replace(title, rf"(?s),\s*{start}[^,]*\z", "")
    return F.struct(F.when(tail != "", head).otherwise(title).alias("title"), F.trim(tail).alias("signature"))


def object_to_pid(c: Column | str, space: str, model: str = "gemini") -> Column:
    """The persistent identifier of an object's file name: o_<space>.1 becomes o:<space>.1, and a model's name at the end goes."""
    return F.regexp_replace(F.replace(_col(c), F.lit(f"o_{space}."), F.lit(f"o:{space}.")), f"_{re.escape(model)}.*$", "")


def https(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "^http:", "https:")


def language_key(c: Column | str) -> Column:
    """de, fr, en or empty, from free text such as 'Deutsch, Englisch (Zitate)'."""
    first = F.trim(F.lower(F.split_part(F.split_part(F.coalesce(_col(c), F.lit("")), F.lit(","), F.lit(1)), F.lit("("), F.lit(1))))
    return F.coalesce(lookup(first, LANGUAGE_KEYS), F.lit(""))


def language_code(c: Column | str, unknown: int = 3) -> Column:
    """An ISO code; names beyond the table are cut to `unknown` letters, and nothing is 'und'."""
    key = F.trim(F.lower(F.coalesce(_col(c), F.lit(""))))
    return F.when(key == "", "und").otherwise(F.coalesce(lookup(key, LANGUAGE_CODES), F.substring(key, 1, unknown)))


def escape_html(c: Column | str) -> Column:
    c = _col(c)
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(plain), F.lit(entity))
    return c


def strike_html(c: Column | str) -> Column:
    return F.regexp_replace(escape_html(c), "~~(.+?)~~", "<del>$1</del>")


def relative_time(then: Column, now: Column) -> Column:
    """Seconds, minutes, hours, days up to a month, then the date."""
    then, now = then.cast("timestamp"), now.cast("timestamp")
    s = F.unix_seconds(now) - F.unix_seconds(then)
    n = lambda by, unit: F.concat(F.floor(s / by).cast("string"), F.lit(unit))
    return F.when(s < 60, n(1, "s")).when(s < 3600, n(60, "m")).when(s < 86400, n(3600, "h")).when(s < 30 * 86400, n(86400, "d")).otherwise(F.date_format(then, "yyyy-MM-dd"))


def context_block(fields: dict[str, Column]) -> Column:
    """One labelled line for each field that is not empty."""
    lines = (F.when(F.coalesce(fields[name], F.lit("")) != "", F.concat(F.lit(f"- {label}: "), fields[name])) for label, name in CONTEXT_FIELDS if name in fields)
    return F.concat_ws("\n", *lines)


def split_list(c: Column | str, by: str = ",") -> Column:
    return F.filter(F.transform(F.split(F.coalesce(_col(c), F.lit("")), by), lambda x: F.trim(x)), lambda x: x != "")


def first_fenced(c: Column | str) -> Column:
    """What the first fenced block of a Markdown text holds, or the whole text."""
    inner = F.regexp_extract(_col(c), r"(?s)```\n(.*?)```", 1)
    return F.when(_col(c).rlike(r"(?s)```\n.*?```"), inner).otherwise(_col(c))


def wiki_slugs(c: Column | str) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(r"\[\[([^\]|]+)\]\]"), F.lit(1))


#: How a link to a document is written.
LINK = ('<a href="#knowledge/', '" class="knowledge__wikilink">', "</a>")


def resolved_links(rows: DataFrame, key: str, body: str, titles: DataFrame) -> DataFrame:
    """rows with the links [[slug]] of their bodies written out with the titles of the documents they name, or with the slugs themselves where there are none.

    titles: slug, title, one a slug. Bodies are cut at their links; the distinct slugs of each row meet their titles in a join, and the pieces are put
    together in order. Bodies without links, and null ones, stay as they are. The key tells rows apart.
    """
    link = r"\[\[(.+?)\]\]"
    slugs = F.regexp_extract_all(_col(body), F.lit(link), F.lit(1))
    named = rows.select(key, F.explode(F.array_distinct(slugs)).alias("slug")).join(titles.select("slug", "title"), "slug", "left")
    named = named.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("slug", F.coalesce("title", "slug")))).alias("titles_"))
    written = lambda s: F.concat(F.lit(LINK[0]), s, F.lit(LINK[1]), F.element_at("titles_", s), F.lit(LINK[2]))
    pieces = F.zip_with(F.split(_col(body), link, -1), slugs, lambda p, s: F.concat(p, F.when(s.isNull(), "").otherwise(written(s))))
    out = rows.join(named, key, "left")
    return out.withColumn(body, F.when(F.col("titles_").isNotNull(), F.array_join(pieces, "")).otherwise(_col(body))).drop("titles_")


def strip_fence(c: Column | str) -> Column:
    """Model output without the Markdown fence around it."""
    c = F.trim(_col(c))
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"^```[A-Za-z]*\s*\n?", ""), r"\n?```\s*$", ""))

"""Ordered rules as CASE columns: the first that holds decides."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import letter_runs

#: What notes say of a page that shows a colour chart.
CHART_WORDS = (
    "farbskala", "farb-", "grauskala", "farbkeil", "color chart", "grey scale", "graustuf",
    "farbkarte", "color patches", "kodak", "farbkontroll", "farbkalibrier", "color control",
)
#: What notes say of a page without writing.
BLANK_WORDS = ("rückseite", "rueckseite", "leer", "blank", "keine beschriftung", "kein text")
#: Frequent words of three languages; earlier languages win ties.
STOPWORDS = {
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "est", "dans", "qui", "ne", "pas", "sur", "au", "ce", "il"),
    "en": ("the", "and", "of", "to", "in", "a", "is", "that", "for", "it", "with", "was", "on", "are", "as", "at", "be", "this", "have", "from"),
}
#: Words in an object's type and in its classification, and the group they lead to, in order.
GROUP_RULES = (
    (("korrekturfahne", "druckfahne"), (), "korrekturfahne"),
    (("zeitungsausschnitt",), (), "zeitungsausschnitt"),
    (("konvolut",), (), "konvolut"),
    (("notizbuch", "manuskript"), (), "handschrift"),
    (("urkunde", "passkopie", "bescheid", "nachweis", "geburtsschein"), ("rechtsdokumente", "finanzen"), "formular"),
    (("typoskript", "durchschlag"), (), "typoskript"),
    (("register", "kalender", "adressbuch", "kontorbuch"), ("verzeichnisse", "kalender"), "tabellarisch"),
    (("karte", "eintrittskarte", "briefumschlag"), ("diverses", "büromaterialien"), "kurztext"),
)
#: Words in an object's type and the document type of exports, in order.
DOCUMENT_TYPES = {
    "manuskript": "manuscript", "notizbuch": "notebook", "tagebuch": "diary",
    "typoskript": "typescript", "typoskriptdurchschlag": "typescript",
    "karte": "postcard", "postkarte": "postcard",
    "kalender": "calendar", "register": "register", "kontorbuch": "ledger",
    "korrekturfahne": "proof_sheet", "druckfahne": "proof_sheet",
    "zeitungsausschnitt": "newspaper_clipping",
    "konvolut": "mixed_materials", "briefumschlag": "letter",
}
#: Region labels of a layout detector, and those that are skipped.
REGION_TYPES = {
    "title": "heading", "section_header": "heading", "section-header": "heading",
    "page_header": "heading", "page-header": "heading",
    "text": "paragraph", "caption": "paragraph", "footnote": "paragraph", "formula": "paragraph",
    "list_item": "list", "list-item": "list",
    "table": "table",
}
REGION_SKIP = ("picture", "page_footer", "page-footer")
#: Region types in PAGE XML.
PAGE_XML_TYPES = {"paragraph": "paragraph", "heading": "heading", "list": "list-label", "table": "other", "marginalia": "marginalia"}
LETTERS = "korrespondenzen"


@dataclass(frozen=True)
class Thresholds:
    """Limits of the quality rules."""

    short_text: int = 10
    length_share: float = 0.1
    empty_share: float = 0.75
    duplicate_chars: int = 50
    duplicate_jaccard: float = 0.9
    language_hits: int = 3
    language_words: int = 50
    cer_high: float = 0.03
    cer_moderate: float = 0.10
    overlap_verified: float = 0.95
    overlap_moderate: float = 0.90
    overlap_review: float = 0.75
    merge_same: float = 0.02
    merge_near: float = 0.05


DEFAULT = Thresholds()


def _has(c: Column, words) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | c.contains(w)
    return found


def page_type(text: Column, notes: Column, th: Thresholds = DEFAULT) -> Column:
    """color_chart by its notes, whatever the text; blank if short and noted so, or without text; else content."""
    notes, text = F.lower(F.coalesce(notes, F.lit(""))), F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+\z", "")
    blank = (text == "") | ((F.length(text) < th.short_text) & _has(notes, BLANK_WORDS))
    return F.when(_has(notes, CHART_WORDS), "color_chart").when(blank, "blank").otherwise("content")


def object_group(object_type: Column, classification: Column, collection: Column) -> Column:
    kind, cls = F.lower(F.coalesce(object_type, F.lit(""))), F.lower(F.coalesce(classification, F.lit("")))
    out = F.when(collection == LETTERS, "korrespondenz")
    for types, classes, group in GROUP_RULES:
        out = out.when(_has(kind, types) | _has(cls, classes), group)
    return out.otherwise("handschrift")


def document_type(object_type: Column, classification: Column, collection: Column) -> Column:
    kind, cls = F.lower(F.coalesce(object_type, F.lit(""))), F.lower(F.coalesce(classification, F.lit("")))
    out = F.when(collection == LETTERS, "letter")
    for word, found in DOCUMENT_TYPES.items():
        out = out.when(kind.contains(word), found)
    return out.when(_has(cls, ("rechtsdokumente", "finanzen")), "form").when(cls.contains("verlagsvertr"), "certificate").otherwise("manuscript")


def letter_type(title: Column) -> Column:
    t = F.lower(title)
    return F.when(t.contains("ansichtspostkarte"), "Ansichtspostkarte").when(t.contains("postkarte"), "Postkarte").when(t.contains("telegramm"), "Telegramm").otherwise("Brief")


def agreement(cer: Column, th: Thresholds = DEFAULT) -> Column:
    return F.when(cer < th.cer_high, "high").when(cer < th.cer_moderate, "moderate").otherwise("low")


def consensus(cer: Column, overlap: Column, th: Thresholds = DEFAULT) -> Column:
    verified = (cer < th.cer_high) | ((overlap >= th.overlap_verified) & (cer < th.cer_moderate))
    return F.when(verified, "verified").when((cer < th.cer_moderate) | (overlap >= th.overlap_moderate), "moderate").when(overlap >= th.overlap_review, "review").otherwise("divergent")


def truncation(pages: Column, images_in: Column, images: Column) -> Column:
    """Null where nothing is amiss or there are no images."""
    return F.when(images > 0, F.when((images_in > 0) & (images_in <= 5) & (images > 5), "max5_truncated").when(pages == 0, "zero_pages").when((images_in > 5) & (pages < images_in), "vlm_mismatch"))


def review_tier(gt_verified: Column, status: Column, needs_review: Column) -> Column:
    return F.when(gt_verified | (status == "gt_verified"), "gt_verified").when(status == "approved", "approved").when(status == "agent_verified", "agent_verified").when(needs_review, "needs_review").when(~needs_review, "ok").otherwise("none")


def least_confidence(confidences: Column) -> Column:
    """The lowest of an array of low, medium, high; names beyond these rank as medium, and none is high."""
    rank = lambda c: F.when(c == "low", 0).when(c == "high", 2).otherwise(1)
    return F.coalesce(F.array_min(F.transform(confidences, lambda c: F.struct(rank(c).alias("r"), c.alias("c"))))["c"], F.lit("high"))


def layout_overall(marks: Column) -> Column:
    return F.when(F.array_contains(marks, "needs_correction"), "needs_correction").when(F.array_contains(marks, "acceptable"), "acceptable").otherwise("good")


def cer_bin(cer: Column) -> Column:
    return F.when(cer < 0.03, "<3").when(cer < 0.05, "<5").when(cer < 0.10, "<10").when(cer < 0.20, "<20").otherwise(">=20")


def adaptive_band(cer: Column) -> Column:
    return F.when(cer < 0.05, "<5").when(cer <= 0.15, "5-15").when(cer <= 0.30, "15-30").otherwise(">30")


def ratio_bin(ratio: Column) -> Column:
    return F.least(F.lit(7), F.floor(ratio * 10)).cast("int")


def region_type(label: Column) -> Column:
    """Null for labels that are skipped."""
    table = F.create_map(*(F.lit(x) for kv in REGION_TYPES.items() for x in kv))
    return F.when(~label.isin(*REGION_SKIP), F.coalesce(F.element_at(table, label), F.lit("paragraph")))


def language_marks(text: Column) -> Column:
    """Which of the languages' most frequent words a text has; those of several texts may be put together."""
    return F.array_intersect(letter_runs(text), F.array(*(F.lit(w) for w in dict.fromkeys(w for words in STOPWORDS.values() for w in words))))


def language_of_marks(marks: Column, th: Thresholds = DEFAULT) -> Column:
    """The language of which most frequent words occur; empty below three of them."""
    hits = {lang: F.size(F.array_intersect(marks, F.array(*map(F.lit, words)))) for lang, words in STOPWORDS.items()}
    best = F.greatest(*hits.values())
    out = F.when(best < th.language_hits, "")
    for lang, n in hits.items():
        out = out.when(n == best, lang)
    return F.coalesce(out, F.lit(""))


def detect_language(text: Column, th: Thresholds = DEFAULT) -> Column:
    return language_of_marks(letter_runs(text), th)

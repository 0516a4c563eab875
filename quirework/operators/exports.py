"""Exchange formats: page JSON, MODS and METS, as columns of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The names that the formats prescribe.
MODS = "http://www.loc.gov/mods/v3"
METS = "http://www.loc.gov/METS/"
XLINK = "http://www.w3.org/1999/xlink"
RIGHTS = "http://dfg-viewer.de/"


def truthy(c: Column | str) -> Column:
    """A text that is not empty, else null."""
    return F.nullif(c, F.lit(""))


def some(c: Column) -> Column:
    """A list that is not empty, else null."""
    return F.when(F.size(c) > 0, c)


def record(**fields: Column) -> Column:
    """A struct of fields; null if all are null, so that JSON leaves it out."""
    return F.when(F.greatest(*(v.isNotNull() for v in fields.values()), F.lit(False)), F.struct(*(v.alias(k) for k, v in fields.items())))


def descriptive(m: Column, rights: Column) -> Column:
    """The descriptive block: only what is there. m: creators, subject, holding, provenance, hands as lists or structs; the rest texts."""
    t = lambda k: truthy(m[k])
    physical = record(writing_instrument=t("writing_instrument"), writing_material=t("writing_material"), hands=some(m["hands"]), dimensions=t("dimensions"), binding=t("binding"), inscriptions=t("inscriptions"))
    return record(creator=some(m["creators"]), subject=some(m["subject"]), origin_place=t("origin_place"), extent=t("extent"), rights=truthy(rights), holding=m["holding"], provenance=some(m["provenance"]), physical_description=physical, notes=t("notes"))


def page_json(source: Column, provenance: Column, pages: Column, confidence: Column, notes: Column, quality: Column, review: Column) -> Column:
    """Page JSON 0.2 of an object; what is null is left out."""
    return F.to_json(F.struct(F.lit("0.2").alias("page_json"), source.alias("source"), provenance.alias("provenance"), pages.alias("pages"), truthy(confidence).alias("confidence"), truthy(notes).alias("confidence_notes"), quality.alias("quality"), review.alias("review")))


def escaped(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def quoted(c: Column) -> Column:
    """A text within an attribute's double quotes."""
    return F.replace(escaped(c), F.lit('"'), F.lit("&quot;"))


def element(name: str, content: Column | None, attributes: str = "") -> Column:
    """An XML element around content; null without it."""
    return F.concat(F.lit(f"<{name}{attributes}>"), content, F.lit(f"</{name}>"))


def joined(*parts: Column) -> Column:
    """The parts that are there; null if none is."""
    return truthy(F.concat_ws("", *parts))


def each(values: Column, make) -> Column:
    return truthy(F.array_join(F.transform(values, make), ""))


def mods(m: Column, rights: Column, pid: Column, language: Column, language_code: Column) -> Column:
    """MODS of an object's metadata. m: title, signature, creators (name, role, gnd), date, origin_place, objecttyp, subject, extent, dimensions,
    writing_instrument, writing_material, hands, repository, repository_gnd, provenance, notes; language by name (may be empty) and code."""
    t = lambda k: escaped(truthy(m[k]))
    creator = lambda c: element("mods:name", joined(element("mods:displayForm", escaped(F.coalesce(c["name"], F.lit("")))), element("mods:role", element("mods:roleTerm", escaped(truthy(c["role"])), ' type="text"')), element("mods:nameIdentifier", escaped(truthy(c["gnd"])), ' type="gnd"')), ' type="personal"')
    note = lambda kind: (lambda c: element("mods:note", escaped(c), f' type="{kind}"'))
    known = (F.coalesce(language, F.lit("")) != "") | (language_code != "und")
    place = F.when(
        truthy(m["repository"]).isNotNull(),
        F.concat(F.lit("<mods:physicalLocation"), F.coalesce(F.concat(F.lit(' authority="gnd" valueURI="'), quoted(truthy(m["repository_gnd"])), F.lit('"')), F.lit("")), F.lit(">"), t("repository"), F.lit("</mods:physicalLocation>")),
    )
    return element(
        "mods:mods",
        F.concat_ws(
            "",
            element("mods:titleInfo", joined(element("mods:title", F.coalesce(t("title"), F.lit(""))), note("signature")(truthy(m["signature"])))),
            each(m["creators"], creator),
            F.when(known, element("mods:language", joined(element("mods:languageTerm", escaped(truthy(language)), ' type="text"'), element("mods:languageTerm", language_code, ' authority="iso639-1" type="code"')))),
            element("mods:originInfo", joined(element("mods:dateCreated", t("date")), element("mods:place", element("mods:placeTerm", t("origin_place"), ' type="text"')))),
            element("mods:genre", t("objecttyp")),
            element("mods:subject", each(m["subject"], lambda s: element("mods:topic", escaped(s)))),
            element("mods:physicalDescription", joined(element("mods:extent", t("extent")), element("mods:extent", t("dimensions")), note("writing_instrument")(truthy(m["writing_instrument"])), note("writing_material")(truthy(m["writing_material"])), each(m["hands"], note("script")))),
            element("mods:location", joined(place, element("mods:shelfLocator", t("signature")))),
            element("mods:identifier", F.concat(F.lit("info:fedora/"), escaped(truthy(pid))), ' type="urn"'),
            each(F.filter(m["provenance"], lambda p: p != ""), note("provenance")),
            element("mods:accessCondition", escaped(truthy(rights))),
            element("mods:note", t("notes")),
        ),
        f' xmlns:mods="{MODS}"',
    )


def link_target(kind: Column) -> Column:
    """The logical part that a page belongs to: text pages, or charts and the rest."""
    return F.when(F.coalesce(kind, F.lit("content")) == "content", "U.1").otherwise("U.2")


def mets(mods_xml: Column, owner: Column, object_id: Column, base: Column, images: Column, kinds: Column, layouts: Column) -> Column:
    """METS of an object. images: URLs in order; kinds: page types by page; layouts: numbers of pages with a PAGE XML; base: what IMG.n is appended to."""
    n = lambda i: (i + 1).cast("string")
    here = F.lit
    file_ = lambda i, url: F.concat(here('<mets:file ID="IMG.'), n(i), here('" MIMETYPE="image/jpeg"><mets:FLocat LOCTYPE="URL" xlink:href="'), quoted(url), here('" /></mets:file>'))
    page_file = lambda k: F.concat(here('<mets:file ID="PAGE.'), k.cast("string"), here('" MIMETYPE="application/xml"><mets:FLocat LOCTYPE="URL" xlink:href="'), quoted(object_id), here("_page/page_"), F.lpad(k.cast("string"), 3, "0"), here('.xml" /></mets:file>'))
    has = lambda i: F.when(F.array_contains(layouts, i + 1), F.concat(here('<mets:fptr FILEID="PAGE.'), n(i), here('" />'))).otherwise("")
    page = lambda url, i: F.concat(here('<mets:div ID="DIV.'), n(i), here('" ORDER="'), n(i), here('" TYPE="page" CONTENTIDS="'), quoted(base), here("/IMG."), n(i), here('"><mets:fptr FILEID="IMG.'), n(i), here('" />'), has(i), here("</mets:div>"))
    link = lambda url, i: F.concat(here('<mets:smLink xlink:from="'), link_target(F.get(kinds, i)), here('" xlink:to="DIV.'), n(i), here('" />'))
    all_ = lambda make: F.array_join(F.transform(images, make), "")
    return F.concat(
        here(f'<mets:mets xmlns:mets="{METS}" xmlns:xlink="{XLINK}" xmlns:dv="{RIGHTS}"><mets:dmdSec ID="DMD.1"><mets:mdWrap MDTYPE="MODS" MIMETYPE="text/xml"><mets:xmlData>'), mods_xml,
        here('</mets:xmlData></mets:mdWrap></mets:dmdSec><mets:amdSec ID="AMD.1"><mets:rightsMD ID="RMD.1"><mets:mdWrap MDTYPE="OTHER" MIMETYPE="text/xml" OTHERMDTYPE="DVRIGHTS"><mets:xmlData><dv:rights><dv:owner>'), escaped(owner),
        here('</dv:owner></dv:rights></mets:xmlData></mets:mdWrap></mets:rightsMD><mets:digiprovMD ID="PMD.1"><mets:mdWrap MDTYPE="OTHER" MIMETYPE="text/xml" OTHERMDTYPE="DVLINKS"><mets:xmlData><dv:links><dv:reference /><dv:presentation /></dv:links></mets:xmlData></mets:mdWrap></mets:digiprovMD></mets:amdSec>'),
        here('<mets:fileSec><mets:fileGrp USE="DEFAULT">'), all_(lambda url, i: file_(i, url)), here("</mets:fileGrp>"), F.coalesce(element("mets:fileGrp", each(layouts, page_file), ' USE="PAGE"'), here("")),
        here('</mets:fileSec><mets:structMap TYPE="PHYSICAL"><mets:div ID="PHY.1" TYPE="physSequence">'), all_(page),
        here('</mets:div></mets:structMap><mets:structMap TYPE="LOGICAL"><mets:div ADMID="AMD.1" DMDID="DMD.1" ID="LOG.1" TYPE="monograph"><mets:div ID="U.1" TYPE="Textseiten" /><mets:div ID="U.2" TYPE="Farbreferenz/Schluss" /></mets:div></mets:structMap><mets:structLink>'),
        all_(link), here("</mets:structLink></mets:mets>"),
    )

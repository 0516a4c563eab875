"""Layout regions: boxes are [x, y, w, h] in percent of the page."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import PAGE_XML_TYPES
from ..functions.text import lookup
from .readings import spread_out


def percent_box(left: Column, top: Column, right: Column, bottom: Column, width: Column, height: Column, from_bottom: bool = False) -> Column:
    """Pixels to a percent box, within 0 to 100, to one decimal; with `from_bottom`, y counts upwards."""
    limit = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(100.0), c))
    y = (height - top) if from_bottom else top
    tall = F.abs(bottom - top)
    return F.array(*(F.bround(limit(c), 1) for c in (left / width * 100, y / height * 100, (right - left) / width * 100, tall / height * 100)))


def area(b: Column) -> Column:
    return b[2] * b[3]


def iou(a: Column, b: Column) -> Column:
    """Intersection over union."""
    w = F.least(a[0] + a[2], b[0] + b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[1] + a[3], b[1] + b[3]) - F.greatest(a[1], b[1])
    both = F.when((w > 0) & (h > 0), w * h).otherwise(0.0)
    return F.coalesce(F.try_divide(both, area(a) + area(b) - both), F.lit(0.0))


def contains(outer: Column, inner: Column, slack: float = 1.0) -> Column:
    near = lambda i: (inner[i] >= outer[i] - slack) & (inner[i] + inner[i + 2] <= outer[i] + outer[i + 2] + slack)
    return near(0) & near(1)


def clamped(b: Column) -> Column:
    return F.transform(b, lambda v: F.greatest(F.lit(0.0), F.least(F.lit(100.0), v)))


def valid(b: Column) -> Column:
    """Large enough, and not the whole page."""
    return (F.size(b) == 4) & (b[2] > 0.5) & (b[3] > 0.3) & ~((b[2] > 95) & (b[3] > 95))


def polygon(b: Column, width: Column, height: Column) -> Column:
    """Corner points in pixels, clockwise from the upper left, within the picture."""
    at = lambda v, n: F.bround(v / 100 * n).cast("int")
    x1, y1 = F.greatest(F.lit(0), at(b[0], width)), F.greatest(F.lit(0), at(b[1], height))
    x2, y2 = F.least(width.cast("int"), at(b[0] + b[2], width)), F.least(height.cast("int"), at(b[1] + b[3], height))
    return F.format_string("%d,%d %d,%d %d,%d %d,%d", x1, y1, x2, y1, x2, y2, x1, y2)


def edge_noise(kind: Column, b: Column) -> Column:
    """Flat strips at the top or bottom (small headings stay: they are page numbers), and tall slivers at the sides."""
    flat = (b[3] < 2) & ((b[1] < 8) | (b[1] + b[3] > 92)) & ((kind != "heading") | (b[2] > 15))
    sliver = (b[2] < 3) & ((b[0] < 8) | (b[0] + b[2] > 92)) & (b[3] > 20)
    return flat | sliver


def _suppress(regions: pd.DataFrame) -> pd.DataFrame:
    """Of overlapping regions of one type the larger stays, met in order; then flat regions inside one of more than three times their area go."""
    regions = regions.sort_values(["reading_order", "region_id"], kind="stable")
    boxes, kinds, live = regions["bbox"].tolist(), regions["type"].tolist(), ~regions["noise"].to_numpy(copy=True)
    if len(boxes) > 1:

        def overlap(a, b):
            w, h = min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0]), min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1])
            both = w * h if w > 0 and h > 0 else 0.0
            whole = a[2] * a[3] + b[2] * b[3] - both
            return both / whole if whole > 0 else 0.0

        for i, a in enumerate(boxes):
            later = (j for j in range(i + 1, len(boxes)) if live[j] and kinds[j] == kinds[i] and overlap(a, boxes[j]) > 0.5)
            while live[i] and (j := next(later, None)) is not None:
                live[j if a[2] * a[3] >= boxes[j][2] * boxes[j][3] else i] = False
        for i, a in enumerate(boxes):
            inside = lambda o, a=a: o[2] * o[3] > 3 * a[2] * a[3] and all(a[k] >= o[k] - 1 and a[k] + a[k + 2] <= o[k] + o[k + 2] + 1 for k in (0, 1))
            if live[i] and a[3] < 1.5 and any(live[j] and j != i and inside(o) for j, o in enumerate(boxes)):
                live[i] = False
    else:
        live[:] = True
    return regions.loc[live, ["object_id", "page", "region_id", "type", "bbox", "reading_order"]]


def cleaned(regions: DataFrame) -> DataFrame:
    """regions: object_id, page, region_id, type, bbox, reading_order. Without noise and duplicates; where any went, ids and order are given anew.

    Suppression depends on order, so it goes page by page; a page has few regions.
    """
    rows = regions.withColumn("noise", edge_noise(F.col("type"), F.col("bbox")))
    kept = rows.groupBy("object_id", "page").applyInPandas(_suppress, "object_id string, page int, region_id string, type string, bbox array<double>, reading_order int")
    before = regions.groupBy("object_id", "page").agg(F.count("*").alias("before"))
    w = Window.partitionBy("object_id", "page")
    nth = F.row_number().over(w.orderBy("reading_order", "region_id"))
    kept = kept.withColumns({"nth": nth, "after": F.count("*").over(w)}).join(before, ["object_id", "page"])
    anew = F.col("after") < F.col("before")
    return kept.select("object_id", "page", F.when(anew, F.concat(F.lit("r"), "nth")).otherwise(F.col("region_id")).alias("region_id"), "type", "bbox", F.when(anew, F.col("nth")).otherwise(F.col("reading_order")).alias("reading_order"))


def text_to_regions(regions: DataFrame, pages: DataFrame) -> DataFrame:
    """Adds text: a page's lines dealt to its regions in reading order by their estimated lines; the last gets the rest."""
    w = Window.partitionBy("object_id", "page").orderBy("reading_order", "region_id")
    all_ = Window.partitionBy("object_id", "page")
    rows = regions.join(pages.select("object_id", "page", F.split("text", "\n").alias("text_lines")), ["object_id", "page"])
    total = F.sum("lines").over(all_)
    n = F.size("text_lines")
    share = F.when(total > 0, F.greatest(F.lit(1), F.bround(n * F.col("lines") / total))).otherwise(F.greatest(F.lit(1), F.floor(n / F.count("*").over(all_)))).cast("int")
    rows = rows.withColumn("share", share)
    rows = rows.withColumns({"start": F.coalesce(F.sum("share").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int"), "is_last": F.lead("region_id").over(w).isNull()})
    take = F.when(F.col("is_last"), F.greatest(F.size("text_lines") - F.col("start"), F.lit(0))).otherwise(F.col("share"))
    return rows.withColumn("text", F.array_join(F.slice("text_lines", F.col("start") + 1, take), "\n")).drop("text_lines", "share", "start", "is_last")


def page_xml(regions: DataFrame) -> DataFrame:
    """object_id, page, xml: one PAGE document a page, from regions with text, picture name and size. Text is escaped; regions stand in reading order."""
    esc = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    kind = F.coalesce(lookup(F.col("type"), PAGE_XML_TYPES), F.lit("paragraph"))
    body = F.concat(
        F.lit('<TextRegion id="'), esc(F.col("region_id")), F.lit('" type="'), kind, F.lit('"><Coords points="'), polygon(F.col("bbox"), F.col("width"), F.col("height")), F.lit('"/>'),
        F.when(F.coalesce("text", F.lit("")) != "", F.concat(F.lit("<TextEquiv><Unicode>"), esc(F.col("text")), F.lit("</Unicode></TextEquiv>"))).otherwise(""), F.lit("</TextRegion>"),
    )
    each = F.array_sort(F.collect_list(F.struct("reading_order", "region_id", body.alias("body"))))
    rows = regions.groupBy("object_id", "page", "image", "width", "height").agg(each.alias("each"))
    order = F.array_join(F.transform("each", lambda r, i: F.concat(F.lit('<RegionRefIndexed regionRef="'), esc(r["region_id"]), F.lit('" index="'), i.cast("string"), F.lit('"/>'))), "")
    xml = F.concat(
        F.lit('<PcGts xmlns="http://schema.primaresearch.org/PAGE/gts/pagecontent/2019-07-15"><Page imageFilename="'), esc(F.col("image")), F.lit('" imageWidth="'), F.col("width").cast("string"), F.lit('" imageHeight="'), F.col("height").cast("string"),
        F.lit('"><ReadingOrder><OrderedGroup id="ro">'), order, F.lit("</OrderedGroup></ReadingOrder>"), F.array_join(F.transform("each", lambda r: r["body"]), ""), F.lit("</Page></PcGts>"),
    )
    return rows.select("object_id", "page", xml.alias("xml"))


def with_first_text(layouts: DataFrame, pages: DataFrame) -> DataFrame:
    """Layout rows (object_id, page) with the text of the page of that number: the first by pos where a result has the number twice, empty where it has none."""
    first = pages.groupBy("object_id", "page").agg(F.min_by("text", "pos").alias("text"))
    return layouts.join(first, ["object_id", "page"], "left").withColumn("text", F.coalesce("text", F.lit("")))


def merged_sources(model: DataFrame, regions: DataFrame, lines: DataFrame) -> DataFrame:
    """object_id, page, type, bbox, source, nth: the model's regions of a page or, where the model gave none, the detectors': regions first, then lines as paragraphs.

    model, regions and lines: object_id, page, nth, bbox; the first two with type. Order is that of the detectors, and nth counts anew from 1.
    """
    columns = ["object_id", "page", "type", "bbox"]
    detected = regions.select(*columns, "nth", F.lit(1).alias("rank"), F.lit("regions").alias("source")).unionByName(lines.withColumn("type", F.lit("paragraph")).select(*columns, "nth", F.lit(2).alias("rank"), F.lit("lines").alias("source")))
    every = model.select(*columns, "nth", F.lit(0).alias("rank"), F.lit("model").alias("source")).unionByName(detected)
    page = Window.partitionBy("object_id", "page")
    every = spread_out(every, ("object_id", "page"))  # a task holds as much whatever the size of the tables
    kept = every.withColumn("best_", F.min("rank").over(page)).where("best_ > 0 or rank = 0")
    return kept.withColumn("nth", F.row_number().over(page.orderBy("rank", "nth"))).select(*columns, "source", "nth")

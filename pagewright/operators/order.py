"""Sorts and reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.operators import reading
from pagewright.operators.paged import by_page

PAGE = "page_id"

#: Groups of labels that are ordered differently.
ORDER_GROUPS = {
    "doc_title": reading.TITLES,
    "paragraph_title": reading.HEADINGS,
    "vision": reading.VISION,
    "vision_title": reading.VISION_TITLES,
    "header": reading.HEADERS,
    "footer": reading.FOOTERS,
    "unordered": reading.UNORDERED,
}

# fixed values: red, green, blue and opacity that blocks are drawn with, by label and by the group they are ordered with
LABEL_COLOURS = {
    "paragraph_title": "102,102,255,100",
    "doc_title": "255,248,220,100",
    "table_title": "255,255,102,100",
    "figure_title": "102,178,255,100",
    "chart_title": "221,160,221,100",
    "vision_footnote": "144,238,144,100",
    "text": "153,0,76,100",
    "formula": "0,255,0,100",
    "abstract": "255,239,213,100",
    "content": "40,169,92,100",
    "seal": "158,158,158,100",
    "table": "204,204,0,100",
    "image": "153,255,51,100",
    "figure": "153,255,51,100",
    "chart": "216,191,216,100",
    "reference": "229,255,204,100",
    "algorithm": "255,250,240,100",
}
GROUP_COLOURS = {
    "doc_title": "255,248,220,100",
    "doc_title_text": "255,239,213,100",
    "paragraph_title": "102,102,255,100",
    "sub_paragraph_title": "102,178,255,100",
    "vision": "153,255,51,100",
    "vision_title": "144,238,144,100",
    "vision_footnote": "144,238,144,100",
    "normal_text": "153,0,76,100",
    "cross_layout": "53,218,207,100",
    "cross_reference": "221,160,221,100",
}
OTHER_COLOUR = "158,158,158,100"


def colour(name: Column, of_group: bool = False) -> Column:
    """Colour of a label, or of an order group; grey for all others."""
    known = F.create_map(*[F.lit(x) for kv in (GROUP_COLOURS if of_group else LABEL_COLOURS).items() for x in kv])
    return F.coalesce(known[name], F.lit(OTHER_COLOUR))


def order_label(label: Column) -> Column:
    """The group a label is ordered with; normal_text for all labels not named."""
    out = F.lit("normal_text")
    for group, labels in reversed(list(ORDER_GROUPS.items())):
        out = F.when(label.isin(*labels), group).otherwise(out)
    return out


def two_column_order(blocks: DataFrame, page_width: int) -> DataFrame:
    """(page_id, box_id, place): blocks across the page part it into bands; within one the left column comes before the right.

    Left: starts in the first quarter and ends before three fifths; right: starts after two fifths.
    """
    order = Window.partitionBy(PAGE).orderBy("y1", "x1", "box_id")
    side = F.when((F.col("x1") < page_width / 4) & (F.col("x2") < 3 * page_width / 5), 0).when(F.col("x1") > 2 * page_width / 5, 1).otherwise(2)
    rows = blocks.withColumn("_side", side)
    # a crossing block closes the band before it and comes last in it
    rows = rows.withColumn("_band", F.sum((F.col("_side") == 2).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.when(F.col("_side") == 2, 1).otherwise(0))
    place = F.row_number().over(Window.partitionBy(PAGE).orderBy("_band", "_side", "y1", "x1", "box_id"))
    return rows.select(PAGE, "box_id", place.cast("long").alias("place"))


def normal_order(blocks: DataFrame, line_height: int, line_width: int, direction: str = "horizontal") -> DataFrame:
    """(page_id, box_id, place): by text row, then text column, then distance of the centre from the origin."""
    row, col = F.floor(F.col("y1") / line_height), F.floor(F.col("x1") / line_width)
    centre = (F.col("x1") + F.col("x2")) * (F.col("x1") + F.col("x2")) + (F.col("y1") + F.col("y2")) * (F.col("y1") + F.col("y2"))
    keys = (row, col) if direction == "horizontal" else (-F.floor(F.col("x1") / line_width), F.floor(F.col("y1") / line_height))
    return blocks.select(PAGE, "box_id", F.row_number().over(Window.partitionBy(PAGE).orderBy(*keys, centre, "box_id")).cast("long").alias("place"))


def child_order(children: DataFrame, direction: str = "horizontal") -> DataFrame:
    """(page_id, parent_block_id, box_id, place): children along the reading direction, then across it."""
    keys = ("y1", "x1") if direction == "horizontal" else ("x1", "y1")
    return children.select(PAGE, "parent_block_id", "box_id", F.row_number().over(Window.partitionBy(PAGE, "parent_block_id").orderBy(*keys, "box_id")).cast("long").alias("place"))


def by_area(regions: DataFrame) -> DataFrame:
    """Regions from the smallest, ties to the smaller id: (page_id, box_id, place)."""
    return regions.select(PAGE, "box_id", F.row_number().over(Window.partitionBy(PAGE).orderBy(G.area(G.box()), "box_id")).cast("long").alias("place"))


def top_classes(rows: DataFrame, scores: str, k: int, *keys: str) -> DataFrame:
    """(keys, class_id, score, place): the k best classes of a score array, scores to five places, ties to the smaller class."""
    listed = F.transform(F.col(scores), lambda s, i: F.struct((-s).alias("neg"), i.alias("class_id")))
    best = rows.select(*keys, F.posexplode(F.slice(F.array_sort(listed), 1, k)).alias("p", "c"))
    return best.select(*keys, F.col("c.class_id").alias("class_id"), F.round(-F.col("c.neg"), 5).alias("score"), (F.col("p") + 1).cast("long").alias("place"))


def argmax(scores: Column) -> Column:
    """First place, from 0, of the largest entry."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


# --- reading order ---------------------------------------------------------------------------

#: Optional columns of blocks that the reading order uses: text lines, their mean size, and where the first and last line begin and end.
LINE_COLUMNS = {"lines": "int", "line_width": "double", "line_height": "double", "seg_start": "double", "seg_end": "double", "direction": "string"}


def _blocks(page: dict[str, list]) -> list[reading.Block]:
    out = []
    for k, id_ in enumerate(page["box_id"]):
        given = {c: page[c][k] for c in ("lines", "line_width", "line_height", "seg_start", "seg_end") if c in page and page[c][k] is not None}
        axis = {"horizontal": 0, "vertical": 1}.get(page["direction"][k]) if "direction" in page else None
        out.append(reading.Block(id_, page["label"][k], [page[s][k] for s in G.SIDES], axis=axis, **given))
    return out


def _enclosing(blocks: list[reading.Block]) -> tuple[int, int, int, int]:
    sides = list(zip(*(b.own for b in blocks), strict=True))
    return min(sides[0]), min(sides[1]), max(sides[2]), max(sides[3])


def order_page(page: dict[str, list]) -> list[int]:
    """Box ids of a page in reading order; with ``region_id`` in two levels, blocks without a region last."""
    blocks = _blocks(page)
    regions: dict = {}
    for b, region in zip(blocks, page.get("region_id", [0] * len(blocks)), strict=True):
        regions.setdefault((region is None, region or 0), []).append(b)
    return [b.id for b in reading.order_regions([(_enclosing(regions[r]), regions[r]) for r in sorted(regions)], _enclosing(blocks))]


def _ordered(page: dict[str, list]) -> dict[str, list]:
    ids = order_page(page)
    return {PAGE: page[PAGE], "box_id": ids, "order_index": list(range(1, len(ids) + 1))}


def reading_order(blocks: DataFrame) -> DataFrame:
    """(page_id, box_id, order_index) from 1.

    blocks: page_id, box_id, label, the four sides, and any of ``LINE_COLUMNS`` and region_id.
    A page is one unit of work: its blocks move each other, so it is ordered as a whole.
    """
    more = [F.col(c).cast(kind).alias(c) for c, kind in (LINE_COLUMNS | {"region_id": "long"}).items() if c in blocks.columns]
    rows = blocks.select(PAGE, "box_id", "label", *[F.col(s).cast("double").alias(s) for s in G.SIDES], *more)
    return by_page(rows, [PAGE], ["box_id"], _ordered, f"{PAGE} long, box_id long, order_index long")


def order_regions_and_blocks(blocks: DataFrame, regions: DataFrame, bridge: DataFrame) -> DataFrame:
    """(page_id, box_id, order_index): regions as blocks of the page, then the blocks of each region; those without one last."""
    known = bridge.join(regions.select(PAGE, "region_id"), [PAGE, "region_id"], "left_semi").select(PAGE, "box_id", "region_id")
    return reading_order(blocks.drop("region_id").join(known, [PAGE, "box_id"], "left"))

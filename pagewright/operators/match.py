"""Joins of boxes, spans and cells within a page: equi on the page, theta on the geometry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import geometry as G

PAGE = "page_id"

#: Predicates on (block or first box, span or second box), by name.
PREDICATES = {
    "small": lambda a, b: G.overlap(a, b, "small") > 0.1,
    "pixels": lambda a, b: G.overlaps_pixels(a, b, 3),
    "inter2": lambda a, b: G.overlap(a, b, "second") > 0.7,
    "cover": lambda a, b: G.overlap(a, b, "second") > 0.5,
    "neighbour": lambda a, b: G.is_neighbour(a, b),
    "inside": lambda a, b: (b.x1 >= a.x1) & (b.y1 >= a.y1) & (b.x2 <= a.x2) & (b.y2 <= a.y2),
}


def match(left: DataFrame, right: DataFrame, predicate: str = "small", left_id: str = "box_id", right_id: str = "span_id") -> DataFrame:
    """Bridge table (page_id, left id, right id) of all pairs of a page for which the predicate holds."""
    a = left.select(PAGE, left_id, *G.SIDES).alias("a")
    b = right.select(PAGE, right_id, *G.SIDES).alias("b")
    joined = a.join(b, (F.col(f"a.{PAGE}") == F.col(f"b.{PAGE}")) & PREDICATES[predicate](G.box(table="a"), G.box(table="b")))
    return joined.select(F.col(f"a.{PAGE}").alias(PAGE), F.col(f"a.{left_id}").alias(left_id), F.col(f"b.{right_id}").alias(right_id))


def match_blocks_to_spans(blocks: DataFrame, spans: DataFrame, predicate: str = "small", without: tuple[str, ...] = ("formula", "table", "seal")) -> DataFrame:
    """Block-span bridge; blocks of the labels in ``without`` have their text from elsewhere."""
    return match(blocks.where(~F.col("label").isin(*without)), spans, predicate)


def inside(spans: DataFrame, regions: DataFrame, flag_within: bool = True) -> DataFrame:
    """Spans that overlap some region by more than three pixels both ways, or those that overlap none."""
    s, r = spans.alias("s"), regions.select(PAGE, *G.SIDES).alias("r")
    condition = (F.col(f"s.{PAGE}") == F.col(f"r.{PAGE}")) & G.overlaps_pixels(G.box(table="s"), G.box(table="r"))
    return s.join(r, condition, "left_semi" if flag_within else "left_anti")


def paragraphs_only(spans: DataFrame, blocks: DataFrame, labels: tuple[str, ...] = ("formula", "table", "seal")) -> DataFrame:
    """Spans outside formulas, tables and seals."""
    return inside(spans, blocks.where(F.col("label").isin(*labels)), False)


def nearest_cell(spans: DataFrame, cells: DataFrame) -> DataFrame:
    """Exactly one cell for each span: least (1 - IoU, corner distance), ties to the smaller cell_id.

    (page_id, span_id, cell_id).  The distance is the sum of the corners' coordinate gaps plus
    the smaller of the two corner pairs' own sums.
    """
    s, c = spans.select(PAGE, "span_id", *G.SIDES).alias("s"), cells.select(PAGE, "cell_id", *G.SIDES).alias("c")
    a, b = G.box(table="s"), G.box(table="c")
    top = F.abs(b.x1 - a.x1) + F.abs(b.y1 - a.y1)
    bottom = F.abs(b.x2 - a.x2) + F.abs(b.y2 - a.y2)
    far = top + bottom + F.least(top, bottom)
    joined = s.join(c, F.col(f"s.{PAGE}") == F.col(f"c.{PAGE}"))
    best = F.struct((1 - G.overlap(a, b, "union")).alias("d"), far.alias("far"), F.col("c.cell_id").alias("cell_id"))
    return joined.groupBy(F.col(f"s.{PAGE}").alias(PAGE), F.col("s.span_id").alias("span_id")).agg(F.min(best).alias("best")).select(PAGE, "span_id", F.col("best.cell_id").alias("cell_id"))


def neighbour_text(tables: DataFrame, spans: DataFrame) -> DataFrame:
    """(page_id, box_id, neighbor_texts): texts just above or below each table, joined in span order."""
    hits = match(tables, spans, "neighbour").join(spans.select(PAGE, "span_id", "text"), [PAGE, "span_id"])
    return hits.groupBy(PAGE, "box_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("span_id", "text"))), lambda x: x.text), "; ").alias("neighbor_texts"))


def beside(blocks: DataFrame, axis: str = "horizontal", least: float = 0.1) -> DataFrame:
    """(page_id, box_id, before, after): blocks whose projections overlap the block's, ordered away from it.

    ``axis`` is the one projected on; ids of earlier blocks come nearest first, as do later ones.
    """
    start, end = ("y1", "y2") if axis == "horizontal" else ("x1", "x2")
    b = blocks.select(PAGE, "box_id", *G.SIDES)
    joined = b.alias("p").join(b.alias("q"), (F.col(f"p.{PAGE}") == F.col(f"q.{PAGE}")) & (F.col("p.box_id") != F.col("q.box_id")) & (G.projection_overlap(G.box(table="p"), G.box(table="q"), axis, "small") > least))
    before = F.when(F.col(f"q.{end}") <= F.col(f"p.{start}"), F.struct((-F.col(f"q.{end}")).alias("k"), F.col("q.box_id").alias("id")))
    after = F.when(F.col(f"q.{end}") > F.col(f"p.{start}"), F.struct(F.col(f"q.{start}").alias("k"), F.col("q.box_id").alias("id")))
    lists = joined.groupBy(F.col(f"p.{PAGE}").alias(PAGE), F.col("p.box_id").alias("box_id")).agg(F.array_sort(F.collect_list(before)).alias("b"), F.array_sort(F.collect_list(after)).alias("a"))
    return lists.select(PAGE, "box_id", F.transform("b", lambda x: x.id).alias("before"), F.transform("a", lambda x: x.id).alias("after"))


def uncovered(spans: DataFrame, cells: DataFrame, share: float = 0.6) -> DataFrame:
    """Spans of which all cells together cover less than ``share``."""
    s, c = spans.select(PAGE, "span_id", *G.SIDES).alias("s"), cells.select(PAGE, *G.SIDES).alias("c")
    covered = G.overlap(G.box(table="s"), G.box(table="c"), "first")
    joined = s.join(c, (F.col(f"s.{PAGE}") == F.col(f"c.{PAGE}")) & (G.inter_area(G.box(table="s"), G.box(table="c")) > 0), "left")
    total = joined.groupBy(F.col(f"s.{PAGE}").alias(PAGE), F.col("s.span_id").alias("span_id")).agg(F.sum(F.coalesce(F.when(F.col(f"c.{PAGE}").isNotNull(), covered), F.lit(0.0))).alias("covered"))
    return total.where(F.col("covered") < share).select(PAGE, "span_id")


def split_spans(spans: DataFrame, cells: DataFrame, least_cells: int = 2) -> DataFrame:
    """Pieces of spans that cover at least ``least_cells`` cells: one for each cell and each gap, left to right.

    (page_id, span_id, piece, x1, y1, x2, y2); equal pieces occur once.
    """
    hit = match(spans, cells, "cover", "span_id", "cell_id")
    joined = hit.join(spans.select(PAGE, "span_id", *G.SIDES), [PAGE, "span_id"]).join(cells.select(PAGE, "cell_id", F.col("x1").alias("cx1"), F.col("x2").alias("cx2")), [PAGE, "cell_id"])
    grouped = joined.groupBy(PAGE, "span_id", *G.SIDES).agg(F.array_sort(F.collect_list(F.struct("cx1", "cx2"))).alias("cells")).where(F.size("cells") >= least_cells)
    state = F.struct(F.col("x1").alias("at"), F.array().cast("array<struct<x1:bigint,x2:bigint>>").alias("out"))

    def step(acc: Column, c: Column) -> Column:
        lo, hi = F.greatest(c.cx1, F.col("x1")), F.least(c.cx2, F.col("x2"))
        gap = F.when(lo > acc.at, F.array(F.struct(acc.at.alias("x1"), lo.alias("x2")))).otherwise(F.slice(acc.out, 1, 0))
        own = F.when(hi > lo, F.array(F.struct(lo.alias("x1"), hi.alias("x2")))).otherwise(F.slice(acc.out, 1, 0))
        return F.struct(F.greatest(acc.at, hi).alias("at"), F.concat(acc.out, gap, own).alias("out"))

    walked = grouped.withColumn("w", F.aggregate("cells", state, step))
    tail = F.when(F.col("w.at") < F.col("x2"), F.array(F.struct(F.col("w.at").alias("x1"), F.col("x2").alias("x2")))).otherwise(F.slice(F.col("w.out"), 1, 0))
    pieces = walked.select(PAGE, "span_id", "y1", "y2", F.posexplode(F.array_distinct(F.concat(F.col("w.out"), tail))).alias("piece", "p"))
    return pieces.select(PAGE, "span_id", "piece", F.col("p.x1").alias("x1"), "y1", F.col("p.x2").alias("x2"), "y2")


def overlapping(boxes: DataFrame, others: DataFrame, mode: str = "union", threshold: float = 0.5, keep: bool = True) -> DataFrame:
    """Boxes (all columns) that overlap some other by more than the threshold, or with ``keep`` off those that overlap none so.

    ``mode``: the overlap's share of the union, or of the smaller or larger of the two.
    """
    a, b = boxes.alias("a"), others.select(PAGE, *G.SIDES).alias("b")
    condition = (F.col(f"a.{PAGE}") == F.col(f"b.{PAGE}")) & (G.overlap(G.box(table="a"), G.box(table="b"), mode) > threshold)
    return a.join(b, condition, "left_semi" if keep else "left_anti")


def in_interval(boxes: DataFrame, low: float, high: float, axis: str = "x") -> DataFrame:
    """(page_id, box_id, place): boxes that lie within an interval of an axis, by their end, ties to the smaller id."""
    rows = boxes.where((F.col(f"{axis}1") >= low) & (F.col(f"{axis}2") <= high))
    return rows.select(PAGE, "box_id", F.row_number().over(Window.partitionBy(PAGE).orderBy(f"{axis}2", "box_id")).cast("long").alias("place"))


def shared_spans(bridge: DataFrame) -> DataFrame:
    """Rows of a block-span bridge whose span is matched by two blocks or more."""
    return bridge.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(PAGE, "span_id"))).where("_n > 1").drop("_n")


def without_text(blocks: DataFrame, bridge: DataFrame, visual: tuple[str, ...] = ("image", "table", "formula", "seal", "chart")) -> DataFrame:
    """Blocks that should hold text and match no span."""
    return blocks.where(~F.col("label").isin(*visual)).join(bridge.select(PAGE, "box_id"), [PAGE, "box_id"], "left_anti")


def to_frame(spans: DataFrame, tables: DataFrame) -> DataFrame:
    """Spans fully inside a table, in the table's coordinates: (page_id, box_id, span_id, x1, y1, x2, y2)."""
    hit = match(tables, spans, "inside")
    moved = hit.join(spans.select(PAGE, "span_id", *G.SIDES), [PAGE, "span_id"]).join(tables.select(PAGE, "box_id", F.col("x1").alias("dx"), F.col("y1").alias("dy")), [PAGE, "box_id"])
    return moved.select(PAGE, "box_id", "span_id", (F.col("x1") - F.col("dx")).alias("x1"), (F.col("y1") - F.col("dy")).alias("y1"), (F.col("x2") - F.col("dx")).alias("x2"), (F.col("y2") - F.col("dy")).alias("y2"))


def assign_regions(regions: DataFrame, blocks: DataFrame, share: float = 0.6) -> DataFrame:
    """(page_id, region_id, box_id): each block goes to the smallest region that overlaps it by more than ``share``
    of the smaller area; ties to the smaller region_id.  Blocks of no region are left out (see ``supplement``)."""
    r = regions.select(PAGE, "region_id", *G.SIDES).alias("r")
    b = blocks.select(PAGE, "box_id", *G.SIDES).alias("b")
    joined = r.join(b, (F.col(f"r.{PAGE}") == F.col(f"b.{PAGE}")) & (G.overlap(G.box(table="r"), G.box(table="b"), "small") > share))
    first = F.min(F.struct(G.area(G.box(table="r")).alias("a"), F.col("r.region_id").alias("region_id"))).alias("m")
    return joined.groupBy(F.col(f"b.{PAGE}").alias(PAGE), F.col("b.box_id").alias("box_id")).agg(first).select(PAGE, F.col("m.region_id").alias("region_id"), "box_id")


def supplement(blocks: DataFrame, bridge: DataFrame, label: str = "SupplementaryRegion", masked: tuple[str, ...] = ()) -> DataFrame:
    """One region per page around the blocks of no region: (page_id, label, x1, y1, x2, y2, n_blocks).  Blocks of masked labels don't count."""
    rest = blocks.where(~F.col("label").isin(*masked)) if masked else blocks
    rest = rest.join(bridge.select(PAGE, "box_id"), [PAGE, "box_id"], "left_anti")
    return rest.groupBy(PAGE).agg(F.lit(label).alias("label"), F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"), F.count(F.lit(1)).alias("n_blocks"))


def flags_as_of(rows: DataFrame, flags: DataFrame) -> DataFrame:
    """As-of join: for each row start the largest flag at or before it, 0 where there is none.

    rows: (page_id, start); flags: (page_id, flag).  Union and running maximum, one sort per page.
    """
    both = rows.select(PAGE, "start", F.lit(None).cast("long").alias("flag"), F.lit(1).alias("is_row")).unionByName(
        flags.select(PAGE, F.col("flag").cast("long").alias("start"), F.col("flag").cast("long").alias("flag"), F.lit(0).alias("is_row"))
    )
    upto = Window.partitionBy(PAGE).orderBy("start", "is_row").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("flag", F.coalesce(F.max("flag").over(upto), F.lit(0))).where("is_row = 1").drop("is_row")

"""Windows, gaps-and-islands and ordered folds over a page's boxes or a sequence's steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import geometry as G

PAGE = "page_id"


def merge_intervals(boxes: DataFrame, axis: str = "x") -> DataFrame:
    """(page_id, island, start, end, members): overlapping or touching extents on an axis, merged."""
    s, e = (F.col(f"{axis}{k}") for k in "12")
    order = Window.partitionBy(PAGE).orderBy(s, "box_id")
    reach = F.max(e).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = boxes.withColumn("_new", F.when(s <= reach, 0).otherwise(1))
    numbered = opened.withColumn("island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(PAGE, "island").agg(F.min(s).alias("start"), F.max(e).alias("end"), F.count(F.lit(1)).alias("members"))


def cluster_positions(positions: DataFrame, tolerance: float, column: str = "pos") -> DataFrame:
    """(page_id, cluster, center, members): distinct positions, a new cluster where the gap exceeds the tolerance."""
    order = Window.partitionBy(PAGE).orderBy(column)
    rows = positions.select(PAGE, column).distinct().withColumn("_new", F.when(F.col(column) - F.lag(column).over(order) <= tolerance, 0).otherwise(1))
    rows = rows.withColumn("cluster", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(PAGE, "cluster").agg(F.avg(column).alias("center"), F.count(F.lit(1)).alias("members"))


def projection_profile(boxes: DataFrame, axis: str = "x") -> DataFrame:
    """(page_id, pos, cover): how many boxes cover the axis from ``pos`` to the next one (half-open extents)."""
    marks = boxes.select(PAGE, F.explode(F.array(F.struct(F.col(f"{axis}1").alias("pos"), F.lit(1).alias("d")), F.struct(F.col(f"{axis}2").alias("pos"), F.lit(-1).alias("d")))).alias("m"))
    steps = marks.groupBy(PAGE, F.col("m.pos").alias("pos")).agg(F.sum("m.d").alias("d"))
    return steps.select(PAGE, "pos", F.sum("d").over(Window.partitionBy(PAGE).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)).alias("cover"))


def profile_segments(profile: DataFrame, least: int = 0, min_gap: int = 1) -> DataFrame:
    """(page_id, start, end): runs of a profile above ``least``; gaps of fewer than ``min_gap`` pixels don't part them."""
    order = Window.partitionBy(PAGE).orderBy("pos")
    rows = profile.withColumns({"end": F.lead("pos").over(order), "_on": F.col("cover") > least}).where("end IS NOT NULL AND _on")
    rows = rows.withColumn("_new", F.when(F.col("pos") - F.lag("end").over(order) < min_gap, 0).otherwise(1))
    rows = rows.withColumn("run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(PAGE, "run").agg(F.min("pos").alias("start"), F.max("end").alias("end")).drop("run")


def profile_minima(profile: DataFrame) -> DataFrame:
    """(page_id, start, end, cover): flat stretches lower than both neighbours, without each page's first stretch and last."""
    order = Window.partitionBy(PAGE).orderBy("pos")
    rows = profile.withColumn("end", F.lead("pos").over(order)).where("end IS NOT NULL")
    rows = rows.withColumn("_new", F.when(F.col("cover") == F.lag("cover").over(order), 0).otherwise(1))
    rows = rows.withColumn("run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    flat = rows.groupBy(PAGE, "run").agg(F.min("pos").alias("start"), F.max("end").alias("end"), F.first("cover").alias("cover"))
    runs = Window.partitionBy(PAGE).orderBy("run")
    flat = flat.withColumns({"_before": F.lag("cover").over(runs), "_after": F.lead("cover").over(runs)})
    return flat.where("cover < _before AND cover < _after").select(PAGE, "start", "end", "cover")


def ctc_collapse(steps: DataFrame, blank: int = 0, key: str = "seq_id", order: tuple[str, ...] = ("t",)) -> DataFrame:
    """Steps left of a greedy decoding: repeats go, then blanks."""
    last = F.lag("cls").over(Window.partitionBy(key).orderBy(*order))
    return steps.withColumn("_last", last).where((F.col("cls") != blank) & (F.col("_last").isNull() | (F.col("_last") != F.col("cls")))).drop("_last")


def word_box_lines(boxes: DataFrame, threshold: float) -> DataFrame:
    """(page_id, box_id, line, place): words by centre height, a new line where it rises by the threshold; then left to right."""
    cy, cx = (F.col("y1") + F.col("y2")) / 2, (F.col("x1") + F.col("x2")) / 2
    order = Window.partitionBy(PAGE).orderBy("_cy", "box_id")
    rows = boxes.withColumns({"_cy": cy, "_cx": cx})
    rows = rows.withColumn("_new", F.when(F.col("_cy") - F.lag("_cy").over(order) < threshold, 0).otherwise(1))
    rows = rows.withColumn("line", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.select(PAGE, "box_id", "line", F.row_number().over(Window.partitionBy(PAGE, "line").orderBy("_cx", "box_id")).cast("long").alias("place"))


def _fold_lines(sorted_boxes: str, joins, grow) -> Column:
    """Line number of each box of a sorted array, by a fold whose state is the current line's extent.

    ``joins`` (state, box) says whether the box is on the line, ``grow`` gives the line's new extent.
    """
    state = F.struct(F.lit(None).cast("struct<lo:bigint,hi:bigint>").alias("span"), F.lit(0).alias("line"), F.array().cast("array<struct<box_id:bigint,x1:bigint,line:int>>").alias("out"))

    def step(acc: Column, c: Column) -> Column:
        same = acc.span.isNotNull() & joins(acc.span, c)
        line = acc.line + F.when(same, 0).otherwise(1)
        own = F.struct(c.y1.alias("lo"), c.y2.alias("hi"))
        return F.struct(
            F.when(same, grow(acc.span, c)).otherwise(own).alias("span"),
            line.alias("line"),
            F.array_append(acc.out, F.struct(c.box_id.alias("box_id"), c.x1.alias("x1"), line.alias("line"))).alias("out"),
        )

    return F.aggregate(F.col(sorted_boxes), state, step, lambda acc: acc.out)


def _lines(boxes: DataFrame, joins, grow) -> DataFrame:
    entry = F.struct("y1", "box_id", "x1", "x2", "y2")
    pages = boxes.groupBy(PAGE).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    rows = pages.select(PAGE, F.explode(_fold_lines("entries", joins, grow)).alias("r")).select(PAGE, "r.*")
    return rows.select(PAGE, "box_id", "line", F.row_number().over(Window.partitionBy(PAGE, "line").orderBy("x1", "box_id")).cast("long").alias("place"))


def group_lines(boxes: DataFrame, share: float = 0.6) -> DataFrame:
    """(page_id, box_id, line, place): spans from the top; a span is on the line while it overlaps the line's growing
    extent by ``share`` of the lower of the two."""

    def joins(span: Column, c: Column) -> Column:
        inter = F.least(span.hi, c.y2) - F.greatest(span.lo, c.y1)
        lower = F.least(span.hi - span.lo, c.y2 - c.y1)
        return (inter > 0) & (inter / lower >= share)

    return _lines(boxes, joins, lambda span, c: F.struct(F.least(span.lo, c.y1).alias("lo"), F.greatest(span.hi, c.y2).alias("hi")))


def group_band(boxes: DataFrame, share: float = 0.6) -> DataFrame:
    """As ``group_lines``, but the overlap must exceed the share (the projection sort of table cells)."""

    def joins(span: Column, c: Column) -> Column:
        inter = F.least(span.hi, c.y2) - F.greatest(span.lo, c.y1)
        lower = F.least(span.hi - span.lo, c.y2 - c.y1)
        return (inter > 0) & (inter / lower > share)

    return _lines(boxes, joins, lambda span, c: F.struct(F.least(span.lo, c.y1).alias("lo"), F.greatest(span.hi, c.y2).alias("hi")))


def cell_rows(boxes: DataFrame, tolerance: int = 10) -> DataFrame:
    """(page_id, box_id, line, place): cells from the top; a row holds cells whose top is within the tolerance of its first."""
    return _lines(boxes, lambda span, c: F.abs(c.y1 - span.lo) <= tolerance, lambda span, c: span)


def row_offsets(rows: DataFrame) -> DataFrame:
    """(page_id, line, first, members): running start of each row of ``cell_rows``."""
    sizes = rows.groupBy(PAGE, "line").agg(F.count(F.lit(1)).alias("members"))
    before = F.sum("members").over(Window.partitionBy(PAGE).orderBy("line").rowsBetween(Window.unboundedPreceding, -1))
    return sizes.select(PAGE, "line", F.coalesce(before, F.lit(0)).alias("first"), "members")


def quad_order(boxes: DataFrame, nearby: int = 10) -> DataFrame:
    """(page_id, box_id, place): boxes by (top, left), then each moves up past those of about its height that begin to its right.

    An insertion sort over the page's boxes as a fold: a box is put before the trailing run of
    boxes it passes one by one, stopping at the first it may not pass.
    """
    pages = boxes.groupBy(PAGE).agg(F.array_sort(F.collect_list(F.struct("y1", "x1", "box_id"))).alias("entries"))

    def insert(done: Column, c: Column) -> Column:
        # how many boxes at the end are passed: the run from the end for which the rule holds
        passed = F.aggregate(
            F.reverse(done),
            F.struct(F.lit(0).alias("n"), F.lit(True).alias("go")),
            lambda acc, p: F.when(acc.go & (F.abs(c.y1 - p.y1) < nearby) & (c.x1 < p.x1), F.struct((acc.n + 1).alias("n"), F.lit(True).alias("go"))).otherwise(F.struct(acc.n.alias("n"), F.lit(False).alias("go"))),
            lambda acc: acc.n,
        )
        at = F.size(done) - passed
        return F.concat(F.slice(done, F.lit(1), at), F.array(c), F.slice(done, at + 1, passed))

    placed = pages.select(PAGE, F.aggregate("entries", F.slice(F.col("entries"), 1, 0), insert).alias("s"))
    return placed.select(PAGE, F.posexplode("s").alias("p", "e")).select(PAGE, F.col("e.box_id").alias("box_id"), (F.col("p") + 1).cast("long").alias("place"))


def order_by_top(boxes: DataFrame) -> DataFrame:
    """(page_id, box_id, place): by least y, ties to the smaller box_id."""
    return boxes.select(PAGE, "box_id", F.row_number().over(Window.partitionBy(PAGE).orderBy("y1", "box_id")).cast("long").alias("place"))


def drop_odd_heights(lines: DataFrame) -> DataFrame:
    """Vertical lines (page_id, line, h): if the largest is over twice the least and fewer than 40 % are near the least, only those stay."""
    page = Window.partitionBy(PAGE)
    rows = lines.withColumns({"_lo": F.min("h").over(page), "_hi": F.max("h").over(page)})
    rows = rows.withColumn("_near", F.avg((F.col("h") < F.col("_lo") * 1.1).cast("int")).over(page))
    return rows.where(~((F.col("_hi") > F.col("_lo") * 2) & (F.col("_near") < 0.4)) | (F.col("h") <= F.col("_lo") * 1.1)).drop("_lo", "_hi", "_near")


def segment_flags(blocks: DataFrame, near: int = 10) -> DataFrame:
    """Whether a block starts and ends a segment, judged against the block before in reading order.

    blocks: (page_id, order_index, block_id, start, end, seg_start, seg_end, width, num_of_lines).
    Adds seg_start_flag and seg_end_flag.
    """
    order = Window.partitionBy(PAGE).orderBy("order_index")
    rows = blocks.withColumn("_p", F.lag(F.struct("start", "end", "seg_end", "width", "num_of_lines")).over(order))
    p = F.col("_p")
    first = p.isNull()
    over = ~first & (F.col("start") < p.end) & (F.col("end") > p.start)
    left = F.when(over, F.least(p.start, F.col("start"))).otherwise(F.col("start"))
    right = F.when(over, F.greatest(p.end, F.col("end"))).otherwise(F.col("end"))
    full_line_before = F.when(over, F.abs(right - p.seg_end) < near).otherwise(F.abs(p.end - p.seg_end) < near)
    gap = F.when(over, 0).otherwise(F.abs(F.col("start") - p.end))
    flush = F.col("seg_start") - left < near
    goes_on = full_line_before & flush & (p.num_of_lines > 1) & (gap < F.greatest(p.width, F.col("width")))
    return rows.withColumns({"seg_start_flag": F.when(first, ~flush).otherwise(~goes_on), "seg_end_flag": ~(right - F.col("seg_end") < near)}).drop("_p")


def segment_flags_simple(blocks: DataFrame) -> DataFrame:
    """As ``segment_flags`` from boxes alone: side by side, close, after a block of several lines.

    blocks: (page_id, order_index, x1, y1, x2, y2, num_of_lines).
    """
    order = Window.partitionBy(PAGE).orderBy("order_index")
    rows = blocks.withColumn("_p", F.lag(F.struct(*G.SIDES, "num_of_lines")).over(order))
    p, b = F.col("_p"), G.box()
    goes_on = (F.col("y1") < p.y2) & (F.col("y2") > p.y1) & (F.abs(F.col("x1") - p.x2) < F.greatest(G.width(p), G.width(b))) & (p.num_of_lines > 1)
    return rows.withColumns({"seg_start_flag": F.when(p.isNull(), False).otherwise(~goes_on), "seg_end_flag": F.lit(True)}).drop("_p")


def number_in_order(blocks: DataFrame, labels: tuple[str, ...]) -> DataFrame:
    """Adds order_index from 1 for blocks of the labels shown; null for the others."""
    shown = F.col("label").isin(*labels)
    n = F.sum(shown.cast("int")).over(Window.partitionBy(PAGE).orderBy("box_id").rowsBetween(Window.unboundedPreceding, 0))
    return blocks.withColumn("order_index", F.when(shown, n))


def batches(rows: DataFrame, size: int, order: str = "path") -> DataFrame:
    """Adds batch_id: consecutive groups of ``size`` rows in the given order, per source."""
    n = F.row_number().over(Window.partitionBy("source").orderBy(order))
    return rows.withColumn("batch_id", F.floor((n - 1) / size).cast("long"))


def stitch_pages(pages: DataFrame, key: str, order: str = "page_index") -> DataFrame:
    """(key, text): pages joined by a blank line, or where a paragraph runs on by a space, or by nothing between CJK characters.

    pages: (key, page_index, text, starts, ends): whether the page starts and ends a paragraph.
    """
    cjk = r"[一-鿿]"
    w = Window.partitionBy(key).orderBy(order)
    rows = pages.withColumns({"_ends": F.lag("ends").over(w), "_last": F.lag(F.right(F.col("text"), F.lit(1))).over(w)})
    between = (
        F.when(F.col("_ends").isNull(), "")
        .when(F.col("_ends") | F.col("starts"), "\n\n")
        .when(F.col("_last").rlike(cjk) & F.left(F.col("text"), F.lit(1)).rlike(cjk), "")
        .otherwise(" ")
    )
    rows = rows.withColumn("_piece", F.concat(between, F.col("text")))
    return rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "_piece"))), lambda x: x["_piece"]), "").alias("text"))


def word_boxes(rows: DataFrame) -> DataFrame:
    """Boxes of words from decoding columns: (…, words) with an array of (word, x1, x2).

    rows: x1, x2, col_num, words array<struct<word string, first int, last int>>; a column is the box width over col_num.
    """
    cell = (F.col("x2") - F.col("x1")) / F.col("col_num")
    return rows.withColumn(
        "word_boxes",
        F.transform("words", lambda w: F.struct(w.word.alias("word"), F.floor(F.col("x1") + w["first"] * cell).alias("x1"), F.floor(F.col("x1") + (w["last"] + 1) * cell).alias("x2"))),
    )

"""Detector post-processing: thresholds, suppression, containment and overlap removal.

Boxes are rows (page_id, box_id, cls_id, label, score, x1, y1, x2, y2).  Pages are
independent: every join and fold is within ``page_id``, and the folds run as JVM
higher-order functions over one page's boxes.  Ties in score go to the smaller box_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import geometry as G

PAGE = "page_id"


def above_threshold(boxes: DataFrame, threshold: float | dict[int, float], default: float = 0.5) -> DataFrame:
    """Boxes scoring strictly more than the threshold, which may be given per class."""
    limit: Column = F.lit(threshold)
    if isinstance(threshold, dict):
        per_class = F.create_map(*[F.lit(x) for kv in threshold.items() for x in kv])
        limit = F.coalesce(per_class[F.col("cls_id")], F.lit(default))
    return boxes.where((F.col("score") > limit) & (F.col("cls_id") > -1))


def drop_oversize(boxes: DataFrame, page_width: int, page_height: int, label: str = "image", landscape: float = 0.82, portrait: float = 0.93) -> DataFrame:
    """Drops boxes of ``label`` that cover nearly the whole page; not on pages of one box, nor where none would be left."""
    limit = (landscape if page_width > page_height else portrait) * page_width * page_height
    b = G.clamp(G.box(), page_width, page_height)
    large = (F.col("label") == label) & (G.width(b) * G.height(b) > limit)
    page = Window.partitionBy(PAGE)
    flagged = boxes.withColumn("_keep", F.coalesce(~large, F.lit(True)))
    flagged = flagged.withColumns({"_n": F.count(F.lit(1)).over(page), "_left": F.sum(F.col("_keep").cast("int")).over(page)})
    return flagged.where(F.col("_keep") | (F.col("_n") <= 1) | (F.col("_left") == 0)).drop("_keep", "_n", "_left")


def clamp_to_page(boxes: DataFrame, page_width: int, page_height: int) -> DataFrame:
    """Boxes cut to the page; empty ones go."""
    cut = boxes.withColumn("_b", G.clamp(G.box(), page_width, page_height))
    return cut.withColumns({s: F.col(f"_b.{s}") for s in G.SIDES}).drop("_b").where("x2 > x1 AND y2 > y1")


def unclip(boxes: DataFrame, ratio: tuple[float, float] | dict[int, tuple[float, float]]) -> DataFrame:
    """Boxes widened about their centres, by one pair of ratios or a pair per class (others stay)."""
    if isinstance(ratio, dict):
        w, h = (F.coalesce(F.create_map(*[F.lit(x) for c, r in ratio.items() for x in (c, r[k])])[F.col("cls_id")], F.lit(1.0)) for k in (0, 1))
    else:
        w, h = F.lit(ratio[0]), F.lit(ratio[1])
    wide = boxes.withColumn("_b", G.expand(G.box(), w, h))
    return wide.withColumns({s: F.col(f"_b.{s}") for s in G.SIDES}).drop("_b")


def _page_arrays(boxes: DataFrame, order: list[Column]) -> DataFrame:
    """One row per page: its boxes as an array in the given order."""
    keys = [k.alias(f"k{i}") for i, k in enumerate(order)]
    entry = F.struct(*keys, F.col("box_id"), F.col("cls_id"), G.box().alias("b"))
    return boxes.groupBy(PAGE).agg(F.array_sort(F.collect_list(entry)).alias("entries"))


def _fold(entries: str, suppresses) -> Column:
    """Greedy suppression: an entry stays unless one that stayed before suppresses it."""
    start = F.slice(F.col(entries), 1, 0)
    return F.aggregate(F.col(entries), start, lambda kept, c: F.when(F.exists(kept, lambda k: suppresses(k, c)), kept).otherwise(F.concat(kept, F.array(c))))


def suppress(boxes: DataFrame, same: float = 0.6, different: float = 0.98) -> DataFrame:
    """Greedy non-maximum suppression by falling score in inclusive pixels; classes have thresholds of their own.

    Returns (page_id, box_id) of the boxes kept.
    """

    def hides(k: Column, c: Column) -> Column:
        return G.overlap(k.b, c.b, "plus1") >= F.when(k.cls_id == c.cls_id, same).otherwise(different)

    pages = _page_arrays(boxes, [-F.col("score"), F.col("box_id")])
    return pages.select(PAGE, F.explode(F.transform(_fold("entries", hides), lambda k: k.box_id)).alias("box_id"))


def suppress_cells(boxes: DataFrame, most: float = 0.3) -> DataFrame:
    """Greedy suppression of table cells: those over ``most`` of the union with a better one go."""
    pages = _page_arrays(boxes, [-F.col("score"), F.col("box_id")])
    return pages.select(PAGE, F.explode(F.transform(_fold("entries", lambda k, c: G.overlap(k.b, c.b, "union") > most), lambda k: k.box_id)).alias("box_id"))


def pairs(boxes: DataFrame, condition: Column, left: str = "p", right: str = "q") -> DataFrame:
    """Self-join of a page's boxes, as aliases ``left`` and ``right``."""
    return boxes.alias(left).join(boxes.alias(right), (F.col(f"{left}.{PAGE}") == F.col(f"{right}.{PAGE}")) & condition)


def containment(boxes: DataFrame, share: float = 0.9, formula_cls: int | None = None, cls_id: int | None = None, mode: str | None = None) -> DataFrame:
    """(page_id, box_id, contains_other, contained_by_other): A is in B if B covers ``share`` of A.

    A formula can only be in a formula.  With a class and mode, "large" looks at containers of
    that class, "small" at contained boxes of it.
    """
    a, b = G.box(table="p"), G.box(table="q")
    condition = (F.col("p.box_id") != F.col("q.box_id")) & (G.overlap(a, b, "first") >= share)
    if formula_cls is not None:
        condition &= ~((F.col("p.cls_id") == formula_cls) & (F.col("q.cls_id") != formula_cls))
    if cls_id is not None and mode is not None:
        condition &= F.col("q.cls_id" if mode == "large" else "p.cls_id") == cls_id
    found = pairs(boxes.select(PAGE, "box_id", "cls_id", *G.SIDES), condition).select(F.col(f"p.{PAGE}").alias(PAGE), F.col("p.box_id").alias("inner"), F.col("q.box_id").alias("outer"))
    marks = found.select(PAGE, F.explode(F.array(F.struct(F.col("inner").alias("box_id"), F.lit(0).alias("c"), F.lit(1).alias("i")), F.struct(F.col("outer").alias("box_id"), F.lit(1).alias("c"), F.lit(0).alias("i")))).alias("m"))
    flags = marks.groupBy(PAGE, F.col("m.box_id").alias("box_id")).agg(F.max("m.c").alias("contains_other"), F.max("m.i").alias("contained_by_other"))
    return boxes.select(PAGE, "box_id").join(flags, [PAGE, "box_id"], "left").na.fill(0, ["contains_other", "contained_by_other"])


def merge(boxes: DataFrame, mode: str | dict[int, str], share: float = 0.9, formula_cls: int | None = None) -> DataFrame:
    """Keeps outer boxes ("large"), inner boxes ("small") or all ("union"), for all classes or class by class."""
    rules = [(None, mode)] if isinstance(mode, str) else list(mode.items())
    kept = boxes
    for cls_id, rule in rules:
        if rule == "union":
            continue
        flags = containment(boxes, share, formula_cls, cls_id, rule if cls_id is not None else None)
        stay = flags.where("contained_by_other = 0") if rule == "large" else flags.where("contains_other = 0 OR contained_by_other = 1")
        kept = kept.join(stay.select(PAGE, "box_id"), [PAGE, "box_id"], "left_semi")
    return kept


def _dropped(entries: Column, threshold: float, label: str) -> Column:
    """Ids that overlap removal drops of a page's entries (box_id, label, b) in box order."""

    def goes(p: Column, q: Column) -> Column:
        images = (p.label == label, q.label == label)
        return F.when(images[0] != images[1], F.when(images[0], p.box_id).otherwise(q.box_id)).when(G.area(p.b) <= G.area(q.b), p.box_id).otherwise(q.box_id)

    def later(p: Column, at: Column) -> Column:
        rest = F.slice(entries, at + 2, F.size(entries))
        over = F.filter(rest, lambda q: G.overlap(p.b, q.b, "small") > threshold)
        return F.transform(over, lambda q: F.struct(p.box_id.alias("i"), q.box_id.alias("j"), goes(p, q).alias("d")))

    pairs_ = F.flatten(F.transform(entries, later))
    return F.aggregate(pairs_, F.array().cast("array<long>"), lambda acc, c: F.when(F.array_contains(acc, c.i) | F.array_contains(acc, c.j), acc).otherwise(F.array_append(acc, c.d)))


def _rows_of_pages(boxes: DataFrame, *order: Column) -> DataFrame:
    """(page, entries): a page's boxes in the given order, each with its whole row, so that nothing is joined back."""
    keys = [k.alias(f"k{i}") for i, k in enumerate(order)]
    label = F.col("label") if "label" in boxes.columns else F.lit("")
    cls = F.col("cls_id") if "cls_id" in boxes.columns else F.lit(0)
    entry = F.struct(*keys, F.col("box_id").alias("box_id"), cls.alias("cls_id"), label.alias("label"), G.box().alias("b"), F.struct(*boxes.columns).alias("row"))
    return boxes.groupBy(PAGE).agg(F.array_sort(F.collect_list(entry)).alias("entries"))


def overlap_drops(boxes: DataFrame, threshold: float = 0.5, label: str = "image") -> DataFrame:
    """(page_id, box_id) of boxes that overlap removal drops.

    Pairs are visited in box order; a pair with a box that is already dropped counts no more.
    Of an image and another box the image goes, else the smaller one, ties the first.
    """
    pages = _rows_of_pages(boxes, F.col("box_id"))
    return pages.select(PAGE, F.explode(_dropped(F.col("entries"), threshold, label)).alias("box_id"))


def remove_overlaps(boxes: DataFrame, threshold: float = 0.5, label: str = "image") -> DataFrame:
    """Boxes (all columns) that overlap removal keeps."""
    pages = _rows_of_pages(boxes, F.col("box_id")).withColumn("gone", _dropped(F.col("entries"), threshold, label))
    return _kept_rows(pages)


def _kept_rows(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode(F.filter("entries", lambda e: ~F.array_contains("gone", e.box_id))).alias("e")).select("e.row.*")


def clean(boxes: DataFrame, same: float = 0.6, different: float = 0.98, threshold: float = 0.5, label: str = "image") -> DataFrame:
    """Suppression, then overlap removal, of a page's boxes in one row: one shuffle, no join.  All columns stay."""

    def hides(k: Column, c: Column) -> Column:
        return G.overlap(k.b, c.b, "plus1") >= F.when(k.cls_id == c.cls_id, same).otherwise(different)

    pages = _rows_of_pages(boxes, -F.col("score"), F.col("box_id"))
    pages = pages.select(PAGE, F.array_sort(_fold("entries", hides), lambda x, y: F.when(x.box_id < y.box_id, -1).when(x.box_id > y.box_id, 1).otherwise(0)).alias("entries"))
    return _kept_rows(pages.withColumn("gone", _dropped(F.col("entries"), threshold, label)))


def relabel(boxes: DataFrame, title_share: float = 0.3) -> DataFrame:
    """A footnote above the lowest text is text; a page's only paragraph title, if no document title is there and it
    is larger than ``title_share`` of the largest box, is the document title."""
    page = Window.partitionBy(PAGE)
    size = G.area(G.box())
    stats = boxes.withColumns(
        {
            "_bottom": F.max(F.when(F.col("label") == "text", F.col("y2"))).over(page),
            "_titles": F.sum((F.col("label") == "paragraph_title").cast("int")).over(page),
            "_docs": F.sum((F.col("label") == "doc_title").cast("int")).over(page),
            "_largest": F.max(size).over(page),
        }
    )
    fixed = (
        F.when((F.col("label") == "footnote") & (F.col("y2") < F.col("_bottom")), "text")
        .when((F.col("label") == "paragraph_title") & (F.col("_titles") == 1) & (F.col("_docs") == 0) & (size > F.col("_largest") * title_share), "doc_title")
        .otherwise(F.col("label"))
    )
    return stats.withColumn("label", fixed).drop("_bottom", "_titles", "_docs", "_largest")


def shrink_overlaps(boxes: DataFrame, most: float = 0.1) -> DataFrame:
    """Neighbours along y that overlap a little (under ``most`` of the smaller) part at a line between them, a pixel apart.

    Each box is cut against the next one below in (y1, box_id) order.
    """
    order = Window.partitionBy(PAGE).orderBy("y1", "box_id")
    here = G.box()
    nxt, prv = F.lead(here).over(order), F.lag(here).over(order)
    rows = boxes.withColumns({"_next": nxt, "_prev": prv})

    def slight(a: Column, b: Column) -> Column:
        share = G.overlap(a, b, "small")
        return (share > 0) & (share < most)

    def line(a: Column, b: Column) -> Column:
        return F.floor((F.greatest(a.y1, b.y1) + F.least(a.y2, b.y2)) / 2)

    down = F.when(slight(here, F.col("_next")), line(here, F.col("_next")) - 1).otherwise(F.col("y2"))
    up = F.when(slight(F.col("_prev"), here), line(F.col("_prev"), here) + 1).otherwise(F.col("y1"))
    return rows.withColumns({"_y1": up, "_y2": down}).withColumns({"y1": F.col("_y1"), "y2": F.col("_y2")}).drop("_next", "_prev", "_y1", "_y2")


def top_candidates(boxes: DataFrame, n: int = 1000) -> DataFrame:
    """The n best boxes of each page by score, ties to the smaller box_id."""
    rank = F.row_number().over(Window.partitionBy(PAGE).orderBy(F.desc("score"), "box_id"))
    return boxes.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")

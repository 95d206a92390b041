"""The parsing chains as plans: recognition, tables, formulas, seals, classification, preprocessing, and a general parse.

Models are predictors (see :mod:`pagewright.operators.models`); everything around them is
relational, keyed by page and region numbers, never by position in a list.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.operators import match, models, sequence

PAGE = "page_id"


# --- parts -----------------------------------------------------------------------------------


def confident(spans: DataFrame, least: float, score: str = "score") -> DataFrame:
    """Spans recognised with at least that score; equal is enough, null is not."""
    return spans.where(F.col(score) >= least)


def numbered(boxes: DataFrame, label: str, name: str = "region_no") -> DataFrame:
    """A page's boxes of a label with a number from 1 in box order: the key under which crops are sent to a model and come back."""
    return boxes.where(F.col("label") == label).withColumn(name, F.row_number().over(Window.partitionBy(PAGE).orderBy("box_id")).cast("long"))


def gathered(crops: DataFrame, results: DataFrame, *columns: str, name: str = "region_no") -> DataFrame:
    """Results of a model put back to their crops by page and number; a crop without a result keeps nulls."""
    return crops.join(results.select(PAGE, name, *columns), [PAGE, name], "left")


def zip_pages(**parts: DataFrame) -> DataFrame:
    """One row a page with the rows of each part as an array in box or span order; a page may lack parts (empty array).

    Each part has page_id and an id as its second column; pages meet by key.
    """
    out = None
    for name, rows in parts.items():
        key = rows.columns[1]
        listed = rows.groupBy(PAGE).agg(F.array_sort(F.collect_list(F.struct(F.col(key), *[c for c in rows.columns if c not in (PAGE, key)]))).alias(name))
        out = listed if out is None else out.join(listed, PAGE, "full")
    return out.select(PAGE, *[F.coalesce(name, F.array()).alias(name) for name in parts])


def aspect_batches(crops: DataFrame, size: int) -> DataFrame:
    """(page_id, box_id, batch, place): a page's crops by aspect ratio, ties to the smaller id, in batches of ``size``.

    The ids put the results back into the order of the page.
    """
    ratio = G.width(G.box()) / G.height(G.box())
    at = F.row_number().over(Window.partitionBy(PAGE).orderBy(ratio, "box_id")) - 1
    return crops.select(PAGE, "box_id", F.floor(at / size).alias("batch"), (at % size).cast("long").alias("place"))


def split_between_blocks(spans: DataFrame, blocks: DataFrame, recognise: Callable[[Column], Column], least: float = 0.0, predicate: str = "small", covered: float = 0.8) -> DataFrame:
    """Spans of several blocks parted: (page_id, box_id, span_id, x1, y1, x2, y2, text, kind).

    Of a span that two blocks or more match, the part in each block is recognised anew
    (``recognise`` gives (text, score) for a box); kind is ``part``.  Spans that such a part
    covers by more than ``covered`` of the smaller area lose their text in that block (kind
    ``cleared``); all other matches stay (kind ``whole``).
    """
    bridge = match.match_blocks_to_spans(blocks, spans, predicate)
    several = match.shared_spans(bridge)
    b, s = blocks.select(PAGE, "box_id", *G.SIDES).alias("b"), spans.select(PAGE, "span_id", *G.SIDES).alias("s")
    both = several.join(b, [PAGE, "box_id"]).join(s, [PAGE, "span_id"])
    edges = [F.greatest("b.x1", "s.x1").alias("x1"), F.greatest("b.y1", "s.y1").alias("y1"), F.least("b.x2", "s.x2").alias("x2"), F.least("b.y2", "s.y2").alias("y2")]
    parts = both.select(PAGE, "box_id", "span_id", *edges).where("x1 < x2 AND y1 < y2")
    read = parts.withColumn("r", recognise(G.box())).where(F.col("r.score") >= least).withColumn("text", F.col("r.text")).drop("r")
    rest = bridge.join(spans.select(PAGE, "span_id", *G.SIDES, "text"), [PAGE, "span_id"])
    # spans that a part of their block covers; the parted span itself is replaced by its parts
    p, r = parts.alias("p"), rest.alias("r")
    same = (F.col(f"p.{PAGE}") == F.col(f"r.{PAGE}")) & (F.col("p.box_id") == F.col("r.box_id"))
    hidden = r.join(p, same & (G.overlap(G.box(table="r"), G.box(table="p"), "small") > covered), "left_semi").join(several, [PAGE, "box_id", "span_id"], "left_anti")
    whole = rest.join(several, [PAGE, "box_id", "span_id"], "left_anti").join(hidden.select(PAGE, "box_id", "span_id"), [PAGE, "box_id", "span_id"], "left_anti")
    columns = [PAGE, "box_id", "span_id", *G.SIDES]
    return (
        read.select(*columns, "text", F.lit("part").alias("kind"))
        .unionByName(hidden.select(*columns, F.lit("").alias("text"), F.lit("cleared").alias("kind")))
        .unionByName(whole.select(*columns, "text", F.lit("whole").alias("kind")))
    )


def relabel_direct(boxes: DataFrame, title_share: float = 0.3) -> DataFrame:
    """As ``detect.relabel``, but titles count as text for the lowest text too."""
    page = Window.partitionBy(PAGE)
    label, size = F.col("label"), G.area(G.box())
    bottom = F.max(F.when(label.isin("text", "paragraph_title", "doc_title"), F.col("y2"))).over(page)
    only = (F.count(F.when(label == "paragraph_title", 1)).over(page) == 1) & (F.count(F.when(label == "doc_title", 1)).over(page) == 0)
    fixed = F.when((label == "footnote") & (F.col("y2") < bottom), "text").when((label == "paragraph_title") & only & (size > title_share * F.max(size).over(page)), "doc_title")
    return boxes.withColumn("label", F.coalesce(fixed, label))


def lines_of_blocks(spans: DataFrame, bridge: DataFrame, share: float = 0.6) -> DataFrame:
    """(page_id, box_id, lines, line_width, line_height, seg_start, seg_end) of the text lines in each block.

    A line is a run of spans, from the top, that overlap its growing extent by ``share`` of
    the lower; sizes are means over lines; the segment begins at the first line's first span
    and, with two lines or more, ends at the last line's last span.
    """
    # a block's spans are a page of their own to the line fold
    key = F.struct(PAGE, "box_id")
    own = bridge.join(spans, [PAGE, "span_id"]).select(key.alias("key"), F.col("span_id").alias("box_id"), *G.SIDES)
    placed = sequence.group_lines(own.withColumnRenamed("key", PAGE), share).withColumnRenamed(PAGE, "key")
    per = own.join(placed, ["key", "box_id"]).groupBy("key", "line").agg(
        (F.max("x2") - F.min("x1")).alias("w"), (F.max("y2") - F.min("y1")).alias("h"), F.min_by("x1", "place").alias("first"), F.max_by("x2", "place").alias("last")
    )
    out = per.groupBy("key").agg(
        F.count(F.lit(1)).cast("int").alias("lines"), F.avg("w").alias("line_width"), F.avg("h").alias("line_height"),
        F.min_by("first", "line").cast("double").alias("seg_start"), F.when(F.count(F.lit(1)) > 1, F.max_by("last", "line").cast("double")).alias("seg_end"),
    )
    return out.select(F.col(f"key.{PAGE}").alias(PAGE), F.col("key.box_id").alias("box_id"), "lines", "line_width", "line_height", "seg_start", "seg_end")


# --- chains ----------------------------------------------------------------------------------


def recognise_pages(boxes: DataFrame, recogniser: models.Predictor, least: float = 0.0, nearby: int = 10) -> DataFrame:
    """Text recognition: found boxes in page order, read in batches of like shape, filtered by score, numbered anew.

    (page_id, span_id, box_id, text, score, x1, y1, x2, y2); ``span_id`` from 1 in page order.
    """
    placed = boxes.join(sequence.quad_order(boxes, nearby), [PAGE, "box_id"])
    read = models.predict(models.sorted_for_batches(boxes.select(PAGE, "box_id", *G.SIDES)), recogniser, "page_id long, box_id long, text string, score double")
    kept = confident(placed.select(PAGE, "box_id", "place", *G.SIDES).join(read, [PAGE, "box_id"]), least)
    return kept.select(PAGE, F.row_number().over(Window.partitionBy(PAGE).orderBy("place")).cast("long").alias("span_id"), "box_id", "text", "score", *G.SIDES)


def recognise_regions(boxes: DataFrame, label: str, model: models.Predictor, column: str) -> DataFrame:
    """Formulas or seals: boxes of the label numbered on their page, read by a model, put back by number.

    (page_id, region_no, box_id, ``column``, score).
    """
    crops = numbered(boxes, label)
    read = models.predict(crops.select(PAGE, F.col("region_no").alias("box_id"), *G.SIDES), model, "page_id long, box_id long, text string, score double")
    return gathered(crops, read.select(PAGE, F.col("box_id").alias("region_no"), F.col("text").alias(column), F.col("score").alias("read_score")), column, "read_score").select(PAGE, "region_no", "box_id", column, F.col("read_score").alias("score"))


def classify(rows: DataFrame, scores: str, labels: list[str], k: int, *keys: str) -> DataFrame:
    """Image classification: the k best classes of each row, best first, with their names and scores to five places."""
    listed = F.transform(F.col(scores), lambda s, i: F.struct((-s).alias("neg"), i.alias("id")))
    best = F.slice(F.array_sort(listed), 1, k)
    names = class_names(labels)
    return rows.select(
        *keys,
        F.transform(best, lambda b: b.id).alias("class_ids"),
        F.transform(best, lambda b: F.round(-b.neg, 5)).alias("scores"),
        F.transform(best, lambda b: names[b.id]).alias("label_names"),
    )


def class_names(labels: list[str]) -> Column:
    """A map from class number to name."""
    return F.create_map(*[F.lit(x) for k, name in enumerate(labels) for x in (k, str(name))])


def preprocess(boxes: DataFrame, angle: Column, width: Column, height: Column) -> DataFrame:
    """Boxes of pages that a classifier found turned by 0, 90, 180 or 270 degrees, in the upright page's coordinates."""
    upright = {
        "x1": F.when(angle == 90, F.col("y1")).when(angle == 180, width - F.col("x2")).when(angle == 270, height - F.col("y2")).otherwise(F.col("x1")),
        "y1": F.when(angle == 90, width - F.col("x2")).when(angle == 180, height - F.col("y2")).when(angle == 270, F.col("x1")).otherwise(F.col("y1")),
        "x2": F.when(angle == 90, F.col("y2")).when(angle == 180, width - F.col("x1")).when(angle == 270, height - F.col("y1")).otherwise(F.col("x2")),
        "y2": F.when(angle == 90, width - F.col("x1")).when(angle == 180, height - F.col("y1")).when(angle == 270, F.col("x2")).otherwise(F.col("y2")),
    }
    return boxes.withColumns(upright)


def assemble_tables(structures: DataFrame, cells: DataFrame, spans: DataFrame, tolerance: int = 10) -> DataFrame:
    """Table HTML from a predicted structure, found cells and recognised spans: (page_id, html).

    structures: (page_id, structure array<string>), of which the first and last three tokens
    frame the rows; cells: (page_id, box_id, sides); spans: (page_id, span_id, text, sides);
    all of one table a page.

    Cells are sorted into rows.  A row of the structure takes the row of found cells that
    begins last at or before its own first cell; its k-th cell takes the texts of the k-th
    found one, as long as that row has one.  A span belongs to the cells that hold more than
    0.7 of it.  A table without cells or spans keeps its structure, joined by blanks.
    """
    rows = sequence.cell_rows(cells, tolerance)
    position = F.row_number().over(Window.partitionBy(PAGE).orderBy("line", "place")) - 1
    sorted_cells = rows.select(PAGE, "box_id", position.cast("long").alias("n"))
    flags = sequence.row_offsets(rows).select(PAGE, F.col("first").alias("flag"))
    # cells of the structure, and the first cell of each of its rows
    tokens = structures.select(PAGE, F.posexplode("structure").alias("at", "token"), F.size("structure").alias("length"))
    is_cell = F.col("token").isin("<td></td>", "</td>")
    upto = Window.partitionBy(PAGE).orderBy("at")
    tds = tokens.withColumns({"td": F.sum(is_cell.cast("long")).over(upto) - 1, "tr": F.sum((F.col("token") == "<tr>").cast("long")).over(upto)}).where(is_cell)
    first = tds.groupBy(PAGE, "tr").agg(F.min("td").alias("start"))
    begun = match.flags_as_of(first.where("tr > 0").select(PAGE, "start"), flags)
    total = sorted_cells.groupBy(PAGE).agg(F.count(F.lit(1)).alias("total"))
    nxt = F.lead("flag").over(Window.partitionBy(PAGE).orderBy("start"))
    begun = begun.withColumn("next_flag", nxt).join(total, PAGE).select(PAGE, "start", "flag", F.coalesce("next_flag", "total").alias("until"))
    wanted = tds.join(first, [PAGE, "tr"]).join(begun, [PAGE, "start"]).withColumn("n", F.col("flag") + F.col("td") - F.col("start")).where("n < until")
    hit = match.match(cells, spans, "inter2").join(sorted_cells, [PAGE, "box_id"])
    texts = hit.join(spans.select(PAGE, "span_id", "text"), [PAGE, "span_id"]).groupBy(PAGE, "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("span_id", "text"))), lambda x: x.text).alias("t"))
    filled = wanted.join(texts, [PAGE, "n"]).select(PAGE, "at", cell_text(F.col("t")).alias("content"))
    inner = (F.col("at") >= 3) & (F.col("at") < F.col("length") - 3)
    content = F.when(inner, F.coalesce("content", F.lit(""))).otherwise("")
    shown = F.when(F.col("token") == "<td></td>", F.concat(F.lit("<td>"), content, F.lit("</td>"))).when(F.col("token").contains("</td>"), F.concat(content, F.col("token"))).otherwise(F.col("token"))
    pieces = tokens.join(filled, [PAGE, "at"], "left").groupBy(PAGE).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", shown.alias("s")))), lambda x: x.s).alias("s"))
    usable = cells.select(PAGE).distinct().join(spans.select(PAGE).distinct(), PAGE).withColumn("usable", F.lit(True))
    return structures.join(pieces, PAGE).join(usable, PAGE, "left").select(PAGE, F.when(F.col("usable"), F.array_join("s", "")).otherwise(F.array_join("structure", " ")).alias("html"))


def cell_text(texts: Column) -> Column:
    """A cell's texts as one: a single one as it is; several without their own bold marks and leading blank, a blank
    between, all bold if the first has a bold mark; empty ones are left out."""

    def bare(t: Column) -> Column:
        t = F.when(t.startswith(" "), F.substring(t, 2, 1 << 20)).otherwise(t)
        t = F.when(t.contains("<b>"), F.substring(t, 4, 1 << 20)).otherwise(t)
        return F.when(t.contains("</b>"), F.left(t, F.length(t) - 4)).otherwise(t)

    several = F.transform(texts, lambda t, i: F.when(F.length(bare(t)) == 0, "").when((i < F.size(texts) - 1) & ~bare(t).endswith(" "), F.concat(bare(t), F.lit(" "))).otherwise(bare(t)))
    joined = F.array_join(several, "")
    return F.when(F.size(texts) == 1, texts[0]).when(texts[0].contains("<b>"), F.concat(F.lit("<b>"), joined, F.lit("</b>"))).otherwise(joined)


# --- results as JSON -------------------------------------------------------------------------

#: The keys of each kind of result, in order.  A part that is missing or off is left out.
RESULTS: dict[str, tuple[str, ...]] = {
    "page": ("input_path", "page_index", "model_settings", "parsing_res_list", "doc_preprocessor_res", "layout_det_res", "overall_ocr_res", "table_res_list", "seal_res_list", "formula_res_list"),
    "ocr": ("input_path", "page_index", "model_settings", "doc_preprocessor_res", "dt_polys", "text_det_params", "text_type", "textline_orientation_angles", "text_rec_score_thresh", "return_word_box", "rec_texts", "rec_scores", "rec_polys", "rec_boxes", "text_word_boxes", "text_word"),
    "detection": ("input_path", "page_index", "boxes"),
    "structure": ("input_path", "page_index", "bbox", "structure", "structure_score"),
    "formula": ("input_path", "page_index", "rec_formula"),
    "formulas": ("input_path", "page_index", "model_settings", "doc_preprocessor_res", "layout_det_res", "formula_res_list"),
    "seals": ("input_path", "page_index", "model_settings", "doc_preprocessor_res", "layout_det_res", "seal_res_list"),
    "preprocessor": ("input_path", "page_index", "model_settings", "angle"),
    "classes": ("input_path", "page_index", "class_ids", "scores", "label_names"),
    "text_detection": ("input_path", "page_index", "dt_polys", "dt_scores"),
    "text_recognition": ("input_path", "page_index", "rec_text", "rec_score"),
    "unwarping": ("input_path", "page_index", "doctr_img"),
    "tables": ("input_path", "page_index", "model_settings", "doc_preprocessor_res", "layout_det_res", "overall_ocr_res", "table_res_list"),
    "table": ("cell_box_list", "pred_html", "table_ocr_pred"),
}
#: Parts that a setting must ask for.
SWITCHED = {"doc_preprocessor_res": "use_doc_preprocessor", "table_res_list": "use_table_recognition", "seal_res_list": "use_seal_recognition", "formula_res_list": "use_formula_recognition"}


def result_json(rows: DataFrame, kind: str, settings: dict[str, bool] | None = None, *keys: str) -> DataFrame:
    """(keys, json) of rows that have the kind's parts as columns.

    Parts that are no columns are left out, and in a page's result those whose setting is off.
    """
    if kind not in RESULTS:
        raise ValueError(f"no result named {kind}; known: {', '.join(sorted(RESULTS))}")
    parts = []
    for name in RESULTS[kind]:
        if name == "model_settings" and settings is not None:
            parts.append(F.struct(*[F.lit(v).alias(k) for k, v in settings.items()]).alias(name))
        elif name in rows.columns and (settings is None or settings.get(SWITCHED.get(name, ""), name not in SWITCHED)):
            parts.append(F.col(name))
    return rows.select(*(keys or (PAGE,)), F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}).alias("json"))


def page_parts(blocks: DataFrame, boxes: DataFrame, spans: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """The parts of a page's result: parsed blocks in reading order, found boxes, recognised spans, tables.

    blocks: (page_id, order_index, label, block_content, sides); boxes: (page_id, box_id,
    label, score, sides); spans: (page_id, span_id, text, score, sides); tables: (page_id, html).
    """
    side = F.array(*[F.col(s).cast("double") for s in G.SIDES])
    corners = F.array(F.array("x1", "y1"), F.array("x2", "y1"), F.array("x2", "y2"), F.array("x1", "y2")).cast("array<array<double>>")
    parsed = zip_pages(b=blocks.select(PAGE, "order_index", F.col("label").alias("block_label"), F.col("block_content"), side.alias("block_bbox")))
    found = zip_pages(b=boxes.select(PAGE, "box_id", side.alias("coordinate"), "label", F.col("score").cast("double").alias("score")))
    read = zip_pages(s=spans.select(PAGE, "span_id", "text", F.col("score").cast("double").alias("score"), corners.alias("poly")))
    out = parsed.select(PAGE, F.transform("b", lambda b: F.struct(b.block_label, b.block_content, b.block_bbox)).alias("parsing_res_list"))
    det = found.select(PAGE, F.struct(F.transform("b", lambda b: F.struct(b.coordinate, b.label, b.score)).alias("boxes")).alias("layout_det_res"))
    ocr = read.select(PAGE, F.struct(F.transform("s", lambda s: s.text).alias("rec_texts"), F.transform("s", lambda s: s.score).alias("rec_scores"), F.transform("s", lambda s: s.poly).alias("dt_polys")).alias("overall_ocr_res"))
    out = out.join(det, PAGE, "full").join(ocr, PAGE, "full")
    if tables is not None:
        out = out.join(tables.select(PAGE, F.array(F.struct(F.col("html").alias("pred_html"))).alias("table_res_list")), PAGE, "left")
    none = {"parsing_res_list": out.schema["parsing_res_list"].dataType}
    return out.withColumns({c: F.coalesce(c, F.array().cast(t)) for c, t in none.items()}).withColumn("page_index", F.col(PAGE))


# --- values ----------------------------------------------------------------------------------


def plain(value: Any) -> Any:
    """A value as JSON has it: numpy numbers and arrays, frames (records), paths, and containers of them."""
    import numpy as np
    import pandas as pd

    if isinstance(value, pd.DataFrame):
        return [plain(r) for r in value.to_dict("records")]
    if isinstance(value, np.ndarray):
        return [plain(v) for v in value.tolist()]
    if isinstance(value, np.generic):
        return value.item()
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value.as_posix() if hasattr(value, "as_posix") else value


def rows_of(columns: dict[str, list], n: int) -> list[dict[str, Any]]:
    """A batch of columns as rows; columns of another length than n are refused."""
    wrong = {k: len(v) for k, v in columns.items() if len(v) != n}
    if wrong:
        raise ValueError(f"columns of another length than {n}: {wrong}")
    return [{k: v[i] for k, v in columns.items()} for i in range(n)]


def override(settings: Any, *changes: str) -> Any:
    """Nested settings with "a.b.0.c=value" applied; missing maps are made, list places must exist.  The input stays as it is."""
    import copy

    import yaml

    out = copy.deepcopy(settings)
    for change in changes:
        path, sep, given = change.partition("=")
        if not sep or not path:
            raise ValueError(f"not a setting: {change}")
        at, (*way, last) = out, path.split(".")
        for step in way:
            at = at[int(step)] if isinstance(at, list) else at.setdefault(step, {})
        value = {"None": None, "T": True, "t": True, "F": False, "f": False}.get(given, yaml.safe_load(given) if given else given)
        if isinstance(at, list):
            at[int(last)] = value
        else:
            at[last] = value
    return out


def device(spec: str) -> tuple[str, list[int] | None]:
    """("gpu", [0, 1]) from "gpu:0,1"; a CPU has no numbers."""
    kind, *rest = spec.lower().split(":")
    if len(rest) > 1 or kind not in ("cpu", "gpu", "xpu", "npu", "mlu", "gcu", "dcu"):
        raise ValueError(f"invalid device: {spec}")
    if not rest:
        return kind, None
    if kind == "cpu" or not all(p.isdigit() for p in rest[0].split(",")):
        raise ValueError(f"invalid device: {spec}")
    return kind, [int(p) for p in rest[0].split(",")]


def model_files(folder: str, prefix: str = "inference") -> dict[str, tuple[str, ...]]:
    """Model files of a folder by format: a program with its parameters, or one file."""
    from pathlib import Path

    at = lambda suffix: Path(folder) / f"{prefix}.{suffix}"
    found = {}
    program = next((at(s) for s in ("json", "pdmodel") if at(s).exists()), None)
    if program and at("pdiparams").exists():
        found["program"] = (str(program), str(at("pdiparams")))
    return found | {s: (str(at(s)),) for s in ("onnx", "om") if at(s).exists()}


def aligned_equation(latex: Column) -> Column:
    """An equation in its environment, unless it is aligned already; a line end behind it."""
    own = F.concat(latex, F.lit("\n"))
    aligned = own.contains("begin{align}") | own.contains("begin{align*}")
    return F.when(aligned, own).otherwise(F.concat(F.lit("\\begin{equation}\n"), F.regexp_replace(own, r"^\s+|\s+$", ""), F.lit("\\nonumber\n\\end{equation}\n")))


def text_for_cjk(latex: Column) -> Column:
    """Runs of characters beyond ASCII as words of text."""
    return F.regexp_replace(latex, r"([^\x00-\x7F]+)", r"\\text{$1}")


def decoder_scales(padded_w: Column, padded_h: Column, w: Column, h: Column, whole_image: bool = False) -> Column:
    """Factors from a table decoder's unit coordinates to the image's pixels."""
    if whole_image:
        return F.struct(w.cast("double").alias("x"), h.cast("double").alias("y"))
    ratio = F.least(padded_w / w, padded_h / h)
    return F.struct((padded_w / ratio).alias("x"), (padded_h / ratio).alias("y"))


def line_count(content: Column) -> Column:
    """Lines of a text: one more than its line ends."""
    return F.greatest(F.lit(1), F.length(content) - F.length(F.replace(content, F.lit("\n"), F.lit(""))) + 1)


def slope(x: Column, y: Column) -> Column:
    """Angle of a vector against the x axis, in radians from 0 up to, but not, pi / 2 and beyond by its size."""
    return F.abs(F.asin(y / (F.sqrt(x * x + y * y) + 1e-8)))


def angle_between(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Angle between two vectors, in radians."""
    unit = lambda x, y: (x / (F.sqrt(x * x + y * y) + 1e-8), y / (F.sqrt(x * x + y * y) + 1e-8))
    (a, b), (c, d) = unit(ax, ay), unit(bx, by)
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), a * c + b * d)))


def byte_decoded(tokens: Column) -> Column:
    """Text of byte-level BPE tokens: their letters stand for bytes (see ``byte_letters``), bad bytes become U+FFFD."""
    letters = byte_letters()
    table = F.create_map(*[F.lit(x) for letter, byte in letters.items() for x in (letter, f"{byte:02x}")])
    joined = F.array_join(tokens, "")
    # one letter is one byte
    return F.decode(F.unhex(F.array_join(F.transform(F.split(joined, ""), lambda c: F.coalesce(table[c], F.lit(""))), "")), "UTF-8")


def byte_letters() -> dict[str, int]:
    """The public byte alphabet: printable bytes stand for themselves, the others for letters from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}



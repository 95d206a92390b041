"""Document parsing as a chain of transforms, its options, and its JSON, Markdown and HTML."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.functions import text
from pagewright.operators import content, detect, match, models, order, sequence
from pagewright.plans import chains

PAGE = "page_id"

#: Pipelines that can be made by name.
PIPELINES = ("ocr", "document", "tables", "preprocessing", "formulas", "classification", "seals", "universal")


@dataclass(frozen=True)
class Options:
    """Settings of a parse.  None means the default, so that 0 and False can be asked for."""

    pipeline: str = "document"
    same_iou: float = 0.6
    different_iou: float = 0.98
    overlap: float = 0.5
    match: str = "small"
    strategy: str = "full_image"
    least_score: float = 0.0
    use_table_recognition: bool = False
    use_formula_recognition: bool = False
    use_seal_recognition: bool = False
    use_chart_recognition: bool = False
    use_region_detection: bool = False
    thresholds: dict[int, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.pipeline not in PIPELINES:
            raise ValueError(f"no pipeline named {self.pipeline}; known: {', '.join(PIPELINES)}")
        if self.strategy not in ("full_image", "direct_block"):
            raise ValueError(f"unknown strategy {self.strategy}")

    def override(self, *settings: str) -> Options:
        """Options changed by "name=value" or "name.key=value" strings; values are read as YAML scalars."""
        from dataclasses import asdict

        for setting in settings:
            if setting.partition("=")[0].partition(".")[0] not in self.__dataclass_fields__ or "=" not in setting:
                raise ValueError(f"not a setting: {setting}")
        changed = chains.override(asdict(self), *settings)
        changed["thresholds"] = {int(k): v for k, v in changed["thresholds"].items()}
        return Options(**changed)

    @classmethod
    def from_yaml(cls, path: str) -> Options:
        """Options from a YAML file; names that aren't settings are ignored."""
        import yaml

        with open(path, encoding="utf-8") as f:
            given = yaml.safe_load(f) or {}
        return cls(**{k: v for k, v in given.items() if k in cls.__dataclass_fields__})


def clean(boxes: DataFrame, options: Options = Options()) -> DataFrame:
    """Thresholds, suppression and overlap removal."""
    if options.thresholds:
        boxes = detect.above_threshold(boxes, options.thresholds)
    return detect.clean(boxes, options.same_iou, options.different_iou, options.overlap)


def contents(blocks: DataFrame, spans: DataFrame, options: Options = Options()) -> DataFrame:
    """Blocks with block_content: their spans' texts from top left to bottom right, the label where there are none."""
    bridge = match.match_blocks_to_spans(blocks, spans, options.match)
    listed = bridge.join(spans.select(PAGE, "span_id", "text", "y1", "x1"), [PAGE, "span_id"]).groupBy(PAGE, "box_id")
    content = listed.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y1", "x1", "span_id", "text"))), lambda s: s.text), " ").alias("_content"))
    return blocks.join(content, [PAGE, "box_id"], "left").withColumn("block_content", F.coalesce("_content", "label")).drop("_content")


def assemble(blocks: DataFrame, spans: DataFrame, options: Options = Options()) -> DataFrame:
    """(page_id, text, n_blocks): a page's cleaned blocks as text, from top left to bottom right."""
    rows = contents(clean(blocks, options), spans, options)
    ordered = F.array_sort(F.collect_list(F.struct("y1", "x1", "box_id", "block_content")))
    return rows.groupBy(PAGE).agg(F.array_join(F.transform(ordered, lambda b: b.block_content), "\n\n").alias("text"), F.count(F.lit(1)).alias("n_blocks"))


VISUAL = ("image", "table", "formula", "seal", "chart")


def parse(blocks: DataFrame, spans: DataFrame, options: Options = Options()) -> DataFrame:
    """Blocks with content and reading order: all columns of ``blocks``, block_content, order_index, and the measures of the text lines.

    Text blocks have the text of their spans (see ``content.block_text``), empty where there are
    none; blocks of other kinds have their label.  Blocks are ordered in regions where
    ``blocks`` has region_id.
    """
    return _measured(detect.relabel(clean(blocks, options)), spans, options)


def _measured(rows: DataFrame, spans: DataFrame, options: Options) -> DataFrame:
    bridge = match.match_blocks_to_spans(rows.where(~F.col("label").isin(*VISUAL)), spans, options.match)
    texts = content.block_contents(rows, spans, bridge)
    rows = rows.join(texts, [PAGE, "box_id"], "left").withColumn("block_content", F.when(F.col("label").isin(*VISUAL), F.col("label")).otherwise(F.coalesce("block_content", F.lit(""))))
    return rows.join(order.reading_order(rows), [PAGE, "box_id"]).withColumn("num_of_lines", F.coalesce("lines", F.lit(1)))


def parse_direct(blocks: DataFrame, spans: DataFrame, recogniser: models.Predictor, options: Options = Options()) -> DataFrame:
    """As ``parse``, but text blocks are read one by one by a recogniser; the spans only give the lines."""
    rows = _measured(chains.relabel_direct(clean(blocks, options)), spans, options)
    read = recognise_blocks(rows, recogniser).select(PAGE, "box_id", F.col("text").alias("_text"))
    return rows.join(read, [PAGE, "box_id"], "left").withColumn("block_content", F.coalesce("_text", "block_content")).drop("_text")


def recognise_blocks(blocks: DataFrame, recogniser: models.Predictor) -> DataFrame:
    """Text of each block by a recogniser run on text blocks alone: the filter comes before the model."""
    wanted = blocks.where(~F.col("label").isin(*VISUAL)).select(PAGE, "box_id", *G.SIDES)
    return models.predict(models.sorted_for_batches(wanted), recogniser, "page_id long, box_id long, text string, score double")


#: What each pipeline needs besides options, and the chain it runs.
CHAINS = {
    "ocr": (("boxes", "recogniser"), lambda o, boxes, recogniser: chains.recognise_pages(boxes, recogniser, o.least_score)),
    "document": (("blocks", "spans"), lambda o, blocks, spans: parse(blocks, spans, o)),
    "tables": (("structures", "cells", "spans"), lambda o, structures, cells, spans: chains.assemble_tables(structures, cells, spans)),
    "preprocessing": (("boxes", "angle", "width", "height"), lambda o, boxes, angle, width, height: chains.preprocess(boxes, angle, width, height)),
    "formulas": (("boxes", "recogniser"), lambda o, boxes, recogniser: chains.recognise_regions(boxes, "formula", recogniser, "text")),
    "seals": (("boxes", "recogniser"), lambda o, boxes, recogniser: chains.recognise_regions(boxes, "seal", recogniser, "text")),
    "classification": (("rows", "scores", "labels", "k", "key"), lambda o, rows, scores, labels, k, key: chains.classify(rows, scores, labels, k, key)),
    "universal": (("blocks", "spans", "recogniser"), lambda o, blocks, spans, recogniser: parse_direct(blocks, spans, recogniser, o) if o.strategy == "direct_block" else parse(blocks, spans, o)),
}


def run(options: Options, **inputs) -> DataFrame:
    """Runs the chain that ``options.pipeline`` names; raises where an input that it needs is missing."""
    needed, chain = CHAINS[options.pipeline]
    missing = [n for n in needed if inputs.get(n) is None and not (n == "recogniser" and options.strategy == "full_image" and options.pipeline == "universal")]
    if missing:
        raise ValueError(f"pipeline {options.pipeline} needs {', '.join(missing)}")
    return chain(options, **{n: inputs.get(n) for n in needed})


def to_json(blocks: DataFrame, settings: dict[str, bool] | None = None) -> DataFrame:
    """(page_id, json): a page's result; parts whose setting is off are left out."""
    b = F.struct(F.col("label").alias("block_label"), F.col("block_content").alias("block_content"), F.array(*G.SIDES).alias("block_bbox"))
    listed = blocks.groupBy(PAGE).agg(F.transform(F.array_sort(F.collect_list(F.struct("order_index", "box_id", b.alias("b")))), lambda x: x.b).alias("parsing_res_list"))
    parts = [F.col(PAGE).alias("page_index"), F.col("parsing_res_list")]
    if settings:
        parts.insert(1, F.struct(*[F.lit(v).alias(k) for k, v in settings.items()]).alias("model_settings"))
    return listed.select(PAGE, F.to_json(F.struct(*parts)).alias("json"))


def to_markdown(blocks: DataFrame, page_width: int | None = None, **switches: bool) -> DataFrame:
    """(page_id, markdown, starts, ends, images): a page's blocks in reading order.

    A blank line stands between blocks; a text that goes on from the text before it follows
    directly.  ``starts`` and ``ends`` tell whether the page begins and ends a paragraph
    (``sequence.stitch_pages`` joins pages by them), ``images`` are the paths of the pictures to
    save.  Labels without a form are left out.  ``num_of_lines`` of a block counts as 1 where
    it is no column; ``switches`` are those of ``text.block_markdown``.
    """
    width = F.lit(page_width) if page_width else None
    md = text.block_markdown(F.col("label"), F.col("block_content"), G.box(), width, **switches)
    rows = blocks if "num_of_lines" in blocks.columns else blocks.withColumn("num_of_lines", F.lit(1))
    shown = rows.withColumn("_md", md).where("_md IS NOT NULL")
    flagged = sequence.segment_flags_simple(shown).withColumn("_last", F.lag("label").over(Window.partitionBy(PAGE).orderBy("order_index")))
    goes_on = (F.col("label") == "text") & (F.col("_last") == "text") & ~F.col("seg_start_flag")
    piece = F.concat(F.when(F.col("_last").isNull() | goes_on, "").otherwise("\n\n"), F.col("_md"))
    picture = F.when(F.col("label").isin("image", "figure", "chart", "seal", "table", "formula"), text.image_path(F.col("label"), G.box()))
    listed = flagged.select(PAGE, "order_index", piece.alias("_piece"), picture.alias("_path"))
    pages = listed.groupBy(PAGE).agg(F.array_sort(F.collect_list(F.struct("order_index", "_piece", "_path"))).alias("l"))
    # the page's first block sets the start, whether it is shown or not; it follows nothing
    ends = F.lit(True)
    return pages.select(
        PAGE,
        F.array_join(F.transform("l", lambda x: x["_piece"]), "").alias("markdown"),
        F.lit(False).alias("starts"),
        ends.alias("ends"),
        F.filter(F.transform("l", lambda x: x["_path"]), lambda p: p.isNotNull()).alias("images"),
    )

"""Text of a block from its recognised spans: lines, spaces, hyphens and line ends, from where the words stand.

Works on one block at a time; axis 0 is x.  A line ends early where its last word stands far
from the block's edge, which is what tells paragraphs apart.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.functions.text import NON_BREAKING
from pagewright.operators import regions
from pagewright.operators.paged import by_page
from pagewright.operators.reading import along

PAGE = "page_id"

# fixed values: what stands between the lines of a label's blocks, and the share by which spans overlap on a line
BETWEEN = {"doc_title": " ", "content": "\n"}
ON_LINE = 0.6


@dataclass
class Span:
    box: list[float]
    text: str
    label: str = "text"


@dataclass
class Line:
    """Spans side by side, the box around them, and whether the next line starts anew."""

    spans: list[Span]
    box: tuple
    ends: bool = False

    def extent(self, axis: int) -> float:
        return abs(self.box[axis + 2] - self.box[axis])


def _letter(c: str) -> bool:
    return c.isascii() and c.isalpha()


def axis_of(boxes: Sequence[Sequence[float]], ratio: float = 1.5) -> int:
    """0 if at least half of the boxes are wide (width * ratio >= height), as are no boxes at all."""
    wide = sum((b[2] - b[0]) * ratio >= b[3] - b[1] for b in boxes)
    return 0 if 2 * wide >= len(boxes) else 1


def lines_of(spans: Sequence[Span], axis: int) -> list[Line]:
    """Spans on lines, from the top (vertical ones from the right): a span joins while it overlaps the growing line enough.

    Vertical lines that are over twice as long across as the shortest go, if few lines are about that short.
    """
    cross = 1 - axis
    lines: list[Line] = []
    for span in sorted(spans, key=lambda s: s.box[1] if axis == 0 else -s.box[0]):
        if lines and along(lines[-1].box, span.box, cross, small=True) >= ON_LINE:
            lines[-1].spans.append(span)
            lines[-1].box = regions.enclosing([lines[-1].box, span.box])
        else:
            lines.append(Line([span], tuple(span.box)))
    if axis == 1 and lines:
        sizes = [line.extent(cross) for line in lines]
        usual = 1.1 * min(sizes)
        if max(sizes) > 2 * min(sizes) and sum(s < usual for s in sizes) < 0.4 * len(lines):
            lines = [line for line, s in zip(lines, sizes, strict=True) if s <= usual]
    return lines


def in_reading_order(line: Line, axis: int, read: Callable[[list[float]], tuple[str, float]] | None = None, least: float = 0.0) -> list[Span]:
    """A line's spans along it; where formulas stand inside texts, the texts are parted and the parts read anew, if there is a reader."""
    spans = sorted(line.spans, key=lambda s: (s.box[axis] // 2, s.box[1] if axis == 0 else -s.box[3]))
    if read is None or not any(s.label == "formula" for s in spans):
        return spans
    parted = [Span(b, t, label) for b, t, label in regions.parted_by([(s.box, s.text, s.label) for s in spans], axis)]
    if len(parted) == len(spans):
        return spans
    out = []
    for s in sorted(parted, key=lambda s: s.box[axis]):
        if s.label == "text":
            s.text, score = read(s.box)
            if score < least:
                continue
        out.append(s)
    return out


def line_text(line: Line, axis: int, label: str, width: float, start: float, stop: float) -> str:
    """A line as text; sets ``line.ends``.  Formulas in a text stand between dollar signs, alone on a line of their own."""
    out = ""
    for s in line.spans:
        t = s.text
        if s.label == "formula" and label != "formula" and not (t.startswith("$") or t.endswith("$")):
            t = f"${t}$" if len(line.spans) > 1 else f"\n${t}$"
        out += t
        if s.label == "formula" or t and _letter(out[-1]):
            out += " "
    out = out.removesuffix(" ")
    if not out:
        return ""
    last, left = out[-1], stop - line.spans[-1].box[axis + 2]
    letter, numeric, goes_on = _letter(last), last.isdecimal(), last in NON_BREAKING
    room = 1.5 * line.extent(1 - axis)
    if not (letter or numeric or goes_on) or left > 0.3 * width:
        line.ends |= left > room or axis == 1 and line.spans[0].box[1] - start > room
    if last == "-":
        return out[:-1]
    if letter or last == "$":
        out += " "
    if not (letter or numeric) or axis == 1:
        breaks = left > 0.3 * width and not goes_on
    else:
        breaks = left > 0.5 * (stop - start)
    line.ends |= breaks
    return out + "\n" if breaks else out


@dataclass
class Content:
    text: str
    axis: int
    lines: int
    line_width: float
    line_height: float
    seg_start: float | None
    seg_end: float | None


def block_text(label: str, box: Sequence[float], spans: Sequence[Span], read: Callable[[list[float]], tuple[str, float]] | None = None, least: float = 0.0) -> Content | None:
    """A block's text and the measures of its lines; nothing without spans."""
    if not spans:
        return None
    axis = axis_of([s.box for s in spans if s.label == "text"])
    lines = lines_of(spans, axis)
    edges = regions.enclosing([s.box for s in spans]) if label == "reference" else box
    start, stop = edges[axis], edges[axis + 2]
    texts, widest = [], 0.0
    for line in lines:
        line.spans = in_reading_order(line, axis, read, least)
        widest = max(widest, line.extent(axis))
        texts.append(line_text(line, axis, label, widest, start, stop) if line.spans else "")
    first, last = lines[0].spans or [None], lines[-1].spans or [None]
    measured = Content(
        "", axis, len(lines), sum(x.extent(axis) for x in lines) / len(lines), sum(x.extent(1 - axis) for x in lines) / len(lines),
        first[0].box[0] if first[0] else None, last[-1].box[2] if len(lines) > 1 and last[-1] else None,
    )
    if label in BETWEEN:
        measured.text = BETWEEN[label].join(texts)
        return measured
    ending = sum(line.ends for line in lines)
    out, short_before, char = "", False, ""
    for line, t in zip(lines, texts, strict=True):
        if not t:
            continue
        indent = line.box[axis] - start
        if short_before and not out.endswith("\n"):
            deep = indent > 1.5 * line.extent(1 - axis) and not _letter(char) and not char.isdecimal()
            if deep or indent > 0.4 * (stop - start):
                t = "\n" + t
        out += t
        char = t[-2] if len(t) > 2 and t.endswith(" ") else t[-1]
        closed = not t.endswith("\n") and not _letter(char) and char not in NON_BREAKING and not char.isdecimal()
        if closed and ending > 0.5 * len(texts) or ending > 0.6 * len(texts):
            out += "\n"
        short_before |= stop - line.box[axis + 2] > 0.3 * (stop - start)
    measured.text = out
    return measured


def block_contents(blocks: DataFrame, spans: DataFrame, bridge: DataFrame) -> DataFrame:
    """(page_id, box_id, block_content, direction, lines, line_width, line_height, seg_start, seg_end) of blocks with spans.

    blocks: (page_id, box_id, label, sides); spans: (page_id, span_id, text, sides), and label
    where formulas are among them; bridge: (page_id, box_id, span_id).
    """
    kind = F.col("s.label") if "label" in spans.columns else F.lit("text")
    b, s = blocks.alias("b"), spans.alias("s")
    rows = bridge.join(b, (bridge[PAGE] == F.col(f"b.{PAGE}")) & (bridge["box_id"] == F.col("b.box_id"))).join(s, (bridge[PAGE] == F.col(f"s.{PAGE}")) & (bridge["span_id"] == F.col("s.span_id")))
    rows = rows.select(bridge[PAGE], bridge["box_id"], bridge["span_id"], F.col("b.label").alias("label"), *[F.col(f"b.{x}").cast("double").alias(f"b{x}") for x in G.SIDES], F.col("s.text").alias("text"), kind.alias("kind"), *[F.col(f"s.{x}").cast("double").alias(x) for x in G.SIDES])

    def work(page: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {c: [] for c in (PAGE, "box_id", "block_content", "direction", "lines", "line_width", "line_height", "seg_start", "seg_end")}
        per: dict[int, list[int]] = {}
        for k, box_id in enumerate(page["box_id"]):
            per.setdefault(box_id, []).append(k)
        for box_id, at in per.items():
            own = [Span([page[x][k] for x in G.SIDES], page["text"][k] or "", page["kind"][k]) for k in at]
            c = block_text(page["label"][at[0]], [page[f"b{x}"][at[0]] for x in G.SIDES], own)
            for name, value in zip(out, (page[PAGE][0], box_id, c.text, ("horizontal", "vertical")[c.axis], c.lines, c.line_width, c.line_height, c.seg_start, c.seg_end), strict=True):
                out[name].append(value)
        return out

    schema = f"{PAGE} long, box_id long, block_content string, direction string, lines int, line_width double, line_height double, seg_start double, seg_end double"
    return by_page(rows, [PAGE], ["box_id", "span_id"], work, schema)

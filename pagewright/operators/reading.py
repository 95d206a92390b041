"""The full reading order of a page.

The steps: blocks get the group they are ordered with and adopt their captions, footnotes and
subtitles; centred blocks and wide gaps part the page into bands; within a band, blocks that
cross columns are set aside and the others are sorted by recursive XY cuts; what was set aside
is inserted where a rule of its group puts it; headers come first, footers and unordered
blocks last; adopted blocks stand beside their parents.

All of it works on one page, whose blocks move each other.  Axis 0 is x, axis 1 is y; a
horizontal block or page reads along axis 0.  Ties keep the order of the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import pairwise

import numpy as np

# fixed values: groups of labels, and the settings of the rules
TITLES = ("doc_title",)
HEADINGS = ("paragraph_title", "abstract_title", "reference_title", "content_title")
VISION = ("image", "table", "chart", "flowchart", "figure")
VISION_TITLES = ("table_title", "chart_title", "figure_title", "figure_table_chart_title")
UNORDERED = ("aside_text", "seal", "number", "formula_number")
HEADERS = ("header", "header_image")
FOOTERS = ("footer", "footer_image", "footnote")
TEXT = ("text",)
GROUP_OF = {label: group for group, labels in {"header": HEADERS, "doc_title": TITLES, "paragraph_title": HEADINGS, "vision": VISION, "footer": FOOTERS, "unordered": UNORDERED, "region": ("region",)}.items() for label in labels}
#: Groups of blocks that take no part in the cuts: they come elsewhere, or with a parent.
APART = frozenset(("header", "unordered", "footer", "vision_footnote", "sub_paragraph_title", "doc_title_text", "vision_title", "sub_region"))
BESIDE = 0.1  # overlap with a neighbour, of the smaller, above which it is one
EDGE_WEIGHT, UP_WEIGHT, LEFT_WEIGHT = 1e4, 1.0, 1e-4
EDGE_TOLERANCE = 2
LONG_TEXT_WORDS = 10
WIDE_GAP, NARROW_GAP = 3, 1.2  # in line heights


class Block:
    """A block of a page; ``box`` grows with the blocks it adopts, ``own`` does not."""

    __slots__ = ("axis", "box", "children", "distance", "group", "id", "label", "line_height", "line_width", "lines", "own", "seg_end", "seg_start")

    def __init__(self, id_: int, label: str, box: Sequence[float], lines: int = 1, line_width: float = 1, line_height: float = 1, seg_start: float = np.inf, seg_end: float = -np.inf, axis: int | None = None, distance: float = 0.0):
        self.id, self.label, self.group = id_, label, None
        self.box = self.own = tuple(int(v) for v in box)
        self.axis = axis if axis is not None else int(self.own[2] - self.own[0] < self.own[3] - self.own[1])
        self.lines, self.line_width, self.line_height, self.seg_start, self.seg_end = lines, line_width, line_height, seg_start, seg_end
        self.children: list[Block] = []
        self.distance = distance

    def extent(self, axis: int) -> int:
        return self.own[axis + 2] - self.own[axis]

    @property
    def long(self) -> int:
        return self.extent(self.axis)

    @property
    def short(self) -> int:
        return self.extent(1 - self.axis)

    @property
    def area(self) -> float:
        return float(self.extent(0)) * self.extent(1)

    def span(self, axis: int) -> tuple[int, int]:
        return self.box[axis], self.box[axis + 2]

    @property
    def centre(self) -> tuple[float, float]:
        return (self.box[0] + self.box[2]) / 2, (self.box[1] + self.box[3]) / 2

    def adopt(self, other: Block, group: str) -> None:
        other.group = group
        a, b = self.box, other.box
        self.box = (min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3]))
        self.children += [other, *other.release()]

    def release(self) -> list[Block]:
        """The adopted blocks; the box is the own one again."""
        gone, self.children, self.box = self.children, [], self.own if self.children else self.box
        return gone


# --- geometry --------------------------------------------------------------------------------


def along(a: Sequence[float], b: Sequence[float], axis: int, small: bool = False) -> float:
    """Shared part of two boxes' extents on an axis, of both together or of the smaller."""
    shared = min(a[axis + 2], b[axis + 2]) - max(a[axis], b[axis])
    if shared <= 0:
        return 0.0
    whole = min(a[axis + 2] - a[axis], b[axis + 2] - b[axis]) if small else max(a[axis + 2], b[axis + 2]) - min(a[axis], b[axis])
    return shared / whole if whole > 0 else 0.0


def overlap(a: Sequence[float], b: Sequence[float], small: bool = False) -> float:
    """Shared area of two boxes, of both together or of the smaller."""
    shared = float(max(0, min(a[2], b[2]) - max(a[0], b[0]))) * max(0, min(a[3], b[3]) - max(a[1], b[1]))
    areas = [abs(float(c[2] - c[0]) * (c[3] - c[1])) for c in (a, b)]
    whole = min(areas) if small else sum(areas) - shared
    return shared / whole if whole else 0.0


def edge_distance(a: Sequence[float], b: Sequence[float], weights: Sequence[float] = (1, 1, 1, 1)) -> float:
    """Gap between the nearest edges on both axes; weights: b to the right of a, left, below, above."""
    gaps = [0.0, 0.0]
    for axis in (0, 1):
        if along(a, b, axis) == 0:
            gap = min(abs(a[axis] - b[axis + 2]), abs(a[axis + 2] - b[axis]))
            gaps[axis] = gap * weights[2 * axis + (0 if a[axis + 2] < b[axis] else 1)]
    return sum(gaps)


def merged(boxes: Iterable[Sequence[float]], axis: int) -> list[tuple[float, float, int]]:
    """Islands (start, end, members) of boxes whose extents on an axis touch or overlap."""
    out: list[tuple[float, float, int]] = []
    for low, high in sorted(((b[axis], b[axis + 2]) for b in boxes), key=lambda s: s[0]):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high), out[-1][2] + 1)
        else:
            out.append((low, high, 1))
    return out


def profile(boxes: Iterable[Sequence[float]], axis: int) -> np.ndarray:
    """How many boxes cover each pixel of an axis, up to the furthest."""
    spans = np.abs(np.array([(b[axis], b[axis + 2]) for b in boxes], np.int64))
    edges = np.zeros(int(spans.max()) + 1 if len(spans) else 1, np.int64)
    some = spans[:, 0] < spans[:, 1]
    np.add.at(edges, spans[some, 0], 1)
    np.add.at(edges, spans[some, 1], -1)
    return np.cumsum(edges)[:-1]


def flat_minima(values: np.ndarray) -> list[tuple[int, int]]:
    """Level stretches (first, last) lower than both neighbours, the first one left out and the last stretch never one."""
    if not len(values):
        return []
    starts = np.concatenate([[0], np.flatnonzero(np.diff(values)) + 1])
    level = values[starts]
    found = [(int(starts[k]), int(starts[k + 1]) - 1) for k in range(len(starts) - 1) if (k == 0 or level[k - 1] > level[k]) and level[k + 1] > level[k]]
    return found[1:]


# --- XY cuts ---------------------------------------------------------------------------------


def _stripes(boxes: np.ndarray, members: np.ndarray, axis: int, min_gap: int) -> list[np.ndarray]:
    """Members by the stripes between empty gaps of ``min_gap`` pixels or more, each in order of its start.

    Negative coordinates are mirrored ones: their stripes come in reverse.
    """
    members = members[np.argsort(boxes[members, axis], kind="stable")]
    low, high = np.abs(boxes[members, axis]), np.abs(boxes[members, axis + 2])
    low, high = np.minimum(low, high), np.maximum(low, high)
    order = np.argsort(low, kind="stable")
    reach = np.maximum.accumulate(high[order])
    stripe = np.zeros(len(members), np.int64)
    stripe[order[1:]] = np.cumsum(low[order][1:] - reach[:-1] >= min_gap)
    parts = [members[stripe == s] for s in range(stripe.max() + 1)] if len(members) else []
    return parts[::-1] if len(members) and boxes[members, axis].min() < 0 else parts


def recursive_cut(boxes: np.ndarray, first: int, min_gap: int = 1) -> list[int]:
    """Order of boxes (n, 4) by cuts on the axis ``first``, then the other, and so on until neither cuts."""
    boxes = np.asarray(boxes, np.int64).reshape(-1, 4)

    def cut(members: np.ndarray, gap: int) -> list[int]:
        out: list[int] = []
        for part in _stripes(boxes, members, first, 1):
            cross = _stripes(boxes, part, 1 - first, gap)
            if len(cross) == 1:
                out += part[np.argsort(boxes[part, 1 - first], kind="stable")].tolist()
            else:
                for piece in cross:
                    out += cut(piece, 1)
        return out

    return cut(np.arange(len(boxes)), min_gap)


def shrink(boxes: list[tuple], axis: int, most: float = 0.1) -> list[tuple]:
    """Boxes that overlap the one before them slightly, or nearly touch it, parted by two pixels on the axis."""
    out = [list(b) for b in boxes]
    for a, b in pairwise(out):
        shared = along(a, b, axis)
        if along(a, b, 1 - axis) > 0 and 0 < shared < most or abs(a[axis + 2] - b[axis]) <= 3:
            middle = int((max(a[axis], b[axis]) + min(a[axis + 2], b[axis + 2])) / 2)
            if a[axis] < b[axis]:
                a[axis + 2], b[axis] = middle - 1, middle + 1
            else:
                a[axis], b[axis + 2] = middle - 1, middle + 1
    return [tuple(b) for b in out]


# --- a page ----------------------------------------------------------------------------------


class Sheet:
    """Blocks that are ordered together, their reading axis and their usual line."""

    def __init__(self, blocks: list[Block], box: Sequence[float]):
        self.blocks, self.box = blocks, tuple(box)
        kind = {b.id: GROUP_OF.get(b.label, "vision_title" if b.label in VISION_TITLES else "normal_text") for b in blocks}
        self.kind = {group: [b for b in blocks if kind[b.id] == group] for group in ("header", "footer", "unordered", "paragraph_title", "vision_title")}
        # regions count as text here
        self.normal = [b for b in blocks if kind[b.id] in ("normal_text", "region")]
        self.axis = 0 if 2 * sum(b.axis == 0 for b in self.normal) >= len(self.normal) else 1
        self.line_width = float(np.mean([b.line_width for b in self.normal])) if self.normal else 20.0
        self.line_height = float(np.mean([b.line_height for b in self.normal])) if self.normal else 10.0

    @property
    def of_regions(self) -> bool:
        return bool(self.blocks) and self.blocks[0].label == "region"

    def usual_order(self, blocks: list[Block]) -> list[Block]:
        """By text row, text column, and distance of the centre."""

        def key(b: Block) -> tuple:
            (x1, y1, x2, _), (cx, cy) = b.box, b.centre
            if self.axis == 0:
                return y1 // self.line_height, x1 // self.line_width, cx * cx + cy * cy
            return -x2 // self.line_width, y1 // self.line_height, cy * cy - cx * cx

        return sorted(blocks, key=key)


def neighbours(block: Block, others: Iterable[Block], axis: int) -> tuple[list[Block], list[Block]]:
    """Blocks before and after a block across an axis, nearest first, of those that overlap it along the axis."""
    near = [o for o in others if o is not block and along(block.box, o.box, axis, small=True) > BESIDE]
    at = lambda b: b.box[1 - axis]
    return sorted((o for o in near if at(o) <= at(block)), key=at, reverse=True), sorted((o for o in near if at(o) > at(block)), key=at)


def _leave(listed: list[Block], block: Block) -> None:
    listed[:] = [b for b in listed if b is not block]


def adopt_title_text(sheet: Sheet, title: Block) -> None:
    """A document title takes short small text next to it, and text within it."""
    candidates = list(sheet.normal)
    before, after = neighbours(title, candidates, title.axis)
    for text in before[:1] + after[:1]:
        fits = text.short < 0.8 * title.short and not title.long <= text.long <= 1.5 * title.long
        if text.axis == title.axis and text.label in TEXT and fits and text.lines < 3 and edge_distance(title.box, text.box) < 2 * text.line_height:
            title.adopt(text, "doc_title_text")
            _leave(sheet.normal, text)
    for text in candidates:
        if text.group != "doc_title_text" and text.axis == title.axis and overlap(title.box, text.box, small=True) > 0.9:
            title.adopt(text, "doc_title_text")
            _leave(sheet.normal, text)


def adopt_subheadings(sheet: Sheet, heading: Block) -> None:
    """A heading takes headings right before and after it that start where it starts."""
    for side in neighbours(heading, sheet.kind["paragraph_title"] + sheet.normal, heading.axis):
        for other in side:
            if other.label not in HEADINGS:
                break
            height = min(heading.line_height, other.line_height)
            aligned = abs(other.span(other.axis)[0] - heading.span(heading.axis)[0]) < 2 * height
            if other.axis == heading.axis and aligned and edge_distance(heading.box, other.box) <= 1.5 * height:
                heading.adopt(other, "sub_paragraph_title")
                _leave(sheet.kind["paragraph_title"], other)


def _is_footnote(picture: Block, text: Block) -> bool:
    if text.axis != picture.axis or text.long >= picture.long or edge_distance(picture.box, text.box) > 2 * text.line_height:
        return False
    centred = text.short < picture.short and 2 * text.long < picture.long and abs(picture.centre[0] - text.centre[0]) < 10
    flush = min(picture.box[0] - text.box[0], picture.box[2] - text.box[2]) < 10
    return centred or flush and text.lines == 1


def adopt_captions(sheet: Sheet, picture: Block) -> None:
    """A picture takes titles next to it, one footnote, and text within it."""
    candidates = sheet.normal + sheet.kind["vision_title"]
    titled = noted = False
    for axis in (picture.axis, 1 - picture.axis):
        for after, side in enumerate(neighbours(picture, candidates, axis)):
            for other in side:
                if after and noted and other.label in TEXT or not after and other.label not in TEXT + VISION_TITLES:
                    break
                if other.label in VISION_TITLES and edge_distance(picture.box, other.box) <= 2 * other.line_height:
                    titled = True
                    picture.adopt(other, "vision_title")
                    _leave(sheet.kind["vision_title"], other)
                if other.label in TEXT:
                    if not noted and _is_footnote(picture, other):
                        noted = True
                        picture.adopt(other, "vision_footnote")
                        _leave(sheet.normal, other)
                        if after:
                            other.label = "vision_footnote"
                    break
        if titled:
            break
    for other in candidates:
        if any(other is b for b in sheet.normal) and overlap(picture.box, other.box, small=True) > 0.9:
            other.label = "vision_footnote"
            picture.adopt(other, "vision_footnote")
            _leave(sheet.normal, other)


def adopt_regions(sheet: Sheet, region: Block) -> None:
    """A region takes smaller ones that overlap it."""
    for other in sheet.blocks:
        if other is not region and other.group != "sub_region" and region.area > other.area and overlap(region.box, other.box) > 0:
            region.adopt(other, "sub_region")
            _leave(sheet.normal, other)


ADOPTION: dict[str, Callable[[Sheet, Block], None]] = {"doc_title": adopt_title_text, "paragraph_title": adopt_subheadings, "vision": adopt_captions, "region": adopt_regions}


def assign_groups(sheet: Sheet) -> list[Block]:
    """Gives every block its group, lets parents adopt, and returns the blocks centred on the page."""
    centred = []
    middle = (sheet.box[sheet.axis] + sheet.box[sheet.axis + 2]) / 2
    for b in sheet.blocks:
        if b.group not in APART:
            b.group = GROUP_OF.get(b.label, "normal_text")
            if b.group == "vision":
                b.lines, b.axis = 1, sheet.axis
            if b.group in ADOPTION:
                ADOPTION[b.group](sheet, b)
        tolerance = b.long // 5 if b.axis == 0 else b.short // 10
        if abs(sum(b.span(sheet.axis)) / 2 - middle) <= tolerance:
            centred.append(b)
    return centred


def _differently_parted(sheet: Sheet, low: float, middle: float, high: float) -> bool:
    """Whether the columns above and below a gap have other gutters."""
    cross = 1 - sheet.axis
    gutters = []
    for start, end in ((low, middle), (middle, high)):
        boxes = [b.box for b in sheet.blocks if b.box[cross] >= start and b.box[cross + 2] <= end]
        gutters.append([(s, 0, e, 0) if sheet.axis == 0 else (0, s, 0, e) for s, e in flat_minima(profile(boxes, sheet.axis))] if boxes else [])
    most = max(map(len, gutters))
    return most > 0 and len(merged(gutters[0] + gutters[1], sheet.axis)) != most


def bands(sheet: Sheet, centred: list[Block]) -> list[list[Block]]:
    """The blocks that are cut, parted at centred blocks and at wide gaps; bands in reading order."""
    cross = 1 - sheet.axis
    taking_part = [b for b in sheet.blocks if b.group not in APART]
    if not taking_part:
        return []
    islands = merged((b.box for b in taking_part), cross)
    cuts: set[float] = set()
    for b in centred:
        # a centred block that is alone in its stripe is a band of its own
        if b.group not in APART and b.axis == sheet.axis and (*b.span(cross), 1) in islands:
            cuts.update(b.span(cross))
    columns = [b.box for b in taking_part if b.group != "vision"]
    if sheet.of_regions or columns and len(merged(columns, sheet.axis)) == 1:
        last = max(islands[0][0], max((c for c in cuts if c < islands[0][1]), default=0))
        for (_, end, _), (start, stop, _) in pairwise(islands):
            if sheet.of_regions or start - end >= WIDE_GAP * sheet.line_height:
                cuts.add(end)
            elif start - end > NARROW_GAP * sheet.line_height and _differently_parted(sheet, last, end, stop):
                last = end
                cuts.add(end)
    found: dict[float, list[Block]] = {}
    edges = [*sorted(cuts), np.inf]
    for b in sorted(sheet.blocks, key=lambda b: b.box[cross + 2]):
        if b.group not in APART:
            found.setdefault(edges[int(np.searchsorted(edges, b.box[cross + 2]))], []).append(b)
    ordered = [found[e] for e in edges if e in found]
    return ordered[::-1] if sheet.axis == 1 else ordered


_SET = ("doc_title", "cross_layout", "cross_reference")


def mark_crossing(band: list[Block], axis: int) -> None:
    """Marks blocks that cross columns: they overlap others, or face two that stand side by side."""
    band.sort(key=lambda b: (b.box[0], b.extent(0)))
    free = lambda *but: [b for b in band if b.group not in _SET and not any(b is x for x in but)]

    def judge(block: Block, other: Block) -> bool:
        """Marks one of two that overlap; True ends the search with this other."""
        shared = overlap(block.box, other.box)
        if shared and other.group == "vision":
            other.group = "cross_layout"
        elif shared > 0.1 and block.area < other.area:
            block.group = "cross_layout"
        else:
            return False
        return True

    for block in band:
        if block.group in _SET:
            continue
        for other in band:
            if other is block or other.group in _SET:
                continue
            if judge(block, other):
                break
            if along(block.box, other.box, axis) <= 0:
                continue
            for third in free(block, other):
                if third.group in _SET:
                    continue
                shared = overlap(block.box, third.box)
                if shared > 0.1 and third.group == "vision":
                    third.group = "cross_layout"
                    break
                if shared > 0.1 and (block.group == "vision" or block.area < third.area):
                    block.group = "cross_layout"
                    break
                apart = along(block.box, third.box, axis) > 0 and along(other.box, third.box, axis) == 0 and along(other.box, third.box, 1 - axis) > 0
                long_text = all(b.group == "normal_text" and b.long > LONG_TEXT_WORDS * b.line_height for b in (other, third))
                if apart and (block.group in ("vision", "region") or long_text):
                    block.group = "cross_reference" if block.label == "reference" else "cross_layout"


def cut_order(sheet: Sheet, blocks: list[Block]) -> list[Block]:
    """Blocks of a band by XY cuts: rows first in one column or where all are single lines, columns first otherwise."""
    axis, cross = sheet.axis, 1 - sheet.axis
    rows_first = len(merged((b.box for b in blocks), axis)) == 1 or max(b.lines for b in blocks) == 1
    # pages read from right to left are mirrored
    boxes = [b.box if axis == 0 else (-b.box[0], b.box[1], -b.box[2], b.box[3]) for b in blocks]
    first, second, unit = (cross, axis, sheet.line_height) if rows_first else (axis, cross, sheet.line_width)
    unit = unit // 2 or 1
    order = sorted(range(len(blocks)), key=lambda k: (boxes[k][first] // unit, boxes[k][second]))
    cut = recursive_cut(np.array(shrink([boxes[k] for k in order], cross)), first)
    return [blocks[order[k]] for k in cut]


# --- insertion -------------------------------------------------------------------------------


def starts_segment(block: Block, previous: Block | None) -> bool:
    """Whether a block begins a paragraph, or else continues the previous one."""
    left, right = block.span(block.axis)
    if previous is None:
        return block.seg_start - left >= 10
    low, high = previous.span(previous.axis)
    room, edge = abs(high - previous.seg_end), abs(left - high)
    if left < high and right > low:
        left, room, edge = min(low, left), abs(max(high, right) - previous.seg_end), 0
    continues = room < 10 and block.seg_start - left < 10 and previous.lines > 1 and edge < max(previous.extent(0), block.extent(0))
    return not continues


def _side_weights(block: Block) -> tuple[float, ...]:
    if block.group == "doc_title":
        return (1, 0.1, 0.1, 1) if block.axis == 0 else (0.2, 0.1, 1, 1)
    if block.group in ("paragraph_title", "table_title", "abstract", "image", "seal", "chart", "figure"):
        return 1, 1, 0.1, 1
    return 1, 1, 1, 0.1


def _comes_after(sheet: Sheet, block: Block, other: Block) -> bool:
    (x1, y1, x2, _), (u1, v1, u2, _) = block.box, other.box
    if y1 // 2 != v1 // 2:
        return y1 > v1
    if sheet.axis == 0 and x1 // 2 != x2 // 2:
        return x1 > u1
    if sheet.axis == 1 and x1 != x2:
        return -x2 > -u2
    return sum(c * c for c in block.centre) > sum(c * c for c in other.centre)


def insert_by_weight(sheet: Sheet, ordered: list[Block], block: Block) -> None:
    """Beside the block of the least weighted distance: gap to it, then its height on the page, then its left edge."""
    tolerance, least, least_up, place = EDGE_TOLERANCE, np.inf, np.inf, 0
    floating = block.label in VISION + VISION_TITLES
    for k, other in enumerate(ordered):
        gap = edge_distance(block.box, other.box, _side_weights(block))
        if block.label in TITLES:
            tolerance = max(tolerance, 1, sheet.line_width)
        if block.label == "abstract":
            tolerance, gap = 2 * tolerance, 10 * max(0.1, gap)
        u1, v1, u2, v2 = other.box
        up, left, above = (v1, u1, v2 < block.box[1]) if sheet.axis == 0 else (-u2, v1, u1 > block.box[2])
        if above and block.label not in UNORDERED:
            up, left = -up, -left
        if abs(least_up - up) <= tolerance:
            up = least_up
        least_up = min(least_up, up)
        weight = EDGE_WEIGHT * gap + UP_WEIGHT * up + LEFT_WEIGHT * left
        if weight >= least:
            continue
        least = weight
        if _comes_after(sheet, block, other):
            # a picture doesn't part a paragraph that goes on
            goes_on = floating and k + 1 < len(ordered) and not starts_segment(ordered[k + 1], other)
            place = k + 2 if goes_on else k + 1
        else:
            goes_on = floating and k > 0 and not starts_segment(other, ordered[k - 1])
            place = k - 1 if goes_on else k
    ordered.insert(place, block)


def insert_reference(sheet: Sheet, ordered: list[Block], block: Block) -> None:
    """After the block above it that lies furthest right, then lowest; second where nothing is above."""
    above = [k for k, o in enumerate(ordered) if o.box[3] <= block.box[1]]
    at = max(above, key=lambda k: (10 * ordered[k].box[2] + ordered[k].box[3], -k), default=0)
    ordered.insert(at + 1, block)


def insert_by_corner(sheet: Sheet, ordered: list[Block], block: Block) -> None:
    """After the block whose upper left corner is nearest, by steps along the axes."""
    steps = [abs(o.box[0] - block.box[0]) + abs(o.box[1] - block.box[1]) for o in ordered]
    ordered.insert((int(np.argmin(steps)) if steps else 0) + 1, block)


def insert_by_distance(sheet: Sheet, ordered: list[Block], block: Block) -> None:
    """Before the first block that is further from the origin."""
    ordered.insert(next((k for k, o in enumerate(ordered) if o.distance > block.distance), len(ordered)), block)


INSERTION: dict[str, Callable[[Sheet, list[Block], Block], None]] = {
    **dict.fromkeys(("cross_layout", "paragraph_title", "doc_title", "vision_title", "vision"), insert_by_weight),
    "cross_reference": insert_reference,
    "region": insert_by_distance,
}


def insert_all(sheet: Sheet, ordered: list[Block], blocks: list[Block]) -> list[Block]:
    for k, block in enumerate(sheet.usual_order(blocks)):
        group = "region" if block.label == "region" else block.group
        if k == 0 and group == "doc_title":
            ordered.insert(0, block)
        else:
            INSERTION.get(group, insert_by_corner)(sheet, ordered, block)
    return ordered


def with_children(ordered: list[Block]) -> list[Block]:
    """Every parent replaced by itself and its adopted blocks, from top to bottom (right to left where they are vertical)."""
    out = []
    for block in ordered:
        family = block.release()
        if not family:
            out.append(block)
            continue
        horizontal, family = family[0].axis == 0, [*family, block]
        if block.label == "region":
            family.sort(key=lambda b: b.distance)
        elif horizontal:
            family.sort(key=lambda b: (b.box[1], b.box[0], sum(c * c for c in b.centre)))
        else:
            family.sort(key=lambda b: (-b.box[2], b.box[1], b.centre[1] ** 2 - b.centre[0] ** 2))
        out += family
    return out


def order_sheet(sheet: Sheet) -> list[Block]:
    """All blocks of a sheet in reading order."""
    ordered: list[Block] = []
    aside: list[Block] = []
    for band in bands(sheet, assign_groups(sheet)):
        if band[0].label != "region" or len(merged((b.box for b in band), sheet.axis)) == 1:
            mark_crossing(band, sheet.axis)
        cut = [b for b in band if b.group not in (*_SET, "unordered")]
        titles = [b for b in band if b not in cut and b.label == "doc_title"]
        aside += [b for b in band if b not in cut and b.label != "doc_title"]
        part = insert_all(sheet, cut_order(sheet, cut) if cut else [], titles)
        if aside and aside[0].label == "region":
            part, aside = insert_all(sheet, part, aside), []
        ordered += part
    ordered = insert_all(sheet, ordered, aside)
    kinds = {k: sheet.usual_order(sheet.kind[k]) for k in ("header", "footer", "unordered")}
    return with_children(kinds["header"] + ordered + kinds["footer"] + kinds["unordered"])


def distance_of(sheet: Sheet) -> float:
    """Least distance of a block's corner from where reading starts: top left, or top right for vertical text."""
    x = [b.box[0] if sheet.axis == 0 else b.box[2] - sheet.box[2] for b in sheet.blocks]
    return min((float(np.hypot(u, b.box[1])) for u, b in zip(x, sheet.blocks, strict=True)), default=0.0)


def order_regions(regions: list[tuple[Sequence[float], list[Block]]], page: Sequence[float]) -> list[Block]:
    """Two levels: regions as blocks of the page, then the blocks of each region."""
    sheets = [Sheet(blocks, box) for box, blocks in regions]
    marks = [Block(k, "region", s.box, 10, s.line_width, s.line_height, axis=s.axis, distance=distance_of(s)) for k, s in enumerate(sheets)]
    return [b for mark in order_sheet(Sheet(marks, page)) for b in order_sheet(sheets[mark.id])]

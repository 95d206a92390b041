"""Box geometry as pure column functions.

A box is a struct column with fields x1, y1, x2, y2.  The overlap definitions differ on
purpose (see ``overlap``): each caller names the one it means.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIDES = ("x1", "y1", "x2", "y2")


def box(prefix: str = "", table: str = "") -> Column:
    """Struct of the four side columns, e.g. ``box("page_")`` of page_x1 .. page_y2."""
    dot = f"{table}." if table else ""
    return F.struct(*[F.col(f"{dot}{prefix}{s}").alias(s) for s in SIDES])


def make(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def width(b: Column) -> Column:
    return b.x2 - b.x1


def height(b: Column) -> Column:
    return b.y2 - b.y1


def area(b: Column) -> Column:
    return F.abs(width(b) * height(b))


def center(b: Column) -> Column:
    return F.struct(((b.x1 + b.x2) / 2).alias("x"), ((b.y1 + b.y2) / 2).alias("y"))


def inter_width(a: Column, b: Column) -> Column:
    return F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1)


def inter_height(a: Column, b: Column) -> Column:
    return F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1)


def inter_area(a: Column, b: Column, pixel: int = 0) -> Column:
    """Area of the intersection; ``pixel=1`` counts inclusive pixels."""
    return F.greatest(F.lit(0), inter_width(a, b) + pixel) * F.greatest(F.lit(0), inter_height(a, b) + pixel)


def overlap(a: Column, b: Column, mode: str = "union") -> Column:
    """Intersection over a reference area, 0 where that is 0.

    union, small, large: the union, the smaller, the larger area; first, second: the area of
    that argument; plus1: the union in inclusive pixels.
    """
    if mode == "plus1":
        own = [(width(x) + 1) * (height(x) + 1) for x in (a, b)]
        inter = inter_area(a, b, 1)
        return inter / (own[0] + own[1] - inter)
    inter = inter_area(a, b)
    reference = {
        "union": lambda: area(a) + area(b) - inter,
        "small": lambda: F.least(area(a), area(b)),
        "large": lambda: F.greatest(area(a), area(b)),
        "first": lambda: area(a),
        "second": lambda: area(b),
    }[mode]()
    return F.when(reference == 0, 0.0).otherwise(inter / reference)


def overlaps_pixels(a: Column, b: Column, least: int = 3) -> Column:
    """More than ``least`` pixels of overlap along both axes."""
    return (inter_width(a, b) > least) & (inter_height(a, b) > least)


def is_neighbour(a: Column, b: Column, above: int = -15, below: int = 3) -> Column:
    """Overlapping along x, and a vertical gap or overlap strictly between the two bounds."""
    return (inter_width(a, b) > 0) & (inter_height(a, b) > above) & (inter_height(a, b) < below)


def projection_overlap(a: Column, b: Column, direction: str = "horizontal", mode: str = "union") -> Column:
    """Overlap of the projections on one axis over their union, smaller or larger length; 0 where they don't meet."""
    low, high = ("x1", "x2") if direction == "horizontal" else ("y1", "y2")
    inter = F.least(a[high], b[high]) - F.greatest(a[low], b[low])
    own = a[high] - a[low], b[high] - b[low]
    reference = {"union": lambda: F.greatest(a[high], b[high]) - F.least(a[low], b[low]), "small": lambda: F.least(*own), "large": lambda: F.greatest(*own)}[mode]()
    return F.when((inter <= 0) | (reference <= 0), 0.0).otherwise(inter / reference)


def from_coordinates(c: Column) -> Column:
    """A box from an array of its sides (4 numbers), or around the corners of a polygon (8 numbers or more: x, y, x, y, …)."""
    even, odd = F.filter(c, lambda v, i: i % 2 == 0), F.filter(c, lambda v, i: i % 2 == 1)
    around = make(F.array_min(even), F.array_min(odd), F.array_max(even), F.array_max(odd))
    return F.when(F.size(c) == 4, make(c[0], c[1], c[2], c[3])).when((F.size(c) >= 6) & (F.size(c) % 2 == 0), around)


def corners(b: Column) -> Column:
    """A box as a polygon of 8 numbers, clockwise from the top left."""
    return F.when(b.isNotNull(), F.array(b.x1, b.y1, b.x2, b.y1, b.x2, b.y2, b.x1, b.y2))


def intersection(a: Column, b: Column) -> Column:
    """The common box, null where there is none."""
    common = make(F.greatest(a.x1, b.x1), F.greatest(a.y1, b.y1), F.least(a.x2, b.x2), F.least(a.y2, b.y2))
    return F.when((common.x1 < common.x2) & (common.y1 < common.y2), common)


def clamp(b: Column, page_width: Column | int, page_height: Column | int) -> Column:
    w, h = (x if isinstance(x, Column) else F.lit(x) for x in (page_width, page_height))
    return make(F.greatest(F.lit(0), b.x1), F.greatest(F.lit(0), b.y1), F.least(w, b.x2), F.least(h, b.y2))


def translate(b: Column, dx: Column | int, dy: Column | int) -> Column:
    """Moves a box between page and region coordinates; the inverse is the negative offset."""
    return make(b.x1 + dx, b.y1 + dy, b.x2 + dx, b.y2 + dy)


def expand(b: Column, width_ratio: Column | float, height_ratio: Column | float) -> Column:
    """Scales a box about its centre."""
    half_w, half_h = width(b) * width_ratio / 2, height(b) * height_ratio / 2
    cx, cy = b.x1 + width(b) / 2, b.y1 + height(b) / 2
    return make(cx - half_w, cy - half_h, cx + half_w, cy + half_h)


def unrotate(b: Column, angle: Column, page_width: Column | int, page_height: Column | int) -> Column:
    """A box found on an image turned by 90, 180 or 270 degrees, on the original; other angles leave it."""
    w, h = (x if isinstance(x, Column) else F.lit(x) for x in (page_width, page_height))
    return (
        F.when(angle == 270, make(b.y1, w - b.x2, b.y2, w - b.x1))
        .when(angle == 180, make(w - b.x2, h - b.y2, w - b.x1, h - b.y1))
        .when(angle == 90, make(h - b.y2, b.x1, h - b.y1, b.x2))
        .otherwise(b)
    )


def corners(b: Column) -> Column:
    """Eight coordinates, clockwise from the top left."""
    return F.array(b.x1, b.y1, b.x2, b.y1, b.x2, b.y2, b.x1, b.y2)


def clamp_points(points: Column, page_width: int, page_height: int) -> Column:
    """x, y, x, y, … cut to the page; nothing is dropped."""
    return F.transform(points, lambda v, i: F.greatest(F.lit(0), F.when(i % 2 == 0, F.least(F.lit(page_width), v)).otherwise(F.least(F.lit(page_height), v))))


def polygon_box(points: Column) -> Column:
    """Enclosing box of an array of (x, y) structs."""
    xs, ys = F.transform(points, lambda p: p.x), F.transform(points, lambda p: p.y)
    return make(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def polygon_area(points: Column) -> Column:
    """Shoelace area of an array of (x, y) structs."""
    turned = F.concat(F.slice(points, 2, F.size(points) - 1), F.slice(points, 1, 1))
    cross = F.zip_with(points, turned, lambda p, q: p.x * q.y - q.x * p.y)
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda acc, v: acc + v)) / 2


def distance(ax: Column, ay: Column, bx: Column, by: Column, kind: str = "euclidean") -> Column:
    """Distance of two points; manhattan of two boxes is that of their top left corners."""
    if kind == "manhattan":
        return F.abs(ax - bx) + F.abs(ay - by)
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def direction(b: Column, ratio: float = 1.0) -> Column:
    return F.when(width(b) * ratio >= height(b), "horizontal").otherwise("vertical")


def along(b: Column, flow: Column) -> Column:
    """Start, end and the two side lengths of a box in reading direction."""
    flat = flow == "horizontal"
    return F.struct(
        F.when(flat, b.x1).otherwise(b.y1).alias("start"),
        F.when(flat, b.x2).otherwise(b.y2).alias("end"),
        F.when(flat, width(b)).otherwise(height(b)).alias("long_side"),
        F.when(flat, height(b)).otherwise(width(b)).alias("short_side"),
    )


def rotate_point(x: Column, y: Column, degrees: Column | float) -> Column:
    """A point turned about the origin."""
    r = F.radians(degrees if isinstance(degrees, Column) else F.lit(degrees))
    return F.struct((x * F.cos(r) - y * F.sin(r)).alias("x"), (x * F.sin(r) + y * F.cos(r)).alias("y"))


# --- sizes and scores ------------------------------------------------------------------------


def target_size(w: Column, h: Column, limit: int, rule: str = "max", cap: int = 4000, multiple: int = 32) -> Column:
    """Width and height that an image is resized to: longest side at most (max), shortest at least (min), or
    longest exactly (resize_long) ``limit``; then under ``cap``; then whole multiples, one at least."""
    longest, shortest = F.greatest(w, h), F.least(w, h)
    ratio = {
        "max": lambda: F.when(longest > limit, limit / longest).otherwise(1.0),
        "min": lambda: F.when(shortest < limit, limit / shortest).otherwise(1.0),
        "resize_long": lambda: limit / longest,
    }[rule]()
    rw, rh = F.floor(w * ratio), F.floor(h * ratio)
    shrink = F.when(F.greatest(rw, rh) > cap, cap / F.greatest(rw, rh)).otherwise(1.0)
    sides = [F.greatest(F.floor(F.floor(x * shrink) / multiple + 0.5) * multiple, F.lit(multiple)).cast("long") for x in (rw, rh)]
    return F.struct(sides[0].alias("width"), sides[1].alias("height"))


def recognition_width(w: Column, h: Column, line_height: int = 48, cap: int = 3200) -> Column:
    """Width of a text line scaled to ``line_height``, rounded up, capped."""
    return F.least(F.ceil(line_height * (w / h)), F.lit(cap)).cast("long")


def normalise_score(score: Column, low: float, high: float, lower_is_better: bool = False) -> Column:
    """Score mapped to 0 .. 1, better is higher; a score out of range raises."""
    unit = (score - low) / (high - low)
    unit = 1 - unit if lower_is_better else unit
    return F.when((unit < 0) | (unit > 1), F.raise_error(F.lit("score out of range"))).otherwise(unit).cast("double")


def parse_range(text: Column) -> Column:
    """A range like "~0, ~1" as (low, high, low_approximate, high_approximate)."""
    ends = F.split(text, ",")
    parts = [F.trim(F.try_element_at(ends, F.lit(k))) for k in (1, 2)]
    numbers = [F.regexp_replace(p, "~", "").try_cast("double") for p in parts]
    return F.struct(numbers[0].alias("low"), numbers[1].alias("high"), parts[0].startswith("~").alias("low_approximate"), parts[1].startswith("~").alias("high_approximate"))

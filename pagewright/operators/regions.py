"""Regions: growing, fitting and parting of boxes on one page."""

from __future__ import annotations

from collections.abc import Sequence

from pagewright.operators.reading import overlap

Box = tuple[float, float, float, float]

# fixed values: shares of a block's or region's smaller area
HELD, PARTED = 0.6, 0.4


def enclosing(boxes: Sequence[Sequence[float]]) -> Box:
    sides = list(zip(*boxes, strict=True))
    return min(sides[0]), min(sides[1]), max(sides[2]), max(sides[3])


def grown(region: Sequence[float] | None, box: Sequence[float]) -> tuple:
    """A running region with one more box, cut to whole pixels; the first box is taken as it is."""
    return tuple(box) if region is None else tuple(int(v) for v in enclosing([region, box]))


def _slack(outer: Sequence[float], inner: Sequence[float], width: float, height: float) -> list[float]:
    """How far the sides of a box stand outside another's, as shares of the page: left, top, right, bottom."""
    return [(inner[0] - outer[0]) / width, (inner[1] - outer[1]) / height, (outer[2] - inner[2]) / width, (outer[3] - inner[3]) / height]


def fitted(region: Sequence[float], other: Sequence[float], width: float, height: float, blocks: dict[int, Sequence[float]]) -> tuple[Box, list[int]]:
    """A region drawn back from another one beside it, and the blocks it keeps.

    The side that stands out least is tried first, three sides at most: the opposite side is
    moved to the other region's near side.  The first move that leaves a block in the region
    decides; blocks that it parts draw the region back further.  The region then is what
    encloses the kept blocks.
    """
    region = list(region)
    if not blocks:
        return tuple(region), []
    first = _slack(region, other, width, height)
    kept: list[int] = []
    for value in sorted(first)[:3]:
        near = (first.index(value) + 2) % 4
        tried = list(region)
        tried[(near + 2) % 4] = other[near]
        share = {k: overlap(tried, b, small=True) for k, b in blocks.items()}
        kept = [k for k, s in share.items() if s > HELD]
        if not kept:
            continue
        for k, s in share.items():
            if PARTED < s <= HELD:
                slack = _slack(tried, blocks[k], width, height)
                side = slack.index(max(slack))
                tried[(side + 2) % 4] = blocks[k][side]
                tried = list(fitted(tried, other, width, height, {i: blocks[i] for i in kept})[0])
        return enclosing([blocks[k] for k in kept]), kept
    return tuple(region), kept


def parted_by(spans: list[tuple[list[float], str, str]], axis: int = 0, offset: float = 1e-5) -> list[tuple[list[float], str, str]]:
    """Spans (box, text, label) of a line, in order, parted where a later one lies within their extent along the axis.

    What stands out on the left by more than a pixel becomes a span of its own, what stands
    out on the right goes on; both keep text and label.
    """
    out = []
    for k, (box, text, label) in enumerate(spans):
        rest, parted = list(box), False
        for inner, _, _ in spans[k:]:
            low, high = inner[axis], inner[axis + 2]
            if inner is box or not (rest[axis] <= low and high <= rest[axis + 2]):
                continue
            parted = True
            if low - offset - rest[axis] > 1:
                left = list(rest)
                left[axis + 2] = low - offset
                out.append((left, text, label))
            if rest[axis + 2] - high + offset > 1:
                rest[axis] = high + offset
        out.append((rest, text, label))
    return out

"""Resampling kernels in numpy: perspective crops, affine maps, rotation by any angle, rectangles around points, masks."""

from __future__ import annotations

import numpy as np


def _cubic(t: np.ndarray, a: float = -0.75) -> np.ndarray:
    """Weights of the four neighbours at a fraction t, by the cubic convolution kernel."""
    near = lambda x: ((a + 2) * x - (a + 3)) * x * x + 1
    far = lambda x: ((a * x - 5 * a) * x + 8 * a) * x - 4 * a
    return np.stack([far(t + 1), near(t), near(1 - t), far(2 - t)], axis=-1)


def sample(image: np.ndarray, x: np.ndarray, y: np.ndarray, outside: float | None = None, cubic: bool = True) -> np.ndarray:
    """Values of an image (h, w, c) at real places; beyond the edge the edge goes on, or ``outside`` is the value."""
    h, w = image.shape[:2]
    fx, fy = np.floor(x).astype(int), np.floor(y).astype(int)
    if cubic:
        wx, wy, steps = _cubic(x - fx), _cubic(y - fy), (-1, 0, 1, 2)
    else:
        wx, wy, steps = np.stack([1 - x + fx, x - fx], -1), np.stack([1 - y + fy, y - fy], -1), (0, 1)
    out = np.zeros((*x.shape, image.shape[2]))
    for j, dy in enumerate(steps):
        for i, dx in enumerate(steps):
            u, v = fx + dx, fy + dy
            value = image[np.clip(v, 0, h - 1), np.clip(u, 0, w - 1)].astype(float)
            if outside is not None:
                value[(u < 0) | (u >= w) | (v < 0) | (v >= h)] = outside
            out += value * (wx[..., i] * wy[..., j])[..., None]
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def homography(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The 3 x 3 map that takes four points to four others."""
    rows, right = [], []
    for (x, y), (u, v) in zip(source, target, strict=True):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
        right += [u, v]
    return np.append(np.linalg.solve(np.array(rows, float), np.array(right, float)), 1.0).reshape(3, 3)


def perspective_crop(image: np.ndarray, quad: np.ndarray) -> np.ndarray:
    """The upright rectangle of a quadrilateral (from top left, clockwise), a quarter turn left if it is 1.5 times as high as wide or more."""
    quad = np.asarray(quad, float)
    side = lambda a, b: float(np.hypot(*(quad[a] - quad[b])))
    w, h = int(max(side(0, 1), side(2, 3))), int(max(side(0, 3), side(1, 2)))
    if w < 1 or h < 1:
        return np.zeros((0, 0, image.shape[2]), np.uint8)
    back = homography(np.array([(0, 0), (w, 0), (w, h), (0, h)]), quad)
    x, y = np.meshgrid(np.arange(w), np.arange(h))
    u, v, s = np.tensordot(back, np.stack([x, y, np.ones_like(x)]), 1)
    out = sample(image, u / s, v / s)
    return np.rot90(out) if h / w >= 1.5 else out


def affine(centre: tuple[float, float], scale: float, degrees: float, size: tuple[int, int]) -> np.ndarray:
    """The 2 x 3 map that scales and turns about a centre and puts it into the middle of (width, height)."""
    a = np.deg2rad(degrees)
    turn = scale * np.array([[np.cos(a), -np.sin(a)], [np.sin(a), np.cos(a)]])
    return np.hstack([turn, (np.array(size) / 2 - turn @ np.array(centre, float))[:, None]])


def warp_affine(image: np.ndarray, matrix: np.ndarray, size: tuple[int, int], outside: float = 0) -> np.ndarray:
    back = np.linalg.inv(np.vstack([matrix, [0, 0, 1]]))
    x, y = np.meshgrid(np.arange(size[0]), np.arange(size[1]))
    u, v, _ = np.tensordot(back, np.stack([x, y, np.ones_like(x)]), 1)
    return sample(image, u, v, outside, cubic=False)


def rotate_any(image: np.ndarray, degrees: float, outside: float = 0) -> np.ndarray:
    """An image turned counter-clockwise about its centre, on a canvas that holds all of it."""
    h, w = image.shape[:2]
    if degrees % 90 == 0:
        return np.rot90(image, int(degrees // 90) % 4)
    a = np.deg2rad(degrees)
    size = (int(h * abs(np.sin(a)) + w * abs(np.cos(a))), int(h * abs(np.cos(a)) + w * abs(np.sin(a))))
    return warp_affine(image, affine((w / 2, h / 2), 1.0, -degrees, size), size, outside)


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull, counter-clockwise in a right-handed system, from the least (x, y)."""
    p = np.unique(np.asarray(points, float).reshape(-1, 2), axis=0)
    if len(p) < 3:
        return p

    def chain(rows: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for q in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out[:-1]

    return np.array(chain(p) + chain(p[::-1]))


def least_rectangle(points: np.ndarray) -> tuple[np.ndarray, float]:
    """The rectangle of least area around points (top left first, clockwise on the page), and its shorter side.

    One of its sides lies on a side of the hull, so only those directions are tried.
    """
    corners = hull(points)
    best: tuple[float, np.ndarray, float] | None = None
    edges = np.roll(corners, -1, axis=0) - corners if len(corners) > 1 else np.array([[1.0, 0.0]])
    for e in edges:
        axis = e / (np.hypot(*e) or 1.0)
        frame = np.array([axis, [-axis[1], axis[0]]])
        turned = corners @ frame.T
        low, high = turned.min(0), turned.max(0)
        size = high - low
        if best is None or size[0] * size[1] < best[0] - 1e-9:
            box = np.array([low, [high[0], low[1]], high, [low[0], high[1]]]) @ frame
            best = (float(size[0] * size[1]), box, float(size.min()))
    _, box, short = best
    by_x = box[np.argsort(box[:, 0], kind="stable")]
    left, right = by_x[:2][np.argsort(by_x[:2, 1], kind="stable")], by_x[2:][np.argsort(by_x[2:, 1], kind="stable")]
    return np.array([left[0], right[0], right[1], left[1]]), short


def polygon_mask(polygon: np.ndarray, height: int, width: int) -> np.ndarray:
    """Pixels whose centre lies in a polygon or on its edge."""
    polygon = np.asarray(polygon, float)
    x, y = np.meshgrid(np.arange(width, dtype=float), np.arange(height, dtype=float))
    inside, edge = np.zeros((height, width), bool), np.zeros((height, width), bool)
    for (x1, y1), (x2, y2) in zip(polygon, np.roll(polygon, -1, axis=0), strict=True):
        cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
        edge |= (np.abs(cross) < 1e-9) & (np.minimum(x1, x2) <= x) & (x <= np.maximum(x1, x2)) & (np.minimum(y1, y2) <= y) & (y <= np.maximum(y1, y2))
        if y1 != y2:
            inside ^= ((y1 <= y) != (y2 <= y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
    return inside | edge


def mean_inside(scores: np.ndarray, polygon: np.ndarray) -> float:
    """Mean of a score map in a polygon; 0 if no pixel lies in it."""
    mask = polygon_mask(np.floor(polygon), *scores.shape[:2])
    return float(scores[mask].mean()) if mask.any() else 0.0


def unclip_distance(polygon: np.ndarray, ratio: float) -> float:
    """How far a found text polygon is pushed out: area times the ratio over the length of its outline."""
    nxt = np.roll(np.asarray(polygon, float), -1, axis=0)
    area = abs((polygon[:, 0] * nxt[:, 1] - polygon[:, 1] * nxt[:, 0]).sum()) / 2
    return float(area * ratio / np.hypot(*(nxt - polygon).T).sum())


def push_out(rectangle: np.ndarray, distance: float) -> np.ndarray:
    """A rectangle's corners moved outwards so that each side is ``distance`` further out."""
    box = np.asarray(rectangle, float)
    across, down = box[1] - box[0], box[3] - box[0]
    a, d = (v / (np.hypot(*v) or 1.0) * distance for v in (across, down))
    return box + np.array([-a - d, a - d, a + d, -a + d])


def to_picture(prediction: np.ndarray, scale: float = 255.0) -> np.ndarray:
    """A model's (1, 3, h, w) output in 0 .. 1 as an image (h, w, 3) of bytes, channels reversed."""
    out = np.moveaxis(np.squeeze(prediction), 0, -1) * scale
    return np.clip(out[..., ::-1], 0, 255).astype(np.uint8)

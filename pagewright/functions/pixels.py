"""Pixel kernels over binary image columns, in numpy, as Arrow functions.

An image is (data binary, height int, width int, channels int), rows first, bytes.  What
needs an imaging library (perspective warps, drawing, curved text) is left to plug-ins:
register a predictor in ``operators.models`` that maps the same columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

SCHEMA = "data binary, height int, width int, channels int"


def _image(row) -> np.ndarray:
    return np.frombuffer(row.data, np.uint8).reshape(row.height, row.width, row.channels)


def apply(images: DataFrame, kernel: Callable[[np.ndarray], np.ndarray], keys: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Maps each image by a kernel (array to array), keeping the key columns."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in images.schema.fields if f.name in keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [np.ascontiguousarray(kernel(_image(r)).astype(np.uint8)) for r in batch.itertuples()]
            shapes = [(*o.shape, 1)[:3] for o in out]
            made = pd.DataFrame({"data": [o.tobytes() for o in out], "height": [s[0] for s in shapes], "width": [s[1] for s in shapes], "channels": [s[2] for s in shapes]})
            yield pd.concat([batch[list(keys)].reset_index(drop=True), made], axis=1)

    return images.select(*keys, "data", "height", "width", "channels").mapInPandas(run, f"{fields}, {SCHEMA}")


def flip(a: np.ndarray, horizontal: bool = True) -> np.ndarray:
    return a[:, ::-1] if horizontal else a[::-1]


def rotate(a: np.ndarray, degrees: int) -> np.ndarray:
    """Quarter turns, clockwise."""
    if degrees % 90:
        raise ValueError("only quarter turns need no resampling")
    return np.rot90(a, -(degrees // 90) % 4)


def crop(a: np.ndarray, x1: int, y1: int, x2: int, y2: int) -> np.ndarray:
    return a[max(0, y1) : max(0, y2), max(0, x1) : max(0, x2)]


def center_crop(a: np.ndarray, height: int, width: int) -> np.ndarray:
    top, left = max(0, (a.shape[0] - height) // 2), max(0, (a.shape[1] - width) // 2)
    return a[top : top + height, left : left + width]


def pad(a: np.ndarray, height: int, width: int, value: int = 0) -> np.ndarray:
    """Pads at the bottom and right up to a size."""
    rest = [(0, max(0, height - a.shape[0])), (0, max(0, width - a.shape[1]))] + [(0, 0)] * (a.ndim - 2)
    return np.pad(a, rest, constant_values=value)


def pad_to_multiple(a: np.ndarray, multiple: int, value: int = 0) -> np.ndarray:
    return pad(a, -(-a.shape[0] // multiple) * multiple, -(-a.shape[1] // multiple) * multiple, value)


def resize(a: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear resize with pixel centres aligned."""
    y = np.clip((np.arange(height) + 0.5) * a.shape[0] / height - 0.5, 0, a.shape[0] - 1)
    x = np.clip((np.arange(width) + 0.5) * a.shape[1] / width - 0.5, 0, a.shape[1] - 1)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, a.shape[0] - 1), np.minimum(x0 + 1, a.shape[1] - 1)
    fy, fx = (y - y0)[:, None, None], (x - x0)[None, :, None]
    b = a.astype(float).reshape(a.shape[0], a.shape[1], -1)
    out = (b[y0][:, x0] * (1 - fx) + b[y0][:, x1] * fx) * (1 - fy) + (b[y1][:, x0] * (1 - fx) + b[y1][:, x1] * fx) * fy
    return np.round(out).astype(np.uint8).reshape((height, width, *a.shape[2:]))


def gray(a: np.ndarray) -> np.ndarray:
    """Luma of a BGR image."""
    return np.round(a[..., :3] @ np.array([0.114, 0.587, 0.299])).astype(np.uint8)


def normalise(a: np.ndarray, mean: tuple[float, ...] = (0.5, 0.5, 0.5), std: tuple[float, ...] = (0.5, 0.5, 0.5)) -> np.ndarray:
    """(channels, height, width) floats about zero, as models take them."""
    return ((a / 255.0 - np.asarray(mean)) / np.asarray(std)).transpose(2, 0, 1).astype(np.float32)


def crop_margin(a: np.ndarray, threshold: int = 200) -> np.ndarray:
    """Without the light margin around the content."""
    dark = (gray(a) if a.ndim == 3 and a.shape[2] >= 3 else a.reshape(a.shape[:2])) < threshold
    rows, cols = np.flatnonzero(dark.any(1)), np.flatnonzero(dark.any(0))
    return a[rows[0] : rows[-1] + 1, cols[0] : cols[-1] + 1] if len(rows) else a


def mask(a: np.ndarray, boxes: list[tuple[int, int, int, int]], value: int = 255) -> np.ndarray:
    """A copy with boxes painted over."""
    out = a.copy()
    for x1, y1, x2, y2 in boxes:
        out[y1:y2, x1:x2] = value
    return out


def components(bitmap: np.ndarray, least_side: int = 3) -> list[tuple[int, int, int, int]]:
    """Boxes around the 4-connected regions of a bitmap, of a least side, from the top."""
    label = np.zeros(bitmap.shape, int)
    found, n = [], 0
    for y, x in zip(*np.nonzero(bitmap), strict=True):
        if label[y, x]:
            continue
        n += 1
        stack, y1, y2, x1, x2 = [(y, x)], y, y, x, x
        label[y, x] = n
        while stack:
            cy, cx = stack.pop()
            y1, y2, x1, x2 = min(y1, cy), max(y2, cy), min(x1, cx), max(x2, cx)
            for ny, nx in ((cy - 1, cx), (cy + 1, cx), (cy, cx - 1), (cy, cx + 1)):
                if 0 <= ny < bitmap.shape[0] and 0 <= nx < bitmap.shape[1] and bitmap[ny, nx] and not label[ny, nx]:
                    label[ny, nx] = n
                    stack.append((ny, nx))
        if min(x2 - x1, y2 - y1) + 1 >= least_side:
            found.append((int(x1), int(y1), int(x2) + 1, int(y2) + 1))
    return found

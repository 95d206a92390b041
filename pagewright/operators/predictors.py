"""Predictors of the model families: images in, rows out.

Each is preprocessing, a session (a function from a float array to the model's outputs) and
postprocessing, all in numpy.  Sessions are made once per worker, by ``OnnxSession`` or any
factory; tests give plain functions.  Images are rows of (data, height, width, channels).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from pagewright.functions import pixels, warps

Session = Callable[[np.ndarray], Sequence[np.ndarray]]


class OnnxSession:
    """A factory of sessions from a model file; inputs are fed in order of their names."""

    def __init__(self, path: str, threads: int = 1, providers: tuple[str, ...] = ("CPUExecutionProvider",)):
        self.path, self.threads, self.providers = path, threads, providers

    def __call__(self) -> Session:
        import onnxruntime

        options = onnxruntime.SessionOptions()
        options.intra_op_num_threads = self.threads
        session = onnxruntime.InferenceSession(self.path, options, providers=list(self.providers))
        names = sorted(i.name for i in session.get_inputs())
        return lambda *arrays: session.run(None, dict(zip(names, arrays, strict=True)))


class ImagePredictor:
    """Keys and results of each image; an image that fails gets its message in ``error`` and no results.

    ``schema`` are the result columns in DDL; ``results`` gives them for one image.
    """

    schema = ""

    def __init__(self, make: Callable[[], Session]):
        self.make, self._session = make, None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_session": None}

    def infer(self, *arrays: np.ndarray) -> Sequence[np.ndarray]:
        if self._session is None:
            self._session = self.make()
        return self._session(*arrays)

    def results(self, image: np.ndarray) -> list[dict[str, Any]]:
        raise NotImplementedError

    def run(self, images: DataFrame, *keys: str) -> DataFrame:
        kinds = {f.name: f.dataType.simpleString() for f in images.schema.fields}
        ddl = ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], self.schema, "error string"])
        names = [p.strip().split(" ")[0] for p in _fields(self.schema)]

        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = []
                for row in batch.itertuples(index=False):
                    own = {k: getattr(row, k) for k in keys}
                    try:
                        image = np.frombuffer(row.data, np.uint8).reshape(row.height, row.width, row.channels)
                        rows += [own | r | {"error": None} for r in self.results(image)]
                    except Exception as e:  # one bad image doesn't end the job
                        rows.append(own | dict.fromkeys(names) | {"error": f"{type(e).__name__}: {e}"})
                yield pd.DataFrame(rows, columns=[*keys, *names, "error"])

        return images.select(*keys, "data", "height", "width", "channels").mapInPandas(work, ddl)


def _fields(ddl: str) -> list[str]:
    """Top-level fields of a DDL string."""
    out, depth, start = [], 0, 0
    for k, c in enumerate(ddl):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(ddl[start:k])
            start = k + 1
    return [*out, ddl[start:]]


class TextDetector(ImagePredictor):
    """Text boxes from a probability map: threshold, regions, least rectangles, mean score, unclipping.

    An image is shrunk so that its longer side is ``limit`` at most, then to multiples of 32.
    """

    schema = "poly array<array<double>>, score double"

    def __init__(self, make: Callable[[], Session], limit: int = 960, threshold: float = 0.3, least_score: float = 0.6, unclip: float = 2.0, candidates: int = 1000, least_side: int = 3):
        super().__init__(make)
        self.limit, self.threshold, self.least_score, self.unclip, self.candidates, self.least_side = limit, threshold, least_score, unclip, candidates, least_side

    def size(self, height: int, width: int) -> tuple[int, int]:
        ratio = min(1.0, self.limit / max(height, width))
        return max(32, round(height * ratio / 32) * 32), max(32, round(width * ratio / 32) * 32)

    def results(self, image: np.ndarray) -> list[dict[str, Any]]:
        h, w = image.shape[:2]
        tall, wide = self.size(h, w)
        scores = np.squeeze(self.infer(pixels.normalise(pixels.resize(image, tall, wide), (0.485, 0.456, 0.406), (0.229, 0.224, 0.225))[None])[0])
        found = []
        for x1, y1, x2, y2 in pixels.components(scores > self.threshold, self.least_side)[: self.candidates]:
            region = np.argwhere(scores[y1:y2, x1:x2] > self.threshold)[:, ::-1] + [x1, y1]
            box, _ = warps.least_rectangle(region)
            mean = warps.mean_inside(scores, box)
            if mean < self.least_score:
                continue
            distance = warps.unclip_distance(box, self.unclip) if np.ptp(box, axis=0).min() > 0 else 0.0
            wider = warps.push_out(box, distance)
            if min(np.hypot(*(wider[1] - wider[0])), np.hypot(*(wider[3] - wider[0]))) < self.least_side + 2:
                continue
            poly = np.clip(np.rint(wider * [w / wide, h / tall]), 0, [w, h])
            found.append({"poly": poly.tolist(), "score": mean})
        return found


class TextRecogniser(ImagePredictor):
    """Text of a line image: fixed height, width by its shape, greedy decoding; the score is the mean over kept steps, 0 if none."""

    schema = "text string, score double"

    def __init__(self, make: Callable[[], Session], characters: Sequence[str], height: int = 48, width: int = 320, widest: int = 3200, right_to_left: bool = False):
        super().__init__(make)
        self.characters = ["", *characters]  # the blank comes first
        self.height, self.width, self.widest, self.right_to_left = height, width, widest, right_to_left

    def results(self, image: np.ndarray) -> list[dict[str, Any]]:
        ratio = image.shape[1] / image.shape[0]
        wide = min(self.widest, int(np.ceil(self.height * ratio)))
        canvas = min(self.widest, max(self.width, wide))
        line = pixels.normalise(pixels.resize(image, self.height, wide))
        padded = np.zeros((line.shape[0], self.height, canvas), np.float32)
        padded[:, :, :wide] = line
        steps = np.squeeze(self.infer(padded[None])[0], 0)
        best, sure = steps.argmax(1), steps.max(1)
        kept = (best != 0) & np.append(True, best[1:] != best[:-1])
        letters = [self.characters[k] for k in best[kept]]
        return [{"text": "".join(letters[::-1] if self.right_to_left else letters), "score": float(sure[kept].mean()) if kept.any() else 0.0}]


class Classifier(ImagePredictor):
    """The k best classes of an image: of a whole image's orientation, a text line's, a table's kind."""

    schema = "class_ids array<int>, scores array<double>, label_names array<string>"

    def __init__(self, make: Callable[[], Session], labels: Sequence[str], k: int = 1, height: int = 224, width: int = 224):
        super().__init__(make)
        self.labels, self.k, self.height, self.width = list(labels), k, height, width

    def results(self, image: np.ndarray) -> list[dict[str, Any]]:
        scores = np.ravel(self.infer(pixels.normalise(pixels.resize(image, self.height, self.width), (0.485, 0.456, 0.406), (0.229, 0.224, 0.225))[None])[0])
        best = np.lexsort((np.arange(len(scores)), -scores))[: self.k]
        return [{"class_ids": best.tolist(), "scores": np.round(scores[best].astype(float), 5).tolist(), "label_names": [self.labels[k] for k in best]}]


class TableStructure(ImagePredictor):
    """Structure tokens up to the end mark, a box for each cell, and the mean token score."""

    schema = "structure array<string>, boxes array<array<double>>, score double"

    def __init__(self, make: Callable[[], Session], tokens: Sequence[str], size: int = 488, whole_image: bool = False):
        super().__init__(make)
        self.tokens, self.size, self.whole_image = ["sos", *tokens, "eos"], size, whole_image

    def scales(self, height: int, width: int) -> tuple[float, float]:
        if self.whole_image:
            return float(width), float(height)
        ratio = min(self.size / width, self.size / height)
        return self.size / ratio, self.size / ratio

    def results(self, image: np.ndarray) -> list[dict[str, Any]]:
        h, w = image.shape[:2]
        ratio = self.size / max(h, w)
        small = pixels.resize(image, max(1, int(h * ratio)), max(1, int(w * ratio)))
        places, chances = self.infer(pixels.normalise(pixels.pad(small, self.size, self.size), (0.485, 0.456, 0.406), (0.229, 0.224, 0.225))[None])[:2]
        chances, places = np.squeeze(chances, 0), np.squeeze(places, 0)
        best, sure = chances.argmax(1), chances.max(1)
        end = len(self.tokens) - 1
        stops = np.flatnonzero((best == end) & (np.arange(len(best)) > 0))
        upto = int(stops[0]) if len(stops) else len(best)
        keep = [t for t in range(upto) if 0 < best[t] < end]
        x, y = self.scales(h, w)
        names = [self.tokens[best[t]] for t in keep]
        cells = [t for t, name in zip(keep, names, strict=True) if name in ("<td>", "<td", "<td></td>")]
        boxes = [(places[t] * np.resize([x, y], places.shape[1])).tolist() for t in cells]
        return [{"structure": ["<html>", "<body>", "<table>", *names, "</table>", "</body>", "</html>"], "boxes": boxes, "score": float(sure[keep].mean()) if keep else 0.0}]


class FormulaRecogniser(ImagePredictor):
    """LaTeX of a formula image, margin cut off: byte-level tokens up to the end mark."""

    schema = "latex string"

    def __init__(self, make: Callable[[], Session], tokens: Sequence[str], end: int, special: Sequence[int] = (), height: int = 192, width: int = 672):
        super().__init__(make)
        self.tokens, self.end, self.special, self.height, self.width = list(tokens), end, frozenset(special), height, width

    def results(self, image: np.ndarray) -> list[dict[str, Any]]:
        from pagewright.plans.chains import byte_letters

        cut = pixels.crop_margin(image)
        ratio = min(self.height / cut.shape[0], self.width / cut.shape[1])
        small = pixels.resize(cut, max(1, int(cut.shape[0] * ratio)), max(1, int(cut.shape[1] * ratio)))
        one = pixels.gray(pixels.pad(small, self.height, self.width, 255))[None].astype(np.float32) / 255
        ids = np.ravel(self.infer(one[None])[0]).astype(int).tolist()
        ids = ids[: ids.index(self.end)] if self.end in ids else ids
        letters = byte_letters()
        raw = bytes(letters[c] for k in ids if k not in self.special for c in self.tokens[k] if c in letters)
        return [{"latex": raw.decode("utf-8", errors="replace")}]


class Unwarper(ImagePredictor):
    """A flattened page image."""

    schema = "flat binary, flat_height int, flat_width int"

    def results(self, image: np.ndarray) -> list[dict[str, Any]]:
        flat = warps.to_picture(self.infer((image[..., ::-1].transpose(2, 0, 1) / 255.0).astype(np.float32)[None])[0])
        return [{"flat": np.ascontiguousarray(flat).tobytes(), "flat_height": flat.shape[0], "flat_width": flat.shape[1]}]

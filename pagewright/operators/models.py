"""The model surface: a predictor is an object with ``schema``-shaped output, run in Arrow batches.

Weights and imaging libraries are external.  A predictor is registered by name and made on
first use in each Python worker; the stub ones are deterministic and need nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Predictor(Protocol):
    """Maps a batch of input rows to output rows; state is built once per worker in ``setup``."""

    def setup(self) -> None: ...

    def __call__(self, batch: pd.DataFrame) -> pd.DataFrame: ...


#: Families of models, and the constructors registered for each.
FAMILIES = ("text_detection", "text_recognition", "classification", "detection", "formula", "table", "unwarping")
_registry: dict[str, Callable[..., Predictor]] = {}


def register(name: str) -> Callable[[Callable[..., Predictor]], Callable[..., Predictor]]:
    """Adds a predictor class under a name; a name can be taken only once."""

    def add(make: Callable[..., Predictor]) -> Callable[..., Predictor]:
        if name in _registry:
            raise ValueError(f"a model named {name} is registered already")
        _registry[name] = make
        return make

    return add


def create(name: str, **options: Any) -> Predictor:
    if name not in _registry:
        raise ValueError(f"no model named {name}; known: {', '.join(sorted(_registry))}")
    return _registry[name](**options)


def predict(rows: DataFrame, predictor: Predictor, schema: str) -> DataFrame:
    """Runs a predictor over all rows, batch by batch, without a shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predictor.setup()
        for batch in batches:
            yield predictor(batch)

    return rows.mapInPandas(run, schema)


@register("stub_detector")
class StubDetector:
    """Labels boxes by their shape, with a score from their size: a stand-in with the right interface."""

    LABELS = ("text", "paragraph_title", "image", "table")

    def setup(self) -> None:
        pass

    def __call__(self, batch: pd.DataFrame) -> pd.DataFrame:
        w, h = batch["x2"] - batch["x1"], batch["y2"] - batch["y1"]
        kind = ((w * 7 + h * 3) % len(self.LABELS)).astype(int)
        return pd.DataFrame({"page_id": batch["page_id"], "box_id": batch["box_id"], "label": kind.map(dict(enumerate(self.LABELS))), "score": ((w * h) % 101) / 100.0})


@register("stub_recogniser")
class StubRecogniser:
    """Text "w x h" for each box."""

    def setup(self) -> None:
        pass

    def __call__(self, batch: pd.DataFrame) -> pd.DataFrame:
        w, h = (batch["x2"] - batch["x1"]).astype(str), (batch["y2"] - batch["y1"]).astype(str)
        return pd.DataFrame({"page_id": batch["page_id"], "box_id": batch["box_id"], "text": w + "x" + h, "score": 1.0})


@register("onnx")
class OnnxPredictor:
    """An ONNX model over one tensor column; the session is made once per worker."""

    def __init__(self, path: str, column: str, output: str, providers: tuple[str, ...] = ("CPUExecutionProvider",), threads: int = 1):
        self.path, self.column, self.output, self.providers, self.threads = path, column, output, providers, threads
        self._session = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_session": None}

    def setup(self) -> None:
        if self._session is None:
            import onnxruntime

            options = onnxruntime.SessionOptions()
            options.intra_op_num_threads = self.threads
            self._session = onnxruntime.InferenceSession(self.path, options, providers=list(self.providers))

    def __call__(self, batch: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        name = self._session.get_inputs()[0].name
        out = self._session.run(None, {name: np.stack([np.asarray(v, np.float32) for v in batch[self.column]])})[0]
        return batch.drop(columns=[self.column]).assign(**{self.output: [row.ravel().tolist() for row in out]})


def route(quality: Column, size: Column, least_quality: float, least_size: int) -> Column:
    """Which plan a document takes: reject under the quality threshold, lite for small ones, else full."""
    return F.when(quality < least_quality, "reject").when(size < least_size, "lite").otherwise("full")


def sorted_for_batches(crops: DataFrame) -> DataFrame:
    """Crops of like aspect ratio side by side in each partition, so that batches need little padding; keys tell them apart after."""
    return crops.sortWithinPartitions((F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")))

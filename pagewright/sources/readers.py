"""Sources: images and documents as files, text, Markdown, CSV and YAML, through Spark's own readers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

IMAGE_SUFFIXES = ("jpg", "png", "jpeg", "bmp")
PAGE_SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("input_path", T.StringType()), T.StructField("page_index", T.IntegerType())])


def files(spark: SparkSession, path: str, suffixes: tuple[str, ...] = IMAGE_SUFFIXES, content: bool = True) -> DataFrame:
    """Files under a folder whose lower-cased suffix is known, in order of their path: path, length, content.  An empty selection is an error."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    rows = rows.where(F.lower(F.element_at(F.split("path", r"\."), -1)).isin(*suffixes))
    rows = rows.select("path", "length", "content") if content else rows.select("path", "length")
    if rows.select("path").isEmpty():
        raise FileNotFoundError(f"no {'/'.join(suffixes)} file under {path}")
    return rows.orderBy("path")


def batched(rows: DataFrame, size: int) -> DataFrame:
    """Files with a batch_id: consecutive groups of ``size`` in path order within each folder."""
    from pagewright.operators.sequence import batches

    return batches(rows.withColumn("source", F.regexp_replace("path", r"/[^/]*$", "")), size)


def images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images (Spark's image source: height, width, channels, BGR data), undecodable ones left out."""
    return spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(path).select("image.*")


#: What reads files of a suffix.
BY_SUFFIX = dict.fromkeys(IMAGE_SUFFIXES, "images") | {"txt": "whole_text", "md": "whole_text", "csv": "csv"}


def read(spark: SparkSession, path: str) -> DataFrame:
    """A file or folder by the reader of its suffix (folders are read as images)."""
    suffix = path.rsplit("/", 1)[-1].rpartition(".")[2].lower() if "." in path.rsplit("/", 1)[-1] else "jpg"
    if suffix not in BY_SUFFIX:
        raise ValueError(f"no reader for {suffix} files; known: {', '.join(sorted(BY_SUFFIX))}")
    return globals()[BY_SUFFIX[suffix]](spark, path)


def channels(data: str, order: str) -> Column:
    """Bytes of BGR image data in another order: BGR, RGB or GRAY (0.114 B + 0.587 G + 0.299 R, rounded)."""
    if order == "BGR":
        return F.col(data)

    @F.arrow_udf("binary")
    def turned(pixels: pa.Array) -> pa.Array:
        out = []
        for raw in pixels.to_pylist():
            a = None if raw is None else np.frombuffer(raw, np.uint8).reshape(-1, 3)
            out.append(None if a is None else (a[:, ::-1] if order == "RGB" else np.rint(a @ np.array([0.114, 0.587, 0.299])).astype(np.uint8)).tobytes())
        return pa.array(out, pa.binary())

    if order not in ("RGB", "GRAY"):
        raise ValueError(f"unknown order of channels: {order}")
    return turned(data)


def with_scale(images: DataFrame, height: int, width: int) -> DataFrame:
    """Images with what a detector needs to know of them: img_size, ori_img_size and scale_factors (x, y) for a target size."""
    size = F.array(F.col("width"), F.col("height"))
    return images.withColumns({"ori_img_size": size, "img_size": F.array(F.lit(width), F.lit(height)), "scale_factors": F.array(F.lit(width) / F.col("width"), F.lit(height) / F.col("height"))})


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    """Text or Markdown files, one row each: value."""
    return spark.read.text(path, wholetext=True)


def csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=True)


def yaml_options(path: str) -> dict:
    """A YAML file as plain values; objects are not constructed."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def page_results(spark: SparkSession, path: str) -> DataFrame:
    """Page results written by ``writers.json_results``, one row a page."""
    block = "array<struct<block_label:string,block_content:string,block_bbox:array<double>>>"
    schema = f"input_path string, page_index int, parsing_res_list {block}"
    return spark.read.text(path).select(F.from_json("value", schema).alias("r")).select("r.*")

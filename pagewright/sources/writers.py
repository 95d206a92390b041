"""Sinks: JSON, Markdown, HTML, CSV and images, each a distributed write with a row a document."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import markup
from pagewright.sources import pictures


class Writer(Protocol):
    def __call__(self, df: DataFrame, path: str) -> None: ...


_writers: dict[str, Writer] = {}

#: Documents in one written file, at most.
ROWS_PER_FILE = 10_000


def writer(name: str) -> Callable[[Writer], Writer]:
    def add(f: Writer) -> Writer:
        _writers[name] = f
        return f

    return add


def _documents(df: DataFrame, name: Column, content: str, path: str) -> None:
    """Rows (path, content), a document each, in files of a bounded number of rows: no folder or file a document."""
    rows = df.select(name.alias("path"), F.col(content).alias("content"))
    rows.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)


@writer("json")
def json_results(df: DataFrame, path: str) -> None:
    """df: (page_id, json), as made by ``plans.document.to_json``; a line a page."""
    df.select(F.col("json").alias("value")).write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).text(path)


@writer("markdown")
def markdown(df: DataFrame, path: str) -> None:
    """df: (page_id, markdown)."""
    _documents(df, F.concat(F.lit("page_"), "page_id", F.lit(".md")), "markdown", path)


@writer("html")
def html(df: DataFrame, path: str) -> None:
    """df: (table_region_id, pred_html): a row a table."""
    _documents(df, F.concat(F.lit("table_"), "table_region_id", F.lit(".html")), "pred_html", path)


@writer("yaml")
def yaml_rows(df: DataFrame, path: str) -> None:
    """Rows as a YAML list, each in flow style (JSON is YAML)."""
    df.select(F.concat(F.lit("- "), F.to_json(F.struct("*"))).alias("value")).write.mode("overwrite").text(path)


@writer("cells")
def cells(df: DataFrame, path: str) -> None:
    """df: (table_id, html): the tables' cells as CSV rows with their spans, a sheet's content without a workbook library."""
    markup.grid(df).write.mode("overwrite").option("header", True).csv(path)


@writer("xlsx")
def xlsx(df: DataFrame, path: str) -> None:
    """df: (page_id, html), a row a table: a workbook a page, a sheet a table in order of ``table_no`` where there is one; rows (path, content)."""
    number = F.col("table_no") if "table_no" in df.columns else F.lit(0)
    books = df.groupBy("page_id").agg(F.transform(F.array_sort(F.collect_list(F.struct(number.alias("n"), "html"))), lambda t: t.html).alias("tables"))
    binary(books.select(F.concat(F.lit("page_"), "page_id", F.lit(".xlsx")).alias("path"), pictures.workbooks(F.col("tables")).alias("content")), path)


@writer("text")
def plain(df: DataFrame, path: str) -> None:
    df.select(F.col("text").alias("value")).write.mode("overwrite").text(path)


@writer("csv")
def csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


@writer("parquet")
def parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


@writer("binary")
def binary(df: DataFrame, path: str) -> None:
    """df: (path, content): crops and overlays, kept as rows so that any file system takes them."""
    df.select("path", "content").write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)


def save(df: DataFrame, path: str, kind: str) -> None:
    if kind not in _writers:
        raise ValueError(f"no writer named {kind}; known: {', '.join(sorted(_writers))}")
    _writers[kind](df, path)


def save_all(outputs: dict[str, DataFrame], folder: str) -> None:
    """Each output by the writer of its name, to a folder of its name."""
    for kind, df in outputs.items():
        save(df, f"{folder}/{kind}", kind)

"""Aggregations over pages, regions and blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.operators.paged import by_page


def enclosing_box(boxes: DataFrame, *keys: str) -> DataFrame:
    """Least box around each group, and its size."""
    return boxes.groupBy(*keys).agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"), F.count(F.lit(1)).alias("n"))


def enclosing_box_in_one_system(boxes: DataFrame, *keys: str) -> DataFrame:
    """As ``enclosing_box``; raises where a group mixes coordinate systems."""
    one = F.count_distinct("coord_system")
    agg = boxes.groupBy(*keys).agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"), one.alias("_systems"), F.min("coord_system").alias("coord_system"))
    return agg.withColumn("x1", F.when(F.col("_systems") > 1, F.raise_error(F.lit("boxes of different coordinate systems")).cast("double")).otherwise(F.col("x1"))).drop("_systems")


def text_direction(boxes: DataFrame, *keys: str, ratio: float = 1.5) -> DataFrame:
    """Direction of most boxes: horizontal if at least half have width * ratio >= height."""
    flat = (G.width(G.box()) * ratio >= G.height(G.box())).cast("int")
    return boxes.groupBy(*keys).agg(F.when(F.sum(flat) * 2 >= F.count(F.lit(1)), "horizontal").otherwise("vertical").alias("direction"))


def region_stats(blocks: DataFrame, *keys: str, text_label: str = "text", line_height: float = 10.0, line_width: float = 20.0) -> DataFrame:
    """Blocks by kind, and mean height and width of text blocks with defaults where there are none."""
    is_text = F.col("label") == text_label
    return blocks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_blocks"),
        F.sum(is_text.cast("int")).alias("n_text"),
        F.sum((F.col("label").like("%title%")).cast("int")).alias("n_titles"),
        F.coalesce(F.avg(F.when(is_text, G.height(G.box()))), F.lit(line_height)).alias("line_height"),
        F.coalesce(F.avg(F.when(is_text, G.width(G.box()))), F.lit(line_width)).alias("line_width"),
    )


def region_distance(blocks: DataFrame, *keys: str, right: Column | None = None) -> DataFrame:
    """Least distance of the blocks' top left corners to the page's origin, or with ``right`` of their top right ones to that edge's top."""
    x = F.col("x1") if right is None else right - F.col("x2")
    return blocks.groupBy(*keys).agg(F.min(F.sqrt(x * x + F.col("y1") * F.col("y1"))).alias("distance"))


def mean_confidence(steps: DataFrame, *keys: str, column: str = "prob") -> DataFrame:
    """Mean probability of a sequence's kept steps, 0 where none is kept (left joins bring nulls)."""
    return steps.groupBy(*keys).agg(F.coalesce(F.avg(column), F.lit(0.0)).alias("confidence"))


def children(blocks: DataFrame, parent: str = "parent_block_id") -> DataFrame:
    """(page_id, parent, n_children, box around parent's children, their ids in order)."""
    return blocks.where(F.col(parent).isNotNull()).groupBy("page_id", parent).agg(
        F.count(F.lit(1)).alias("n_children"),
        F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"),
        F.array_sort(F.collect_list("box_id")).alias("child_ids"),
    )


def joined_text(rows: DataFrame, *keys: str, order: str = "order_index", text: str = "text", separator: str = "\n\n") -> DataFrame:
    """Texts of a group in order, with a separator between."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x.t), separator).alias("text"), F.count(F.lit(1)).alias("n"))


def _k_means(points: list[tuple[float, float]], k: int, rounds: int) -> list[int]:
    n = min(k, len(points))
    centres = [points[round(j * ((len(points) - 1) / (n - 1))) if n > 1 else 0] for j in range(n)]
    own: list[int] = []
    for _ in range(rounds):
        own = [min(range(n), key=lambda j: (x - centres[j][0]) ** 2 + (y - centres[j][1]) ** 2) for x, y in points]
        for j in range(n):
            mine = [p for p, o in zip(points, own, strict=True) if o == j]
            if mine:
                centres[j] = (sum(x for x, _ in mine) / len(mine), sum(y for _, y in mine) / len(mine))
    return own


def cluster_centers(boxes: DataFrame, k: int = 4, rounds: int = 10) -> DataFrame:
    """(page_id, box_id, cluster): k-means of box centres within each page, started from evenly spread boxes in order.

    A page of fewer boxes than k has a cluster a box.
    """

    def run(page: dict[str, list]) -> dict[str, list]:
        points = [((a + c) / 2, (b + d) / 2) for a, b, c, d in zip(*(page[s] for s in G.SIDES), strict=True)]
        return {"page_id": page["page_id"], "box_id": page["box_id"], "cluster": _k_means(points, k, rounds)}

    return by_page(boxes.select("page_id", "box_id", *G.SIDES), ["page_id"], ["box_id"], run, "page_id long, box_id long, cluster int")

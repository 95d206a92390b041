"""Relations derived from the test tables by integer arithmetic, for Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: A page per order, a box per line item: six labels, integer scores with many ties, integer sides.
BOX = """
SELECT l_orderkey AS page_id,
 CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS BIGINT) AS box_id,
 CASE concat(l_returnflag, l_linestatus) WHEN 'AF' THEN 'text' WHEN 'AO' THEN 'paragraph_title' WHEN 'NF' THEN 'image' WHEN 'NO' THEN 'table' WHEN 'RF' THEN 'formula' ELSE 'footnote' END AS label,
 CASE concat(l_returnflag, l_linestatus) WHEN 'AF' THEN 0 WHEN 'AO' THEN 1 WHEN 'NF' THEN 2 WHEN 'NO' THEN 3 WHEN 'RF' THEN 4 ELSE 5 END AS cls_id,
 CAST(100 - round(l_discount * 100) AS BIGINT) AS score,
 (l_partkey % 40) * 50 AS x1, CAST(round(l_quantity) AS BIGINT) * 20 AS y1,
 (l_partkey % 40) * 50 + 100 + (l_suppkey % 7) * 60 AS x2, CAST(round(l_quantity) AS BIGINT) * 20 + 40 + (l_partkey % 5) * 30 AS y2
FROM lineitem
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BOX.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, sf_dir, "lineitem"))


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes with odd ids, as layout blocks."""
    return boxes(spark, sf_dir).where("box_id % 2 = 1")


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes with even ids, as recognised spans with a text."""
    rows = boxes(spark, sf_dir).where("box_id % 2 = 0")
    return rows.selectExpr("page_id", "box_id AS span_id", "concat('s', box_id, label) AS text", "score", "x1", "y1", "x2", "y2")


#: The same in SQL, to stand before a query.
WITH = f"""WITH fx AS ({BOX}),
blk AS (SELECT * FROM fx WHERE box_id % 2 = 1),
spn AS (SELECT page_id, box_id AS span_id, concat('s', box_id, label) AS text, score, x1, y1, x2, y2 FROM fx WHERE box_id % 2 = 0)"""

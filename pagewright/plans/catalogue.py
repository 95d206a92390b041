"""Named queries over the test tables, and the SQL that must return the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.functions import markup, text
from pagewright.operators import detect, match, models, order, sequence, summary
from pagewright.plans import document
from pagewright.plans.fixtures import WITH, blocks, boxes, spans, table

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _queries[name] = f
        if sql is not None:
            _sql[name] = sql
        return f

    return add


# SQL fragments over two aliases
def _ix(a: str, b: str) -> str:
    return f"(least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1))"


def _iy(a: str, b: str) -> str:
    return f"(least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1))"


def _inter(a: str, b: str) -> str:
    return f"(greatest(0, {_ix(a, b)}) * greatest(0, {_iy(a, b)}))"


def _area(a: str) -> str:
    return f"(({a}.x2 - {a}.x1) * ({a}.y2 - {a}.y1))"


# --- filters and projections -----------------------------------------------------------------


@query("score_filter", f"{WITH} SELECT page_id, box_id, score FROM fx WHERE score > 93 AND cls_id > -1")
def _(spark, d):
    return detect.above_threshold(boxes(spark, d), 93).select("page_id", "box_id", "score")


@query("class_threshold_filter", f"{WITH} SELECT page_id, box_id, cls_id, score FROM fx WHERE score > CASE cls_id WHEN 0 THEN 95 WHEN 3 THEN 90 ELSE 92 END AND cls_id > -1")
def _(spark, d):
    return detect.above_threshold(boxes(spark, d), {0: 95, 3: 90}, 92).select("page_id", "box_id", "cls_id", "score")


@query(
    "oversize_image_filter",
    f"""{WITH}, k AS (SELECT *, NOT (label = 'image' AND (least(2400, x2) - greatest(0, x1)) * (least(1200, y2) - greatest(0, y1)) > 0.015 * 2400 * 1200) AS keep FROM fx),
    n AS (SELECT *, count(*) OVER (PARTITION BY page_id) AS n, sum(CAST(keep AS INT)) OVER (PARTITION BY page_id) AS l FROM k) SELECT page_id, box_id, label FROM n WHERE keep OR n <= 1 OR l = 0""",
)
def _(spark, d):
    return detect.drop_oversize(boxes(spark, d), 2400, 1200, landscape=0.015).select("page_id", "box_id", "label")


@query(
    "clamp_drop_empty",
    f"{WITH}, c AS (SELECT page_id, box_id, greatest(0, x1) AS x1, greatest(0, y1) AS y1, least(1500, x2) AS x2, least(800, y2) AS y2 FROM fx) SELECT * FROM c WHERE x2 > x1 AND y2 > y1",
)
def _(spark, d):
    return detect.clamp_to_page(boxes(spark, d), 1500, 800).select("page_id", "box_id", *G.SIDES)


@query(
    "unclip_boxes",
    f"""{WITH}, r AS (SELECT *, CASE cls_id WHEN 0 THEN 1.5 WHEN 3 THEN 2.0 ELSE 1.0 END AS w, CASE cls_id WHEN 0 THEN 1.25 WHEN 3 THEN 0.5 ELSE 1.0 END AS h FROM fx)
    SELECT page_id, box_id, CAST(round(4 * (x1 + (x2 - x1) / 2.0 - (x2 - x1) * w / 2)) AS BIGINT) AS x1_q, CAST(round(4 * (y1 + (y2 - y1) / 2.0 - (y2 - y1) * h / 2)) AS BIGINT) AS y1_q,
      CAST(round(4 * (x1 + (x2 - x1) / 2.0 + (x2 - x1) * w / 2)) AS BIGINT) AS x2_q, CAST(round(4 * (y1 + (y2 - y1) / 2.0 + (y2 - y1) * h / 2)) AS BIGINT) AS y2_q FROM r""",
)
def _(spark, d):
    wide = detect.unclip(boxes(spark, d), {0: (1.5, 1.25), 3: (2.0, 0.5)})
    return wide.select("page_id", "box_id", *[F.round(4 * F.col(s)).cast("long").alias(f"{s}_q") for s in G.SIDES])


@query(
    "rotate_cells",
    f"""{WITH} SELECT page_id, box_id, page_id % 4 * 90 AS angle,
    CASE page_id % 4 WHEN 3 THEN y1 WHEN 2 THEN 2600 - x2 WHEN 1 THEN 1300 - y2 ELSE x1 END AS x1, CASE page_id % 4 WHEN 3 THEN 2600 - x2 WHEN 2 THEN 1300 - y2 WHEN 1 THEN x1 ELSE y1 END AS y1,
    CASE page_id % 4 WHEN 3 THEN y2 WHEN 2 THEN 2600 - x1 WHEN 1 THEN 1300 - y1 ELSE x2 END AS x2, CASE page_id % 4 WHEN 3 THEN 2600 - x1 WHEN 2 THEN 1300 - y1 WHEN 1 THEN x2 ELSE y2 END AS y2 FROM fx""",
)
def _(spark, d):
    angle = F.col("page_id") % 4 * 90
    return boxes(spark, d).select("page_id", "box_id", angle.alias("angle"), G.unrotate(G.box(), angle, 2600, 1300).alias("b")).select("page_id", "box_id", "angle", "b.*")


@query("page_offset", f"{WITH} SELECT page_id, box_id, x1 - 100 AS x1, y1 + 25 AS y1, x2 - 100 AS x2, y2 + 25 AS y2 FROM fx")
def _(spark, d):
    return boxes(spark, d).select("page_id", "box_id", G.translate(G.box(), -100, 25).alias("b")).select("page_id", "box_id", "b.*")


@query("corners8", f"{WITH} SELECT page_id, box_id, concat_ws(',', x1, y1, x2, y1, x2, y2, x1, y2) AS corners FROM fx")
def _(spark, d):
    return boxes(spark, d).select("page_id", "box_id", F.array_join(F.transform(G.corners(G.box()), lambda c: c.cast("string")), ",").alias("corners"))


@query("box_measures", f"{WITH} SELECT page_id, box_id, x2 - x1 AS w, y2 - y1 AS h, (x2 - x1) * (y2 - y1) AS a, x1 + x2 AS cx2, y1 + y2 AS cy2, CASE WHEN (x2 - x1) * 1.5 >= y2 - y1 THEN 'horizontal' ELSE 'vertical' END AS dir FROM fx")
def _(spark, d):
    b = G.box()
    return boxes(spark, d).select("page_id", "box_id", G.width(b).alias("w"), G.height(b).alias("h"), G.area(b).alias("a"), (G.center(b).x * 2).cast("long").alias("cx2"), (G.center(b).y * 2).cast("long").alias("cy2"), G.direction(b, 1.5).alias("dir"))


@query("polygon_boxes", f"{WITH} SELECT page_id, box_id, x1, y1 - 5 AS y1, x2 + 7 AS x2, y2, CAST(round(2 * ((x2 - x1) * (y2 - y1) + (x2 - x1) * 5 / 2.0 + 7 * (y2 - y1) / 2.0 + 0.0)) AS BIGINT) AS area2 FROM fx")
def _(spark, d):
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    top = corner((F.col("x1") + F.col("x2")) / 2, F.col("y1") - 5)
    right = corner(F.col("x2") + 7, (F.col("y1") + F.col("y2")) / 2)
    points = F.array(corner(F.col("x1"), F.col("y1")), top, corner(F.col("x2"), F.col("y1")), right, corner(F.col("x2"), F.col("y2")), corner(F.col("x1"), F.col("y2")))
    rows = boxes(spark, d).select("page_id", "box_id", G.polygon_box(points).alias("b"), F.round(2 * G.polygon_area(points)).cast("long").alias("area2"))
    return rows.select("page_id", "box_id", *[F.col(f"b.{s}").cast("long").alias(s) for s in G.SIDES], "area2")


@query(
    "relabel_footnote_title",
    f"""{WITH}, w AS (SELECT *, max(CASE WHEN label = 'text' THEN y2 END) OVER p AS bot, sum(CAST(label = 'paragraph_title' AS INT)) OVER p AS nt, max((x2 - x1) * (y2 - y1)) OVER p AS big FROM fx WINDOW p AS (PARTITION BY page_id))
    SELECT page_id, box_id, CASE WHEN label = 'footnote' AND y2 < bot THEN 'text' WHEN label = 'paragraph_title' AND nt = 1 AND (x2 - x1) * (y2 - y1) * 10 > big * 3 THEN 'doc_title' ELSE label END AS label FROM w""",
)
def _(spark, d):
    return detect.relabel(boxes(spark, d)).select("page_id", "box_id", "label")


@query("order_labels", f"{WITH} SELECT page_id, box_id, CASE label WHEN 'paragraph_title' THEN 'paragraph_title' WHEN 'image' THEN 'vision' WHEN 'table' THEN 'vision' WHEN 'footnote' THEN 'footer' ELSE 'normal_text' END AS order_label FROM fx")
def _(spark, d):
    return boxes(spark, d).select("page_id", "box_id", order.order_label(F.col("label")).alias("order_label"))


@query("interval_blocks", f"{WITH} SELECT page_id, box_id, row_number() OVER (PARTITION BY page_id ORDER BY x2, box_id) AS place FROM fx WHERE x1 >= 300 AND x2 <= 1200")
def _(spark, d):
    from pyspark.sql import Window

    rows = boxes(spark, d).where("x1 >= 300 AND x2 <= 1200")
    return rows.select("page_id", "box_id", F.row_number().over(Window.partitionBy("page_id").orderBy("x2", "box_id")).cast("long").alias("place"))


@query("project_sides", f"{WITH} SELECT page_id, box_id, CASE WHEN w THEN x1 ELSE y1 END AS s, CASE WHEN w THEN x2 ELSE y2 END AS e, CASE WHEN w THEN x2 - x1 ELSE y2 - y1 END AS l, CASE WHEN w THEN y2 - y1 ELSE x2 - x1 END AS t FROM (SELECT *, x2 - x1 >= y2 - y1 AS w FROM fx)")
def _(spark, d):
    a = G.along(G.box(), G.direction(G.box()))
    return boxes(spark, d).select("page_id", "box_id", a.start.alias("s"), a.end.alias("e"), a.long_side.alias("l"), a.short_side.alias("t"))


@query(
    "clamp_rotated",
    f"{WITH} SELECT page_id, box_id, concat_ws(',', least(1500, x1), least(800, y1), least(1500, x2), least(800, y1), least(1500, x2), least(800, y2), least(1500, x1), least(800, y2)) AS corners FROM fx",
)
def _(spark, d):
    cut = G.clamp_points(G.corners(G.box()), 1500, 800)
    return boxes(spark, d).select("page_id", "box_id", F.array_join(F.transform(cut, lambda c: c.cast("string")), ",").alias("corners"))


@query("rotate_points", f"{WITH} SELECT page_id, box_id, round(x1 * cos(radians(30)) - y1 * sin(radians(30)), 4) AS x, round(x1 * sin(radians(30)) + y1 * cos(radians(30)), 4) AS y FROM fx")
def _(spark, d):
    p = G.rotate_point(F.col("x1"), F.col("y1"), 30)
    return boxes(spark, d).select("page_id", "box_id", F.round(p.x, 4).alias("x"), F.round(p.y, 4).alias("y"))


@query("label_colours", f"{WITH} SELECT page_id, box_id, CASE label WHEN 'text' THEN '153,0,76,100' WHEN 'image' THEN '153,255,51,100' WHEN 'table' THEN '204,204,0,100' WHEN 'formula' THEN '0,255,0,100' WHEN 'paragraph_title' THEN '102,102,255,100' ELSE '158,158,158,100' END AS rgba, CASE label WHEN 'image' THEN '153,255,51,100' WHEN 'table' THEN '153,255,51,100' WHEN 'paragraph_title' THEN '102,102,255,100' WHEN 'footnote' THEN '158,158,158,100' ELSE '153,0,76,100' END AS group_rgba FROM fx")
def _(spark, d):
    return boxes(spark, d).select("page_id", "box_id", order.colour(F.col("label")).alias("rgba"), order.colour(order.order_label(F.col("label")), of_group=True).alias("group_rgba"))


# --- joins -----------------------------------------------------------------------------------


@query("match_small", f"{WITH} SELECT b.page_id, b.box_id, s.span_id FROM blk b JOIN spn s ON b.page_id = s.page_id WHERE b.label NOT IN ('formula', 'table', 'seal') AND {_inter('b', 's')} * 10 > least({_area('b')}, {_area('s')})")
def _(spark, d):
    return match.match_blocks_to_spans(blocks(spark, d), spans(spark, d), "small")


@query("match_pixels", f"{WITH} SELECT b.page_id, b.box_id, s.span_id FROM blk b JOIN spn s ON b.page_id = s.page_id WHERE b.label NOT IN ('formula', 'table', 'seal') AND {_ix('b', 's')} > 3 AND {_iy('b', 's')} > 3")
def _(spark, d):
    return match.match_blocks_to_spans(blocks(spark, d), spans(spark, d), "pixels")


@query("match_inter2", f"{WITH} SELECT b.page_id, b.box_id, s.span_id FROM blk b JOIN spn s ON b.page_id = s.page_id WHERE {_inter('b', 's')} * 10 > 7 * {_area('s')}")
def _(spark, d):
    return match.match(blocks(spark, d), spans(spark, d), "inter2")


_FAR = "(abs(c.x1 - s.x1) + abs(c.y1 - s.y1) + abs(c.x2 - s.x2) + abs(c.y2 - s.y2) + least(abs(c.x1 - s.x1) + abs(c.y1 - s.y1), abs(c.x2 - s.x2) + abs(c.y2 - s.y2)))"


@query(
    "nearest_cell",
    f"""{WITH}, c AS (SELECT s.page_id, s.span_id, c.box_id AS cell_id, row_number() OVER (PARTITION BY s.page_id, s.span_id ORDER BY 1 - CAST({_inter('c', 's')} AS DOUBLE) / ({_area('c')} + {_area('s')} - {_inter('c', 's')}), {_FAR}, c.box_id) AS n
    FROM spn s JOIN blk c ON s.page_id = c.page_id) SELECT page_id, span_id, cell_id FROM c WHERE n = 1""",
)
def _(spark, d):
    return match.nearest_cell(spans(spark, d), blocks(spark, d).withColumnRenamed("box_id", "cell_id"))


@query("neighbor_text", f"{WITH} SELECT b.page_id, b.box_id, string_agg(s.text, '; ' ORDER BY s.span_id) AS neighbor_texts FROM blk b JOIN spn s ON b.page_id = s.page_id WHERE {_ix('b', 's')} > 0 AND {_iy('b', 's')} > -15 AND {_iy('b', 's')} < 3 GROUP BY ALL")
def _(spark, d):
    return match.neighbour_text(blocks(spark, d), spans(spark, d))


@query(
    "prev_next_blocks",
    f"""{WITH}, j AS (SELECT p.page_id, p.box_id, q.box_id AS id, q.y1, q.y2, q.y2 <= p.y1 AS bef FROM fx p JOIN fx q ON p.page_id = q.page_id AND p.box_id <> q.box_id WHERE {_ix('p', 'q')} > 0 AND {_ix('p', 'q')} * 10 > least(p.x2 - p.x1, q.x2 - q.x1))
    SELECT page_id, box_id, coalesce(string_agg(CAST(id AS VARCHAR), ',' ORDER BY y2 DESC, id) FILTER (bef), '') AS before, coalesce(string_agg(CAST(id AS VARCHAR), ',' ORDER BY y1, id) FILTER (NOT bef), '') AS after FROM j GROUP BY ALL""",
)
def _(spark, d):
    ids = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return match.beside(boxes(spark, d)).select("page_id", "box_id", ids("before").alias("before"), ids("after").alias("after"))


@query(
    "uncovered_spans",
    f"""{WITH}, c AS (SELECT s.page_id, s.span_id, sum(CASE WHEN b.page_id IS NULL THEN 0 ELSE {_inter('b', 's')} END) AS i, any_value({_area('s')}) AS a FROM spn s LEFT JOIN blk b ON b.page_id = s.page_id AND {_inter('b', 's')} > 0 GROUP BY s.page_id, s.span_id)
    SELECT page_id, span_id FROM c WHERE i * 10 < a * 6""",
)
def _(spark, d):
    return match.uncovered(spans(spark, d), blocks(spark, d))


@query("within_semi", f"{WITH} SELECT page_id, span_id FROM spn s WHERE EXISTS (SELECT 1 FROM blk b WHERE b.page_id = s.page_id AND {_ix('b', 's')} > 3 AND {_iy('b', 's')} > 3)")
def _(spark, d):
    return match.inside(spans(spark, d), blocks(spark, d)).select("page_id", "span_id")


@query("outside_anti", f"{WITH} SELECT page_id, span_id FROM spn s WHERE NOT EXISTS (SELECT 1 FROM blk b WHERE b.page_id = s.page_id AND b.label IN ('formula', 'table', 'seal') AND {_ix('b', 's')} > 3 AND {_iy('b', 's')} > 3)")
def _(spark, d):
    return match.paragraphs_only(spans(spark, d), blocks(spark, d)).select("page_id", "span_id")


@query("multi_block_spans", f"{WITH}, m AS (SELECT b.page_id, b.box_id, s.span_id FROM blk b JOIN spn s ON b.page_id = s.page_id WHERE {_inter('b', 's')} * 10 > least({_area('b')}, {_area('s')})) SELECT page_id, box_id, span_id FROM (SELECT *, count(*) OVER (PARTITION BY page_id, span_id) AS n FROM m) WHERE n > 1")
def _(spark, d):
    return match.shared_spans(match.match(blocks(spark, d), spans(spark, d)))


@query("blocks_without_text", f"{WITH} SELECT page_id, box_id, label FROM blk b WHERE label NOT IN ('image', 'table', 'formula', 'seal', 'chart') AND NOT EXISTS (SELECT 1 FROM spn s WHERE b.page_id = s.page_id AND {_inter('b', 's')} * 10 > least({_area('b')}, {_area('s')}))")
def _(spark, d):
    return match.without_text(blocks(spark, d), match.match(blocks(spark, d), spans(spark, d))).select("page_id", "box_id", "label")


@query("spans_in_table_frame", f"{WITH} SELECT b.page_id, b.box_id, s.span_id, s.x1 - b.x1 AS x1, s.y1 - b.y1 AS y1, s.x2 - b.x1 AS x2, s.y2 - b.y1 AS y2 FROM blk b JOIN spn s ON b.page_id = s.page_id AND s.x1 >= b.x1 AND s.y1 >= b.y1 AND s.x2 <= b.x2 AND s.y2 <= b.y2")
def _(spark, d):
    return match.to_frame(spans(spark, d), blocks(spark, d))


@query(
    "region_assign",
    f"""{WITH}, j AS (SELECT b.page_id, r.box_id AS region_id, b.span_id AS box_id, row_number() OVER (PARTITION BY b.page_id, b.span_id ORDER BY {_area('r')}, r.box_id) AS n FROM blk r JOIN spn b ON r.page_id = b.page_id AND {_inter('r', 'b')} * 10 > 6 * least({_area('r')}, {_area('b')}))
    SELECT page_id, region_id, box_id FROM j WHERE n = 1""",
)
def _(spark, d):
    return match.assign_regions(blocks(spark, d).withColumnRenamed("box_id", "region_id"), spans(spark, d).withColumnRenamed("span_id", "box_id"))


@query(
    "supplement_rows",
    f"""{WITH}, j AS (SELECT DISTINCT b.page_id, b.span_id FROM blk r JOIN spn b ON r.page_id = b.page_id AND {_inter('r', 'b')} * 10 > 6 * least({_area('r')}, {_area('b')}))
    SELECT page_id, 'SupplementaryRegion' AS label, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2, count(*) AS n_blocks FROM spn s WHERE NOT EXISTS (SELECT 1 FROM j WHERE j.page_id = s.page_id AND j.span_id = s.span_id) GROUP BY page_id""",
)
def _(spark, d):
    own = spans(spark, d).withColumnRenamed("span_id", "box_id")
    return match.supplement(own, match.assign_regions(blocks(spark, d).withColumnRenamed("box_id", "region_id"), own))


@query("row_flag_asof", f"{WITH} SELECT r.page_id, r.x1 AS start, coalesce(max(f.x1), 0) AS flag FROM (SELECT DISTINCT page_id, x1 FROM spn) r LEFT JOIN blk f ON f.page_id = r.page_id AND f.x1 <= r.x1 GROUP BY ALL")
def _(spark, d):
    starts = spans(spark, d).select("page_id", F.col("x1").alias("start")).distinct()
    return match.flags_as_of(starts, blocks(spark, d).select("page_id", F.col("x1").alias("flag")))


@query(
    "cell_split",
    f"""{WITH}, s AS (SELECT page_id, span_id, x1, y1 - 200 AS y1, x2 + 800 AS x2, y2 + 200 AS y2 FROM spn),
    hit AS (SELECT s.*, greatest(c.x1, s.x1) AS lo, least(c.x2, s.x2) AS hi, row_number() OVER w AS k, count(*) OVER (PARTITION BY s.page_id, s.span_id) AS n,
        coalesce(greatest(s.x1, max(least(c.x2, s.x2)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), s.x1) AS reach
      FROM s JOIN blk c ON s.page_id = c.page_id AND {_inter("s", "c")} * 2 > {_area("c")} WINDOW w AS (PARTITION BY s.page_id, s.span_id ORDER BY c.x1, c.x2)),
    several AS (SELECT * FROM hit WHERE n >= 2),
    piece AS (SELECT page_id, span_id, y1, y2, 2 * k AS o, reach AS x1, lo AS x2 FROM several WHERE lo > reach
      UNION ALL SELECT page_id, span_id, y1, y2, 2 * k + 1, lo, hi FROM several WHERE hi > lo
      UNION ALL SELECT page_id, span_id, y1, y2, 1000000, greatest(reach, hi), x2 FROM several WHERE k = n AND greatest(reach, hi) < x2)
    SELECT page_id, span_id, CAST(row_number() OVER (PARTITION BY page_id, span_id ORDER BY o) - 1 AS INT) AS piece, x1, y1, x2, y2 FROM (SELECT page_id, span_id, x1, y1, x2, y2, min(o) AS o FROM piece GROUP BY ALL)""",
)
def _(spark, d):
    wide = spans(spark, d).withColumn("x2", F.col("x2") + 800).withColumn("y1", F.col("y1") - 200).withColumn("y2", F.col("y2") + 200)
    return match.split_spans(wide, blocks(spark, d).withColumnRenamed("box_id", "cell_id"))


# --- aggregations ----------------------------------------------------------------------------


@query("enclosing_box", f"{WITH} SELECT page_id, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2, count(*) AS n FROM fx GROUP BY page_id")
def _(spark, d):
    return summary.enclosing_box(boxes(spark, d), "page_id")


@query("direction_majority", f"{WITH} SELECT page_id, CASE WHEN sum(CAST((x2 - x1) * 0.8 >= y2 - y1 AS INT)) * 2 >= count(*) THEN 'horizontal' ELSE 'vertical' END AS direction FROM fx GROUP BY page_id")
def _(spark, d):
    return summary.text_direction(boxes(spark, d), "page_id", ratio=0.8)


@query("region_stats", f"{WITH} SELECT page_id, count(*) AS n_blocks, CAST(sum(CAST(label = 'text' AS INT)) AS BIGINT) AS n_text, CAST(sum(CAST(label LIKE '%title%' AS INT)) AS BIGINT) AS n_titles, round(coalesce(avg(CASE WHEN label = 'text' THEN y2 - y1 END), 10), 6) AS line_height, round(coalesce(avg(CASE WHEN label = 'text' THEN x2 - x1 END), 20), 6) AS line_width FROM fx GROUP BY page_id")
def _(spark, d):
    return summary.region_stats(boxes(spark, d), "page_id").withColumns({c: F.round(c, 6) for c in ("line_height", "line_width")})


@query("region_distance", f"{WITH} SELECT page_id, round(sqrt(min(x1 * x1 + y1 * y1)), 6) AS distance FROM fx GROUP BY page_id")
def _(spark, d):
    return summary.region_distance(boxes(spark, d), "page_id").withColumn("distance", F.round("distance", 6))


@query("page_text", "SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn, text) AS text, count(*) AS n FROM conversations GROUP BY conv_id")
def _(spark, d):
    rows = table(spark, d, "conversations").withColumn("o", F.struct("turn", "text"))
    return summary.joined_text(rows, "conv_id", order="o")


@query("children", f"{WITH} SELECT page_id, box_id // 3 AS parent_block_id, count(*) AS n_children, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2, string_agg(CAST(box_id AS VARCHAR), ',' ORDER BY box_id) AS ids FROM fx GROUP BY ALL")
def _(spark, d):
    rows = boxes(spark, d).withColumn("parent_block_id", F.floor(F.col("box_id") / 3).cast("long"))
    return summary.children(rows).select("page_id", "parent_block_id", "n_children", *G.SIDES, F.array_join(F.transform("child_ids", lambda x: x.cast("string")), ",").alias("ids"))


_FAR = "(p.x - {c}.x) * (p.x - {c}.x) + (p.y - {c}.y) * (p.y - {c}.y)"
_OWN = "list_position(list_transform(acc, lambda c: " + _FAR.format(c="c") + "), list_min(list_transform(acc, lambda c: " + _FAR.format(c="c") + ")))"


@query(
    "cluster_centers",
    # the state of the fold are the centres; n rounds from evenly spread boxes
    f"""{WITH}, p AS (SELECT page_id, list({{'x': (x1 + x2) / 2.0::DOUBLE, 'y': (y1 + y2) / 2.0::DOUBLE}} ORDER BY box_id) AS e, list(box_id ORDER BY box_id) AS ids, least(4, count(*)) AS n FROM fx GROUP BY page_id),
    s AS (SELECT *, list_transform(generate_series(0, n - 1), lambda j: e[CAST(round_even(CASE WHEN n = 1 THEN 0 ELSE j * ((len(e) - 1) / (n - 1)::DOUBLE) END, 0) AS INT) + 1]) AS c0 FROM p),
    c AS (SELECT *, list_reduce(list_prepend(c0, list_transform(generate_series(1, 9), lambda i: c0)), lambda acc, unused: list_transform(acc, lambda a, j:
        CASE WHEN len(list_filter(e, lambda p: {_OWN} = j)) > 0 THEN {{'x': list_avg(list_transform(list_filter(e, lambda p: {_OWN} = j), lambda p: p.x)), 'y': list_avg(list_transform(list_filter(e, lambda p: {_OWN} = j), lambda p: p.y))}} ELSE a END)) AS acc FROM s)
    SELECT page_id, unnest(ids) AS box_id, unnest(list_transform(e, lambda p: CAST({_OWN} - 1 AS INT))) AS cluster FROM c""",
)
def _(spark, d):
    return summary.cluster_centers(boxes(spark, d))


# --- windows and sequences -------------------------------------------------------------------

_ISLANDS = f"""{WITH}, m AS (SELECT *, CASE WHEN x1 <= max(x2) OVER (PARTITION BY page_id ORDER BY x1, box_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS st FROM fx),
g AS (SELECT *, sum(st) OVER (PARTITION BY page_id ORDER BY x1, box_id ROWS UNBOUNDED PRECEDING) AS island FROM m)"""


@query("interval_merge", f"{_ISLANDS} SELECT page_id, CAST(island AS BIGINT) AS island, min(x1) AS start, max(x2) AS \"end\", count(*) AS members FROM g GROUP BY page_id, island")
def _(spark, d):
    return sequence.merge_intervals(boxes(spark, d))


@query(
    "cluster_positions",
    f"""{WITH}, p AS (SELECT DISTINCT page_id, y1 AS pos FROM fx), m AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY page_id ORDER BY pos) <= 40 THEN 0 ELSE 1 END AS st FROM p),
    g AS (SELECT *, sum(st) OVER (PARTITION BY page_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS c FROM m) SELECT page_id, CAST(c AS BIGINT) AS cluster, round(avg(pos), 6) AS center, count(*) AS members FROM g GROUP BY page_id, c""",
)
def _(spark, d):
    return sequence.cluster_positions(boxes(spark, d).withColumnRenamed("y1", "pos"), 40).withColumn("center", F.round("center", 6))


_PROFILE = f"""{WITH}, e AS (SELECT page_id, x1 AS pos, 1 AS d FROM fx UNION ALL SELECT page_id, x2, -1 FROM fx), s AS (SELECT page_id, pos, sum(d) AS d FROM e GROUP BY ALL),
prof AS (SELECT page_id, pos, CAST(sum(d) OVER (PARTITION BY page_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cover FROM s)"""


@query("projection_profile", f"{_PROFILE} SELECT * FROM prof")
def _(spark, d):
    return sequence.projection_profile(boxes(spark, d))


@query(
    "profile_segments",
    f"""{_PROFILE}, l AS (SELECT *, lead(pos) OVER (PARTITION BY page_id ORDER BY pos) AS e FROM prof), o AS (SELECT * FROM l WHERE e IS NOT NULL AND cover > 0),
    n AS (SELECT *, CASE WHEN pos = lag(e) OVER (PARTITION BY page_id ORDER BY pos) THEN 0 ELSE 1 END AS st FROM o), r AS (SELECT *, sum(st) OVER (PARTITION BY page_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM n)
    SELECT page_id, min(pos) AS start, max(e) AS "end" FROM r GROUP BY page_id, run""",
)
def _(spark, d):
    return sequence.profile_segments(sequence.projection_profile(boxes(spark, d)))


@query(
    "profile_minima",
    f"""{_PROFILE}, l AS (SELECT *, lead(pos) OVER (PARTITION BY page_id ORDER BY pos) AS e FROM prof), o AS (SELECT *, CASE WHEN cover = lag(cover) OVER (PARTITION BY page_id ORDER BY pos) THEN 0 ELSE 1 END AS st FROM l WHERE e IS NOT NULL),
    r AS (SELECT *, sum(st) OVER (PARTITION BY page_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM o), f AS (SELECT page_id, run, min(pos) AS start, max(e) AS "end", min(cover) AS cover FROM r GROUP BY page_id, run),
    b AS (SELECT *, lag(cover) OVER (PARTITION BY page_id ORDER BY run) AS p, lead(cover) OVER (PARTITION BY page_id ORDER BY run) AS n FROM f) SELECT page_id, start, "end", cover FROM b WHERE cover < p AND cover < n""",
)
def _(spark, d):
    return sequence.profile_minima(sequence.projection_profile(boxes(spark, d)))


_CLS = "CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END"


@query("ctc_collapse", f"WITH k AS (SELECT user_id, ts, event_id, {_CLS} AS cls FROM events), l AS (SELECT *, lag(cls) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pc FROM k) SELECT user_id, event_id, cls FROM l WHERE cls <> 0 AND (pc IS NULL OR pc <> cls)")
def _(spark, d):
    steps = table(spark, d, "events").selectExpr("user_id", "ts", "event_id", f"{_CLS} AS cls")
    return sequence.ctc_collapse(steps, 0, "user_id", ("ts", "event_id")).select("user_id", "event_id", "cls")


@query("mean_confidence", f"WITH k AS (SELECT user_id, ts, event_id, value, {_CLS} AS cls FROM events), l AS (SELECT *, lag(cls) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pc FROM k) SELECT user_id, round(coalesce(avg(CASE WHEN cls <> 0 AND (pc IS NULL OR pc <> cls) THEN value END), 0), 6) AS confidence FROM l GROUP BY user_id")
def _(spark, d):
    steps = table(spark, d, "events").selectExpr("user_id", "ts", "event_id", "value", f"{_CLS} AS cls")
    kept = sequence.ctc_collapse(steps, 0, "user_id", ("ts", "event_id")).select("event_id", F.col("value").alias("prob"))
    return summary.mean_confidence(steps.join(kept, "event_id", "left"), "user_id").withColumn("confidence", F.round("confidence", 6))


@query(
    "word_box_lines",
    f"""{WITH}, m AS (SELECT *, (y1 + y2) / 2.0 AS cy, CASE WHEN (y1 + y2) / 2.0 - lag((y1 + y2) / 2.0) OVER (PARTITION BY page_id ORDER BY y1 + y2, box_id) < 50 THEN 0 ELSE 1 END AS st FROM fx),
    g AS (SELECT *, CAST(sum(st) OVER (PARTITION BY page_id ORDER BY cy, box_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS line FROM m) SELECT page_id, box_id, line, row_number() OVER (PARTITION BY page_id, line ORDER BY x1 + x2, box_id) AS place FROM g""",
)
def _(spark, d):
    return sequence.word_box_lines(boxes(spark, d), 50)


def _fold_sql(joins: str, lo: str, hi: str) -> str:
    """Lines by a recursive walk through a page's boxes in (y1, box_id) order."""
    return f"""{WITH.replace("WITH fx", "WITH RECURSIVE fx")}, o AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY y1, box_id) AS k FROM fx),
    r AS (SELECT page_id, box_id, x1, k, y1 AS lo, y2 AS hi, 1 AS line FROM o WHERE k = 1
      UNION ALL SELECT o.page_id, o.box_id, o.x1, o.k, CASE WHEN {joins} THEN {lo} ELSE o.y1 END, CASE WHEN {joins} THEN {hi} ELSE o.y2 END, CASE WHEN {joins} THEN r.line ELSE r.line + 1 END FROM r JOIN o ON o.page_id = r.page_id AND o.k = r.k + 1)
    SELECT page_id, box_id, line, row_number() OVER (PARTITION BY page_id, line ORDER BY x1, box_id) AS place FROM r"""


_ON_LINE = "(least(r.hi, o.y2) - greatest(r.lo, o.y1) > 0 AND (least(r.hi, o.y2) - greatest(r.lo, o.y1)) * 10 {} 6 * least(r.hi - r.lo, o.y2 - o.y1))"


@query("line_grouping", _fold_sql(_ON_LINE.format(">="), "least(r.lo, o.y1)", "greatest(r.hi, o.y2)"))
def _(spark, d):
    return sequence.group_lines(boxes(spark, d))


@query("band_grouping", _fold_sql(_ON_LINE.format(">"), "least(r.lo, o.y1)", "greatest(r.hi, o.y2)"))
def _(spark, d):
    return sequence.group_band(boxes(spark, d))


@query("cell_rows", _fold_sql("abs(o.y1 - r.lo) <= 30", "r.lo", "r.hi"))
def _(spark, d):
    return sequence.cell_rows(boxes(spark, d), 30)


@query("row_offsets", f"SELECT page_id, line, coalesce(CAST(sum(members) OVER (PARTITION BY page_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS first, members FROM (SELECT page_id, line, count(*) AS members FROM ({_fold_sql('abs(o.y1 - r.lo) <= 30', 'r.lo', 'r.hi')}) GROUP BY page_id, line)")
def _(spark, d):
    return sequence.row_offsets(sequence.cell_rows(boxes(spark, d), 30))


@query(
    "quad_sort",
    f"""{WITH}, p AS (SELECT page_id, list({{'y1': y1, 'x1': x1, 'i': box_id}} ORDER BY y1, x1, box_id) AS e FROM fx GROUP BY page_id),
    s AS (SELECT page_id, list_reduce(list_transform(e, lambda v: [v]), lambda acc, c: list_concat(list_append(acc[1:coalesce(list_max(list_filter(generate_series(1, len(acc)), lambda i: NOT (abs(c[1].y1 - acc[i].y1) < 30 AND c[1].x1 < acc[i].x1))), 0)], c[1]),
        acc[coalesce(list_max(list_filter(generate_series(1, len(acc)), lambda i: NOT (abs(c[1].y1 - acc[i].y1) < 30 AND c[1].x1 < acc[i].x1))), 0) + 1:])) AS l FROM p)
    SELECT page_id, unnest(list_transform(l, lambda v: v.i)) AS box_id, unnest(generate_series(1, len(l))) AS place FROM s""",
)
def _(spark, d):
    return sequence.quad_order(boxes(spark, d), 30)


@query("poly_sort", f"{WITH} SELECT page_id, box_id, row_number() OVER (PARTITION BY page_id ORDER BY y1, box_id) AS place FROM fx")
def _(spark, d):
    return sequence.order_by_top(boxes(spark, d))


@query(
    "odd_height_filter",
    f"""{WITH}, w AS (SELECT page_id, box_id, y2 - y1 AS h, min(y2 - y1) OVER p AS lo, max(y2 - y1) OVER p AS hi, avg(CAST((y2 - y1) * 10 < (min_h) * 11 AS INT)) OVER p AS near FROM (SELECT *, min(y2 - y1) OVER (PARTITION BY page_id) AS min_h FROM fx) WINDOW p AS (PARTITION BY page_id))
    SELECT page_id, box_id, h FROM w WHERE NOT (hi > lo * 2 AND near < 0.4) OR h * 10 <= lo * 11""",
)
def _(spark, d):
    return sequence.drop_odd_heights(boxes(spark, d).select("page_id", "box_id", (F.col("y2") - F.col("y1")).alias("h"))).select("page_id", "box_id", "h")


@query(
    "continuation_flags",
    f"""{WITH}, l AS (SELECT *, lag(x1) OVER p AS px1, lag(x2) OVER p AS px2, lag(y1) OVER p AS py1, lag(y2) OVER p AS py2, lag(box_id % 3) OVER p AS pl FROM fx WINDOW p AS (PARTITION BY page_id ORDER BY box_id))
    SELECT page_id, box_id, CASE WHEN px1 IS NULL THEN FALSE ELSE NOT (y1 < py2 AND y2 > py1 AND abs(x1 - px2) < greatest(px2 - px1, x2 - x1) AND pl > 1) END AS seg_start_flag, TRUE AS seg_end_flag FROM l""",
)
def _(spark, d):
    rows = boxes(spark, d).withColumns({"order_index": F.col("box_id"), "num_of_lines": F.col("box_id") % 3})
    return sequence.segment_flags_simple(rows).select("page_id", "box_id", "seg_start_flag", "seg_end_flag")


@query(
    "segment_flags",
    f"""{WITH}, b AS (SELECT page_id, box_id, x1 AS s, x2 AS e, x1 + box_id % 4 * 6 AS ss, x2 - score % 4 * 6 AS se, x2 - x1 AS w, box_id % 3 + 1 AS n FROM fx),
    l AS (SELECT *, lag(s) OVER p AS ps, lag(e) OVER p AS pe, lag(se) OVER p AS pse, lag(w) OVER p AS pw, lag(n) OVER p AS pn FROM b WINDOW p AS (PARTITION BY page_id ORDER BY box_id)),
    c AS (SELECT *, ps IS NOT NULL AND s < pe AND e > ps AS ov FROM l), x AS (SELECT *, CASE WHEN ov THEN least(ps, s) ELSE s END AS lft, CASE WHEN ov THEN greatest(pe, e) ELSE e END AS rgt FROM c)
    SELECT page_id, box_id, CASE WHEN ps IS NULL THEN NOT (ss - lft < 10) ELSE NOT (CASE WHEN ov THEN abs(rgt - pse) < 10 ELSE abs(pe - pse) < 10 END AND ss - lft < 10 AND pn > 1 AND CASE WHEN ov THEN 0 ELSE abs(s - pe) END < greatest(pw, w)) END AS seg_start_flag,
      NOT (rgt - se < 10) AS seg_end_flag FROM x""",
)
def _(spark, d):
    rows = boxes(spark, d).selectExpr(
        "page_id", "box_id", "box_id AS order_index", "x1 AS start", "x2 AS end", "x1 + box_id % 4 * 6 AS seg_start", "x2 - score % 4 * 6 AS seg_end", "x2 - x1 AS width", "box_id % 3 + 1 AS num_of_lines"
    )
    return sequence.segment_flags(rows).select("page_id", "box_id", "seg_start_flag", "seg_end_flag")


@query("reading_index", f"{WITH} SELECT page_id, box_id, label, CASE WHEN label IN ('text', 'paragraph_title', 'table') THEN CAST(sum(CAST(label IN ('text', 'paragraph_title', 'table') AS INT)) OVER (PARTITION BY page_id ORDER BY box_id ROWS UNBOUNDED PRECEDING) AS BIGINT) END AS order_index FROM fx QUALIFY order_index IS NOT NULL")
def _(spark, d):
    return sequence.number_in_order(boxes(spark, d), ("text", "paragraph_title", "table")).where("order_index IS NOT NULL").select("page_id", "box_id", "label", "order_index")


@query("page_batches", "SELECT doc_id, source, CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 8 AS BIGINT) AS batch_id FROM documents")
def _(spark, d):
    return sequence.batches(table(spark, d, "documents"), 8, "doc_id").select("doc_id", "source", "batch_id")


@query(
    "page_stitch",
    """WITH l AS (SELECT conv_id, turn, text, turn % 2 = 0 AS starts, lag(turn % 3 = 0) OVER (PARTITION BY conv_id ORDER BY turn) AS pe, lag(right(text, 1)) OVER (PARTITION BY conv_id ORDER BY turn) AS lc FROM conversations)
    SELECT conv_id, string_agg(CASE WHEN pe IS NULL THEN '' WHEN pe OR starts THEN chr(10) || chr(10) WHEN regexp_matches(lc, '[一-鿿]') AND regexp_matches(left(text, 1), '[一-鿿]') THEN '' ELSE ' ' END || text, '' ORDER BY turn) AS text FROM l GROUP BY conv_id""",
)
def _(spark, d):
    rows = table(spark, d, "conversations").selectExpr("conv_id", "turn AS page_index", "text", "turn % 2 = 0 AS starts", "turn % 3 = 0 AS ends")
    return sequence.stitch_pages(rows, "conv_id")


@query("word_boxes", f"{WITH} SELECT page_id, box_id, concat_ws(',', CAST(floor(x1) AS BIGINT), CAST(floor(x1 + 3 * ((x2 - x1) / 10.0)) AS BIGINT), CAST(floor(x1 + 4 * ((x2 - x1) / 10.0)) AS BIGINT), CAST(floor(x1 + 10 * ((x2 - x1) / 10.0)) AS BIGINT)) AS edges FROM fx")
def _(spark, d):
    word = lambda w, a, b: F.struct(F.lit(w).alias("word"), F.lit(a).alias("first"), F.lit(b).alias("last"))
    rows = sequence.word_boxes(boxes(spark, d).withColumns({"col_num": F.lit(10), "words": F.array(word("one", 0, 2), word("other", 4, 9))}))
    return rows.select("page_id", "box_id", F.array_join(F.flatten(F.transform("word_boxes", lambda w: F.array(w.x1.cast("string"), w.x2.cast("string")))), ",").alias("edges"))


_RUNS = r"[\x{4e00}-\x{9fff}]+|[a-zA-Z0-9][a-zA-Z0-9-]*(?:\.[0-9][a-zA-Z0-9-]*)*|[^a-zA-Z0-9\x{4e00}-\x{9fff}]+"


@query("word_runs", f"SELECT doc_id, CAST(len(r) AS INT) AS n_runs, CAST(len(list_filter(r, lambda x: regexp_matches(x, '^[a-zA-Z0-9]'))) AS INT) AS n_words FROM (SELECT doc_id, regexp_extract_all(text, '{_RUNS}') AS r FROM documents)")
def _(spark, d):
    rows = table(spark, d, "documents").select("doc_id", text.word_runs(F.col("text")).alias("runs"))
    return rows.select("doc_id", F.size("runs").alias("n_runs"), F.size(F.filter("runs", lambda r: r.rlike("^[a-zA-Z0-9]"))).alias("n_words"))


@query("rtl_reverse", "SELECT item_id, array_to_string(list_reverse(regexp_extract_all(text, '([a-zA-Z0-9 :*./%+-]+|[^a-zA-Z0-9 :*./%+-])')), '') AS text FROM benchmark")
def _(spark, d):
    return table(spark, d, "benchmark").select("item_id", text.latin_runs_reversed(F.col("text")).alias("text"))


# --- suppression and containment -------------------------------------------------------------


def _nms_sql(hides: str) -> str:
    return f"""{WITH}, p AS (SELECT page_id, list({{'s': -score, 'i': box_id, 'c': cls_id, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}} ORDER BY score DESC, box_id) AS e FROM fx GROUP BY page_id),
    k AS (SELECT page_id, list_reduce(list_transform(e, lambda v: [v]), lambda acc, c: CASE WHEN len(list_filter(acc, lambda k: {hides})) > 0 THEN acc ELSE list_concat(acc, c) END) AS kept FROM p)
    SELECT page_id, unnest(list_transform(kept, lambda v: v.i)) AS box_id FROM k"""


_PX = "(greatest(0, least(k.x2, c[1].x2) - greatest(k.x1, c[1].x1) + 1) * greatest(0, least(k.y2, c[1].y2) - greatest(k.y1, c[1].y1) + 1))"
_PXU = f"((k.x2 - k.x1 + 1) * (k.y2 - k.y1 + 1) + (c[1].x2 - c[1].x1 + 1) * (c[1].y2 - c[1].y1 + 1) - {_PX})"
_CI = "(greatest(0, least(k.x2, c[1].x2) - greatest(k.x1, c[1].x1)) * greatest(0, least(k.y2, c[1].y2) - greatest(k.y1, c[1].y1)))"
_CU = f"((k.x2 - k.x1) * (k.y2 - k.y1) + (c[1].x2 - c[1].x1) * (c[1].y2 - c[1].y1) - {_CI})"


@query("nms_class_aware", _nms_sql(f"{_PX} * 100 >= {_PXU} * CASE WHEN k.c = c[1].c THEN 20 ELSE 50 END"))
def _(spark, d):
    return detect.suppress(boxes(spark, d), 0.2, 0.5)


@query("nms_cells", _nms_sql(f"{_CI} * 10 > {_CU} * 3"))
def _(spark, d):
    return detect.suppress_cells(boxes(spark, d))


_IN = f"""{WITH}, c AS (SELECT p.page_id, p.box_id AS i, q.box_id AS o FROM fx p JOIN fx q ON p.page_id = q.page_id AND p.box_id <> q.box_id AND NOT (p.cls_id = 4 AND q.cls_id <> 4) WHERE {_inter('p', 'q')} * 10 >= 5 * {_area('p')}),
f AS (SELECT page_id, box_id, CAST(EXISTS (SELECT 1 FROM c WHERE c.page_id = fx.page_id AND c.o = fx.box_id) AS INT) AS contains_other, CAST(EXISTS (SELECT 1 FROM c WHERE c.page_id = fx.page_id AND c.i = fx.box_id) AS INT) AS contained_by_other FROM fx)"""


@query("containment_flags", f"{_IN} SELECT * FROM f")
def _(spark, d):
    return detect.containment(boxes(spark, d), 0.5, 4)


@query("merge_large", f"{_IN} SELECT page_id, box_id FROM f WHERE contained_by_other = 0")
def _(spark, d):
    return detect.merge(boxes(spark, d), "large", 0.5, 4).select("page_id", "box_id")


@query("merge_small", f"{_IN} SELECT page_id, box_id FROM f WHERE contains_other = 0 OR contained_by_other = 1")
def _(spark, d):
    return detect.merge(boxes(spark, d), "small", 0.5, 4).select("page_id", "box_id")


@query(
    "merge_by_class",
    f"""{WITH}, c AS (SELECT p.page_id, p.box_id AS i, q.box_id AS o, p.cls_id AS ci, q.cls_id AS co FROM fx p JOIN fx q ON p.page_id = q.page_id AND p.box_id <> q.box_id WHERE {_inter('p', 'q')} * 10 >= 5 * {_area('p')})
    SELECT page_id, box_id FROM fx WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.page_id = fx.page_id AND c.i = fx.box_id AND c.co = 3)
      AND (NOT EXISTS (SELECT 1 FROM c WHERE c.page_id = fx.page_id AND c.o = fx.box_id AND c.ci = 0) OR EXISTS (SELECT 1 FROM c WHERE c.page_id = fx.page_id AND c.i = fx.box_id AND c.ci = 0))""",
)
def _(spark, d):
    return detect.merge(boxes(spark, d), {3: "large", 0: "small", 2: "union"}, 0.5).select("page_id", "box_id")


_PAIRS = f"""{WITH}, pr AS (SELECT p.page_id, p.box_id AS i, q.box_id AS j, CASE WHEN (p.label = 'image') <> (q.label = 'image') THEN CASE WHEN p.label = 'image' THEN p.box_id ELSE q.box_id END WHEN {_area('p')} <= {_area('q')} THEN p.box_id ELSE q.box_id END AS d
  FROM fx p JOIN fx q ON p.page_id = q.page_id AND p.box_id < q.box_id WHERE {_inter('p', 'q')} * 2 > least({_area('p')}, {_area('q')})),
dr AS (SELECT page_id, unnest(list_reduce(list_prepend(CAST([] AS BIGINT[]), list_transform(list({{'i': i, 'j': j, 'd': d}} ORDER BY i, j), lambda c: [c.i, c.j, c.d])), lambda acc, c: CASE WHEN list_contains(acc, c[1]) OR list_contains(acc, c[2]) THEN acc ELSE list_append(acc, c[3]) END)) AS box_id FROM pr GROUP BY page_id)"""


@query("overlap_removal", f"{_PAIRS} SELECT page_id, box_id FROM fx WHERE NOT EXISTS (SELECT 1 FROM dr WHERE dr.page_id = fx.page_id AND dr.box_id = fx.box_id)")
def _(spark, d):
    return detect.remove_overlaps(boxes(spark, d)).select("page_id", "box_id")


@query(
    "shrink_overlaps",
    f"""{WITH}, l AS (SELECT *, lead(x1) OVER w AS nx1, lead(y1) OVER w AS ny1, lead(x2) OVER w AS nx2, lead(y2) OVER w AS ny2, lag(x1) OVER w AS px1, lag(y1) OVER w AS py1, lag(x2) OVER w AS px2, lag(y2) OVER w AS py2 FROM fx WINDOW w AS (PARTITION BY page_id ORDER BY y1, box_id)),
    i AS (SELECT *, greatest(0, least(x2, nx2) - greatest(x1, nx1)) * greatest(0, least(y2, ny2) - greatest(y1, ny1)) AS ni, greatest(0, least(x2, px2) - greatest(x1, px1)) * greatest(0, least(y2, py2) - greatest(y1, py1)) AS pi FROM l)
    SELECT page_id, box_id, x1, CASE WHEN py1 IS NOT NULL AND pi > 0 AND pi * 10 < least((x2 - x1) * (y2 - y1), (px2 - px1) * (py2 - py1)) THEN (greatest(y1, py1) + least(y2, py2)) // 2 + 1 ELSE y1 END AS y1, x2,
      CASE WHEN ny1 IS NOT NULL AND ni > 0 AND ni * 10 < least((x2 - x1) * (y2 - y1), (nx2 - nx1) * (ny2 - ny1)) THEN (greatest(y1, ny1) + least(y2, ny2)) // 2 - 1 ELSE y2 END AS y2 FROM i""",
)
def _(spark, d):
    return detect.shrink_overlaps(boxes(spark, d)).select("page_id", "box_id", *G.SIDES)


# --- sorts and top k -------------------------------------------------------------------------


@query(
    "two_column_sort",
    f"""{WITH}, s AS (SELECT *, CASE WHEN x1 < 600 AND x2 < 1440 THEN 0 WHEN x1 > 960 THEN 1 ELSE 2 END AS side FROM fx), b AS (SELECT *, sum(CAST(side = 2 AS INT)) OVER (PARTITION BY page_id ORDER BY y1, x1, box_id ROWS UNBOUNDED PRECEDING) - CAST(side = 2 AS INT) AS band FROM s)
    SELECT page_id, box_id, row_number() OVER (PARTITION BY page_id ORDER BY band, side, y1, x1, box_id) AS place FROM b""",
)
def _(spark, d):
    return order.two_column_order(boxes(spark, d), 2400)


@query("normal_sort", f"{WITH} SELECT page_id, box_id, row_number() OVER (PARTITION BY page_id ORDER BY y1 // 60, x1 // 200, (x1 + x2) * (x1 + x2) + (y1 + y2) * (y1 + y2), box_id) AS place FROM fx")
def _(spark, d):
    return order.normal_order(boxes(spark, d), 60, 200)


@query("child_sort", f"{WITH} SELECT page_id, box_id // 4 AS parent_block_id, box_id, row_number() OVER (PARTITION BY page_id, box_id // 4 ORDER BY y1, x1, box_id) AS place FROM fx")
def _(spark, d):
    return order.child_order(boxes(spark, d).withColumn("parent_block_id", F.floor(F.col("box_id") / 4).cast("long")))


@query("regions_by_area", f"{WITH} SELECT page_id, box_id, row_number() OVER (PARTITION BY page_id ORDER BY (x2 - x1) * (y2 - y1), box_id) AS place FROM fx")
def _(spark, d):
    return order.by_area(boxes(spark, d))


@query("topn_cells", f"{WITH} SELECT page_id, box_id, score FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, box_id) AS n FROM fx) WHERE n <= 3")
def _(spark, d):
    return detect.top_candidates(boxes(spark, d), 3).select("page_id", "box_id", "score")


@query("topk_classes", "WITH e AS (SELECT vec_id, unnest(embedding) AS s, generate_subscripts(embedding, 1) - 1 AS c FROM embeddings), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, c) AS place FROM e) SELECT vec_id, CAST(c AS INT) AS class_id, round(CAST(s AS DOUBLE), 5) AS score, CAST(place AS BIGINT) AS place FROM r WHERE place <= 5")
def _(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("scores"))
    return order.top_classes(rows, "scores", 5, "vec_id")


@query("argmax_class", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INT) AS class_id FROM embeddings")
def _(spark, d):
    return table(spark, d, "embeddings").select("vec_id", order.argmax(F.col("embedding")).alias("class_id"))


@query("reading_order")
def _(spark, d):
    return order.reading_order(boxes(spark, d))


@query("region_block_order")
def _(spark, d):
    own = blocks(spark, d)
    regions = spans(spark, d).withColumnRenamed("span_id", "region_id")
    return order.order_regions_and_blocks(own, regions, match.assign_regions(regions, own))


# --- set operations --------------------------------------------------------------------------


@query("union_formula_rows", f"{WITH} SELECT page_id, span_id AS id, 'text' AS label, score FROM spn UNION ALL SELECT page_id, box_id, 'formula', 100 FROM blk WHERE label = 'formula'")
def _(spark, d):
    found = spans(spark, d).select("page_id", F.col("span_id").alias("id"), F.lit("text").alias("label"), "score")
    return found.unionByName(blocks(spark, d).where("label = 'formula'").select("page_id", F.col("box_id").alias("id"), F.lit("formula").alias("label"), F.lit(100).cast("long").alias("score")))


@query("box_intersection", f"{WITH} SELECT p.page_id, p.box_id AS a, q.box_id AS b, greatest(p.x1, q.x1) AS x1, greatest(p.y1, q.y1) AS y1, least(p.x2, q.x2) AS x2, least(p.y2, q.y2) AS y2 FROM fx p JOIN fx q ON p.page_id = q.page_id AND p.box_id < q.box_id WHERE {_ix('p', 'q')} > 0 AND {_iy('p', 'q')} > 0")
def _(spark, d):
    common = G.intersection(G.box(table="p"), G.box(table="q"))
    joined = detect.pairs(boxes(spark, d), F.col("p.box_id") < F.col("q.box_id"))
    return joined.select(F.col("p.page_id").alias("page_id"), F.col("p.box_id").alias("a"), F.col("q.box_id").alias("b"), common.alias("c")).where("c IS NOT NULL").select("page_id", "a", "b", "c.*")


@query("distinct_matches", f"{WITH} SELECT DISTINCT s.page_id, s.span_id FROM blk b JOIN spn s ON b.page_id = s.page_id WHERE {_ix('b', 's')} > 3 AND {_iy('b', 's')} > 3")
def _(spark, d):
    return match.match(blocks(spark, d), spans(spark, d), "pixels").select("page_id", "span_id").distinct()


@query("overlap_modes", f"""{WITH} SELECT p.page_id, p.box_id AS a, q.box_id AS b, round(CAST({_inter('p', 'q')} AS DOUBLE) / ({_area('p')} + {_area('q')} - {_inter('p', 'q')}), 9) AS iou, round(CAST({_inter('p', 'q')} AS DOUBLE) / least({_area('p')}, {_area('q')}), 9) AS small,
  round(CAST({_inter('p', 'q')} AS DOUBLE) / greatest({_area('p')}, {_area('q')}), 9) AS large, round(CAST({_inter('p', 'q')} AS DOUBLE) / {_area('p')}, 9) AS first_, round(CASE WHEN {_ix('p', 'q')} <= 0 THEN 0 ELSE CAST({_ix('p', 'q')} AS DOUBLE) / (greatest(p.x2, q.x2) - least(p.x1, q.x1)) END, 9) AS proj
  FROM fx p JOIN fx q ON p.page_id = q.page_id AND p.box_id < q.box_id""")
def _(spark, d):
    a, b = G.box(table="p"), G.box(table="q")
    joined = detect.pairs(boxes(spark, d), F.col("p.box_id") < F.col("q.box_id"))
    return joined.select(
        F.col("p.page_id").alias("page_id"), F.col("p.box_id").alias("a"), F.col("q.box_id").alias("b"),
        *[F.round(G.overlap(a, b, m), 9).alias(n) for m, n in (("union", "iou"), ("small", "small"), ("large", "large"), ("first", "first_"))],
        F.round(G.projection_overlap(a, b), 9).alias("proj"),
    )


# --- text and markup -------------------------------------------------------------------------

_LINES = "SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INT) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents"


def _lines(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


@query(
    "title_format",
    f"""WITH l AS ({_LINES}), n AS (SELECT doc_id, pos, CASE WHEN pos % 4 = 0 THEN CAST(pos + 1 AS VARCHAR) || '.2 ' || line WHEN pos % 4 = 1 THEN 'IV.' || line WHEN pos % 4 = 2 THEN '(3)  ' || line ELSE line END AS t FROM l),
    m AS (SELECT *, '^\\s*((?:[1-9][0-9]*(?:\\.[1-9][0-9]*)*[\\.、]?|[\\(（](?:[1-9][0-9]*|[一二三四五六七八九十百千万亿零壹贰叁肆伍陆柒捌玖拾]+)[\\)）]|[一二三四五六七八九十百千万亿零壹贰叁肆伍陆柒捌玖拾]+[、\\.]?|(?:I|II|III|IV|V|VI|VII|VIII|IX|X)\\.?))(\\s*)(.*)$' AS re FROM n),
    s AS (SELECT doc_id, pos, rtrim(CASE WHEN regexp_matches(t, re) THEN trim(regexp_extract(t, re, 1)) || ' ' || ltrim(regexp_extract(t, re, 3)) ELSE t END, '.') AS b FROM m)
    SELECT doc_id, pos, repeat('#', CAST(length(b) - length(replace(b, '.', '')) + 2 AS BIGINT)) || ' ' || b AS title FROM s""",
)
def _(spark, d):
    line, pos = F.col("line"), F.col("pos")
    numbered = F.when(pos % 4 == 0, F.concat((pos + 1).cast("string"), F.lit(".2 "), line)).when(pos % 4 == 1, F.concat(F.lit("IV."), line)).when(pos % 4 == 2, F.concat(F.lit("(3)  "), line)).otherwise(line)
    return _lines(spark, d).select("doc_id", "pos", text.title(numbered).alias("title"))


@query(
    "markdown_blocks",
    f"""{WITH} SELECT page_id, box_id, CASE label WHEN 'paragraph_title' THEN '## ' || c WHEN 'text' THEN c WHEN 'image' THEN '![](imgs/img_in_image_box_' || x1 || '_' || y1 || '_' || x2 || '_' || y2 || '.jpg)' WHEN 'formula' THEN '$$' || c || '$$' WHEN 'table' THEN chr(10) || chr(10) || c END AS md
    FROM (SELECT *, 'block ' || box_id AS c FROM fx)""",
)
def _(spark, d):
    content = F.concat(F.lit("block "), F.col("box_id"))
    return boxes(spark, d).select("page_id", "box_id", text.block_markdown(F.col("label"), content, G.box()).alias("md"))


@query("centered_title", f"{WITH} SELECT page_id, box_id, '<div style=\"text-align: center;\">' || label || ' ' || box_id || '</div>' || chr(10) AS md FROM fx")
def _(spark, d):
    return boxes(spark, d).select("page_id", "box_id", text.centered(F.concat("label", F.lit("\n"), "box_id")).alias("md"))


@query("scaled_image", f"{WITH} SELECT page_id, box_id, '<img src=\"imgs/img_in_image_box_' || x1 || '_' || y1 || '_' || x2 || '_' || y2 || '.jpg\" alt=\"Image\" width=\"' || CAST(floor((x2 - x1) * 100 / 2400.0) AS BIGINT) || '%\" />' AS md FROM fx WHERE label = 'image'")
def _(spark, d):
    rows = boxes(spark, d).where("label = 'image'")
    return rows.select("page_id", "box_id", text.image_tag(text.image_path(F.col("label"), G.box()), G.width(G.box()), F.lit(2400)).alias("md"))


@query(
    "chart_table",
    """WITH c AS (SELECT conv_id, string_agg(role || '|' || turn || '|' || length(text), chr(10) ORDER BY turn, text) AS t FROM conversations GROUP BY conv_id)
    SELECT conv_id, array_to_string(list_transform(list_concat(list_concat([string_split(t, chr(10))[1]], ['---|---|---']), string_split(t, chr(10))[2:]), lambda l: '|' || l || '|'), chr(10)) AS md FROM c""",
)
def _(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", F.struct("turn", "text").alias("o"), F.concat_ws("|", "role", "turn", F.length("text")).alias("line"))
    chart = summary.joined_text(rows, "conv_id", order="o", text="line", separator="\n")
    return chart.select("conv_id", text.chart_table(F.col("text")).alias("md"))


@query("first_line_heading", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN chr(10) || '## Abstract' || chr(10) ELSE 'References' || chr(10) END || text AS text FROM documents")
def _(spark, d):
    marked = F.concat(F.when(F.col("doc_id") % 2 == 0, "\nAbstract\n").otherwise("References\n"), F.col("text"))
    return table(spark, d, "documents").select("doc_id", text.first_line_heading(marked, ("abstract", "摘要")).alias("text"))


@query("strip_html_body", "SELECT page_id, chr(10) || replace(replace(replace(replace(html, '<html>', ''), '</html>', ''), '<body>', ''), '</body>', '') AS body FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", text.table_body(F.col("html")).alias("body"))


@query("html_tokens", "SELECT page_id, len(t) AS n_tokens, len(list_filter(t, lambda x: x LIKE '<%')) AS n_tags, t[1] AS first_token FROM (SELECT page_id, regexp_extract_all(html, '(<[^>]+>|[^<]+)', 1) AS t FROM pages)")
def _(spark, d):
    rows = table(spark, d, "pages").select("page_id", markup.tokens(F.col("html")).alias("t"))
    return rows.select("page_id", F.size("t").cast("long").alias("n_tokens"), F.size(F.filter("t", lambda x: x.startswith("<"))).cast("long").alias("n_tags"), F.element_at("t", 1).alias("first_token"))


def _structure(spark, d):
    """A two-column table structure per page with as many cells as boxes."""
    cell = F.when(F.col("box_id") % 2 == 1, F.array(F.lit("<tr>"), F.lit("<td></td>"))).otherwise(F.array(F.lit("<td></td>"), F.lit("</tr>")))
    rows = boxes(spark, d).groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("box_id", cell.alias("t")))).alias("c"))
    return rows.select(F.col("page_id").alias("table_id"), F.flatten(F.transform("c", lambda x: x.t)).alias("structure"))


def _cell_texts(spark, d):
    return boxes(spark, d).where("box_id % 3 > 0").select(F.col("page_id").alias("table_id"), (F.col("box_id") - 1).alias("cell_id"), F.col("score").alias("span_id"), F.col("label").alias("text"))


@query("html_fill", f"{WITH} SELECT page_id AS table_id, string_agg(CASE WHEN box_id % 2 = 1 THEN '<tr>' ELSE '' END || '<td>' || CASE WHEN box_id % 3 > 0 THEN label ELSE '' END || '</td>' || CASE WHEN box_id % 2 = 0 THEN '</tr>' ELSE '' END, '' ORDER BY box_id) AS html FROM fx GROUP BY page_id")
def _(spark, d):
    return markup.fill_cells(_structure(spark, d), _cell_texts(spark, d))


@query("html_grid", f"{WITH} SELECT page_id AS table_id, CAST((box_id - 1) // 2 AS INT) AS row, CAST((box_id - 1) % 2 AS INT) AS place, CASE WHEN box_id % 3 > 0 THEN label ELSE '' END AS text, 1 AS colspan, 1 AS rowspan FROM fx WHERE box_id <= (SELECT max(f.box_id) // 2 * 2 FROM fx f WHERE f.page_id = fx.page_id)")
def _(spark, d):
    return markup.grid(markup.fill_cells(_structure(spark, d), _cell_texts(spark, d)))


@query("row_first_cells", f"{WITH} SELECT page_id AS table_id, string_agg(CAST(box_id - 1 AS VARCHAR), ',' ORDER BY box_id) AS starts FROM fx WHERE box_id % 2 = 1 GROUP BY page_id")
def _(spark, d):
    starts = markup.first_cells(F.transform("structure", lambda t: F.when(t == "<td></td>", "<td>").otherwise(t)))
    return _structure(spark, d).select("table_id", F.array_join(F.transform(starts, lambda x: x.cast("string")), ",").alias("starts"))


def _grid_sql(axis: str) -> str:
    """Grid lines of an axis, and the line nearest to each cell's edges."""
    a, b = f"{axis}1", f"{axis}2"
    nearest = "list_position(list_transform(g, lambda c: abs(c - {0})), list_min(list_transform(g, lambda c: abs(c - {0})))) - 1"
    return f"""{axis}e AS (SELECT page_id, {a} AS pos FROM fx UNION SELECT page_id, {b} FROM fx),
    {axis}s AS (SELECT page_id, pos, CASE WHEN pos - lag(pos) OVER (PARTITION BY page_id ORDER BY pos) <= 20 THEN 0 ELSE 1 END AS st FROM {axis}e),
    {axis}k AS (SELECT page_id, pos, sum(st) OVER (PARTITION BY page_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS k FROM {axis}s),
    {axis}g AS (SELECT page_id, list(c ORDER BY k) AS g FROM (SELECT page_id, k, avg(pos) AS c FROM {axis}k GROUP BY page_id, k) GROUP BY page_id),
    {axis}p AS (SELECT page_id, box_id, {nearest.format(a)} AS {axis}a, {nearest.format(b)} AS {axis}b FROM fx JOIN {axis}g USING (page_id))"""


@query(
    "cells_to_html",
    f"""{WITH}, {_grid_sql("x")}, {_grid_sql("y")},
    cell AS (SELECT page_id, box_id, label, ya AS r, xa AS c, greatest(yb - ya, 1) AS rs, greatest(xb - xa, 1) AS cs FROM fx JOIN xp USING (page_id, box_id) JOIN yp USING (page_id, box_id) QUALIFY row_number() OVER (PARTITION BY page_id, ya, xa ORDER BY box_id) = 1),
    tr AS (SELECT page_id, r, string_agg('<td' || CASE WHEN rs > 1 THEN ' rowspan="' || rs || '"' ELSE '' END || CASE WHEN cs > 1 THEN ' colspan="' || cs || '"' ELSE '' END || '>' || label || '</td>', '' ORDER BY c) AS tds, max(c + cs) AS w FROM cell GROUP BY page_id, r)
    SELECT page_id, '<html><body><table>' || string_agg('<tr>' || tds || '</tr>', '' ORDER BY r) || '</table></body></html>' AS html, count(*) AS n_rows, CAST(max(w) AS INT) AS n_cols FROM tr GROUP BY page_id""",
)
def _(spark, d):
    return markup.cells_to_html(boxes(spark, d).withColumn("text", F.col("label")), 20)


@query("css_styles", f"{WITH} SELECT page_id, box_id, CAST(x1 AS VARCHAR) || 'px' AS lft, 'bold' AS weight FROM fx")
def _(spark, d):
    s = markup.styles(F.concat(F.lit("left: "), F.col("x1"), F.lit("px; Font-Weight:bold;")))
    return boxes(spark, d).select("page_id", "box_id", s["left"].alias("lft"), s["font-weight"].alias("weight"))


@query("token_decode", f"WITH e AS (SELECT user_id, event_id, ts, event_type, min(CASE WHEN event_type = 'error' THEN event_id END) OVER (PARTITION BY user_id) AS stop FROM events) SELECT user_id, string_agg(event_type, ' ' ORDER BY event_id) FILTER (stop IS NULL OR event_id < stop) AS tokens FROM e GROUP BY user_id")
def _(spark, d):
    rows = table(spark, d, "events").groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda x: x.event_type).alias("t"))
    return rows.select("user_id", F.nullif(F.array_join(markup.until_end(F.col("t"), "error"), " "), F.lit("")).alias("tokens"))


_WORDY = r"\\(?:operatorname|mathrm|text|mathbf)\s?\*? \{.*?\}"
_PARTED = r"(regexp_matches(acc, '[^\p{L}\\\s]$') AND regexp_matches(t, '^([^\p{L}]|[a-zA-Z])')) OR (regexp_matches(acc, '[a-zA-Z]$') AND regexp_matches(t, '^[^\p{L}]'))"


@query(
    "latex_normalise",
    rf"""WITH a AS (SELECT item_id, replace(regexp_replace('\frac {{ a }} {{ b }} + \operatorname {{ a r g }} \ x  y _ 2 ' || '\text{{中文}} ' || text, '\\text\s*\{{([^{{}}]*[\x{{4e00}}-\x{{9fff}}][^{{}}]*)\}}', '\1', 'g'), '"', '') AS s FROM benchmark),
    b AS (SELECT item_id, string_split_regex(s, '{_WORDY}') AS rest, list_prepend('', list_transform(regexp_extract_all(s, '{_WORDY}'), lambda m: replace(m, ' ', ''))) AS found FROM a),
    c AS (SELECT item_id, regexp_replace(array_to_string(list_transform(rest, lambda r, i: found[i] || r), ''), '\s+', ' ', 'g') AS s FROM b)
    SELECT item_id, list_reduce(string_split(s, ' '), lambda acc, t: acc || CASE WHEN {_PARTED} THEN '' ELSE ' ' END || t) AS latex FROM c""",
)
def _(spark, d):
    return table(spark, d, "benchmark").select("item_id", text.tighten_latex(text.remove_cjk_text(F.concat(F.lit(r"\frac { a } { b } + \operatorname { a r g } \ x  y _ 2 \text{中文} "), F.col("text")))).alias("latex"))


_LAST = "right(acc, 1)"


@query(
    "line_join",
    f"""SELECT doc_id, list_reduce(string_split(text, chr(10)), lambda acc, l: CASE WHEN acc = '' THEN l ELSE CASE WHEN {_LAST} = '-' THEN left(acc, length(acc) - 1) ELSE acc END
      || CASE WHEN {_LAST} = '-' THEN '' WHEN doc_id % 2 = 1 THEN chr(10) WHEN regexp_matches({_LAST}, '[A-Za-z0-9,.;:]') THEN ' ' ELSE '' END || l END) AS text FROM documents""",
)
def _(spark, d):
    rows = table(spark, d, "documents")
    return rows.select("doc_id", text.join_lines(F.split("text", "\n"), F.when(F.col("doc_id") % 2 == 0, "text").otherwise("content")).alias("text"))


# --- scores, sizes, routing ------------------------------------------------------------------


@query("resize_rules", f"""{WITH}, s AS (SELECT page_id, box_id, x2 - x1 AS w, y2 - y1 AS h FROM fx), r AS (SELECT *, CASE WHEN greatest(w, h) > 300 THEN 300.0 / greatest(w, h) ELSE 1.0 END AS k FROM s)
SELECT page_id, box_id, CAST(greatest(floor(floor(w * k) / 32 + 0.5) * 32, 32) AS BIGINT) AS width, CAST(greatest(floor(floor(h * k) / 32 + 0.5) * 32, 32) AS BIGINT) AS height, CAST(least(ceil(48 * (CAST(w AS DOUBLE) / h)), 200) AS BIGINT) AS rec_width FROM r""")
def _(spark, d):
    w, h = G.width(G.box()), G.height(G.box())
    size = G.target_size(w, h, 300)
    return boxes(spark, d).select("page_id", "box_id", size.width.alias("width"), size.height.alias("height"), G.recognition_width(w, h, cap=200).alias("rec_width"))


@query("score_normalise", f"{WITH} SELECT page_id, box_id, round(1 - score / 100.0, 6) AS unit FROM fx")
def _(spark, d):
    return boxes(spark, d).select("page_id", "box_id", F.round(G.normalise_score(F.col("score"), 0, 100, True), 6).alias("unit"))


@query("score_ranges", "SELECT item_id, CAST(item_id AS DOUBLE) AS low, CAST(100 AS DOUBLE) AS high, TRUE AS low_approximate, FALSE AS high_approximate FROM benchmark")
def _(spark, d):
    rng = G.parse_range(F.concat(F.lit("~"), F.col("item_id"), F.lit(", 100")))
    return table(spark, d, "benchmark").select("item_id", rng.alias("r")).select("item_id", "r.*")


@query("quality_route", "SELECT l.doc_id, CASE WHEN l.quality = 0 THEN 'reject' WHEN d.n_chars < 500 THEN 'lite' ELSE 'full' END AS route FROM labels l JOIN documents d ON l.doc_id = d.doc_id")
def _(spark, d):
    rows = table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id")
    return rows.select("doc_id", models.route(F.col("quality"), F.col("n_chars"), 0.5, 500).alias("route"))


@query("lang_model", "SELECT doc_id, CASE lang WHEN 'en' THEN 'en_v5_mobile_rec' ELSE 'latin_v5_mobile_rec' END AS model, CASE lang WHEN 'en' THEN 'eslav_v5_mobile_rec' WHEN 'de' THEN 'v5_server_rec' END AS other FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", text.model_of_language(F.col("lang"), "v5", "latin_v5_mobile_rec").alias("model"), text.model_of_language(F.when(F.col("lang") == "en", "uk").when(F.col("lang") == "de", "zh"), "v5").alias("other"))


@query("props_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query("json_export", f"{WITH} SELECT page_id, CAST(to_json({{'page_index': page_id, 'parsing_res_list': list({{'block_label': label, 'block_content': label || ' ' || box_id, 'block_bbox': [x1, y1, x2, y2]}} ORDER BY box_id)}}) AS VARCHAR) AS json FROM fx GROUP BY page_id")
def _(spark, d):
    return document.to_json(boxes(spark, d).withColumns({"block_content": F.concat("label", F.lit(" "), "box_id"), "order_index": F.col("box_id")}))


@query("model_stub", f"{WITH} SELECT page_id, box_id, ['text', 'paragraph_title', 'image', 'table'][((x2 - x1) * 7 + (y2 - y1) * 3) % 4 + 1] AS label, CAST(((x2 - x1) * (y2 - y1)) % 101 AS DOUBLE) / 100 AS score FROM fx")
def _(spark, d):
    return models.predict(boxes(spark, d).select("page_id", "box_id", *G.SIDES), models.StubDetector(), "page_id long, box_id long, label string, score double")


@query("document_assembly")
def _(spark, d):
    return flagship(spark, d)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks kept by suppression and overlap removal, matched to spans, their text in reading order, per page."""
    return document.assemble(blocks(spark, sf_dir), spans(spark, sf_dir))


_sql["document_assembly"] = f"""{WITH}, p AS (SELECT page_id, list({{'i': box_id, 'c': cls_id, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}} ORDER BY score DESC, box_id) AS e FROM blk GROUP BY page_id),
k AS (SELECT page_id, unnest(list_transform(list_reduce(list_transform(e, lambda v: [v]), lambda acc, c: CASE WHEN len(list_filter(acc, lambda k: {_PX} * 100 >= {_PXU} * CASE WHEN k.c = c[1].c THEN 60 ELSE 98 END)) > 0 THEN acc ELSE list_concat(acc, c) END), lambda v: v.i)) AS box_id FROM p),
n AS (SELECT blk.* FROM blk JOIN k ON blk.page_id = k.page_id AND blk.box_id = k.box_id),
pr AS (SELECT p.page_id, p.box_id AS i, q.box_id AS j, CASE WHEN (p.label = 'image') <> (q.label = 'image') THEN CASE WHEN p.label = 'image' THEN p.box_id ELSE q.box_id END WHEN {_area('p')} <= {_area('q')} THEN p.box_id ELSE q.box_id END AS d
  FROM n p JOIN n q ON p.page_id = q.page_id AND p.box_id < q.box_id WHERE {_inter('p', 'q')} * 2 > least({_area('p')}, {_area('q')})),
dr AS (SELECT page_id, unnest(list_reduce(list_prepend(CAST([] AS BIGINT[]), list_transform(list({{'i': i, 'j': j, 'd': d}} ORDER BY i, j), lambda c: [c.i, c.j, c.d])), lambda acc, c: CASE WHEN list_contains(acc, c[1]) OR list_contains(acc, c[2]) THEN acc ELSE list_append(acc, c[3]) END)) AS box_id FROM pr GROUP BY page_id),
b AS (SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM dr WHERE dr.page_id = n.page_id AND dr.box_id = n.box_id)),
m AS (SELECT b.page_id, b.box_id, s.span_id, s.text, s.y1, s.x1 FROM b JOIN spn s ON b.page_id = s.page_id WHERE b.label NOT IN ('formula', 'table', 'seal') AND {_inter('b', 's')} * 10 > least({_area('b')}, {_area('s')})),
t AS (SELECT page_id, box_id, string_agg(text, ' ' ORDER BY y1, x1, span_id) AS content FROM m GROUP BY page_id, box_id)
SELECT b.page_id, string_agg(coalesce(t.content, b.label), chr(10) || chr(10) ORDER BY b.y1, b.x1, b.box_id) AS text, count(*) AS n_blocks FROM b LEFT JOIN t ON b.page_id = t.page_id AND b.box_id = t.box_id GROUP BY b.page_id"""


def queries() -> dict[str, Query]:
    from pagewright.plans import chain_queries  # noqa: F401  adds its own

    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    from pagewright.plans import chain_queries  # noqa: F401

    return dict(_sql)

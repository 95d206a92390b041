"""Queries of the parsing chains, their parts and their results, and the SQL that must return the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.operators import match, models, sequence, summary
from pagewright.plans import chains, document
from pagewright.plans.catalogue import _ON_LINE, _area, _inter, _sql, query
from pagewright.plans.fixtures import WITH, blocks, boxes, spans, table

_BRIDGE = f"br AS (SELECT b.page_id, b.box_id, s.span_id FROM blk b JOIN spn s ON b.page_id = s.page_id WHERE b.label NOT IN ('formula', 'table', 'seal') AND {_inter('b', 's')} * 10 > least({_area('b')}, {_area('s')}))"


# --- parts -----------------------------------------------------------------------------------


@query("confidence_filter", f"{WITH} SELECT page_id, span_id, score FROM spn WHERE score >= 95")
def _(spark, d):
    return chains.confident(spans(spark, d), 95).select("page_id", "span_id", "score")


@query("aspect_batches", f"{WITH} SELECT page_id, box_id, (k - 1) // 3 AS batch, (k - 1) % 3 AS place FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY (x2 - x1)::DOUBLE / (y2 - y1), box_id) AS k FROM fx)")
def _(spark, d):
    return chains.aspect_batches(boxes(spark, d), 3)


@query(
    "page_zip",
    f"""{WITH}, b AS (SELECT page_id, count(*) AS n_blocks, string_agg(box_id || label, ',' ORDER BY box_id) AS blocks FROM blk GROUP BY page_id), s AS (SELECT page_id, count(*) AS n_spans, string_agg(span_id || text, ',' ORDER BY span_id) AS spans FROM spn GROUP BY page_id)
    SELECT coalesce(b.page_id, s.page_id) AS page_id, coalesce(n_blocks, 0) AS n_blocks, coalesce(n_spans, 0) AS n_spans, coalesce(blocks, '') AS blocks, coalesce(spans, '') AS spans FROM b FULL JOIN s ON b.page_id = s.page_id""",
)
def _(spark, d):
    zipped = chains.zip_pages(b=blocks(spark, d).select("page_id", "box_id", "label"), s=spans(spark, d).select("page_id", "span_id", "text"))
    b, s = F.transform("b", lambda x: F.concat(x.box_id, x.label)), F.transform("s", lambda x: F.concat(x.span_id, x.text))
    return zipped.select("page_id", F.size("b").cast("long").alias("n_blocks"), F.size("s").cast("long").alias("n_spans"), F.array_join(b, ",").alias("blocks"), F.array_join(s, ",").alias("spans"))


@query(
    "multi_block_split",
    f"""{WITH}, {_BRIDGE}, n AS (SELECT *, count(*) OVER (PARTITION BY page_id, span_id) AS n FROM br),
    part AS (SELECT n.page_id, n.box_id, n.span_id, greatest(b.x1, s.x1) AS x1, greatest(b.y1, s.y1) AS y1, least(b.x2, s.x2) AS x2, least(b.y2, s.y2) AS y2 FROM n JOIN blk b USING (page_id, box_id) JOIN spn s USING (page_id, span_id) WHERE n > 1),
    p AS (SELECT * FROM part WHERE x1 < x2 AND y1 < y2),
    r AS (SELECT n.page_id, n.box_id, n.span_id, s.x1, s.y1, s.x2, s.y2, s.text, EXISTS (SELECT 1 FROM p WHERE p.page_id = n.page_id AND p.box_id = n.box_id AND {_inter("s", "p")} * 10 > 8 * least({_area("s")}, {_area("p")})) AS hidden FROM n JOIN spn s USING (page_id, span_id) WHERE n = 1)
    SELECT page_id, box_id, span_id, x1, y1, x2, y2, (x2 - x1) || 'x' || (y2 - y1) AS text, 'part' AS kind FROM p
    UNION ALL SELECT page_id, box_id, span_id, x1, y1, x2, y2, CASE WHEN hidden THEN '' ELSE text END, CASE WHEN hidden THEN 'cleared' ELSE 'whole' END FROM r""",
)
def _(spark, d):
    read = lambda b: F.struct(F.concat(b.x2 - b.x1, F.lit("x"), b.y2 - b.y1).alias("text"), F.lit(1.0).alias("score"))
    return chains.split_between_blocks(spans(spark, d), blocks(spark, d), read)


@query(
    "relabel_direct",
    f"""{WITH}, w AS (SELECT *, max(CASE WHEN label IN ('text', 'paragraph_title', 'doc_title') THEN y2 END) OVER p AS low, count(CASE WHEN label = 'paragraph_title' THEN 1 END) OVER p AS titles, max((x2 - x1) * (y2 - y1)) OVER p AS largest FROM fx WINDOW p AS (PARTITION BY page_id))
    SELECT page_id, box_id, CASE WHEN label = 'footnote' AND y2 < low THEN 'text' WHEN label = 'paragraph_title' AND titles = 1 AND (x2 - x1) * (y2 - y1) * 10 > largest * 3 THEN 'doc_title' ELSE label END AS label FROM w""",
)
def _(spark, d):
    return chains.relabel_direct(boxes(spark, d)).select("page_id", "box_id", "label")


@query(
    "block_lines",
    f"""{WITH.replace("WITH fx", "WITH RECURSIVE fx")}, j AS (SELECT b.page_id, b.box_id, s.span_id, s.x1, s.y1, s.x2, s.y2 FROM blk b JOIN spn s ON b.page_id = s.page_id WHERE b.box_id % 4 = 1),
    o AS (SELECT *, row_number() OVER (PARTITION BY page_id, box_id ORDER BY y1, span_id) AS k FROM j),
    r AS (SELECT page_id, box_id, span_id, x1, x2, y1, y2, k, y1 AS lo, y2 AS hi, 1 AS line FROM o WHERE k = 1
      UNION ALL SELECT o.page_id, o.box_id, o.span_id, o.x1, o.x2, o.y1, o.y2, o.k, CASE WHEN {_ON_LINE.format(">=")} THEN least(r.lo, o.y1) ELSE o.y1 END, CASE WHEN {_ON_LINE.format(">=")} THEN greatest(r.hi, o.y2) ELSE o.y2 END, CASE WHEN {_ON_LINE.format(">=")} THEN r.line ELSE r.line + 1 END FROM r JOIN o ON o.page_id = r.page_id AND o.box_id = r.box_id AND o.k = r.k + 1),
    l AS (SELECT page_id, box_id, line, max(x2) - min(x1) AS w, max(y2) - min(y1) AS h, arg_min(x1, (x1, span_id)) AS first, arg_max(x2, (x1, span_id)) AS last FROM r GROUP BY page_id, box_id, line)
    SELECT page_id, box_id, CAST(count(*) AS INT) AS lines, avg(w) AS line_width, avg(h) AS line_height, CAST(arg_min(first, line) AS DOUBLE) AS seg_start, CASE WHEN count(*) > 1 THEN CAST(arg_max(last, line) AS DOUBLE) END AS seg_end FROM l GROUP BY page_id, box_id""",
)
def _(spark, d):
    bridge = blocks(spark, d).where("box_id % 4 = 1").select("page_id", "box_id").join(spans(spark, d).select("page_id", "span_id"), "page_id")
    return chains.lines_of_blocks(spans(spark, d), bridge)


@query("upright_boxes", f"""{WITH} SELECT page_id, box_id, CASE page_id % 4 WHEN 1 THEN y1 WHEN 2 THEN 3000 - x2 WHEN 3 THEN 2000 - y2 ELSE x1 END AS x1, CASE page_id % 4 WHEN 1 THEN 3000 - x2 WHEN 2 THEN 2000 - y2 WHEN 3 THEN x1 ELSE y1 END AS y1,
    CASE page_id % 4 WHEN 1 THEN y2 WHEN 2 THEN 3000 - x1 WHEN 3 THEN 2000 - y1 ELSE x2 END AS x2, CASE page_id % 4 WHEN 1 THEN 3000 - x1 WHEN 2 THEN 2000 - y1 WHEN 3 THEN x2 ELSE y2 END AS y2 FROM fx""")  # fmt: skip
def _(spark, d):
    return chains.preprocess(boxes(spark, d), F.col("page_id") % 4 * 90, F.lit(3000), F.lit(2000)).select("page_id", "box_id", *G.SIDES)


# --- chains ----------------------------------------------------------------------------------


@query(
    "ocr_chain",
    f"""SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY place) AS span_id, box_id, (x2 - x1) || 'x' || (y2 - y1) AS text, 1.0::DOUBLE AS score, x1, y1, x2, y2 FROM ({_sql["quad_sort"]}) JOIN ({WITH} SELECT * FROM fx) USING (page_id, box_id)""",
)
def _(spark, d):
    return chains.recognise_pages(boxes(spark, d), models.StubRecogniser(), 0.5, 30)


for _label in ("formula", "seal"):

    @query(f"{_label}_chain", f"{WITH} SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY box_id) AS region_no, box_id, (x2 - x1) || 'x' || (y2 - y1) AS text, 1.0::DOUBLE AS score FROM fx WHERE label = '{'formula' if _label == 'formula' else 'image'}'")
    def _(spark, d, label=_label):
        rows = boxes(spark, d)
        if label == "seal":
            rows = rows.withColumn("label", F.when(F.col("label") == "image", "seal").otherwise(F.col("label")))
        return chains.recognise_regions(rows, label, models.StubRecogniser(), "text")


@query(
    "classification_chain",
    f"""{WITH}, c AS (SELECT page_id, box_id, list_sort([{{'neg': -((x1 % 97) / 97.0::DOUBLE), 'id': 0}}, {{'neg': -((y1 % 89) / 97.0::DOUBLE), 'id': 1}}, {{'neg': -((x2 % 83) / 97.0::DOUBLE), 'id': 2}}, {{'neg': -((y2 % 79) / 97.0::DOUBLE), 'id': 3}}])[1:2] AS b FROM fx)
    SELECT page_id, box_id, b[1].id || ',' || b[2].id AS ids, ['none', 'left', 'half', 'right'][b[1].id + 1] AS best, round(-b[1].neg, 5) AS score FROM c""",
)
def _(spark, d):
    scores = F.array(*[F.col(c) % n / F.lit(97.0) for c, n in (("x1", 97), ("y1", 89), ("x2", 83), ("y2", 79))])
    found = chains.classify(boxes(spark, d).withColumn("s", scores), "s", ["none", "left", "half", "right"], 2, "page_id", "box_id")
    return found.select("page_id", "box_id", F.array_join("class_ids", ",").alias("ids"), F.col("label_names")[0].alias("best"), F.col("scores")[0].alias("score"))


#: Structures with as many cells as blocks: rows of two, three framing tokens at either end.
_FRAME = ["<html>", "<body>", "<table>"], ["</table>", "</body>", "</html>"]


@query(
    "table_assembly",
    f"""{WITH.replace("WITH fx", "WITH RECURSIVE fx")}, sp AS (SELECT page_id, span_id, text, x1 + 20 AS x1, y1, x1 + 60 AS x2, y1 + 20 AS y2 FROM spn),
    o AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY y1, box_id) AS k FROM blk),
    r AS (SELECT page_id, box_id, x1, k, y1 AS lo, 1 AS line FROM o WHERE k = 1 UNION ALL SELECT o.page_id, o.box_id, o.x1, o.k, CASE WHEN abs(o.y1 - r.lo) <= 30 THEN r.lo ELSE o.y1 END, CASE WHEN abs(o.y1 - r.lo) <= 30 THEN r.line ELSE r.line + 1 END FROM r JOIN o ON o.page_id = r.page_id AND o.k = r.k + 1),
    cell AS (SELECT page_id, box_id, line, row_number() OVER (PARTITION BY page_id ORDER BY line, x1, box_id) - 1 AS n FROM r),
    flag AS (SELECT page_id, line, min(n) AS flag FROM cell GROUP BY page_id, line),
    td AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY box_id) - 1 AS td, count(*) OVER (PARTITION BY page_id) AS total FROM blk),
    st AS (SELECT td.page_id, td.td AS start, td.total, (SELECT max(flag) FROM flag WHERE flag.page_id = td.page_id AND flag.flag <= td.td) AS flag FROM td WHERE td.td % 2 = 0),
    st2 AS (SELECT *, coalesce(lead(flag) OVER (PARTITION BY page_id ORDER BY start), total) AS until FROM st),
    want AS (SELECT td.page_id, td.td, s.flag + td.td - s.start AS n FROM td JOIN st2 s ON s.page_id = td.page_id AND s.start = td.td // 2 * 2 WHERE s.flag + td.td - s.start < s.until),
    hit AS (SELECT c.page_id, c.n, list(s.text ORDER BY s.span_id) AS t FROM cell c JOIN blk b USING (page_id, box_id) JOIN sp s ON s.page_id = b.page_id AND {_inter("b", "s")} * 10 > 7 * {_area("s")} GROUP BY c.page_id, c.n),
    txt AS (SELECT w.page_id, w.td, array_to_string(h.t, ' ') AS content FROM want w JOIN hit h USING (page_id, n)),
    hassp AS (SELECT DISTINCT page_id FROM spn)
    SELECT td.page_id, CASE WHEN hassp.page_id IS NULL THEN '<html> <body> <table> ' || string_agg(CASE WHEN td.td % 2 = 0 THEN '<tr> ' ELSE '' END || '<td></td>' || CASE WHEN td.td % 2 = 1 OR td.td = total - 1 THEN ' </tr>' ELSE '' END, ' ' ORDER BY td.td) || ' </table> </body> </html>'
      ELSE '<html><body><table>' || string_agg(CASE WHEN td.td % 2 = 0 THEN '<tr>' ELSE '' END || '<td>' || coalesce(content, '') || '</td>' || CASE WHEN td.td % 2 = 1 OR td.td = total - 1 THEN '</tr>' ELSE '' END, '' ORDER BY td.td) || '</table></body></html>' END AS html
    FROM td LEFT JOIN txt ON txt.page_id = td.page_id AND txt.td = td.td LEFT JOIN hassp ON hassp.page_id = td.page_id GROUP BY td.page_id, hassp.page_id""",
)
def _(spark, d):
    rows = blocks(spark, d)
    n = F.count(F.lit(1)).alias("n")
    cell = F.transform(F.sequence(F.lit(0), F.col("n").cast("int") - 1), lambda k: F.concat(F.when(k % 2 == 0, F.array(F.lit("<tr>"))).otherwise(F.array().cast("array<string>")), F.array(F.lit("<td></td>")), F.when((k % 2 == 1) | (k == F.col("n") - 1), F.array(F.lit("</tr>"))).otherwise(F.array().cast("array<string>"))))
    frame = [F.array(*map(F.lit, part)) for part in _FRAME]
    structures = rows.groupBy("page_id").agg(n).select("page_id", F.concat(frame[0], F.flatten(cell), frame[1]).alias("structure"))
    small = spans(spark, d).withColumns({"x1": F.col("x1") + 20, "x2": F.col("x1") + 60, "y2": F.col("y1") + 20})
    return chains.assemble_tables(structures, rows, small, 30)


# --- results ---------------------------------------------------------------------------------


@query(
    "page_result",
    f"""{WITH}, b AS (SELECT page_id, list({{'block_label': label, 'block_content': label || ' ' || box_id, 'block_bbox': [x1::DOUBLE, y1::DOUBLE, x2::DOUBLE, y2::DOUBLE]}} ORDER BY box_id) AS b, list({{'coordinate': [x1::DOUBLE, y1::DOUBLE, x2::DOUBLE, y2::DOUBLE], 'label': label, 'score': score::DOUBLE}} ORDER BY box_id) AS d FROM blk GROUP BY page_id),
    s AS (SELECT page_id, list(text ORDER BY span_id) AS t, list(score::DOUBLE ORDER BY span_id) AS sc, list([[x1::DOUBLE, y1::DOUBLE], [x2::DOUBLE, y1::DOUBLE], [x2::DOUBLE, y2::DOUBLE], [x1::DOUBLE, y2::DOUBLE]] ORDER BY span_id) AS p FROM spn GROUP BY page_id)
    SELECT b.page_id, CAST(to_json({{'page_index': b.page_id, 'model_settings': {{'use_seal_recognition': false, 'use_table_recognition': true}}, 'parsing_res_list': b.b, 'layout_det_res': {{'boxes': b.d}}, 'overall_ocr_res': {{'rec_texts': s.t, 'rec_scores': s.sc, 'dt_polys': s.p}}, 'table_res_list': [{{'pred_html': '<table>' || b.page_id || '</table>'}}]}}) AS VARCHAR) AS json
    FROM b JOIN s ON b.page_id = s.page_id""",
)
def _(spark, d):
    own, read = blocks(spark, d), spans(spark, d)
    both = read.select("page_id").distinct()
    own = own.join(both, "page_id", "left_semi")
    parsed = own.withColumns({"block_content": F.concat("label", F.lit(" "), "box_id"), "order_index": F.col("box_id")})
    tables = own.select("page_id").distinct().withColumn("html", F.concat(F.lit("<table>"), "page_id", F.lit("</table>")))
    parts = chains.page_parts(parsed, own, read, tables).withColumn("seal_res_list", F.array(F.lit("off")))
    return chains.result_json(parts, "page", {"use_seal_recognition": False, "use_table_recognition": True})


_SHAPE = "'<div style=\"text-align: center;\">' || {} || '</div>' || chr(10)"


@query(
    "markdown_document",
    f"""{WITH}, m AS (SELECT *, 'block ' || box_id AS c, 'imgs/img_in_' || label || '_box_' || x1 || '_' || y1 || '_' || x2 || '_' || y2 || '.jpg' AS path, 1 + box_id % 3 AS lines FROM fx),
    s AS (SELECT *, CASE label WHEN 'paragraph_title' THEN '## ' || c WHEN 'text' THEN c WHEN 'image' THEN {_SHAPE.format("'<img src=\"' || path || '\" alt=\"Image\" width=\"' || CAST(floor((x2 - x1) * 100 / 2400.0) AS BIGINT) || '%\" />'")} WHEN 'formula' THEN '$$' || c || '$$' WHEN 'table' THEN chr(10) || {_SHAPE.format("c")} END AS md FROM m),
    l AS (SELECT *, lag(label) OVER p AS pl, lag(x1) OVER p AS px1, lag(x2) OVER p AS px2, lag(y1) OVER p AS py1, lag(y2) OVER p AS py2, lag(lines) OVER p AS pn FROM s WHERE md IS NOT NULL WINDOW p AS (PARTITION BY page_id ORDER BY box_id))
    SELECT page_id, string_agg(CASE WHEN pl IS NULL OR (label = 'text' AND pl = 'text' AND y1 < py2 AND y2 > py1 AND abs(x1 - px2) < greatest(px2 - px1, x2 - x1) AND pn > 1) THEN '' ELSE chr(10) || chr(10) END || md, '' ORDER BY box_id) AS markdown,
      false AS starts, true AS ends, coalesce(string_agg(path, ',' ORDER BY box_id) FILTER (label IN ('image', 'table', 'formula')), '') AS images FROM l GROUP BY page_id""",
)
def _(spark, d):
    rows = boxes(spark, d).withColumns({"block_content": F.concat(F.lit("block "), "box_id"), "order_index": F.col("box_id"), "num_of_lines": 1 + F.col("box_id") % 3})
    return document.to_markdown(rows, 2400, pretty=True).withColumn("images", F.array_join("images", ","))


def _result(name: str, kind: str, sql: str, make) -> None:
    query(name, sql)(lambda spark, d: chains.result_json(make(spark, d), kind))


_PAGE = "input_path := 'p' || page_id, page_index := page_id"


def _paged():
    return {"input_path": F.concat(F.lit("p"), "page_id"), "page_index": F.col("page_id")}


def _one(rows, **columns):
    """Columns gathered from a page's rows in box order."""
    listed = F.array_sort(F.collect_list(F.struct("box_id", *[v.alias(k) for k, v in columns.items()])))
    out = rows.groupBy("page_id").agg(listed.alias("l"))
    field = lambda k: lambda x: x[k]
    return out.withColumns(_paged() | {k: F.transform("l", field(k)) for k in columns})


_result("result_ocr", "ocr", f"{WITH} SELECT page_id, CAST(to_json(struct_pack({_PAGE}, text_type := 'general', text_rec_score_thresh := 0.0::DOUBLE, return_word_box := false, rec_texts := list(label ORDER BY box_id), rec_scores := list(score ORDER BY box_id), rec_boxes := list([x1, y1, x2, y2] ORDER BY box_id))) AS VARCHAR) AS json FROM fx GROUP BY page_id", lambda s, d: _one(boxes(s, d), rec_texts=F.col("label"), rec_scores=F.col("score"), rec_boxes=F.array(*G.SIDES)).withColumns({"text_type": F.lit("general"), "text_rec_score_thresh": F.lit(0.0), "return_word_box": F.lit(False)}))
_result("result_detection", "detection", f"{WITH} SELECT page_id, CAST(to_json(struct_pack({_PAGE}, boxes := list(struct_pack(cls_id := cls_id, label := label, score := score, coordinate := [x1, y1, x2, y2]) ORDER BY box_id))) AS VARCHAR) AS json FROM fx GROUP BY page_id", lambda s, d: _one(boxes(s, d), boxes=F.struct("cls_id", "label", "score", F.array(*G.SIDES).alias("coordinate"))))
_result("result_structure", "structure", f"{WITH} SELECT page_id, CAST(to_json(struct_pack({_PAGE}, bbox := list([x1, y1, x2, y1, x2, y2, x1, y2] ORDER BY box_id), structure := list('<td></td>' ORDER BY box_id), structure_score := 1.0::DOUBLE)) AS VARCHAR) AS json FROM fx GROUP BY page_id", lambda s, d: _one(boxes(s, d), bbox=F.array("x1", "y1", "x2", "y1", "x2", "y2", "x1", "y2"), structure=F.lit("<td></td>")).withColumn("structure_score", F.lit(1.0)))
_result("result_formulas", "formulas", f"{WITH} SELECT page_id, CAST(to_json(struct_pack({_PAGE}, formula_res_list := list(struct_pack(rec_formula := 'x_' || box_id, formula_region_id := k, dt_polys := [x1, y1, x2, y2]) ORDER BY box_id))) AS VARCHAR) AS json FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY box_id) AS k FROM fx WHERE label = 'formula') GROUP BY page_id", lambda s, d: _one(chains.numbered(boxes(s, d), "formula"), formula_res_list=F.struct(F.concat(F.lit("x_"), "box_id").alias("rec_formula"), F.col("region_no").alias("formula_region_id"), F.array(*G.SIDES).alias("dt_polys"))))
_result("result_seals", "seals", f"{WITH} SELECT page_id, CAST(to_json(struct_pack({_PAGE}, seal_res_list := list(struct_pack(rec_texts := [label], seal_region_id := k) ORDER BY box_id))) AS VARCHAR) AS json FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY box_id) AS k FROM fx WHERE label = 'image') GROUP BY page_id", lambda s, d: _one(chains.numbered(boxes(s, d), "image"), seal_res_list=F.struct(F.array("label").alias("rec_texts"), F.col("region_no").alias("seal_region_id"))))
_result("result_tables", "tables", f"{WITH} SELECT page_id, CAST(to_json(struct_pack({_PAGE}, table_res_list := list(struct_pack(cell_box_list := [[x1, y1, x2, y2]], pred_html := '<table>' || box_id || '</table>', table_region_id := k) ORDER BY box_id))) AS VARCHAR) AS json FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY box_id) AS k FROM fx WHERE label = 'table') GROUP BY page_id", lambda s, d: _one(chains.numbered(boxes(s, d), "table"), table_res_list=F.struct(F.array(F.array(*G.SIDES)).alias("cell_box_list"), F.concat(F.lit("<table>"), "box_id", F.lit("</table>")).alias("pred_html"), F.col("region_no").alias("table_region_id"))))
_result("result_classes", "classes", f"{WITH} SELECT page_id, CAST(to_json(struct_pack({_PAGE}, class_ids := list(cls_id ORDER BY box_id), scores := list(score ORDER BY box_id), label_names := list(label ORDER BY box_id))) AS VARCHAR) AS json FROM fx GROUP BY page_id", lambda s, d: _one(boxes(s, d), class_ids=F.col("cls_id"), scores=F.col("score"), label_names=F.col("label")))
_result("result_text_detection", "text_detection", f"{WITH} SELECT page_id, CAST(to_json(struct_pack({_PAGE}, dt_polys := list([[x1, y1], [x2, y1], [x2, y2], [x1, y2]] ORDER BY box_id), dt_scores := list(score ORDER BY box_id))) AS VARCHAR) AS json FROM fx GROUP BY page_id", lambda s, d: _one(boxes(s, d), dt_polys=F.array(F.array("x1", "y1"), F.array("x2", "y1"), F.array("x2", "y2"), F.array("x1", "y2")), dt_scores=F.col("score")))


def _row_result(name: str, kind: str, sql_fields: str, columns) -> None:
    sql = f"{WITH} SELECT page_id, box_id, CAST(to_json(struct_pack({_PAGE}, {sql_fields})) AS VARCHAR) AS json FROM fx"
    query(name, sql)(lambda spark, d: chains.result_json(boxes(spark, d).withColumns(_paged() | columns()), kind, None, "page_id", "box_id"))


_row_result("result_formula", "formula", "rec_formula := 'x_' || box_id", lambda: {"rec_formula": F.concat(F.lit("x_"), "box_id")})
_row_result("result_text_recognition", "text_recognition", "rec_text := label, rec_score := score / 100.0::DOUBLE", lambda: {"rec_text": F.col("label"), "rec_score": F.col("score") / F.lit(100.0)})
_row_result("result_preprocessor", "preprocessor", "angle := box_id % 4 * 90", lambda: {"angle": F.col("box_id") % 4 * 90})
_row_result("result_unwarping", "unwarping", "doctr_img := 'img_' || box_id", lambda: {"doctr_img": F.concat(F.lit("img_"), "box_id")})


# --- functions -------------------------------------------------------------------------------


@query("aligned_equation", r"SELECT doc_id, '\begin{equation}' || chr(10) || regexp_replace(text, '^\s+|\s+$', '', 'g') || '\nonumber' || chr(10) || '\end{equation}' || chr(10) AS latex FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", chains.aligned_equation(F.col("text")).alias("latex"))


@query("cjk_formula", r"SELECT doc_id, regexp_replace(text, '([^\x00-\x7F]+)', '\\text{\1}', 'g') AS latex FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", chains.text_for_cjk(F.col("text")).alias("latex"))


@query("line_counts", "SELECT doc_id, CAST(len(string_split(text, chr(10))) AS INT) AS n FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", chains.line_count(F.col("text")).alias("n"))


@query("decoder_scales", f"{WITH} SELECT page_id, box_id, round(488 / least(488.0::DOUBLE / (x2 - x1), 488.0::DOUBLE / (y2 - y1)), 6) AS x, round(488 / least(488.0::DOUBLE / (x2 - x1), 488.0::DOUBLE / (y2 - y1)), 6) AS y, (x2 - x1)::DOUBLE AS whole FROM fx")
def _(spark, d):
    b = G.box()
    scale = chains.decoder_scales(F.lit(488), F.lit(488), b.x2 - b.x1, b.y2 - b.y1)
    whole = chains.decoder_scales(F.lit(488), F.lit(488), b.x2 - b.x1, b.y2 - b.y1, whole_image=True)
    return boxes(spark, d).select("page_id", "box_id", F.round(scale.x, 6).alias("x"), F.round(scale.y, 6).alias("y"), whole.x.alias("whole"))


@query("vector_angles", f"{WITH} SELECT page_id, box_id, round(abs(asin((y2 - y1) / (sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) + 1e-8))), 6) AS slope, round(acos(least(1.0, (x2 - x1) / (sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) + 1e-8) / (1 + 1e-8))), 6) AS angle FROM fx")
def _(spark, d):
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    return boxes(spark, d).select("page_id", "box_id", F.round(chains.slope(w, h), 6).alias("slope"), F.round(chains.angle_between(w, h, F.lit(1), F.lit(0)), 6).alias("angle"))


@query("bpe_decode", "SELECT p_partkey, p_name || ' é' AS text FROM part")
def _(spark, d):
    # the byte letters of a blank, and of the two bytes of é
    letters = F.split(F.concat(F.replace("p_name", F.lit(" "), F.lit("Ġ")), F.lit("ĠÃ©")), "(?=Ġ)")
    return table(spark, d, "part").select("p_partkey", chains.byte_decoded(letters).alias("text"))


@query("region_box", f"{WITH} SELECT page_id, CAST(trunc(min(x1 / 7.0)) AS INT) AS x1, CAST(trunc(min(y1 / 7.0)) AS INT) AS y1, CAST(trunc(max(x2 / 7.0)) AS INT) AS x2, CAST(trunc(max(y2 / 7.0)) AS INT) AS y2 FROM fx GROUP BY page_id")
def _(spark, d):
    return boxes(spark, d).groupBy("page_id").agg(F.min(F.col("x1") / 7).cast("int").alias("x1"), F.min(F.col("y1") / 7).cast("int").alias("y1"), F.max(F.col("x2") / 7).cast("int").alias("x2"), F.max(F.col("y2") / 7).cast("int").alias("y2"))


@query("overlap_filter", f"{WITH} SELECT b.page_id, b.box_id FROM blk b WHERE EXISTS (SELECT 1 FROM spn s WHERE s.page_id = b.page_id AND {_inter('b', 's')} * 4 > ({_area('b')} + {_area('s')} - {_inter('b', 's')}))")
def _(spark, d):
    return match.overlapping(blocks(spark, d), spans(spark, d), "union", 0.25).select("page_id", "box_id")


@query("overlap_filter_none", f"{WITH} SELECT b.page_id, b.box_id FROM blk b WHERE NOT EXISTS (SELECT 1 FROM spn s WHERE s.page_id = b.page_id AND {_inter('b', 's')} * 10 > greatest({_area('b')}, {_area('s')}))")
def _(spark, d):
    return match.overlapping(blocks(spark, d), spans(spark, d), "large", 0.1, keep=False).select("page_id", "box_id")


@query("interval_rows", f"{WITH} SELECT page_id, box_id, row_number() OVER (PARTITION BY page_id ORDER BY y2, box_id) AS place FROM fx WHERE y1 >= 200 AND y2 <= 800")
def _(spark, d):
    return match.in_interval(boxes(spark, d), 200, 800, "y")


@query("profile_wide_gaps", _sql["profile_segments"].replace("pos = lag(e) OVER (PARTITION BY page_id ORDER BY pos)", "pos - lag(e) OVER (PARTITION BY page_id ORDER BY pos) < 120"))
def _(spark, d):
    return sequence.profile_segments(sequence.projection_profile(boxes(spark, d)), min_gap=120)


@query("region_distance_right", f"{WITH} SELECT page_id, round(sqrt(min((3000 - x2) * (3000 - x2) + y1 * y1)), 6) AS distance FROM fx GROUP BY page_id")
def _(spark, d):
    return summary.region_distance(boxes(spark, d), "page_id", right=F.lit(3000)).withColumn("distance", F.round("distance", 6))


@query("coordinate_boxes", f"{WITH} SELECT page_id, box_id, x1, y1, x2, y2, least(x1, x2 - 90) AS u1, y1 - 7 AS v1, greatest(x2, x2 - 90) AS u2, y2 AS v2, array_to_string([x1, y1, x2, y1, x2, y2, x1, y2], ',') AS poly FROM fx")
def _(spark, d):
    rows = boxes(spark, d).withColumns({"b": G.from_coordinates(F.array(*G.SIDES)), "q": G.from_coordinates(F.array(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y1") - 7, F.col("x2"), F.col("y2"), F.col("x2") - 90, F.col("y2")))})
    sides = [F.col(f"b.{s}").alias(s) for s in G.SIDES] + [F.col(f"q.{s}").alias(n) for s, n in zip(G.SIDES, ("u1", "v1", "u2", "v2"), strict=True)]
    return rows.select("page_id", "box_id", *sides, F.array_join(G.corners(F.col("b")), ",").alias("poly"))


@query("supplement_masked", _sql["supplement_rows"].replace("WHERE NOT EXISTS", "WHERE s.text NOT LIKE '%text' AND NOT EXISTS"))
def _(spark, d):
    own = spans(spark, d).withColumnRenamed("span_id", "box_id").withColumn("label", F.regexp_replace("text", r"^s\d+", ""))
    return match.supplement(own, match.assign_regions(blocks(spark, d).withColumnRenamed("box_id", "region_id"), own), masked=("text",))

"""Chains, results, warps and regions: plain values and edge cases that the SQL comparison does not reach."""

import json
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pagewright.functions import warps
from pagewright.operators import models, regions
from pagewright.plans import chains, document

SPAN = "page_id long, span_id long, text string, score double, x1 long, y1 long, x2 long, y2 long"
BOX = "page_id long, box_id long, label string, cls_id int, score long, x1 long, y1 long, x2 long, y2 long"


def test_confident_keeps_the_threshold(spark):
    df = spark.createDataFrame([(1, 1, "a", 0.5, 0, 0, 1, 1), (1, 2, "b", 0.4, 0, 0, 1, 1), (1, 3, "c", None, 0, 0, 1, 1)], SPAN)
    assert [r.span_id for r in chains.confident(df, 0.5).collect()] == [1]


def test_cell_texts(spark):
    cases = {("a",): "a", (" a",): " a", ("a", "b"): "a b", (" a", "b "): "a b ", ("<b>a</b>", "<b>b</b>"): "<b>a b</b>", ("a", "", "b"): "a b", ("a ", "b"): "a b", ("", "x"): "x"}
    df = spark.createDataFrame([(list(k),) for k in cases], "t array<string>")
    assert {tuple(r.t): r.s for r in df.select("t", chains.cell_text(F.col("t")).alias("s")).collect()} == cases


def test_table_rows_take_the_rows_that_begin_before_them(spark):
    frame = ["<html>", "<body>", "<table>"], ["</table>", "</body>", "</html>"]
    rows = ["<tr>", "<td></td>", "<td", ' colspan="2"', ">", "</td>", "</tr>", "<tr>", "<td></td>", "<td></td>", "</tr>"]
    structures = spark.createDataFrame([(1, frame[0] + rows + frame[1]), (2, frame[0] + rows + frame[1])], "page_id long, structure array<string>")
    cells = [(0, 0, 40, 20), (50, 2, 90, 20), (0, 40, 40, 60), (50, 41, 90, 60)]
    df = spark.createDataFrame([(1, k, "c", 0, 0, *c) for k, c in enumerate(cells)], BOX)
    spans = spark.createDataFrame([(1, k, t, 1.0, c[0] + 2, c[1] + 2, c[0] + 9, c[1] + 9) for k, (t, c) in enumerate(zip("ABCD", cells, strict=True))] + [(1, 9, "out", 1.0, 200, 200, 210, 210)], SPAN)
    got = {r.page_id: r.html for r in chains.assemble_tables(structures, df, spans).collect()}
    assert got[1] == '<html><body><table><tr><td>A</td><td colspan="2">B</td></tr><tr><td>C</td><td>D</td></tr></table></body></html>'
    assert got[2] == " ".join(frame[0] + rows + frame[1])  # no cells, no spans


def test_results_follow_their_settings(spark):
    df = spark.createDataFrame([(1, "x", None, "t")], "page_id long, parsing_res_list string, layout_det_res string, table_res_list string")
    one = lambda **s: json.loads(chains.result_json(df, "page", s or None).first().json)
    assert one(use_table_recognition=True) == {"model_settings": {"use_table_recognition": True}, "parsing_res_list": "x", "layout_det_res": None, "table_res_list": "t"}
    assert "table_res_list" not in one(use_table_recognition=False) and "table_res_list" in one()
    with pytest.raises(ValueError):
        chains.result_json(df, "none")


def test_page_parts_of_pages_that_lack_some(spark):
    blocks = spark.createDataFrame([(1, 1, 1, "text", "hi", 0, 0, 1, 1)], "page_id long, box_id long, order_index long, label string, block_content string, x1 long, y1 long, x2 long, y2 long")
    found = spark.createDataFrame([(1, 1, "text", 0, 90, 0, 0, 1, 1), (2, 1, "text", 0, 90, 0, 0, 1, 1)], BOX)
    spans = spark.createDataFrame([(3, 1, "s", 1.0, 0, 0, 1, 1)], SPAN)
    got = {r.page_id: json.loads(r.json) for r in chains.result_json(chains.page_parts(blocks, found, spans), "page").collect()}
    assert {k: len(v["parsing_res_list"]) for k, v in got.items()} == {1: 1, 2: 0, 3: 0} and got[1]["parsing_res_list"][0]["block_bbox"] == [0.0, 0.0, 1.0, 1.0]


def test_values():
    frame = pd.DataFrame({"a": [1, 2]})
    assert chains.plain({"x": np.float32(0.5), "y": np.array([[1, 2]]), "f": frame, "t": (np.int64(3),)}) == {"x": 0.5, "y": [[1, 2]], "f": [{"a": 1}, {"a": 2}], "t": [3]}
    assert json.dumps(chains.plain(frame))
    assert chains.rows_of({"a": [1, 2], "b": "xy"}, 2) == [{"a": 1, "b": "x"}, {"a": 2, "b": "y"}]
    with pytest.raises(ValueError):
        chains.rows_of({"a": [1]}, 2)


def test_overrides():
    settings = {"a": {"b": [1, {"c": 2}]}, "t": 1}
    assert chains.override(settings, "a.b.1.c=7", "new.deep=True", "t=None", "a.b.0=x") == {"a": {"b": ["x", {"c": 7}]}, "t": None, "new": {"deep": True}}
    assert settings == {"a": {"b": [1, {"c": 2}]}, "t": 1}
    for bad in ("a", "=1"):
        with pytest.raises(ValueError):
            chains.override(settings, bad)
    with pytest.raises(IndexError):
        chains.override(settings, "a.b.7=1")


def test_devices_and_model_files(tmp_path):
    assert chains.device("CPU") == ("cpu", None) and chains.device("gpu:0,1") == ("gpu", [0, 1])
    for bad in ("cpu:0", "gpu:x", "a:1:2", "toaster"):
        with pytest.raises(ValueError):
            chains.device(bad)
    for name in ("inference.pdmodel", "inference.pdiparams", "inference.onnx", "other.om"):
        (tmp_path / name).touch()
    assert set(chains.model_files(str(tmp_path))) == {"program", "onnx"}
    (tmp_path / "inference.json").touch()
    assert chains.model_files(str(tmp_path))["program"][0].endswith("inference.json")


def test_bad_bytes_and_letters(spark):
    assert len(chains.byte_letters()) == 256 and chains.byte_letters()["Ġ"] == 32
    df = spark.createDataFrame([(["Ġa", "Ċ", "ÃŁ"],), ([],)], "t array<string>")
    assert [r[0] for r in df.select(chains.byte_decoded(F.col("t"))).collect()] == [" a\nß", ""]


def test_options_select_a_chain(spark, sf_dir):
    from pagewright.plans.fixtures import blocks, boxes, spans

    own, read = blocks(spark, sf_dir).where("page_id < 40"), spans(spark, sf_dir).where("page_id < 40")
    parsed = document.run(document.Options(), blocks=own, spans=read)
    assert parsed.groupBy("page_id").agg(F.max("order_index").alias("n"), F.count("*").alias("c")).where("n <> c").isEmpty()
    ocr = document.run(document.Options(pipeline="ocr"), boxes=own, recogniser=models.StubRecogniser())
    assert "span_id" in ocr.columns and ocr.count() == own.count()
    direct = document.run(document.Options(pipeline="universal", strategy="direct_block"), blocks=own, spans=read, recogniser=models.StubRecogniser())
    texts = {r.block_content for r in direct.where("label = 'text'").collect()}
    assert texts and all("x" in t for t in texts)
    formulas = document.run(document.Options(pipeline="formulas"), boxes=boxes(spark, sf_dir), recogniser=models.StubRecogniser())
    assert formulas.columns == ["page_id", "region_no", "box_id", "text", "score"]
    with pytest.raises(ValueError):
        document.run(document.Options(pipeline="ocr"), boxes=own)
    with pytest.raises(ValueError):
        document.Options(pipeline="none")
    changed = document.Options().override("same_iou=0.5", "thresholds.3=0.25", "use_table_recognition=true")
    assert (changed.same_iou, changed.thresholds, changed.use_table_recognition) == (0.5, {3: 0.25}, True)
    with pytest.raises(ValueError):
        document.Options().override("nothing=1")


# --- warps -----------------------------------------------------------------------------------


def picture(h=40, w=60):
    y, x = np.mgrid[:h, :w]
    return np.stack([x * 4, y * 5, x + y], -1).astype(np.uint8)


def test_perspective_crop():
    a = picture()
    assert (warps.perspective_crop(a, [(10, 5), (40, 5), (40, 25), (10, 25)]) == a[5:25, 10:40]).all()
    tall = warps.perspective_crop(a, [(10, 0), (20, 0), (20, 30), (10, 30)])
    assert (tall == np.rot90(a[0:30, 10:20])).all()
    turned = warps.perspective_crop(a, [(40, 5), (40, 25), (10, 25), (10, 5)])  # from top right down
    assert turned.shape[:2] == (20, 30) or turned.shape[:2] == (30, 20)
    m = warps.homography(np.array([(0, 0), (1, 0), (1, 1), (0, 1)]), np.array([(2, 3), (5, 3), (6, 8), (1, 7)]))
    for p, q in zip([(0, 0), (1, 0), (1, 1), (0, 1)], [(2, 3), (5, 3), (6, 8), (1, 7)], strict=True):
        u = m @ np.array([*p, 1])
        assert np.allclose(u[:2] / u[2], q)


def test_rotation_and_affine():
    a = picture()
    assert (warps.rotate_any(a, 90) == np.rot90(a)).all() and (warps.rotate_any(a, 360) == a).all()
    b = warps.rotate_any(a, 30)
    assert b.shape[0] >= 40 * np.cos(np.pi / 6) and b.shape[1] >= 60 * np.cos(np.pi / 6) and (b[0, 0] == 0).all()
    same = warps.warp_affine(a, warps.affine((30, 20), 1.0, 0, (60, 40)), (60, 40))
    assert (same == a).all()
    assert warps.to_picture(np.ones((1, 3, 2, 4)) * 0.5).shape == (2, 4, 3)
    assert warps.to_picture(np.arange(3).reshape(1, 3, 1, 1) / 2).ravel().tolist() == [255, 127, 0]


def test_least_rectangle():
    rng = random.Random(2)
    box, short = warps.least_rectangle(np.array([(0, 0), (4, 0), (4, 2), (0, 2), (1, 1)]))
    assert np.allclose(box, [(0, 0), (4, 0), (4, 2), (0, 2)]) and short == 2
    for _ in range(50):
        points = np.array([(rng.uniform(0, 9), rng.uniform(0, 9)) for _ in range(rng.randint(3, 12))])
        box, short = warps.least_rectangle(points)
        sides = np.hypot(*(box[1] - box[0])), np.hypot(*(box[2] - box[1]))
        # no direction out of many gives less
        least = min(np.prod(np.ptp(points @ np.array([(np.cos(t), -np.sin(t)), (np.sin(t), np.cos(t))]), axis=0)) for t in np.linspace(0, np.pi, 720))
        assert sides[0] * sides[1] <= least + 1e-6 and np.isclose(min(sides), short)
    assert warps.least_rectangle(np.array([(1, 1)]))[1] == 0


def test_masks_and_outlines():
    scores = np.zeros((6, 6))
    scores[1:4, 1:4] = 0.9
    assert np.isclose(warps.mean_inside(scores, np.array([(1, 1), (3, 1), (3, 3), (1, 3)])), 0.9) and warps.mean_inside(scores, np.array([(9, 9), (10, 9), (10, 10)])) == 0
    square = np.array([(0.0, 0), (4, 0), (4, 4), (0, 4)])
    assert warps.unclip_distance(square, 2.0) == 2.0
    assert np.allclose(warps.push_out(square, 2.0), [(-2, -2), (6, -2), (6, 6), (-2, 6)])
    assert warps.polygon_mask(np.array([(0, 0), (4, 0), (0, 4)]), 5, 5).sum() == 15


# --- regions ---------------------------------------------------------------------------------


def test_growing_regions():
    region = None
    for box in [(3.7, 4.2, 9.9, 9.9), (1.5, 5, 4, 12.8)]:
        region = regions.grown(region, box)
    assert region == (1, 4, 9, 12)


def test_fitted_regions():
    blocks = {0: (0, 0, 90, 40), 1: (0, 50, 90, 90), 2: (120, 0, 190, 90)}
    # the other region takes the right half: the left one is drawn back to the blocks it keeps
    assert regions.fitted((0, 0, 200, 100), (100, -3, 207, 101), 200, 100, blocks) == ((0, 0, 90, 90), [0, 1])
    assert regions.fitted((0, 0, 200, 100), (100, 0, 200, 100), 200, 100, {}) == ((0, 0, 200, 100), [])
    box, kept = regions.fitted((0, 0, 10, 10), (0, 0, 10, 10), 100, 100, {5: (50, 50, 60, 60)})
    assert kept == [] and box == (0, 0, 10, 10)


def test_spans_parted_by_formulas():
    line = [([0, 0, 100, 10], "left right", "text"), ([40, 0, 60, 10], "x", "formula")]
    got = regions.parted_by(line)
    assert [(round(b[0]), round(b[2]), t) for b, t, _ in got] == [(0, 40, "left right"), (60, 100, "left right"), (40, 60, "x")]
    assert regions.parted_by(line[::-1])[1][0] == [0, 0, 100, 10]  # only later spans part one
    assert regions.parted_by([([0, 0, 10, 5], "a", "text"), ([20, 0, 30, 5], "b", "text")]) == [([0, 0, 10, 5], "a", "text"), ([20, 0, 30, 5], "b", "text")]

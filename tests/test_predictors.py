"""Predictors with plain functions as models, stages and the command line, overlays and workbooks."""

import io
import xml.etree.ElementTree as ET
import zipfile

import numpy as np
import pytest

from pagewright.operators import predictors as P
from pagewright.plans import document, stages
from pagewright.plans.fixtures import blocks, spans
from pagewright.sources import pictures, writers


def images(spark, *arrays):
    rows = [(k, a.tobytes(), *a.shape) for k, a in enumerate(arrays)]
    return spark.createDataFrame(rows, "page_id long, data binary, height int, width int, channels int")


def blank(h=64, w=96):
    return np.full((h, w, 3), 200, np.uint8)


def test_text_detector(spark):
    def model(x):
        out = np.zeros((1, 1, *x.shape[2:]), np.float32)
        out[0, 0, 10:21, 20:61] = 0.9
        out[0, 0, 40:51, 20:61] = 0.5  # over the threshold, under the score
        out[0, 0, 60, 90] = 0.9  # too small
        return [out]

    rows = P.TextDetector(lambda: model).run(images(spark, blank()), "page_id").collect()
    assert len(rows) == 1 and rows[0].error is None and abs(rows[0].score - 0.9) < 1e-6
    (x1, y1), (x2, _), (_, y2), _ = rows[0].poly
    d = 40 * 10 * 2.0 / 100  # area times ratio over outline
    assert (x1, y1, x2, y2) == (20 - d, 10 - d, 60 + d, 20 + d)
    assert P.TextDetector(lambda: model).size(2000, 100) == (960, 64)


def test_text_recogniser(spark):
    def model(x):
        steps = np.full((1, 6, 4), 0.1)
        for t, k in enumerate([1, 1, 0, 1, 2, 0]):
            steps[0, t, k] = 0.8
        return [steps]

    assert P.TextRecogniser(lambda: model, "abc").run(images(spark, blank(20, 60)), "page_id").first().asDict() == {"page_id": 0, "text": "aab", "score": pytest.approx(0.8), "error": None}
    assert P.TextRecogniser(lambda: model, "abc", right_to_left=True).results(blank())[0]["text"] == "baa"
    assert P.TextRecogniser(lambda: lambda x: [np.eye(4)[None, [0, 0]]], "abc").results(blank()) == [{"text": "", "score": 0.0}]


def test_classifier_and_errors(spark):
    model = lambda x: [np.array([[0.2, 0.123456789, 0.2, 0.6]])]
    got = P.Classifier(lambda: model, ["0", "90", "180", "270"], 3).run(images(spark, blank()), "page_id").first()
    assert (got.class_ids, got.scores, got.label_names) == ([3, 0, 2], [0.6, 0.2, 0.2], ["270", "0", "180"])

    def fails(x):
        raise ValueError("no model")

    bad = P.Classifier(lambda: fails, ["a"]).run(images(spark, blank(), blank()), "page_id").collect()
    assert [(r.class_ids, r.error) for r in bad] == [(None, "ValueError: no model")] * 2


def test_table_structure():
    tokens = ["<tr>", "<td></td>", "</tr>"]

    def model(x):
        chances = np.zeros((1, 7, 5))
        for t, k in enumerate([1, 2, 2, 3, 4, 1, 2]):  # then the end mark
            chances[0, t, k] = 1.0
        places = np.full((1, 7, 4), 0.5)
        return [places, chances]

    got = P.TableStructure(lambda: model, tokens).results(blank(100, 200))[0]
    assert got["structure"] == ["<html>", "<body>", "<table>", "<tr>", "<td></td>", "<td></td>", "</tr>", "</table>", "</body>", "</html>"]
    assert got["boxes"] == [[100.0, 100.0, 100.0, 100.0]] * 2 and got["score"] == 1.0
    assert P.TableStructure(lambda: model, tokens, whole_image=True).scales(100, 200) == (200.0, 100.0)


def test_formula_and_unwarping(spark):
    tokens = ["<s>", "</s>", "\\", "frac", "Ġx", "Ã©"]
    got = P.FormulaRecogniser(lambda: lambda x: [np.array([[0, 2, 3, 4, 5, 1, 4]])], tokens, end=1, special=[0]).run(images(spark, blank()), "page_id").first()
    assert got.latex == "\\frac xé"
    flat = P.Unwarper(lambda: lambda x: [x[:, ::-1]]).run(images(spark, blank(4, 6)), "page_id").first()
    assert (flat.flat_height, flat.flat_width) == (4, 6) and np.frombuffer(flat.flat, np.uint8).mean() in (199.0, 200.0)


def test_field_names():
    assert [f.strip() for f in P._fields("a int, b struct<c:int,d:int>, e string")] == ["a int", "b struct<c:int,d:int>", "e string"]


def test_stages(spark, sf_dir, tmp_path):
    few = lambda df: df.where("page_id < 30")
    tables = {"blocks": few(blocks(spark, sf_dir)), "spans": few(spans(spark, sf_dir))}
    made = stages.run_stages(stages.parse_stages(document.Options()), tables)
    assert set(made) == {"blocks", "spans", "parsed", "json", "markdown"} and made["json"].count() == made["parsed"].select("page_id").distinct().count()
    with pytest.raises(ValueError):
        stages.run_stages(stages.parse_stages(document.Options()), {"blocks": tables["blocks"]})
    off = stages.Stage("off", ("none",), lambda n: {}, wanted=False)
    assert stages.run_stages([off], tables) == tables
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}/en")
    out = f"{tmp_path}/out"
    failed = stages.main(["--blocks", f"{tmp_path}/blocks", "--spans", f"{tmp_path}/spans", "--out", out, "--lang", "en", "uk", "-o", "overlap=0.4"], spark)
    assert failed == 1 and spark.read.text(f"{out}/en/json").count() == made["json"].count()


def test_overlays():
    a = np.zeros((20, 30, 3), np.uint8)
    b = pictures.draw_boxes(a, [(5, 5, 15, 15), (40, 0, 50, 5)], [(255, 0, 0, 128), (0, 0, 0, 255)])
    assert b[5, 5].tolist() == [0, 0, 255] and b[10, 10].tolist() == [0, 0, 128] and (b[:, 16:] == 0).all() and (a == 0).all()
    c = pictures.draw_order(a, [(0, 0, 2, 2), (10, 10, 12, 12), (50, 0, 60, 2)])
    assert c[1, 1].tolist() == c[6, 6].tolist() == [0, 0, 255]
    assert len(set(pictures.colour_map(256))) == 256 and pictures.colour_map(2) == [(0, 0, 0), (128, 0, 0)]
    raw = pictures.bitmap(b)
    assert raw[:2] == b"BM" and len(raw) == 54 + 20 * 92


def test_workbooks(spark, tmp_path):
    html = "<table><tr><td rowspan=2>a &amp; b</td><th colspan='2'>1.50</th></tr><tr><td>x<br>y</td><td>007</td></tr></table>"
    assert pictures.table_cells(html) == [(0, 0, 2, 1, "a & b"), (0, 1, 1, 2, "1.50"), (1, 1, 1, 1, "x\ny"), (1, 2, 1, 1, "007")]
    df = spark.createDataFrame([(1, 2, html), (1, 1, "<table></table>"), (2, 1, html)], "page_id long, table_no int, html string")
    writers.save(df, f"{tmp_path}/books", "xlsx")
    books = {r.path: r.content for r in spark.read.parquet(f"{tmp_path}/books").collect()}
    assert set(books) == {"page_1.xlsx", "page_2.xlsx"} and bytes(books["page_2.xlsx"]) == pictures.workbook([html])
    z = zipfile.ZipFile(io.BytesIO(bytes(books["page_1.xlsx"])))
    assert [n for n in z.namelist() if "sheet" in n] == ["xl/worksheets/sheet1.xml", "xl/worksheets/sheet2.xml"]
    for name in z.namelist():
        ET.fromstring(z.read(name))
    sheet = z.read("xl/worksheets/sheet2.xml").decode()
    assert '<c r="B1"><v>1.50</v></c>' in sheet and '<mergeCell ref="A1:A2"/>' in sheet and '<mergeCell ref="B1:C1"/>' in sheet and ">007</t>" in sheet
    assert pictures._reference(0, 27) == "AB1" and zipfile.ZipFile(io.BytesIO(pictures.workbook([]))).testzip() is None

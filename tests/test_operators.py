"""Operators that SQL can't express, against plain Python; and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewright.functions import geometry as G
from pagewright.functions import markup, pixels, text
from pagewright.operators import detect, match, models, order, reading, sequence, summary
from pagewright.plans import document
from pagewright.plans.fixtures import blocks, boxes, spans
from pagewright.sources import readers, writers
from pagewright.streaming import pages as stream

BOX = "page_id long, box_id long, cls_id int, label string, score long, x1 long, y1 long, x2 long, y2 long"


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def by_page(spark, sf_dir):
    found = {}
    for r in boxes(spark, sf_dir).collect():
        found.setdefault(r.page_id, []).append(r)
    return found


def test_quad_order_is_the_insertion_sort(spark, sf_dir):
    want = []
    for page, rows in by_page(spark, sf_dir).items():
        done = sorted(rows, key=lambda r: (r.y1, r.x1, r.box_id))
        for i in range(len(done) - 1):
            for j in range(i, -1, -1):
                if abs(done[j + 1].y1 - done[j].y1) < 30 and done[j + 1].x1 < done[j].x1:
                    done[j], done[j + 1] = done[j + 1], done[j]
                else:
                    break
        want += [(page, r.box_id, k + 1) for k, r in enumerate(done)]
    assert rows_of(sequence.quad_order(boxes(spark, sf_dir), 30), "page_id", "box_id", "place") == sorted(want)


def test_suppression_is_greedy(spark):
    rows = [(1, 1, 0, "text", 90, 0, 0, 100, 100), (1, 2, 0, "text", 90, 1, 1, 101, 101), (1, 3, 1, "image", 80, 1, 1, 101, 101), (1, 4, 0, "text", 70, 500, 500, 600, 600), (2, 1, 0, "text", 50, 0, 0, 10, 10)]
    got = rows_of(detect.suppress(spark.createDataFrame(rows, BOX)), "page_id", "box_id")
    assert got == [(1, 1), (1, 3), (1, 4), (2, 1)]


def test_word_runs(spark):
    df = spark.createDataFrame([("VGG-16 v1.25, 你好(a.b)",)], "t string").select(text.word_runs(F.col("t")).alias("r"))
    assert df.first().r == ["VGG-16", " ", "v1.25", ", ", "你好", "(", "a", ".", "b", ")"]


def test_rtl(spark):
    df = spark.createDataFrame([("אב abc1",)], "t string").select(text.latin_runs_reversed(F.col("t")).alias("r"))
    assert df.first().r == " abc1בא"


def test_titles(spark):
    given = ["1.2 Intro", "1.2.Intro.", "IV. Results", "（三）结果", "No number", "2Title"]
    got = [r.t for r in spark.createDataFrame([(g,) for g in given], "t string").select(text.title(F.col("t")).alias("t")).collect()]
    assert got == ["### 1.2 Intro", "#### 1.2. Intro", "### I V. Results", "## （三） 结果", "## No number", "## 2 Title"]


def test_xy_cut_orders_two_columns():
    left, right = [(0, k * 20, 90, k * 20 + 15) for k in range(4)], [(110, k * 20 + 5, 200, k * 20 + 18) for k in range(4)]
    b = np.array(left + right, float)
    assert reading.recursive_cut(b, 0) == list(range(8))
    assert reading.recursive_cut(np.zeros((0, 4)), 0) == []


def test_reading_order_is_a_permutation(spark, sf_dir):
    got = order.reading_order(boxes(spark, sf_dir)).groupBy("page_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("box_id").alias("d"), F.max("order_index").alias("m")).where("n <> d OR n <> m")
    assert got.isEmpty()


def test_cells_to_html_spans(spark):
    rows = [(1, 1, "a", 0, 0, 100, 20), (1, 2, "b", 0, 20, 50, 40), (1, 3, "c", 50, 20, 100, 40)]
    got = markup.cells_to_html(spark.createDataFrame(rows, "page_id long, box_id long, text string, x1 long, y1 long, x2 long, y2 long")).first()
    assert got.html == '<html><body><table><tr><td colspan="2">a</td></tr><tr><td>b</td><td>c</td></tr></table></body></html>'
    assert (got.n_rows, got.n_cols) == (2, 2)
    grid = rows_of(markup.grid(spark.createDataFrame([(1, got.html)], "table_id long, html string")), "row", "place", "text", "colspan", "rowspan")
    assert grid == [(0, 0, "a", 2, 1), (1, 0, "b", 1, 1), (1, 1, "c", 1, 1)]


def test_fill_bold_cells(spark):
    tokens = spark.createDataFrame([(1, ["<tr>", "<td></td>", "<td", ' colspan="2"', ">", "</td>", "</tr>"])], "table_id long, structure array<string>")
    texts = spark.createDataFrame([(1, 0, 1, "<b>x</b>"), (1, 0, 2, "<b>y</b>"), (1, 1, 3, "z")], "table_id long, cell_id long, span_id long, text string")
    assert markup.fill_cells(tokens, texts).first().html == '<tr><td><b>x y</b></td><td colspan="2">z</td></tr>'


def test_split_spans(spark):
    s = spark.createDataFrame([(1, 1, 0, 0, 100, 10)], "page_id long, span_id long, x1 long, y1 long, x2 long, y2 long")
    c = spark.createDataFrame([(1, 1, 10, 0, 40, 10), (1, 2, 50, 0, 90, 10)], "page_id long, cell_id long, x1 long, y1 long, x2 long, y2 long")
    assert rows_of(match.split_spans(s, c), "x1", "x2") == [(0, 10), (10, 40), (40, 50), (50, 90), (90, 100)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], BOX)
    for df in (detect.suppress(none), detect.remove_overlaps(none), detect.merge(none, "large"), sequence.group_lines(none), sequence.merge_intervals(none), order.reading_order(none), summary.enclosing_box(none, "page_id"), detect.relabel(none)):
        assert df.isEmpty()


def test_containment_joins_within_pages_only(spark, sf_dir):
    plan = detect.containment(boxes(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_what_it_needs(spark, sf_dir):
    plan = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id").where("user_id = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,3)]" in plan


def test_scores_out_of_range_raise(spark):
    with pytest.raises(Exception, match="out of range"):
        spark.createDataFrame([(2.0,)], "s double").select(G.normalise_score(F.col("s"), 0, 1)).collect()


def test_models(spark, sf_dir):
    rec = document.recognise_blocks(blocks(spark, sf_dir), models.create("stub_recogniser"))
    assert rec.count() == blocks(spark, sf_dir).where("label NOT IN ('image', 'table', 'formula')").count()
    with pytest.raises(ValueError, match="no model named"):
        models.create("unknown")
    with pytest.raises(ValueError, match="registered already"):
        models.register("stub_recogniser")(object)


def test_options():
    o = document.Options().override("overlap=0", "use_table_recognition=true")
    assert o.overlap == 0 and o.use_table_recognition is True
    with pytest.raises(ValueError):
        document.Options(pipeline="none")
    with pytest.raises(ValueError):
        document.Options().override("nope=1")


def test_json_and_markdown_round_trip(spark, sf_dir, tmp_path):
    parsed = document.parse(blocks(spark, sf_dir).where("page_id < 50"), spans(spark, sf_dir))
    writers.save_all({"json": document.to_json(parsed), "markdown": document.to_markdown(parsed)}, str(tmp_path))
    back = readers.page_results(spark, f"{tmp_path}/json")
    assert back.select(F.sum(F.size("parsing_res_list"))).first()[0] == parsed.count()
    assert {r.path for r in spark.read.parquet(f"{tmp_path}/markdown").collect()} == {f"page_{r.page_id}.md" for r in document.to_markdown(parsed).collect()}
    assert len([p for p in (tmp_path / "json").rglob("*.txt")]) <= 8  # no file a page


def test_files_source(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for name in ("a/x.PNG", "a/y.jpg", "z.txt"):
        (tmp_path / name).write_bytes(b"123")
    got = readers.batched(readers.files(spark, str(tmp_path)), 1)
    assert rows_of(got, "length", "batch_id") == [(3, 0), (3, 1)]
    with pytest.raises(FileNotFoundError):
        readers.files(spark, str(tmp_path), ("pdf",))


def test_box_stream(spark, sf_dir, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    given = boxes(spark, sf_dir).where("page_id < 200")
    given.repartition(3, "page_id").write.parquet(src)
    stream.parse_stream(stream.box_stream(spark, src, given.schema, 1), detect.suppress, out, str(tmp_path / "state")).awaitTermination()
    assert rows_of(spark.read.parquet(out), "page_id", "box_id") == rows_of(detect.suppress(given), "page_id", "box_id")


def test_windowed_counts(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert stream.windowed_counts(events).agg(F.sum("n")).first()[0] == events.count()


def test_pixels(spark):
    a = np.arange(24, dtype=np.uint8).reshape(2, 4, 3)
    assert (pixels.rotate(a, 90)[0, 0] == a[1, 0]).all()
    assert pixels.resize(a, 4, 8).shape == (4, 8, 3)
    assert (pixels.resize(a, 2, 4) == a).all()
    assert pixels.pad_to_multiple(a, 32).shape == (32, 32, 3)
    assert pixels.normalise(a).shape == (3, 2, 4)
    assert pixels.components(np.pad(np.ones((4, 5), bool), 2)) == [(2, 2, 7, 6)]
    df = spark.createDataFrame([(1, bytearray(a.tobytes()), 2, 4, 3)], "page_id long, data binary, height int, width int, channels int")
    got = pixels.apply(df, lambda x: pixels.crop(x, 1, 0, 3, 2)).first()
    assert (got.height, got.width) == (2, 2) and bytes(got.data) == a[:, 1:3].tobytes()


def test_read_by_suffix_and_channels(spark, tmp_path):
    import struct

    for k in (2, 0, 1):  # a 24-bit bitmap of 4 x 2 pixels, blue first
        pixels = bytes([30, 20, 10 * k]) * 8
        (tmp_path / f"b{k}.bmp").write_bytes(b"BM" + struct.pack("<IHHI", 54 + 24, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, 4, 2, 1, 24, 0, 24, 2835, 2835, 0, 0) + pixels)
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.md").write_text("# x\ny")
    assert [r.path.rsplit("/", 1)[-1] for r in readers.files(spark, str(tmp_path), content=False).collect()] == ["b0.bmp", "b1.bmp", "b2.bmp"]
    assert readers.read(spark, str(tmp_path / "t" / "a.md")).first().value == "# x\ny"
    image = readers.read(spark, str(tmp_path / "b2.bmp"))
    row = image.select("data", readers.channels("data", "RGB").alias("rgb"), readers.channels("data", "GRAY").alias("gray")).first()
    assert bytes(row.data[:3]) == bytes([30, 20, 20]) and bytes(row.rgb[:3]) == bytes([20, 20, 30]) and row.gray[0] == round(0.114 * 30 + 0.587 * 20 + 0.299 * 20) and len(row.gray) == 8
    scaled = readers.with_scale(image, 8, 8).first()
    assert (scaled.ori_img_size, scaled.img_size, scaled.scale_factors) == ([4, 2], [8, 8], [2.0, 4.0])
    for bad in (lambda: readers.read(spark, "x.pdf"), lambda: readers.channels("data", "CMYK")):
        with pytest.raises(ValueError):
            bad()

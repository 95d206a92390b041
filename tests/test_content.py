"""Text of blocks: real blocks of known text, and the rules one by one."""

import pytest

from pagewright.operators import content as C
from pagewright.plans import document

# Real blocks (label, box, spans) and the text they must have.
BLOCKS = [
    ("doc_title", (427, 308, 2620, 423), [((420, 279, 2648, 457), "CS231A Course Notes 1: Camera Models")], "CS231A Course Notes 1: Camera Models "),
    ("text", (248, 1012, 2801, 1377), [((253, 976, 2821, 1142), "The camera is one of the most essential tools in computer vision. It is the"), ((253, 1079, 2819, 1228), "mechanism by which we can record the world around us and use its output -"), ((247, 1172, 2827, 1323), "photographs - for various applications. Therefore, one question we must ask"), ((245, 1262, 2443, 1411), "in introductory computer vision is: how do we model a camera?")],
     "The camera is one of the most essential tools in computer vision. It is the mechanism by which we can record the world around us and use its output photographs - for various applications. Therefore, one question we must ask in introductory computer vision is: how do we model a camera?"),
    ("figure_title", (353, 2627, 2745, 2711), [((345, 2603, 2772, 2741), "Figure l: A simple working camera model: the pinhole camera model.")], "Figure l: A simple working camera model: the pinhole camera model."),
    ("text", (153, 58, 626, 458), [((153, 43, 640, 138), "Портрет дружини"), ((149, 117, 482, 206), "Прилуцького"), ((147, 193, 449, 263), "полковника"), ((138, 244, 420, 344), "Дарагана."), ((145, 315, 411, 411), "Sereдиna"), ((139, 375, 414, 483), "XVIII ст.")], "Портрет дружини\nПрилуцького\nполковника\n\nДарагана.\n\nSereдиna \nXVIII ст.\n\n"),
    ("text", (723, 2051, 1803, 2212), [((773, 2031, 1814, 2148), "Тільки тоді, коли була розділена"), ((716, 2120, 1816, 2238), "між Росією, Пруссією та Австрією")], "Тільки тоді, коли була розділенаміж Росією, Пруссією та Австрією"),
]


def spans(*rows, label="text"):
    return [C.Span(list(map(float, b)), t, label) for b, t in rows]


@pytest.mark.parametrize("k", range(len(BLOCKS)))
def test_real_blocks(k):
    label, box, rows, want = BLOCKS[k]
    assert C.block_text(label, box, spans(*rows)).text == want


def test_blocks_of_pages(spark):
    blocks, read, bridge = [], [], []
    for k, (label, box, rows, _) in enumerate(BLOCKS):
        blocks.append((k % 2, k, label, *map(float, box)))
        for n, (b, t) in enumerate(rows):
            read.append((k % 2, 100 * k + n, t, *map(float, b)))
            bridge.append((k % 2, k, 100 * k + n))
    sides = "x1 double, y1 double, x2 double, y2 double"
    got = C.block_contents(spark.createDataFrame(blocks, f"page_id long, box_id long, label string, {sides}"), spark.createDataFrame(read[::-1], f"page_id long, span_id long, text string, {sides}"), spark.createDataFrame(bridge, "page_id long, box_id long, span_id long")).collect()
    assert {r.box_id: r.block_content for r in got} == {k: b[3] for k, b in enumerate(BLOCKS)}
    assert {(r.box_id, r.direction, r.lines) for r in got} == {(k, "horizontal", len(b[2])) for k, b in enumerate(BLOCKS)}
    assert {r.box_id: r.seg_end for r in got} == {0: None, 1: 2443.0, 2: None, 3: 414.0, 4: 1816.0}


def test_words_of_a_line():
    line = C.Line(spans(((50, 0, 90, 10), "two"), ((0, 1, 40, 9), "one")), (0, 0, 90, 10))
    line.spans = C.in_reading_order(line, 0)
    assert C.line_text(line, 0, "text", 90, 0, 100) == "one two " and not line.ends
    hyphen = C.Line(spans(((0, 0, 95, 10), "hy-")), (0, 0, 95, 10))
    assert C.line_text(hyphen, 0, "text", 95, 0, 100) == "hy"
    short = C.Line(spans(((0, 0, 40, 10), "End.")), (0, 0, 40, 10))
    assert C.line_text(short, 0, "text", 90, 0, 100) == "End.\n" and short.ends
    assert C.line_text(C.Line(spans(((0, 0, 1, 1), "")), (0, 0, 1, 1)), 0, "text", 9, 0, 9) == ""


def test_formulas_in_lines():
    formula = spans(((45, 0, 55, 10), "x^2"), label="formula")
    line = C.Line(spans(((0, 0, 40, 10), "if")) + formula, (0, 0, 55, 10))
    assert C.line_text(line, 0, "text", 90, 0, 60) == "if $x^2$ "
    alone = C.Line(spans(((0, 0, 58, 10), "y"), label="formula"), (0, 0, 58, 10))
    assert C.line_text(alone, 0, "text", 58, 0, 60) == "\n$y$ " and C.line_text(alone, 0, "formula", 58, 0, 60) == "y "
    inside = C.Line(spans(((0, 0, 100, 10), "left right")) + spans(((40, 0, 60, 10), "x"), label="formula"), (0, 0, 100, 10))
    read = C.in_reading_order(inside, 0, lambda b: ("L", 1.0) if b[0] < 40 else ("R", 0.1), 0.5)
    assert [(s.text, s.label) for s in read] == [("L", "text"), ("x", "formula")]  # the right part was read too badly


def test_labels_with_their_own_line_ends():
    rows = [((0, 0, 100, 10), "one"), ((0, 20, 100, 30), "two")]
    assert C.block_text("content", (0, 0, 100, 30), spans(*rows)).text == "one \ntwo "
    assert C.block_text("doc_title", (0, 0, 100, 30), spans(*rows)).text == "one  two "
    assert C.block_text("text", (0, 0, 100, 30), []) is None
    wide = C.block_text("reference", (0, 0, 900, 30), spans(*rows))  # edges of the spans, not of the block
    assert wide.text == "one two " and wide.lines == 2


def test_vertical_lines():
    rows = [((80, 0, 95, 100), "右"), ((50, 0, 65, 100), "中"), ((20, 0, 35, 60), "左")]
    got = C.block_text("text", (20, 0, 95, 100), spans(*rows))
    assert got.axis == 1 and got.lines == 3 and got.text.replace("\n", "") == "右中左" and got.line_height == 15


def test_parse_uses_the_lines(spark):
    label, box, rows, want = BLOCKS[1]
    sides = "x1 long, y1 long, x2 long, y2 long"
    blocks = spark.createDataFrame([(1, 1, label, 0, 90, *box), (1, 2, "image", 2, 90, 0, 0, 2000, 900), (1, 3, "text", 0, 90, 0, 3000, 100, 3100)], f"page_id long, box_id long, label string, cls_id int, score long, {sides}")
    read = spark.createDataFrame([(1, k, t, 90, *b) for k, (b, t) in enumerate(rows)], f"page_id long, span_id long, text string, score long, {sides}")
    got = {r.box_id: (r.block_content, r.order_index, r.num_of_lines) for r in document.parse(blocks, read).collect()}
    assert got == {2: ("image", 1, 1), 1: (want, 2, 4), 3: ("", 3, 1)}

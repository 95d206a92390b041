"""Reading order: steps on hand-made pages, and whole pages of known order."""

import random

import numpy as np
import pytest

from pagewright.operators import order, reading
from pagewright.operators.paged import by_page

# Blocks of real pages in their right order (label, box, lines, line width, line height, start of the
# first line, end of the last), and the order in which a detector gave them.
PAGES = {
    "article": (
        [("doc_title", (427, 308, 2620, 423), 1, 2228, 178, 420, None), ("text", (923, 549, 2152, 636), 1, 1261, 138, 915, None), ("paragraph_title", (272, 819, 1155, 920), 1, 736, 158, 444, None), ("text", (248, 1012, 2801, 1377), 4, 2478, 154, 253, 2443), ("paragraph_title", (249, 1518, 1368, 1620), 1, 1156, 162, 240, None), ("image", (553, 1797, 2530, 2517), 1, 1, 1, None, None), ("figure_title", (353, 2627, 2745, 2711), 1, 2427, 138, 345, None), ("text", (265, 2821, 2844, 3842), 10, 2594, 148, 376, 2876), ("number", (1531, 3949, 1559, 4008), 1, 102, 109, 1497, None)],
        [7, 3, 5, 4, 2, 6, 8, 0, 1],
    ),
    "formulas": (
        [("formula", (894, 617, 2105, 815), 1, 1, 1, None, None), ("text", (280, 836, 2741, 1534), 9, 2265, 160, 872, 2505), ("paragraph_title", (307, 1641, 1553, 1710), 1, 1275, 124, 298, None), ("text", (316, 1760, 2761, 2691), 10, 2260, 123, 308, 785), ("formula", (556, 2742, 2537, 3078), 1, 1, 1, None, None), ("text", (344, 3145, 2758, 3545), 5, 2207, 126, 441, 1735), ("formula", (585, 3610, 2525, 3934), 1, 1, 1, None, None), ("formula_number", (2645, 654, 2730, 732), 1, 128, 118, 2629, None), ("formula_number", (2674, 2877, 2758, 2952), 1, 129, 116, 2653, None), ("formula_number", (2666, 3772, 2748, 3847), 1, 139, 122, 2638, None)],
        [3, 1, 5, 0, 4, 6, 2, 7, 9, 8],
    ),
    "pictures": (
        [("image", (126, 0, 1482, 1077), 1, 1, 1, None, None), ("image", (1596, 1, 3072, 1067), 1, 1, 1, None, None), ("image", (822, 1171, 2238, 2577), 1, 1, 1, None, None), ("figure_title", (2280, 1176, 2952, 1676), 6, 560, 110, 2265, 2661), ("figure_title", (128, 1187, 737, 1764), 7, 572, 106, 114, 705), ("vision_footnote", (2289, 1764, 2886, 1936), 2, 589, 124, 2276, 2901), ("figure_title", (125, 1853, 749, 2259), 5, 501, 103, 118, 460), ("image", (70, 2623, 2893, 4078), 1, 1, 1, None, None)],
        [2, 0, 1, 7, 6, 4, 3, 5],
    ),
    "columns": (
        [("text", (153, 58, 626, 458), 6, 324, 93, 153, 414), ("text", (171, 3501, 455, 3770), 4, 268, 98, 162, 424), ("image", (734, 59, 1815, 1559), 1, 1, 1, None, None), ("text", (724, 1620, 1807, 2026), 5, 1035, 112, 720, 1500), ("text", (723, 2051, 1803, 2212), 2, 1070, 118, 773, 1816), ("image", (724, 2277, 1797, 3803), 1, 1, 1, None, None), ("text", (1896, 65, 2966, 472), 5, 1089, 129, 1888, 2966), ("text", (1891, 481, 2969, 706), 4, 861, 115, 1891, 2983), ("text", (1881, 726, 2974, 1851), 14, 1088, 110, 1941, 2827), ("text", (1865, 1869, 2977, 3156), 16, 1066, 97, 1928, 2066), ("text", (1860, 3174, 2977, 3815), 8, 1131, 101, 1916, 2995), ("number", (739, 3894, 834, 3943), 1, 141, 103, 719, None)],
        [9, 5, 8, 2, 10, 6, 7, 3, 4, 11, 0, 1],
    ),
}


def block(id_, label, box, lines=1, height=10, **more):
    return reading.Block(id_, label, box, lines, 100, height, **more)


def ids(blocks):
    return [b.id for b in blocks]


@pytest.mark.parametrize("name", PAGES)
def test_whole_pages(spark, name):
    blocks, detected = PAGES[name]
    schema = "page_id long, box_id long, rank int, label string, x1 double, y1 double, x2 double, y2 double, lines int, line_width double, line_height double, seg_start double, seg_end double"
    rows = [(1, place, k, blocks[k][0], *map(float, blocks[k][1]), blocks[k][2], *map(float, blocks[k][3:5]), *(None if v is None else float(v) for v in blocks[k][5:])) for place, k in enumerate(detected)]
    got = order.reading_order(spark.createDataFrame(rows, schema)).orderBy("order_index").collect()
    assert [detected[r.box_id] for r in got] == list(range(len(blocks)))


def test_pages_over_batches(spark):
    """Pages that batches part are put together again, and many pages share a batch."""
    rng = random.Random(1)
    rows = [(p, k, rng.randint(0, 9)) for p in range(200) for k in range(rng.randint(1, 40))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame(rows, "page_id long, box_id long, v int").repartition(3)
        got = by_page(df, ["page_id"], ["box_id"], lambda p: {"page_id": p["page_id"][:1], "vs": [p["v"]]}, "page_id long, vs array<int>", batch_rows=5).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r.page_id: r.vs for r in got} == {p: [v for q, _, v in rows if q == p] for p in range(200)} and len(got) == 200
    assert by_page(df.where("false"), ["page_id"], ["box_id"], lambda p: {"page_id": [], "vs": []}, "page_id long, vs array<int>").isEmpty()


def test_measures():
    a, b = (0, 0, 10, 10), (5, 20, 25, 40)
    assert reading.along(a, b, 0) == 5 / 25 and reading.along(a, b, 0, small=True) == 0.5 and reading.along(a, b, 1) == 0
    assert reading.overlap(a, (5, 5, 10, 10)) == 0.25 and reading.overlap(a, (5, 5, 10, 10), small=True) == 1 and reading.overlap(a, a[:2] + a[:2]) == 0
    assert reading.edge_distance(a, b) == 10 and reading.edge_distance(a, (30, 20, 40, 40), (2, 1, 3, 1)) == 2 * 20 + 3 * 10 and reading.edge_distance(a, (5, 5, 6, 6)) == 0
    assert reading.merged([(0, 0, 5, 1), (5, 0, 8, 1), (9, 0, 12, 1)], 0) == [(0, 8, 2), (9, 12, 1)]
    assert reading.profile([(1, 0, 3, 1), (2, 0, 5, 1)], 0).tolist() == [0, 1, 2, 1, 1]


def test_flat_minima_leave_the_first_out():
    assert reading.flat_minima(np.array([0, 2, 1, 1, 3, 0, 0, 4])) == [(2, 3), (5, 6)]
    assert reading.flat_minima(np.array([0, 2, 2])) == [] and reading.flat_minima(np.array([])) == []


def test_cuts():
    grid = np.array([(0, 0, 40, 10), (50, 0, 90, 10), (0, 20, 40, 30), (50, 20, 90, 30)])
    assert reading.recursive_cut(grid, 1) == [0, 1, 2, 3] and reading.recursive_cut(grid, 0) == [0, 2, 1, 3]
    assert reading.recursive_cut(grid * [-1, 1, -1, 1], 0) == [1, 3, 0, 2]  # from right to left
    touching = np.array([(0, 10, 5, 20), (3, 0, 8, 10)])
    assert reading.recursive_cut(touching, 1) == [0, 1]  # no empty pixel between them: in order of x
    assert reading.recursive_cut(touching + [(0, 1, 0, 1), (0, 0, 0, 0)], 1) == [1, 0]
    assert reading.shrink([(0, 0, 5, 10), (0, 10, 5, 20)], 1) == [(0, 0, 5, 9), (0, 11, 5, 20)]
    assert reading.shrink([(0, 0, 5, 10), (0, 30, 5, 40)], 1) == [(0, 0, 5, 10), (0, 30, 5, 40)]


def test_cuts_place_every_box_once():
    rng = np.random.default_rng(0)
    for _ in range(100):
        corner, size = rng.integers(0, 200, (rng.integers(1, 15), 2)), rng.integers(0, 90, 2)
        boxes = np.hstack([corner, corner + size])
        assert sorted(reading.recursive_cut(boxes, 0)) == sorted(reading.recursive_cut(boxes, 1)) == list(range(len(boxes)))


def test_centred_blocks_and_wide_gaps_part_a_page():
    text = lambda k, y, x=0, w=90: block(k, "text", (x, y, x + w, y + 30), lines=3)
    two = [text(0, 0), text(1, 0, 110), block(2, "paragraph_title", (60, 50, 140, 60)), text(3, 80), text(4, 80, 110)]
    sheet = reading.Sheet(two, (0, 0, 200, 110))
    assert [sorted(ids(b)) for b in reading.bands(sheet, reading.assign_groups(sheet))] == [[0, 1], [2], [3, 4]]
    one = [text(0, 0), text(1, 100), text(2, 135)]
    sheet = reading.Sheet(one, (0, 0, 300, 165))  # a single column, not centred
    assert [ids(b) for b in reading.bands(sheet, reading.assign_groups(sheet))] == [[0], [1, 2]]


def test_gap_between_differently_parted_columns():
    text = lambda k, x, y, w: block(k, "text", (x, y, x + w, y + 30), lines=3)
    # two columns above a narrow gap, three below it, held together by a wide text on top and at the bottom
    page = [text(0, 10, 0, 290), text(1, 10, 31, 120), text(2, 180, 31, 120), text(3, 10, 76, 60), text(4, 120, 76, 60), text(5, 240, 76, 60), text(6, 10, 107, 290)]
    sheet = reading.Sheet(page, (10, 0, 600, 140))
    assert [sorted(ids(b)) for b in reading.bands(sheet, reading.assign_groups(sheet))] == [[0, 1, 2], [3, 4, 5, 6]]


def test_crossing_blocks():
    columns = [block(0, "text", (0, 0, 140, 200), 9), block(1, "text", (160, 0, 300, 200), 9)]
    wide = block(2, "text", (0, 250, 300, 280), 2)
    table = block(3, "table", (20, 300, 280, 400))
    cite = block(4, "reference", (0, 420, 300, 440), 2)
    for b, g in zip([*columns, wide, table, cite], ("normal_text", "normal_text", "normal_text", "vision", "normal_text"), strict=True):
        b.group = g
    reading.mark_crossing([*columns, wide, table, cite], 0)
    assert [b.group for b in (*columns, wide, table, cite)] == ["normal_text", "normal_text", "cross_layout", "cross_layout", "cross_reference"]
    under, over = block(0, "text", (0, 0, 50, 50)), block(1, "table", (40, 0, 90, 50))
    under.group, over.group = "normal_text", "vision"
    reading.mark_crossing([under, over], 0)
    assert (under.group, over.group) == ("normal_text", "cross_layout")


def test_children():
    title, subtitle = block(0, "doc_title", (0, 0, 200, 40), height=40), block(1, "text", (40, 45, 160, 60), height=15)
    picture, caption, note = block(2, "image", (0, 100, 200, 200)), block(3, "figure_title", (0, 205, 200, 215)), block(4, "text", (80, 220, 120, 230))
    head, sub = block(5, "paragraph_title", (0, 300, 100, 310)), block(6, "paragraph_title", (0, 315, 80, 325))
    rest = block(7, "text", (0, 340, 200, 400), 6)
    sheet = reading.Sheet([title, subtitle, picture, caption, note, head, sub, rest], (0, 0, 200, 400))
    reading.assign_groups(sheet)
    assert (ids(title.children), ids(picture.children), ids(head.children)) == ([1], [3, 4], [6])
    assert (subtitle.group, caption.group, note.group, sub.group, note.label) == ("doc_title_text", "vision_title", "vision_footnote", "sub_paragraph_title", "vision_footnote")
    assert picture.box == (0, 100, 200, 230) and picture.own == (0, 100, 200, 200)
    assert ids(reading.with_children([title, picture, head, rest])) == [0, 1, 2, 3, 4, 5, 6, 7] and picture.box == picture.own
    inside = [block(0, "table", (0, 0, 100, 100)), block(1, "formula", (10, 10, 20, 20)), block(2, "text", (300, 0, 400, 100))]
    sheet = reading.Sheet(inside, (0, 0, 400, 100))
    reading.assign_groups(sheet)
    assert ids(inside[0].children) == [1]


def test_insertion():
    column = lambda: [block(k, "text", (0, 100 * k, 100, 100 * k + 80), 4, seg_start=0, seg_end=100) for k in range(3)]
    sheet = reading.Sheet(column(), (0, 0, 300, 300))

    def place(new, group, rule, ordered=None):
        new.group, ordered = group, column() if ordered is None else ordered
        rule(sheet, ordered, new)
        return [k for k, b in enumerate(ordered) if b is new][0]

    picture = lambda y, label="image": block(9, label, (0, y, 100, y + 10))
    assert place(picture(185), "vision", reading.insert_by_weight) == 3  # not into a paragraph that goes on
    apart = [block(k, "text", (0, 100 * k, 100, 100 * k + 80), 4) for k in range(3)]
    assert place(picture(185), "vision", reading.insert_by_weight, apart) == 2
    assert place(picture(300, "formula"), "cross_layout", reading.insert_by_weight) == 3
    assert place(block(9, "reference", (0, 190, 100, 199)), "cross_reference", reading.insert_reference) == 2
    assert place(block(9, "reference", (0, -20, 100, -10)), "cross_reference", reading.insert_reference) == 1
    assert place(block(9, "seal", (2, 101, 9, 110)), "unordered", reading.insert_by_corner) == 2
    assert place(block(9, "seal", (2, 101, 9, 110)), "unordered", reading.insert_by_corner, []) == 0
    far = [block(k, "region", (0, 0, 1, 1), distance=d) for k, d in enumerate((5.0, 9.0))]
    assert [place(block(9, "region", (0, 0, 1, 1), distance=d), "region", reading.insert_by_distance, list(far)) for d in (1, 5, 7, 10)] == [0, 1, 1, 2]


def test_headers_footers_and_two_levels():
    page = [block(0, "number", (90, 390, 110, 400)), block(1, "footnote", (0, 370, 200, 380)), block(2, "text", (0, 200, 200, 300), 9), block(3, "header", (0, 0, 200, 10)), block(4, "text", (0, 50, 200, 150), 9)]
    assert ids(reading.order_sheet(reading.Sheet(page, (0, 0, 200, 400)))) == [3, 4, 2, 1, 0]
    left, right = [block(k, "text", (0, 120 * k, 90, 120 * k + 50), 9) for k in (0, 1)], [block(2 + k, "text", (110, 120 * k, 200, 120 * k + 50), 9) for k in (0, 1)]
    assert ids(reading.order_regions([((110, 0, 200, 170), right), ((0, 0, 90, 170), left)], (0, 0, 200, 170))) == [0, 1, 2, 3]


def test_vertical_text_reads_from_right_to_left():
    page = [block(k, "text", (100 * k, 0, 100 * k + 80, 300), 4, axis=1) for k in range(3)]
    assert ids(reading.order_sheet(reading.Sheet(page, (0, 0, 280, 300)))) == [2, 1, 0]


def test_every_block_has_one_place():
    rng = random.Random(3)
    labels = ["text", "paragraph_title", "doc_title", "image", "table", "figure_title", "formula", "reference", "abstract", "seal", "number", "header", "footer"]
    for _ in range(300):
        page = []
        for k in range(rng.randint(1, 14)):
            x, y = rng.randint(0, 400), rng.randint(0, 600)
            page.append(reading.Block(k, rng.choice(labels), (x, y, x + rng.randint(1, 300), y + rng.randint(1, 200)), rng.randint(1, 9), rng.randint(1, 200), rng.randint(1, 30), axis=rng.choice((0, 0, 0, 1))))
        assert sorted(ids(reading.order_sheet(reading.Sheet(page, (0, 0, 700, 800))))) == list(range(len(page)))

"""The training-data operators against plain Python, and on awkward tables."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagewright.llm import ann, components, decontaminate, html_text, langid, minhash, packing, paragraphs, passages, queries, suffix_dedup, tokens, toxicity

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long, bucket int, h long, id string, component string, spans string"


def words(text):
    return WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode())


def shingles(text, k=5):
    w = words(text)
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def union_find(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "src0", len(text) if text else None, 1, 1, "x", "x", "x")


@pytest.fixture(scope="session")
def awkward(spark):
    """Null and empty texts, no letters, a very long text, repeated rows, a null id and label, and clashing columns."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghé", k=rng.randint(2, 8))) for _ in range(400)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    base, long_ = text(120), text(30_000)
    rows = [row(1, None), row(2, ""), row(3, "123 ... !!"), row(4, base), row(5, base), row(6, base + " extra"), row(7, long_), row(7, long_), row(8, text(60), None), row(None, text(40)), row(9, "\n\n" + base + "\n" + text(50)), row(10, "x")]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# --- 1 packing -------------------------------------------------------------------------------


def check_bins(rows, capacities):
    per = collections.defaultdict(list)
    for r in rows:
        if r.bin_id is not None:
            per[r.bin_id].append(r)
    for b in per.values():
        b.sort(key=lambda r: r.bin_offset)
        at = 0
        for r in b:
            assert r.bin_offset == at
            at += r.n_tokens
        assert {r.bin_used for r in b} == {at}
        assert {r.bin_capacity for r in b} == {min(c for c in capacities if c >= at)}
    return per


def test_pack_places_every_token_once(spark):
    rng = random.Random(1)
    sized = [(k, rng.choice([0, 1, 5, 100, 511, 512, 513, 8192, 8193, 20000, rng.randint(1, 3000)])) for k in range(3000)] + [(None, 7), (5, None), (1, 10)]
    df = spark.createDataFrame([(*r, 3) for r in sized], "doc_id long, n_tokens long, bin_id long")
    for group_rows in (10_000, 300):
        rows = packing.best_fit(df, group_rows=group_rows).collect()
        per = check_bins(rows, packing.CAPACITIES)
        assert sum(r.n_tokens for r in rows) == sum(n or 0 for _, n in sized)
        used, room = sum(b[0].bin_used for b in per.values()), sum(b[0].bin_capacity for b in per.values())
        assert used / room > 0.97


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, sizes = packing.pack([60, 50, 40, 30], (100,), 0, float("inf"))
    assert bins.tolist() == [0, 1, 0, 1] and offsets.tolist() == [0, 0, 60, 50] and sizes.tolist() == [100, 100]


def test_least_cost_and_downsizing():
    left = lambda *n: packing.Left(np.array(n, int))
    assert packing.least_cost_capacity(10, left(), (16, 64)) == 64  # both end as 16
    assert packing.least_cost_capacity(600, left(*[100] * 90), (512, 1024, 8192)) == 1024
    assert packing.least_cost_capacity(600, left(*[500] * 90), (1024, 2048), overhead=64) == 2048  # 600 + 500 do not fit 1024
    assert packing.least_cost_capacity(600, left(*[424] * 90), (1024, 2048), overhead=64) == 1024
    assert left(5, 5, 3, 9).fill(14) == 14 and left(5, 5, 3, 9).fill(4) == 3 and left().fill(9) == 0
    assert packing.pack([10], (16, 64, 1024))[2].tolist() == [16]


def total_cost(lengths, capacities, overhead, span):
    return sum(packing.cost(int(c), overhead, span) for c in packing.pack(lengths, capacities, overhead, span)[2])


def least_total(lengths, capacities, overhead, span):
    """The least cost of all ways to share the pieces among bins."""
    best = [float("inf")]

    def place(k, sums):
        if k == len(lengths):
            best[0] = min(best[0], sum(packing.cost(min(c for c in capacities if c >= s), overhead, span) for s in sums))
            return
        for b in range(len(sums)):
            if sums[b] + lengths[k] <= max(capacities):
                place(k + 1, [*sums[:b], sums[b] + lengths[k], *sums[b + 1 :]])
        place(k + 1, [*sums, lengths[k]])

    place(0, [])
    return best[0]


def test_packing_is_near_the_exhaustive_optimum():
    rng = random.Random(12)
    ratios = []
    for _ in range(150):
        capacities, overhead, span = (16, 32, 64), rng.choice([0.0, 2.0, 8.0]), rng.choice([64.0, 512.0])
        lengths = [rng.randint(1, rng.choice([20, 64])) for _ in range(rng.randint(1, 7))]
        ratios.append(total_cost(lengths, capacities, overhead, span) / least_total(lengths, capacities, overhead, span))
    assert min(ratios) >= 1 - 1e-9 and np.mean(ratios) < 1.05 and max(ratios) < 1.35


def test_joint_sizes_cost_less_than_any_one():
    rng = random.Random(2)
    for _ in range(5):
        lengths = [min(8192, int(rng.lognormvariate(6, 1.2)) + 1) for _ in range(3000)]
        joint = total_cost(lengths, packing.CAPACITIES, packing.OVERHEAD, packing.SPAN)
        bins, _, _ = packing.pack(lengths, (8192,), packing.OVERHEAD, packing.SPAN)
        assert joint < 0.9 * packing.cost(8192) * len(set(bins.tolist()))
        opened = {packing.least_cost_capacity(n, packing.Left(np.array(lengths)), packing.CAPACITIES) for n in lengths}
        assert len(opened) >= 4


def test_packing_awkward(awkward, nothing):
    sized = packing.token_lengths(awkward)
    rows = packing.best_fit(sized).collect()
    check_bins(rows, packing.CAPACITIES)
    assert {r.doc_id for r in rows if r.bin_id is None} == {1, 2}
    assert packing.best_fit(packing.token_lengths(nothing)).isEmpty()


# --- 2 html ----------------------------------------------------------------------------------

PAGES = [
    ("<html><head><title>T</title></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav><article><h1>A&amp;B</h1><p><b>One</b>two<br>three<p>four&nbsp;five</article><footer>F</footer></body>", "A&B Onetwo three four five"),
    ("<div class='sidebar'>S</div><article><p>x <!-- no --> y</p><script>var a='</p>';</script><div class=\"ad\">ad</div><aside>z</aside></article><section id=comments><article class=comment>bad</article></section>", "x y"),
    ("<body><header>H</header><main><p>short</p><form><p>mail</p></form></main>", "short"),
    ("<nav>open menu <article><p>kept</p></article>", "kept"),
    ("<form id=aspnet><article><p>kept</p></article></form>", "kept"),
    ("<p>1 &lt; 2 &am", "1 < 2 &am"),
    ("plain", "plain"),
    ("", ""),
    (None, ""),
    ("<script>x", ""),
]


def test_html_cases():
    for page, want in PAGES:
        assert html_text.main_text(page) == want, page


def test_surge_and_dive():
    assert html_text.surge_and_dive([0, 0, 90, 0, 10, 0, 0, 0, 50, 0], 3, 80) == [(2, 5)]
    assert html_text.surge_and_dive([0, 5, 0, 0, 0, 7], 2, 0) == [(1, 2), (5, 6)]
    assert html_text.surge_and_dive([]) == []


def test_html_on_unmarked_page():
    menu = "".join(f"<li><a href=/{k}>menu entry {k}</a></li>" for k in range(8))
    body = "".join(f"<p>{'sentence of the story ' * 12}{k}</p>" for k in range(4))
    got = html_text.main_text(f"<ul>{menu}</ul><div><div>{body}</div></div>")
    assert "menu" not in got and got.count("story") == 48


def brute_ranges(counts, window, threshold):
    """Sums of all windows anew; a state per line."""
    kept, on = [], False
    for k in range(len(counts)):
        total = sum(counts[k : k + window])
        on = on and total > 0 or not on and counts[k] > 0 and total > threshold
        kept.append(on)
    return kept


def test_windows_equal_brute_force():
    rng = random.Random(8)
    for _ in range(300):
        counts = [rng.choice([0, 0, 0, 3, 40, 200]) for _ in range(rng.randint(0, 30))]
        window, threshold = rng.randint(1, 5), rng.choice([0, 30, 80])
        kept = [False] * len(counts)
        for s, e in html_text.surge_and_dive(counts, window, threshold):
            kept[s:e] = [True] * (e - s)
        assert kept == brute_ranges(counts, window, threshold)


def test_html_where_the_marks_are_wrong():
    story = "".join(f"<p>{'a sentence of the story ' * 20}{k}</p>" for k in range(4))
    short = "<p>Yes.</p><p>See <a href=/x>a long enough link to something else</a></p>"
    menu = "".join(f"<li><a href=/{k}>entry {k}</a></li>" for k in range(6))
    teaser = html_text.main_text(f"<ul>{menu}</ul><article><p>Teaser.</p></article><div>{story}{short}{story}</div><ul>{menu}</ul>")
    assert teaser.startswith("Teaser.") and teaser.count("story") == 160 and "Yes. See a long enough" in teaser and "entry" not in teaser
    marked = html_text.main_text(f"<div>{'some words beside it ' * 8}</div><article>{short}</article><ul>{menu}</ul>")
    assert marked == "Yes. See a long enough link to something else"
    inside = html_text.main_text(f"<article><p>Short.</p><div class=related>{menu}</div><nav>{menu}</nav><form>x</form><p>End.</p><section class=comments>{story}</section></article>")
    assert inside == "Short. End."


def test_html_awkward(spark):
    rows = [(1, "u", None, "x", 5), (1, "u", None, "x", 5), (2, None, "", "y", 6), (None, "v", "<article>A <b>b</b></article>", "z", 7), (3, "w", "<p>" + "long " * 300_000, "z", 8), (3, "w", "<main>other</main>", "z", 8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = sorted((r.page_id or 0, r.n_chars, r.text[:10]) for r in html_text.extract(df).collect())
    assert got == [(0, 3, "A b"), (1, 0, ""), (1, 0, ""), (2, 0, ""), (3, 5, "other"), (3, 1_499_999, "long long ")]
    assert html_text.extract(df.where("false")).isEmpty()


def test_html_query(spark, sf_dir):
    rows = queries.queries()["op2_html_extraction"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    assert all(r.n_chars == len(r.text) and r.text == " ".join(r.text.split()) for r in rows)


def test_html_very_long_and_hostile():
    assert html_text.main_text("<article><p>" + "word " * 200_000).count("word") == 200_000
    assert html_text.main_text('<a href="' * 2000 + "x") is not None


# --- 3 toxicity ------------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.queries()["op3_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows)
    assert right / len(rows) > 0.93 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted and not r.toxic for r in rows) <= 2


def test_block_max_search_is_exact():
    rng = np.random.default_rng(2)
    x = rng.random((500, 30)) * (rng.random((500, 30)) < 0.2)
    x[3] = x[7]
    x = x[x.any(1)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    at, term = np.nonzero(x)
    index = toxicity.BlockMaxIndex(np.arange(len(x)) * 3, np.zeros(len(x), int), at, term, x[at, term], 30, 16)
    for left_out in (False, True):
        own = np.argsort(index.rank)  # the position of each example
        place, score = index.nearest(at, term, x[at, term], len(x), 9, own if left_out else None)
        for q in range(len(x)):
            cos = np.round(x @ x[q], 12)
            want = [i for i in np.lexsort((np.arange(len(x)), -cos)) if cos[i] > 0 and not (left_out and i == q)][:9]
            assert (index.ids[place[q][place[q] >= 0]] // 3).tolist() == want and np.allclose(score[q][: len(want)], cos[want])


def brute_toxicity(texts, labels):
    """(evidence, score) of all texts by plain dense arithmetic; labels: {doc_id: 0 or 1} of the examples."""

    def terms(t):
        out = collections.Counter()
        for b in words(t.lower()):
            out[b] += 1
            out["pooled"] += 1
            out.update((b[:n],) for n in toxicity.BEGINNINGS if len(b) > n)
        return out

    bags = {i: terms(t or "") for i, t in texts.items()}
    n, n1 = len(labels), sum(labels.values())
    tried = set().union(*(bags[i] for i in labels))
    penalty = np.log(n) + 2 * toxicity.GAMMA * np.log(len(tried))
    weight = {}
    for term in tried:
        seen = [labels[i] for i in labels if term in bags[i]]
        a, c, g = sum(seen), len(seen), 0.0
        for part, total, share in ((a, c, n1 / n), (c - a, c, 1 - n1 / n), (n1 - a, n - c, n1 / n), (n - n1 - c + a, n - c, 1 - n1 / n)):
            g += 2 * part * np.log(part / (total * share)) if part else 0.0
        idf = np.log(1 + len(texts) / sum(term in b for b in bags.values()))
        if term == "pooled" or g > penalty:
            weight[term] = idf * (1.0 if term == "pooled" else 1 - penalty / g)

    def vector(i):
        v = {t: (1 + np.log(k)) * weight[t] for t, k in bags[i].items() if t in weight}
        norm = np.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}

    vectors = {i: vector(i) for i in texts}

    def vote(i, among):
        cos = sorted((-round(sum(x * vectors[j].get(t, 0) for t, x in vectors[i].items()), 12), j) for j in among)
        near = [(-c, j) for c, j in cos if c < 0][: toxicity.NEIGHBOURS]
        w = [1 / (max(0, 1 - c) + 0.05) for c, _ in near]
        return [j for _, j in near], sum(x * labels[j] for x, (_, j) in zip(w, near, strict=True)) / sum(w) if near else None

    there = sorted(j for j in labels if vectors[j])
    some = [j for j in there if len(vectors[j]) > 1]
    knots, levels = toxicity.isotonic(np.array([vote(j, [i for i in there if i != j])[1] for j in some]), np.array([labels[j] for j in some], float), np.ones(len(some)))
    without = np.mean([labels[j] for j in labels if len(vectors[j]) < 2])
    found = {i: vote(i, there) if len(v) > 1 else ([], None) for i, v in vectors.items()}
    return {i: (near, without if v is None else float(np.clip(np.interp(v, knots, levels), 0, 1))) for i, (near, v) in found.items()}


def test_toxicity_equals_dense_arithmetic(spark):
    sf = "/root/testdata/sf0.01"
    documents, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    texts = {r.doc_id: r.text for r in documents.collect()}
    known = {r.doc_id: r.toxic for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and texts.get(r.doc_id) is not None}
    want = brute_toxicity(texts, known)
    rows = toxicity.predict_toxicity(documents, labels).collect()
    assert len(rows) == len(texts) and sum(bool(near) for near, _ in want.values()) > 20
    for r in rows:
        near, score = want[r.doc_id]
        assert [e.doc_id for e in r.evidence] == near[:5] and abs(r.score - score) < 1e-9 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_isotonic():
    knots, levels = toxicity.isotonic(np.array([0, 1, 2, 3.0]), np.array([0, 1, 0, 1.0]), np.ones(4))
    assert levels.tolist() == [0, 0.5, 1] and knots.tolist() == [0, 1.5, 3]


def test_toxicity_awkward(spark, awkward, nothing):
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 1), (5, 0, 0), (6, 1, 0), (None, 0, 1), (99, 1, 1), (1, 0, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.predict_toxicity(awkward, labels).collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.predict_toxicity(nothing, labels).isEmpty()
    assert len(toxicity.predict_toxicity(awkward, labels.where("false")).collect()) == 12


# --- 4 token files ---------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    for top in (1, 2, 1000, 2**32 - 1):
        x = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
        x[rng.random(n) < 0.05] = 2**32 - 1
        stream = tokens.encode_blocks(x)
        assert (tokens.decode_blocks(stream) == x).all()
        assert (tokens.decode_blocks(stream, 1, 3) == x[128:384]).all()


def expected_tokens(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.tokenizer_path())
    at, out = 0, []
    for doc_id, text in docs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, at, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_files(spark, documents):
    got = tokens.read_token_files(tokens.write_token_files(documents, segment_tokens=5000)).orderBy("start").collect()
    assert [tuple(r) for r in got] == expected_tokens([(r.doc_id, r.text) for r in documents.orderBy("doc_id").collect()])


def test_token_files_awkward(awkward, nothing):
    got = tokens.read_token_files(tokens.write_token_files(awkward)).collect()
    want = expected_tokens([(r.doc_id, r.text) for r in awkward.collect()])
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted((n, c) for _, _, n, c in want)
    assert sorted(r.start for r in got)[0] == 0 and got and max(r.start + r.n_tokens for r in got) == sum(n for _, _, n, _ in want)
    assert tokens.read_token_files(tokens.write_token_files(nothing)).isEmpty()


def test_encoder_equals_the_tokenizer():
    odd = ["", "  ", "A\x01b \x01 c", "a\x1cB H̱ Ḣ É", "<|endoftext|>x it's ΣΑΣ İx K", "  x　y z", "don't 'll 12ab,,.. mail@x.org", "你好 أل"]
    e = tokens.Encoder(tokens.tokenizer_path(), 3)
    for text, ids in zip(odd, e.encode([t.encode() for t in odd]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids, text


# --- 5 nearest neighbours --------------------------------------------------------------------


def brute_neighbours(rows, k, is_query):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    out = {}
    for q, v in zip(ids.tolist(), x, strict=True):
        if is_query(q):
            s = x @ v
            out[q] = [int(ids[i]) for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
    return out


def test_ann_recall(spark):
    sf = "/root/testdata/sf0.1"
    got = collections.defaultdict(list)
    for r in queries.queries()["op5_nearest_neighbours"](spark, sf).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_neighbours(rows, 20, lambda q: q % 20 == 0)
    assert got.keys() == want.keys() and {len(g) for g in got.values()} == {20}
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.95


def test_ann_awkward(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=5).tolist(), 0) for k in range(60)] + [(100 + k, [1.0, 0.0, 2.0, 0.0, 0.0], 0) for k in range(80)]
    bad = [(200, None, 0), (220, [0.0] * 5, 0), (240, [1.0, None, 0.0, 0.0, 0.0], 0), (260, [float("nan")] * 5, 0), (280, [float("inf")] * 5, 0), (300, [1.0], 0), (320, [], 0), (None, [1.0] * 5, 0)]
    df = spark.createDataFrame(rows + bad + rows[:3], "vec_id long, embedding array<double>, rank int")
    got = collections.defaultdict(list)
    for r in ann.search(df, F.col("vec_id") % 20 == 0, block_vectors=16, query_chunk=3, rerank=16).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got == brute_neighbours([(a, np.array(b)) for a, b, _ in rows], 20, lambda q: q % 20 == 0)
    assert ann.search(df.where("false"), F.lit(True)).isEmpty()
    few = ann.search(df.where("vec_id < 3"), F.lit(True)).collect()
    assert len(few) == 6
    twice = spark.createDataFrame([(1, [1.0, 2.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [3.0, 3.0])], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in ann.search(twice, F.col("vec_id") == 1).collect()) == [(1, 1, 3, 3.0), (1, 2, 2, 0.0)]


def test_ann_skips_blocks_without_loss(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(12, 16)) * 3
    x = centres[rng.integers(0, 12, 4000)] + rng.normal(size=(4000, 16)) * 0.3
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = collections.defaultdict(list)
    for r in ann.search(df, F.col("vec_id") % 20 == 0, block_vectors=200, train_vectors=500, query_chunk=64).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    want = brute_neighbours(list(enumerate(x)), 20, lambda q: q % 20 == 0)
    assert got.keys() == want.keys() and {len(g) for g in got.values()} == {20}
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.95
    floor = ann.floors(x[:5], x[:300], 21)
    assert all((x[:300] @ q >= f - 1e-9).sum() >= 21 for q, f in zip(x[:5], floor, strict=True))


def test_anisotropic_codes_keep_the_parallel_part():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 16))
    q, plain = ann.fit(x), ann.fit(x, threshold=0.0)
    assert plain.eta == 1.0 and q.eta == 1.0 or q.eta >= 1.0
    strong = ann.Quantiser(plain.centres.copy(), 16, 20.0)

    def parallel(quantiser):
        codes = quantiser.encode(x)
        rest = x - quantiser.centres[np.arange(8), codes].reshape(len(x), -1)
        return float((((rest * x).sum(1) / np.linalg.norm(x, axis=1)) ** 2).mean())

    assert parallel(strong) < 0.5 * parallel(plain)


# --- 6 exact substrings ----------------------------------------------------------------------


def brute_substrings(docs, length=100):
    first, out = {}, {}
    for doc_id, text in docs:
        t = (text or "").encode()
        cover = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            s = t[i : i + length]
            if first.setdefault(s, (doc_id, i)) != (doc_id, i):
                cover[i] += 1
                cover[i + length] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out[doc_id] = (len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def repeating(spark):
    rng = random.Random(9)
    passage = [" ".join("".join(rng.choices("abcdé", k=5)) for _ in range(n)) for n in (17, 30, 60)]
    texts = ["".join(rng.choices(["a" * 150, "xyz", *passage, "ab" * 80, passage[2][10:180]], k=6)) for _ in range(40)] + [None, "", passage[0][:99], passage[0][:100], "a" * 99, "z" * 100, texts_same := "q" * 300, texts_same]
    return [(k, t) for k, t in enumerate(texts)]


def test_substrings_equal_brute_force(spark):
    docs = repeating(spark)
    df = spark.createDataFrame([(*d, "s") for d in docs], "doc_id long, text string, spans string").repartition(3)
    want = brute_substrings(docs)
    for hot_rows in (200_000, 2):  # the second salts every anchor that occurs twice
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.dedup_substrings(df, hot_rows=hot_rows).collect()}
        assert got == want


def test_substrings_query(spark, duck, sf_dir):
    got = queries.queries()["op6_suffix_dedup"](spark, sf_dir)
    want = duck.sql(suffix_dedup.ORACLE).fetchall()
    assert sorted(tuple(r) for r in got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()) == sorted(want)


def test_substrings_awkward(awkward, nothing):
    rows = suffix_dedup.dedup_substrings(awkward).collect()
    assert len(rows) == 12
    by = {r.doc_id: r for r in rows}
    assert (by[1].n_bytes, by[2].n_bytes, by[4].n_removed) == (0, 0, 0)
    assert by[5].n_removed == by[5].n_bytes and by[7].n_removed == 0
    assert suffix_dedup.dedup_substrings(nothing).isEmpty()


def test_deep_shallow_sorts():
    rng = np.random.default_rng(4)
    words_ = rng.integers(0, 2, (3000, 6)).astype(np.uint64) << np.uint64(40)
    group = np.sort(rng.integers(0, 20, 3000))
    rank = suffix_dedup.deep_shallow(group, words_, shallow=2)
    keys = [(g, *w) for g, w in zip(group.tolist(), words_.tolist(), strict=True)]
    order = sorted(set(keys))
    count = collections.Counter(keys)
    starts, at = {}, 0
    for k in order:
        starts[k], at = at, at + count[k]
    assert rank.tolist() == [starts[k] for k in keys]
    assert suffix_dedup.deep_shallow(np.zeros(0, int), np.zeros((0, 3), np.uint64)).tolist() == []


# --- 7 decontamination -----------------------------------------------------------------------


def brute_contamination(docs, items, window=13):
    wins = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wins[tuple(w[i : i + window])].add(str(item))
    lengths = {len(w) for w in wins}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i : i + n])) in wins:
                    hit |= set(range(i, i + n))
                    found |= wins[g]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def contamination_case(spark):
    rng = random.Random(3)
    v = ["w%d" % k for k in range(30)]
    items = [(k, " ".join(rng.choices(v, k=n))) for k, n in enumerate([5, 13, 14, 40, 1, 40])] + [(90, None), (91, ""), (92, "...")]
    docs = [(k, " ".join(rng.choices(v, k=50)) + " " + (items[k % 6][1] if k % 3 else "") + " " + " ".join(rng.choices(v, k=k))) for k in range(60)] + [(60, None), (61, ""), (62, items[1][1].upper()), (62, items[1][1].upper())]
    return docs, items


def test_contamination_equals_brute_force(spark):
    docs, items = contamination_case(spark)
    d = spark.createDataFrame([(*x, "r") for x in docs], "doc_id long, text string, runs string")
    b = spark.createDataFrame(items, "item_id long, text string")
    for block in (16 << 20, 60):  # the second makes many blocks
        got = decontaminate.contamination(d, b, block_bytes=block).drop("runs", "matches").collect()
        assert sorted(tuple(r) for r in got) == sorted(brute_contamination(docs, items))
        bad = collections.Counter(r[0] for r in brute_contamination(docs, items) if not r[5])
        assert collections.Counter(r.doc_id for r in decontaminate.remove_contaminated(d, b, block_bytes=block).collect()) == bad
    assert decontaminate.contamination(d, b.where("false")).where("contaminated").isEmpty()
    assert decontaminate.contamination(d.where("false"), b).isEmpty()


def test_longest_matches_equal_brute_force(spark):
    docs, items = contamination_case(spark)
    got = {r.doc_id: {tuple(m) for m in r.matches} for r in decontaminate.contamination(spark.createDataFrame(docs[:60], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for doc_id, text in docs[:60]:
        w, want = words(text), set()
        for item, t in items:
            v = words(t)
            n = min(13, len(v))
            place = {}
            for q in range(len(v) - n + 1 if v else 0):
                place.setdefault(tuple(v[q : q + n]), q)
            at = [place.get(tuple(w[p : p + n])) if v else None for p in range(len(w) - n + 1)]
            for p, q in enumerate(at):
                if q is not None and not (p and q and at[p - 1] == q - 1):
                    e = p
                    while e + 1 < len(at) and at[e + 1] is not None and at[e + 1] == at[e] + 1:
                        e += 1
                    assert w[p : e + n] == v[q : q + e - p + n]
                    want.add((str(item), q, p, e - p + n))
        assert got[doc_id] == want


def test_remove_contaminated_keeps_columns(spark):
    docs, items = contamination_case(spark)
    d = spark.createDataFrame([(i, t, i, "x") for i, t in docs], "doc_id long, text string, row long, `_row` string")
    b = spark.createDataFrame(items, "item_id long, text string")
    for block in (16 << 20, 60):
        kept = decontaminate.remove_contaminated(d, b, block_bytes=block)
        assert kept.columns == d.columns and all(r.row == r.doc_id and r._row == "x" for r in kept.collect())


def test_contamination_query(spark, duck, sf_dir):
    got = queries.queries()["op7_decontaminate"](spark, sf_dir)
    names = got.columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(duck.sql(f"SELECT {', '.join(names)} FROM ({decontaminate.ORACLE})").fetchall())


def test_contamination_awkward(spark, awkward):
    b = spark.createDataFrame([(1, awkward.where("doc_id = 4").first().text)], "item_id long, text string")
    rows = {(r.doc_id, r.n_hit) for r in decontaminate.contamination(awkward, b).collect() if r.contaminated}
    assert rows == {(4, 120), (5, 120), (6, 120), (9, 120)}


# --- 8 near-duplicates -----------------------------------------------------------------------


def near_copies(n=400, seed=6):
    """Families of copies with edits, a common passage, exact copies, and texts of few words."""
    rng = random.Random(seed)
    v = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    passage = rng.choices(v, k=40)
    out = []
    for k in range(n):
        base = rng.choices(v, k=rng.randint(60, 150)) if k % 4 == 0 or not out else list(rng.choice(out[-40:]))
        if k % 4:
            for _ in range(rng.randint(0, 4)):
                base[rng.randrange(len(base))] = rng.choice(v)
        elif k % 8 == 0:
            base = base[:20] + passage + base[20:]
        out.append(base)
    texts = [" ".join(w) for w in out] + ["few words", "few words", "few, WORDS!", "", None, "!!", "a b c d e f"]
    return list(enumerate(texts))


def test_near_duplicates_equal_brute_force(spark):
    docs = near_copies()
    sets = {i: shingles(t) for i, t in docs}
    links = [(a, b) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= 0.8]
    want = union_find(sets, links)
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in docs], "doc_id long, text string, class_id int, signature string").repartition(5)
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(df).collect()}
    assert got == want
    kept = minhash.keep_one(df)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values())) and kept.columns == df.columns


def test_rows_that_share_an_id_are_not_lost(spark):
    rng = random.Random(4)
    a, b, c = (" ".join(rng.choices("abcdefghijklmnop", k=200)) for _ in range(3))
    rows = [(1, a, 1), (1, b, 2), (1, b, 3), (2, a, 4), (3, b, 5), (4, c, 6), (4, None, 7), (4, None, 8), (5, c + " x", 9), (None, c, 10)]
    df = spark.createDataFrame([(*r, "g") for r in rows], "doc_id long, text string, row_key long, _gone string")
    kept = minhash.keep_one(df)
    assert kept.columns == df.columns
    left = sorted(r.row_key for r in kept.collect())
    assert len(left) == 5 and set(left) - {2, 3, 7, 8} == {1, 6, 10}
    classes = collections.Counter((r.doc_id, r.class_id, r.is_kept) for r in minhash.near_duplicates(df).collect())
    assert classes == {(1, 1, True): 3, (2, 1, False): 1, (3, 1, False): 1, (4, 4, True): 3, (5, 4, False): 1, (None, None, None): 1}


def test_near_duplicates_with_lines_that_repeat(spark):
    rng = random.Random(17)
    v = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    docs = []
    for _ in range(40):
        base, line = rng.choices(v, k=100), rng.choices(v, k=12)
        docs += [base, base + line * rng.choice([20, 50, 200])]
    docs = [(i, " ".join(w)) for i, w in enumerate(docs)]
    sets = {i: shingles(t) for i, t in docs}
    want = union_find(sets, [(a, b) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= 0.8])
    assert all(want[i] == i - i % 2 for i in want)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(df).collect()} == want


def test_cells_hold_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CELL", 4)  # many blocks and chunks
    docs = near_copies(200, 8)
    sets = {i: shingles(t) for i, t in docs}
    want = union_find(sets, [(a, b) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= 0.8])
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(df).collect()} == want


def test_near_duplicates_awkward(awkward, nothing):
    rows = minhash.near_duplicates(awkward).collect()
    assert len(rows) == 12
    by = {r.doc_id: r.class_id for r in rows}
    assert by == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 4, 7: 7, 8: 8, 9: 9, 10: 10, None: None}
    assert minhash.near_duplicates(nothing).isEmpty()
    assert sorted(str(r.doc_id) for r in minhash.keep_one(awkward).collect()) == sorted(map(str, [1, 2, 3, 4, 7, 8, 9, 10, None]))


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 2**63, 300).astype(np.uint64)
    a, b = np.arange(0, 200), np.arange(50, 300)
    wa, wb = np.ones(200), np.ones(250)
    wa[60:80] = 5.0
    element = np.concatenate([ids[a], ids[b]])
    s = minhash.prob_minhash(element, np.concatenate([wa, wb]), np.repeat([0, 1], [200, 250]), 2, 4096)
    p, q = dict(zip(a, wa, strict=True)), dict(zip(b, wb, strict=True))
    both = set(a) | set(b)
    want = sum(1 / sum(max(p.get(y, 0) / p[x], q.get(y, 0) / q[x]) for y in both) for x in set(a) & set(b))
    assert abs((s[0] == s[1]).mean() - want) < 0.04


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 440)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for p in links for x in p if p[0] != p[1]}
    want = union_find({x for p in links for x in p}, links)
    assert got == {n: want[n] for n in nodes}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).isEmpty()


# --- 9 language ------------------------------------------------------------------------------


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.queries()["op9_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98 and all(0 <= r.score <= 1 for r in rows)


def test_language_mixture(spark, documents):
    model = langid.fit(documents)
    en = " ".join(r.text for r in documents.where("lang = 'en' AND n_chars > 800").limit(2).collect())[:900]
    de = " ".join(r.text for r in documents.where("lang = 'de' AND n_chars > 400").limit(2).collect())[:600]
    df = spark.createDataFrame([(1, en + " " + de), (2, en)], "doc_id long, text string")
    one, two = langid.identify(df, model).orderBy("doc_id").collect()
    assert one.lang_pred == "en" and {x.lang for x in one.languages} == {"en", "de"}
    assert abs(one.score - 0.6) < 0.1 and [x.lang for x in two.languages] == ["en"]


def test_language_awkward(awkward, nothing):
    rows = langid.predict_languages(awkward).collect()
    assert len(rows) == 12 and {r.doc_id for r in rows if r.lang_pred == "und"} == {1, 2, 3}
    assert langid.predict_languages(nothing).isEmpty()
    model = langid.fit(awkward)
    assert langid.accepted(awkward, model).count() == 9
    assert langid.accepted(awkward, model).where("lang IS NULL").isEmpty()
    none = langid.fit(nothing)
    assert {r.lang_pred for r in langid.identify(awkward, none).collect()} == {"und"}
    assert langid.accepted(awkward, none).count() == 12


# --- 10 paragraphs ---------------------------------------------------------------------------


def brute_paragraphs(docs, least=20):
    sets = {(i, k): shingles(line) for i, t in docs if t is not None for k, line in enumerate(t.split("\n")) if len(words(line)) >= least}
    index = collections.defaultdict(list)
    for key, s in sets.items():
        for x in s:
            index[x].append(key)
    pairs = {(a, b) for keys in index.values() for a in keys for b in keys if a < b}
    root = union_find(sets, [(a, b) for a, b in pairs if jaccard(sets[a], sets[b]) >= 0.8])
    out = collections.defaultdict(list)
    for key, first in root.items():
        if key != first:
            out[key[0]].append(key[1])
    return {k: sorted(v) for k, v in out.items()}


def paragraph_case():
    rng = random.Random(11)
    v = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(2000)]
    pool = [rng.choices(v, k=n) for n in (15, 25, 60, 90)]
    docs = []
    for k in range(120):
        lines = [rng.choices(v, k=rng.randint(3, 60)) for _ in range(3)]
        for _ in range(k % 3):
            p = list(rng.choice(pool))
            for _ in range(rng.randint(0, 2)):
                p[rng.randrange(len(p))] = rng.choice(v)
            lines.insert(rng.randrange(4), p)
        docs.append((k, "\n".join(map(" ".join, lines)) + "\n" * (k % 2)))
    return docs + [(120, None), (121, ""), (122, "\n\n")]


def brute_repeats(docs, n=51):
    """doc_id: (words left, words removed, runs of removed words) by the rule of both levels."""
    lines, seen, out = brute_paragraphs(docs), {}, {}
    for i, t in docs:
        w = words(t)
        at = [k for k, x in enumerate((t or "").split("\n")) for _ in words(x)]
        windows = [tuple(w[k : k + n]) for k in range(len(w) - n + 1)]
        gone = {k for k in range(len(w)) if at[k] in lines.get(i, [])} | {k + j for k, g in enumerate(windows) if g in seen for j in range(n)}
        for g in windows:
            seen.setdefault(g, i)
        out[i] = ([x for k, x in enumerate(w) if k not in gone], len(gone), len([k for k in gone if k - 1 not in gone]))
    return out


def passage_case():
    """Passages inside longer lines, across line breaks, of 50 words and of 51, overlapping, and with a line that is alike."""
    rng = random.Random(23)
    v = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(2000)]
    text = lambda n: rng.choices(v, k=n)
    pool = [text(n) for n in (50, 51, 52, 68, 120)]
    docs = []
    for k in range(150):
        w = text(rng.randint(0, 80))
        for _ in range(rng.choice((0, 0, 1, 1, 2))):
            p = rng.choice(pool)
            a = rng.choice((0, 0, 0, 5))
            w += p[a:] + text(rng.randint(0, 40))
        marks = [rng.choice((" ", " ", " ", " ", " ", " ", ", ", "\n" if k % 2 else " ")) for _ in w]
        docs.append((k, "".join(x + m for x, m in zip(w, marks, strict=True)).strip()))
    line = text(30)
    docs += [(150, " ".join([*text(9), *pool[1][:15]]) + "\n" + " ".join(line)), (151, " ".join(line) + "\n" + " ".join(text(60))), (152, None), (153, ""), (154, "\n\n")]
    return docs


@pytest.mark.parametrize("case", ["paragraph_case", "passage_case", "both"])
def test_paragraphs_equal_brute_force(spark, case):
    docs = paragraph_case() if case == "paragraph_case" else passage_case()
    if case == "both":
        docs += [(200 + i, t) for i, t in paragraph_case()]
    df = spark.createDataFrame([(i, t, len(t or ""), "x", i, "y") for i, t in docs], "doc_id long, text string, n_chars long, removed string, lines long, `_removed` string").repartition(4)
    got = paragraphs.dedup_paragraphs(df, count_column="n_chars")
    assert got.columns == [*df.columns, "n_removed", "n_spans", "kept_in"]
    rows = got.collect()
    lines, want, text = brute_paragraphs(docs), brute_repeats(docs), dict(docs)
    assert {r.doc_id: r.removed for r in rows if r.removed} == lines
    assert {r.doc_id: (words(r.text), r.n_removed, r.n_spans) for r in rows} == want
    for r in rows:
        assert (r.text == text[r.doc_id]) == (r.n_removed == 0) and bool(r.kept_in) == (r.n_removed > 0)
        assert r.text is None or r.n_chars == len(r.text)
        assert r.lines == r.doc_id and r._removed == "y"
        if want[r.doc_id][1] == sum(len(words(x)) for k, x in enumerate((text[r.doc_id] or "").split("\n")) if k in lines.get(r.doc_id, [])):  # lines only
            assert r.text == (None if text[r.doc_id] is None else "\n".join(x for k, x in enumerate(text[r.doc_id].split("\n")) if k not in set(lines.get(r.doc_id, []))))


def test_cut_keeps_the_rest():
    w = [f"w{k}" for k in range(60)]
    some = "Left, (in). " + " ".join(w[:51]) + "! Right.\nNext"
    assert passages.cut(some, np.array([], int), np.array([2]), np.array([1])) == ("Left, (in). Right.\nNext", 51, 1)
    lines = "a b\n" + "\n".join(" ".join(w[k : k + 17]) + "." for k in (0, 17, 34)) + "\n\nc"
    assert passages.cut(lines, np.array([], int), np.array([2]), np.array([1])) == ("a b\n\nc", 51, 1)
    assert passages.cut(lines, np.array([0]), np.array([2]), np.array([1])) == ("\nc", 53, 1)
    assert passages.cut(" ".join(w), np.array([], int), np.array([0, 9]), np.array([1, 1])) == ("", 60, 1)


def test_paragraphs_awkward(spark, awkward, nothing):
    rows = sorted((r.doc_id or 0, r.n_removed > 0) for r in paragraphs.dedup_paragraphs(awkward).collect())
    assert rows == sorted([(1, False), (2, False), (3, False), (4, False), (5, True), (6, True), (7, False), (7, False), (8, False), (9, True), (10, False), (0, False)]), rows
    assert paragraphs.dedup_paragraphs(nothing).isEmpty()
    twice = spark.createDataFrame([(1, "x " * 60 + "a"), (1, "y z " * 40), (1, "y z " * 40), (2, "q " + "y z " * 40)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in paragraphs.dedup_paragraphs(twice).collect()) == [(1, 0), (1, 0), (1, 0), (2, 80)]


def test_no_long_repeat_is_left(spark, sf_dir, documents):
    rows = queries.queries()["op10_paragraph_dedup"](spark, sf_dir).collect()
    docs = sorted((r.doc_id, r.text) for r in documents.collect())
    assert {r.doc_id: (words(r.text), r.n_removed, r.n_spans) for r in rows} == brute_repeats(docs)


def test_tuned_bands():
    bands, rows = paragraphs.tune_bands()
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and 1 - (1 - 0.2**rows) ** bands <= 0.1


# --- pipeline --------------------------------------------------------------------------------


def test_pipeline_stages(spark, sf_dir, documents):
    import corpus_pipeline as cp

    docs = documents
    rows = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(cp.STAGES)
    assert list(stages) == ["language_id", "near_duplicates", "repeated_passages", "decontamination", "packing"]
    one = stages["language_id"](spark, docs, sf_dir)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == {i for i, t in rows.items() if any(c.isalpha() for c in t or "")}
    sets = {i: shingles(t) for i, t in rows.items()}
    root = union_find(sets, [(a, b) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= 0.8])
    two = stages["near_duplicates"](spark, docs, sf_dir)
    assert two.columns == docs.columns and {r.doc_id for r in two.collect()} == set(root.values())
    three = stages["repeated_passages"](spark, docs, sf_dir)
    assert three.columns == docs.columns
    left = brute_repeats(sorted(rows.items()))
    assert {r.doc_id: words(r.text) for r in three.collect()} == {i: w for i, (w, _, _) in left.items()}
    assert all(r.text == rows[r.doc_id] or left[r.doc_id][1] for r in three.collect())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    four = stages["decontamination"](spark, docs, sf_dir)
    assert four.columns == docs.columns and {r.doc_id for r in four.collect()} == {r[0] for r in brute_contamination(rows.items(), items) if not r[5]}
    final = cp.run(spark, sf_dir).collect()
    check_bins(final, packing.CAPACITIES)
    assert {r.doc_id for r in final} <= set(root.values())


@pytest.fixture(scope="session")
def clashing(awkward):
    """The awkward rows with columns named like those that operators add or use."""
    names = ["removed", "kept_in", "n_removed", "n_spans", "lines", "spans_in", "own_id", "gone", "row_key", "_gone", "row", "_row", "key", "anchors", "block", "n_tokens", "doc.id"]
    return awkward.withColumns({n: F.concat(F.lit(f"{n} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))) for n in names if n not in awkward.columns})


def test_stages_on_awkward_rows(spark, clashing, sf_dir):
    import corpus_pipeline as cp

    want = {"language_id": [4, 5, 6, 7, 7, 8, 9, 10, None], "near_duplicates": [1, 2, 3, 4, 7, 8, 9, 10, None], "repeated_passages": [1, 2, 3, 4, 5, 6, 7, 7, 8, 9, 10, None], "decontamination": [1, 2, 3, 4, 5, 6, 7, 7, 8, 9, 10, None]}
    for name, stage in cp.STAGES[:-1]:
        got = stage(spark, clashing, sf_dir)
        assert got.columns == clashing.columns, name
        rows = got.collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(map(str, want[name])), name
        for r in rows:
            assert r["doc.id"] == f"doc.id {'null' if r.doc_id is None else r.doc_id}" and r["_row"] == r["doc.id"].replace("doc.id", "_row") and r.removed == r["doc.id"].replace("doc.id", "removed")
            assert r.n_chars == (None if not r.text and r.doc_id in (1, 2) else len(r.text)) or name != "repeated_passages"
        empty = stage(spark, clashing.where("false"), sf_dir)
        assert empty.columns == clashing.columns and empty.isEmpty(), name
    name, stage = cp.STAGES[-1]
    rows = stage(spark, clashing, sf_dir).collect()
    check_bins(rows, packing.CAPACITIES)
    assert {r.doc_id for r in rows} == {r.doc_id for r in clashing.select("doc_id").collect()} and {r.doc_id for r in rows if r.bin_id is None} == {1, 2}
    assert stage(spark, clashing.where("false"), sf_dir).isEmpty()


def test_run_on_awkward_and_empty_tables(spark, awkward, nothing, tmp_path):
    import corpus_pipeline as cp

    for name, docs in (("awkward", awkward), ("empty", nothing)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        rows = cp.run(spark, f"{tmp_path}/{name}").collect()
        check_bins(rows, packing.CAPACITIES)
        assert {r.doc_id for r in rows} == ({4, 7, 8, 9, 10, None} if name == "awkward" else set())


def test_chained_stages_equal_brute_force(spark, sf_dir, documents):
    """Every stage by its own brute force, on what the one before kept."""
    import corpus_pipeline as cp

    rows = {r.doc_id: r.text for r in documents.collect() if any(c.isalpha() for c in r.text or "")}
    sets = {i: shingles(t) for i, t in rows.items()}
    root = union_find(sets, [(a, b) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= 0.8])
    rows = {i: rows[i] for i in sorted(set(root.values()))}
    left = {i: w for i, (w, _, _) in brute_repeats(sorted(rows.items())).items()}
    docs = documents
    for _, stage in cp.STAGES[:3]:
        docs = stage(spark, docs, sf_dir)
    got = {r.doc_id: r.text for r in docs.collect()}
    assert {i: words(t) for i, t in got.items()} == left
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {r[0] for r in brute_contamination(got.items(), items) if not r[5]}
    assert {r.doc_id for r in cp.run(spark, sf_dir).collect()} == clean


def test_text_bytes_of_a_slice():
    from pagewright.llm.shared import Words, text_bytes

    data, offsets = text_bytes(pa.array(["ab", None, "Cé d", ""]).slice(1))
    assert data.tobytes() == "Cé d".encode() and offsets.tolist() == [0, 0, 5, 5]
    w = Words(*text_bytes(pa.array(["ab", "ab", "x-ab"])))
    assert w.counts.tolist() == [1, 1, 2] and w.hashes[0] == w.hashes[1] == w.hashes[3] != w.hashes[2]

"""Benchmark decontamination with suffix arrays over the training shards.

Every Arrow batch slice of training documents is a shard.  A shard's word-suffix array
holds the suffixes that can begin a benchmark window (their words all occur in the
benchmark), sorted to the window depth; every benchmark suffix is then binary-searched in
it, which yields its window matches and their locations in the training text.  Matches of
consecutive windows of one item are joined to the longest verbatim matches, with their places
in item and document (a window that an item repeats counts at its first place in it).  Windows
that overlap or touch, also of different items, are united into runs, which need not be
verbatim in any item.  No training row is shuffled.

The benchmark is broadcast in blocks of a checked size (``block_bytes``): a larger one is
searched block after block and the runs found by each are merged.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.shared import Words, fresh, map_rows, scratch, slices, slim, stash, text_bytes

#: Words of a window; an item of fewer words is one window.
WINDOW = 13
#: A document is contaminated when hit words are at least one in SHARE of its words.
SHARE = 20

#: Bytes of benchmark text that are broadcast at once, as arrays of about ten times the size.
BLOCK_BYTES = 8 << 20

_RUNS = "doc_id long, n_words long, runs array<struct<s:int,e:int>>, items array<string>, matches array<struct<item:string,item_start:int,start:int,words:int>>"
_RUN = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
_MATCH = pa.list_(pa.struct([("item", pa.string()), ("item_start", pa.int32()), ("start", pa.int32()), ("words", pa.int32())]))


class BenchmarkIndex:
    """Windows of a block of benchmark items, as rows of ids of the block's own vocabulary.

    All of it is arrays: about 60 bytes a word of the block, which ``BLOCK_BYTES`` bounds.
    """

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        words = Words(*text_bytes(pa.array([t or "" for _, t in items], pa.large_string())))
        self.window, self.names = window, [item for item, _ in items]
        self.vocabulary, ids = np.unique(words.hashes, return_inverse=True)
        counts = np.where(words.counts >= window, words.counts - window + 1, np.minimum(words.counts, 1))
        owner = np.repeat(np.arange(len(items)), counts)
        place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        columns = (words.first[:-1][owner] + place)[:, None] + np.arange(window)
        inside = columns < words.first[1:][owner][:, None]
        matrix = np.where(inside, (ids + 1)[np.minimum(columns, max(0, len(ids) - 1))] if len(ids) else 0, 0)
        keys = _keys(matrix)
        order = np.lexsort((place, owner, keys)) if len(keys) else np.zeros(0, np.int64)
        keys, owner, place = keys[order], owner[order], place[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        #: distinct windows in byte order, and the words of each
        self.low = keys[new]
        self.lengths = inside[order][new].sum(1)
        # the first place of a window in each item that holds it: rows first[w] .. first[w + 1]
        once = new.copy()
        once[1:] |= owner[1:] != owner[:-1]
        self.owner, self.place = owner[once].astype(np.int32), place[once].astype(np.int32)
        self.first = np.append(np.flatnonzero(new[once]), once.sum())

    @functools.cached_property
    def high(self) -> np.ndarray:
        """The end of each window's range of suffixes: a short window's free places sort behind every id."""
        top = self.low.view(">i4").reshape(-1, self.window).copy() if len(self.low) else np.zeros((0, self.window), ">i4")
        top[np.arange(self.window) >= self.lengths[:, None]] = -1
        return _keys(top)

    def owners(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of ``windows``, item, place in the item) of every item that holds a window."""
        n = self.first[windows + 1] - self.first[windows]
        row = np.repeat(np.arange(len(windows)), n)
        at = self.first[windows][row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        return row, self.owner[at], self.place[at]

    def __len__(self) -> int:
        return len(self.low)


def _keys(matrix: np.ndarray) -> np.ndarray:
    """Rows of big-endian ids as byte strings: their order is the lexicographic order of the rows."""
    matrix = np.ascontiguousarray(matrix, ">i4")
    return matrix.view(f"S{4 * matrix.shape[1]}").ravel() if len(matrix) else np.zeros(0, f"S{4 * matrix.shape[1]}")


def _suffix_array(ids: np.ndarray, ends: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Word suffixes starting at ``at``, cut at their document's end, sorted to ``depth``: (starts, keys)."""
    columns = at[:, None] + np.arange(depth)
    inside = columns < ends[:, None]
    matrix = np.where(inside, ids[np.minimum(columns, len(ids) - 1)], 0)
    keys = _keys(matrix)
    order = np.argsort(keys, kind="stable")
    return at[order], keys[order]


def _matches(words: Words, index: BenchmarkIndex) -> tuple[np.ndarray, np.ndarray]:
    """(window number, word position) of every occurrence of a benchmark window in a shard."""
    none = np.zeros(0, np.int64)
    n = len(words.hashes)
    if n == 0 or len(index) == 0:
        return none, none
    place = np.minimum(np.searchsorted(index.vocabulary, words.hashes), len(index.vocabulary) - 1)
    ids = np.where(index.vocabulary[place] == words.hashes, place + 1, 0)
    # how many known words follow each position within its document
    ends = np.repeat(words.first[1:], words.counts)
    stops = np.flatnonzero(ids == 0)
    nearest = np.append(stops, n)[np.searchsorted(stops, np.arange(n))]
    run = np.minimum(nearest, ends) - np.arange(n)
    at = np.flatnonzero(run >= index.lengths.min())
    if not len(at):
        return none, none
    starts, keys = _suffix_array(ids, ends[at], at, index.window)
    low = np.searchsorted(keys, index.low, "left")
    high = np.searchsorted(keys, index.high, "right")
    count = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(index)), count)
    offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return which, starts[low[which] + offset]


def _hits(words: Words, index: BenchmarkIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which words of a shard are hit, and (window number, word position) of the windows that hit them."""
    which, at = _matches(words, index)
    if not len(which):
        return np.zeros(len(words.hashes), bool), which, at
    cover = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + index.lengths[which], -1)
    return np.cumsum(cover[:-1]) > 0, which, at


def _longest(words: Words, index: BenchmarkIndex, which: np.ndarray, at: np.ndarray, n_docs: int) -> tuple[list[list], list[list]]:
    """Longest verbatim matches, and the names of hit items, of each document of a shard."""
    doc_of = np.repeat(np.arange(n_docs), words.counts)
    row, item, place = index.owners(which)
    at, length = at[row], index.lengths[which[row]]
    doc = doc_of[at]
    order = np.lexsort((at, at - place, item, doc))
    doc, item, place, at, length = doc[order], item[order], place[order], at[order], length[order]
    new = np.ones(len(at), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (at[1:] != at[:-1] + 1) | (place[1:] != place[:-1] + 1)
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(at)) - 1
    matches: list[list] = [[] for _ in range(n_docs)]
    for b, e in zip(begin.tolist(), last.tolist(), strict=True):
        d = int(doc[b])
        matches[d].append({"item": index.names[item[b]], "item_start": int(place[b]), "start": int(at[b] - words.first[d]), "words": int(at[e] + length[e] - at[b])})
    items: list[list] = [[] for _ in range(n_docs)]
    for d, i in np.unique(np.stack([doc, item]), axis=1).T.tolist():
        items[d].append(index.names[i])
    return matches, [sorted(set(i)) for i in items]


def _shard_runs(index: BenchmarkIndex, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for lo, hi in slices(offsets):
            words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1])
            hit, which, at = _hits(words, index)
            runs: list[list] = [[] for _ in range(hi - lo)]
            items: list[list] = [[] for _ in range(hi - lo)]
            matches: list[list] = [[] for _ in range(hi - lo)]
            if len(which):
                doc_of = np.repeat(np.arange(hi - lo), words.counts)
                edge = np.diff(hit.astype(np.int8), prepend=np.int8(0)) > 0
                new_doc = np.zeros(len(hit), bool)
                new_doc[words.first[:-1][words.counts > 0]] = True
                begins = np.flatnonzero(hit & (edge | new_doc))
                last = np.append(~hit[1:] | new_doc[1:], True)
                for s, e in zip(begins, np.flatnonzero(hit & last) + 1, strict=True):
                    d = doc_of[s]
                    runs[d].append({"s": int(s - words.first[d]), "e": int(e - words.first[d])})
                matches, items = _longest(words, index, which, at, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(lo, hi - lo),
                    pa.array(words.counts, pa.int64()),
                    pa.array(runs, _RUN),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(matches, _MATCH),
                ],
                names=["doc_id", "n_words", "runs", "items", "matches"],
            )


def _clean(index: BenchmarkIndex, share: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        keep = np.ones(batch.num_rows, bool)
        for lo, hi in slices(offsets):
            words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1])
            hit, which, _ = _hits(words, index)
            if len(which):
                n_hit = np.diff(np.concatenate([[0], np.cumsum(hit)])[words.first])
                keep[lo:hi] = (n_hit == 0) | (n_hit * share < words.counts)
        yield batch.filter(pa.array(keep))


def _blocks(benchmark: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """Usable items, and the number of blocks of about ``block_bytes`` that they make."""
    bench = slim(benchmark, "item_id", "text").select(F.col("item_id").cast("string").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    total = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return bench, max(1, -(-int(total) // block_bytes))


def find_contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Runs of verbatim benchmark windows of every row of ``documents``.

    Returns (doc_id, n_words, runs, items, matches): ``runs`` are maximal ranges [s, e) of
    word positions covered by benchmark windows, ``items`` the ids (as strings, sorted) whose
    windows occur, ``matches`` the longest verbatim ones: item, its first word there, first
    word in the document, words.  A null or empty text has no words and no runs; a null item is no
    window; repeated rows are each reported; an empty benchmark hits nothing; other
    columns are ignored.
    """
    docs = slim(documents, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    bench, blocks = _blocks(benchmark, block_bytes)
    if blocks == 1:
        return _search(docs, [tuple(r) for r in bench.collect()], window)
    # a larger benchmark: block after block, one broadcast at a time, each result written, then merged by row
    with scratch() as keep:
        keyed = keep(stash(docs.withColumn("row", F.monotonically_increasing_id()), "decontaminate-rows"))
        rows = keyed.select(F.col("row").alias("doc_id"), "text")
        found = None
        for k in range(blocks):
            items = [tuple(r) for r in bench.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect()]
            if items:
                part = keep(stash(_search(rows, items, window).where("size(runs) > 0"), "decontaminate-block"))
                found = part if found is None else found.unionByName(part)
    counts = _search(rows, [], window)
    if found is None:
        found = counts.limit(0)
    merged = found.groupBy("doc_id").agg(
        F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("matches")).alias("matches"),
    )
    union = F.expr(
        "aggregate(runs, cast(array() as array<struct<s:int,e:int>>), (acc, r) -> if(size(acc) > 0 and r.s <= element_at(acc, -1).e,"
        " concat(slice(acc, 1, size(acc) - 1), array(named_struct('s', element_at(acc, -1).s, 'e', greatest(element_at(acc, -1).e, r.e)))), concat(acc, array(r))))"
    )
    merged = merged.select(F.col("doc_id").alias("row"), union.alias("runs"), "items", "matches")
    all_rows = keyed.select("row", F.col("doc_id").alias("id")).join(counts.select(F.col("doc_id").alias("row"), "n_words"), "row").join(merged, "row", "left")
    none = {c: F.coalesce(c, F.array().cast(kind)).alias(c) for c, kind in (f.split(" ", 1) for f in _RUNS.split(", ")[2:])}
    return all_rows.select(F.col("id").alias("doc_id"), "n_words", *none.values())


def _search(docs: DataFrame, items: list[tuple], window: int) -> DataFrame:
    index = docs.sparkSession.sparkContext.broadcast(BenchmarkIndex(items, window))
    return docs.mapInArrow(lambda batches: _shard_runs(index.value, batches), _RUNS)


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Digest per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, runs, matches.  Rows as for ``find_contamination``."""
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda acc, r: acc + r.e - r.s)
    return find_contamination(documents, benchmark, window, block_bytes).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
        "runs",
        "matches",
    )


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of ``documents`` (all columns, of any name) that are not contaminated.

    Null, empty and wordless texts stay, and so do null ids; repeated rows are each judged;
    very long texts are searched whole; an empty benchmark removes nothing.
    """
    bench, blocks = _blocks(benchmark, block_bytes)
    if blocks == 1:
        index = documents.sparkSession.sparkContext.broadcast(BenchmarkIndex([tuple(r) for r in bench.collect()], window))
        return map_rows(documents, lambda b: _clean(index.value, share, b))
    (row,) = fresh(documents, "row")
    marked = stash(documents.withColumn(row, F.monotonically_increasing_id()), "decontaminate-input")
    bad = contamination(marked.select(F.col(row).alias("doc_id"), "text"), benchmark, window, share, block_bytes).where("contaminated")
    return marked.join(bad.select(F.col("doc_id").alias(row)), row, "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns])


ORACLE = r"""
WITH bw AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM bw WHERE len(w) > 0)),
dw AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
pos AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hits AS (SELECT r, i, win.n, item_id FROM pos JOIN win ON pos.n = win.n AND pos.g = win.g),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN words USING (r) LEFT JOIN its USING (r)
"""

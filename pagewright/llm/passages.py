"""Verbatim passages that an earlier document holds, wherever lines break.

The paragraphs compared here are the overlapping runs of ``WINDOW`` words of a text.  Each is
banded by one MinHash register, the least hash of its word shingles of ``GRAM`` words, its
anchor: equal windows always collide, so at similarity 1 one band has full recall.  Anchors
(one in about 22 words) are counted first.  Where one is in two documents, the runs of its
windows are compared as wholes, and only where an anchor has different runs are windows
compared one by one, each of a run's first holder alone; both by 128 bits of hashes over all
words.  A window stays in the document of the least (doc_id, text hash) that holds it and
goes from all others.

Windows are judged on the input, not on what is left.  Anchors all of whose windows lie
within removed lines are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.shared import BROADCAST_BYTES, Words, mix, prefix_sums, slices, span_hashes, stash, text_bytes, unstash

WINDOW = 51
GRAM = 8


def _windows(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, document, anchor) of every window of words inside one document."""
    n = len(words.hashes)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n - gram + 1)
    least = span_hashes(prefix_sums(words.hashes), at, at + gram)
    width, span = window - gram + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    start = np.arange(len(least))
    doc = np.searchsorted(words.first, start, "right") - 1
    inside = start + window <= words.first[doc + 1]
    return start[inside], doc[inside], least[inside]


def line_of(part: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """The line (from 0 in its document) of each word."""
    breaks = np.flatnonzero(part == 10)
    doc = np.repeat(np.arange(len(words.counts)), words.counts)
    return np.searchsorted(breaks, words.starts) - np.searchsorted(breaks, offsets[:-1])[doc]


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of a list column; null lists are empty."""
    sizes = lists.value_lengths().fill_null(0).to_numpy()
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten().to_numpy()


def _paired(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return mix(values.astype(np.int64).view(np.uint64) + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _anchors(window: int, gram: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, anchor, live) of each run of windows of one anchor; live: one of them has words outside removed lines."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        row, line = _flat(batch.column("removed"))
        for lo, hi in slices(offsets):
            part, own = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            words = Words(part, own)
            start, doc, anchor = _windows(words, window, gram)
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])
            stays = np.ones(len(words.hashes), np.int64)
            here = (row >= lo) & (row < hi)
            if here.any():
                gone = np.sort(_paired(line[here], row[here] - lo))
                of_word = _paired(line_of(part, own, words), np.repeat(np.arange(hi - lo), words.counts))
                stays[gone[np.minimum(np.searchsorted(gone, of_word), len(gone) - 1)] == of_word] = 0
            sums = np.concatenate([[0], np.cumsum(stays)])
            runs = np.flatnonzero(new)
            live = np.maximum.reduceat(sums[start + window] > sums[start], runs) if len(runs) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(lo + doc[runs])), pa.array(anchor[runs].view(np.int64)), pa.array(live)], names=["key", "anchor", "live"])


def _selected(window: int, gram: int, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(batch, first row, words, start, document, anchor) of the windows with a row's ``anchors``, slice by slice."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        row, anchors = _flat(batch.column("anchors"))
        for lo, hi in slices(offsets):
            words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1])
            start, doc, anchor = _windows(words, window, gram)
            here = (row >= lo) & (row < hi)
            wanted = np.isin(_paired(anchor.view(np.int64), doc), _paired(anchors[here], row[here] - lo))
            if wanted.any():
                yield batch, lo, words, start[wanted], doc[wanted], anchor[wanted]


def _rows(batch: pa.RecordBatch, lo: int, words: Words, start: np.ndarray, end: np.ndarray, doc: np.ndarray, **more: np.ndarray) -> pa.RecordBatch:
    """Spans of words with two hashes each, and their documents."""
    at = pa.array(lo + doc)
    one = span_hashes(prefix_sums(words.hashes), start, end)
    two = span_hashes(prefix_sums(mix(words.hashes ^ np.uint64(0xA0761D6478BD642F))), start, end)
    columns = {"doc_id": batch.column("doc_id").take(at), "key": batch.column("key").take(at), "h1": one.view(np.int64), "h2": two.view(np.int64), "start": (start - words.first[doc]).astype(np.int32)}
    return pa.RecordBatch.from_pydict(columns | more)


def _runs(window: int, gram: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, lo, words, start, doc, anchor in _selected(window, gram, batches):
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
        begin = np.flatnonzero(new)
        n = np.diff(np.append(begin, len(doc)))
        yield _rows(batch, lo, words, start[begin], start[begin] + n - 1 + window, doc[begin], anchor=anchor[begin].view(np.int64), n=n.astype(np.int32))


def _hashed(window: int, gram: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, lo, words, start, doc, _ in _selected(window, gram, batches):
        yield _rows(batch, lo, words, start, start + window, doc)


def _gone(rows: DataFrame, firsts: DataFrame, n) -> DataFrame:
    """Rows of spans that are not in the span's first document."""
    first = (F.col("key") == F.col("first.key")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    return rows.join(firsts, ["h1", "h2"]).where(~first).select("doc_id", "key", F.struct("start", n.alias("n")).alias("span"), F.col("first.doc_id").alias("kept_doc"))


def repeated_windows(documents: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, key, spans, kept_docs) of every document that holds windows of an earlier one.

    documents: (doc_id, key, text, removed); ``doc_id`` and ``key`` tell documents apart,
    ``removed`` are lines that go anyway.  ``spans`` are (start, n): n windows from that word on.
    """
    anchors = stash(documents.select("key", "text", "removed").mapInArrow(lambda b: _anchors(window, gram, b), "key long, anchor long, live boolean"), "anchors")
    twice = anchors.groupBy("anchor").agg(F.min("key").alias("least"), F.max("key").alias("most"), F.max("live").alias("live"))
    twice = stash(twice.where("least <> most AND live").select("anchor"), "twice")
    shared = stash(anchors.join(twice, "anchor").groupBy("key").agg(F.collect_set("anchor").alias("anchors")), "shared")
    unstash(anchors, twice)

    def texts(wanted: DataFrame) -> DataFrame:
        size = wanted.agg(F.sum(16 + 8 * F.size("anchors"))).first()[0] or 0
        return documents.join(F.broadcast(wanted) if size <= BROADCAST_BYTES else wanted, "key").select("doc_id", "key", "text", "anchors")

    # tables that are joined with hot keys are written, so that the joins deal out their rows anew and can split them
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    spans = "doc_id long, key long, h1 long, h2 long, start int"
    runs = stash(texts(shared).mapInArrow(lambda b: _runs(window, gram, b), f"{spans}, anchor long, n int"), "runs")
    unstash(shared)
    distinct = stash(runs.groupBy("h1", "h2").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.first("anchor").alias("anchor")), "distinct-runs")
    whole = _gone(runs, distinct.where("first <> last").select("h1", "h2", "first"), F.col("n"))
    # windows one by one: those of the first holders of an anchor's different runs
    several = distinct.groupBy("anchor").count().where("count > 1").select("anchor")
    holders = stash(distinct.join(several, "anchor").groupBy(F.col("first.key").alias("key")).agg(F.collect_set("anchor").alias("anchors")), "holders")
    windows = stash(texts(holders).mapInArrow(lambda b: _hashed(window, gram, b), spans), "windows")
    firsts = stash(windows.groupBy("h1", "h2").agg(F.min(order).alias("first"), F.max(order).alias("last")).where("first <> last").select("h1", "h2", "first"), "firsts")
    gone = whole.unionByName(_gone(windows, firsts, F.lit(1)))
    found = gone.groupBy("doc_id", "key").agg(F.array_sort(F.collect_set("span")).alias("spans"), F.collect_set("kept_doc").alias("kept_docs"))
    # windows side by side are one span
    joined = F.expr(
        "aggregate(spans, cast(array() as array<struct<start:int,n:int>>), (acc, s) -> if(size(acc) > 0 and s.start <= element_at(acc, -1).start + element_at(acc, -1).n,"
        " concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start, 'n', greatest(element_at(acc, -1).n, s.start + s.n - element_at(acc, -1).start)))), concat(acc, array(s))))"
    )
    return found.select("doc_id", "key", joined.alias("spans"), "kept_docs")


def cut(text: str, lines: np.ndarray, starts: np.ndarray, counts: np.ndarray, window: int = WINDOW) -> tuple[str, int, int]:
    """(text without the given lines and windows, words removed, runs of removed words).

    ``counts`` windows begin at the word ``starts`` and at those behind it.

    Behind a removed window go marks that adhere to it, and blanks; a line all of whose words
    go, goes.  All else stays byte for byte.
    """
    data = np.frombuffer(text.encode(), np.uint8)
    ends = np.array([0, len(data)])
    words = Words(data, ends)
    line = line_of(data, ends, words)
    cover = np.zeros(len(line) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + counts - 1 + window, -1)
    in_window = np.cumsum(cover[:-1]) > 0
    gone = in_window | np.isin(line, lines)
    edges = np.flatnonzero(np.diff(in_window.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
    out = np.ones(len(data), bool)
    for lo, hi in edges.tolist():
        end = int(words.ends[hi - 1])
        stop = int(words.starts[hi]) if hi < len(line) else len(data)
        while end < stop and data[end] not in b" \t\n":
            end += 1
        while end < stop and data[end] in b" \t":
            end += 1
        out[words.starts[lo] : end] = False
    breaks = np.concatenate([[-1], np.flatnonzero(data == 10), [len(data)]])
    had = np.bincount(line, minlength=len(breaks) - 1)
    left = np.bincount(line[~gone], minlength=len(breaks) - 1)
    drop = (had > 0) & (left == 0)
    drop[lines] = True
    kept = [data[a:b][out[a:b]].tobytes() for a, b in zip((breaks[:-1] + 1)[~drop].tolist(), breaks[1:][~drop].tolist(), strict=True)]
    return b"\n".join(kept).decode(), int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) > 0).sum())

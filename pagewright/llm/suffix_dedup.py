"""Exact substring dedup by sorting suffixes.

A byte goes if a string of ``LENGTH`` bytes over it also starts earlier.  Sorting every
suffix of the corpus would move each byte many times over, so suffixes are sorted where it
can matter:

1.  Each window of LENGTH bytes has an anchor, the GRAM-byte string in it of least hash.
    Equal windows have equal anchors at equal places.  An anchor with the span of text that
    its windows cover is shipped as two hashes; equal ones in a batch, however many, as one.
2.  By anchor hash, equal spans meet: all but the first are repeats throughout.  Where an
    anchor occurs in different spans, the first of each are asked for their bytes.
3.  The suffixes at all windows of those spans are sorted deep-shallow to LENGTH bytes:
    multikey quicksort over 8-byte characters to the shallow depth, then, for groups with a
    longer common prefix, blind tries grown path by path.  Equal windows come out as groups;
    all but the first of each are repeats.

An anchor hash met in more than ``HOT_ROWS`` different spans (estimated on a sample of
documents) is salted: its windows are dealt out by their own 128-bit hashes instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.llm.shared import mix, prefix_sums, slices, slim, span_hashes, stash, text_bytes, unstash

LENGTH = 100
GRAM = 32
#: 8-byte characters of the shallow sort.
SHALLOW = 3
#: Different spans of one anchor hash above which its windows are salted.
HOT_ROWS = 200_000
#: Bytes of text whose anchors one task compares, in expectation.
PART_BYTES = 32 << 20
#: Documents that hot anchors are looked for in, in expectation.  Only the way of dealing rows out depends on it.
HOT_SAMPLE = 20_000
#: Windows sorted at once.
CHUNK = 250_000

_POSITION_BITS = 24
_PIECE = 1 << 23


# --- anchors ---------------------------------------------------------------------------------


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, first window, windows) of each anchor of one text or of several texts end to end.

    The anchor of a window is the leftmost gram with the least 40-bit hash in it.
    """
    width = length - gram + 1
    starts = np.arange(len(data) - gram + 1)
    keys = span_hashes(prefix_sums(data), starts, starts + gram)
    keys = (keys >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | starts.astype(np.uint64)
    least, have = keys, 1
    while 2 * have <= width:
        least, have = np.minimum(least[:-have], least[have:]), 2 * have
    if have < width:
        more = width - have
        least = np.minimum(least[:-more], least[more:])
    at = (least & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return at[first], first, np.diff(first, append=len(at))


def _slice_anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """Anchors of documents that lie end to end; windows never cross documents."""
    sizes = np.diff(offsets)
    out: dict[str, list[np.ndarray]] = {k: [] for k in ("h", "f", "doc", "pos", "start", "n")}
    if len(data) >= length:
        at, first, n = anchors(data, length, gram)
        # cut the runs of windows at the documents' ends
        last_start = offsets[1:] - length
        doc = np.searchsorted(offsets, first, "right") - 1
        until = np.searchsorted(offsets, first + n - 1, "right") - 1
        pieces = until - doc + 1
        row = np.repeat(np.arange(len(first)), pieces)
        d = doc[row] + np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        s = np.maximum(first[row], offsets[d])
        e = np.minimum(first[row] + n[row] - 1, last_start[d])
        good = (e >= s) & (sizes[d] >= length)
        s, e, d, a = s[good], e[good], d[good], at[row[good]]
        sums = prefix_sums(data)
        out["h"].append(span_hashes(sums, a, a + gram))
        out["f"].append(span_hashes(sums, s, e + length))
        out["doc"].append(d), out["pos"].append(a - offsets[d]), out["start"].append(s - offsets[d]), out["n"].append(e - s + 1)
    return {k: np.concatenate(v) if v else np.zeros(0, np.uint64 if k in "hf" else np.int64) for k, v in out.items()}


def _batch_anchors(batch: pa.RecordBatch, length: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]]:
    """(bytes, offsets of documents, anchors) slice by slice; a text over 8 MB comes in overlapping pieces."""
    data, offsets = text_bytes(batch.column("text"))
    ids = batch.column("doc_id").to_numpy()
    for lo, hi in slices(offsets):
        begin, end = int(offsets[lo]), int(offsets[hi])
        for at in range(begin, max(begin + 1, end - length + 1), _PIECE):
            stop = end if end - begin <= _PIECE else min(end, at + _PIECE + length - 1)
            own = offsets[lo : hi + 1] - begin if end - begin <= _PIECE else np.array([0, stop - at])
            found = _slice_anchors(data[at:stop], own, length, gram)
            found["id"] = ids[lo + found.pop("doc")]
            found["pos"] += at - begin if end - begin > _PIECE else 0
            found["start"] += at - begin if end - begin > _PIECE else 0
            yield data[at:stop], own, found


_ANCHOR = (("h", "<u8"), ("f", "<u8"), ("id", "<i8"), ("pos", "<u4"), ("start", "<u4"), ("n", "u1"))
_SPAN = (("id", "<i8"), ("start", "<u4"), ("end", "<u4"))
_WINDOW = (("f", "<u8"), ("g", "<u8"), ("id", "<i8"), ("start", "<u4"))


def _dump(columns: dict[str, np.ndarray], layout: tuple, pick: np.ndarray | slice = slice(None)) -> bytes:
    return b"".join(np.ascontiguousarray(columns[k][pick], t).tobytes() for k, t in layout)


def _load(blobs: list[bytes], layout: tuple) -> dict[str, np.ndarray]:
    width = sum(np.dtype(t).itemsize for _, t in layout)
    parts: dict[str, list[np.ndarray]] = {k: [] for k, _ in layout}
    for blob in blobs:
        n, at = len(blob) // width, 0
        for k, t in layout:
            parts[k].append(np.frombuffer(blob, t, n, at))
            at += n * np.dtype(t).itemsize
    return {k: np.concatenate(parts[k]) if parts[k] else np.zeros(0, t) for k, t in layout}


def _later(columns: dict[str, np.ndarray], keys: tuple[str, ...], tie: tuple[str, str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, head, later): rows sorted by keys, then document and position; the first row of each group of equal
    keys; and which rows stand at another place than the first."""
    order = np.lexsort((columns[tie[1]], columns[tie[0]], *(columns[k] for k in reversed(keys))))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = False
        for k in keys:
            c = columns[k][order]
            new[1:] |= c[1:] != c[:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else order
    a, b = columns[tie[0]][order], columns[tie[1]][order]
    return order, new, (a != a[head]) | (b != b[head])


_DEALT = "part int, anchors binary, windows binary, spans binary"


def _deal(parts: int, length: int, gram: int, hot: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors dealt out by their hash, equal spans of a batch as one; windows of hot anchors by their own hashes."""
    for batch in batches:
        cold: list[dict[str, np.ndarray]] = []
        warm: list[dict[str, np.ndarray]] = []
        for data, own, found in _batch_anchors(batch, length, gram):
            is_hot = np.isin(found["h"], hot)
            cold.append({k: v[~is_hot] for k, v in found.items()})
            if is_hot.any():
                chosen = {k: v[is_hot] for k, v in found.items()}
                warm.append(_windows_of(chosen, batch, length))
        columns = {k: np.concatenate([c[k] for c in cold]) if cold else np.zeros(0, t) for k, t in _ANCHOR}
        order, new, later = _later(columns, ("h", "f"), ("id", "start"))
        columns = {k: v[order] for k, v in columns.items()}
        windows = {k: np.concatenate([c[k] for c in warm]) if warm else np.zeros(0, t) for k, t in _WINDOW}
        spans = {"id": columns["id"][later], "start": columns["start"][later], "end": columns["start"][later] + columns["n"][later] + length - 1}
        columns = {k: v[new] for k, v in columns.items()}
        part_a, part_w, part_s = ((c % np.uint64(parts)).astype(np.int64) for c in (columns["h"], windows["f"], spans["id"].astype(np.uint64)))
        sorts = [np.argsort(p, kind="stable") for p in (part_a, part_w, part_s)]
        edges = [np.searchsorted(p[s], np.arange(parts + 1)) for p, s in zip((part_a, part_w, part_s), sorts, strict=True)]
        full = np.unique(np.concatenate([part_a, part_w, part_s])).tolist()
        rows = [[_dump(c, layout, s[e[p] : e[p + 1]]) for p in full] for c, layout, s, e in zip((columns, windows, spans), (_ANCHOR, _WINDOW, _SPAN), sorts, edges, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *(pa.array(r, pa.binary()) for r in rows)], names=["part", "anchors", "windows", "spans"])


def _windows_of(found: dict[str, np.ndarray], batch: pa.RecordBatch, length: int) -> dict[str, np.ndarray]:
    """Two hashes of every window of the given anchors."""
    data, offsets = text_bytes(batch.column("text"))
    row_of = {int(i): r for r, i in enumerate(batch.column("doc_id").to_pylist())}
    out: list[dict[str, np.ndarray]] = []
    for k in range(len(found["id"])):
        r, start, n = row_of[int(found["id"][k])], int(found["start"][k]), int(found["n"][k])
        text = data[offsets[r] + start : offsets[r] + start + n + length - 1]
        at = np.arange(n)
        out.append(
            {
                "f": span_hashes(prefix_sums(text), at, at + length),
                "g": span_hashes(prefix_sums(mix(text.astype(np.uint64) + np.uint64(977))), at, at + length),
                "id": np.full(n, found["id"][k]),
                "start": start + at,
            }
        )
    return {k: np.concatenate([c[k] for c in out]) for k, _ in _WINDOW}


# --- equal spans -----------------------------------------------------------------------------

_FOUND = "doc_id long, spans binary, asked binary"


def _by_document(ids: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    if not len(ids):
        return
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.diff(ids, prepend=ids[0] - 1))
    for s, e in zip(first, np.append(first[1:], len(ids)), strict=True):
        yield int(ids[s]), [c[order[s:e]] for c in columns]


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open ranges, touching ones joined."""
    order = np.argsort(start, kind="stable")
    start, end = start[order].astype(np.int64), np.maximum.accumulate(end[order].astype(np.int64)) if len(end) else end
    cut = np.flatnonzero(start[1:] > end[:-1]) + 1
    return start[np.append(0, cut)] if len(start) else start, end[np.append(cut - 1, len(end) - 1)] if len(end) else end


def _span_blob(start: np.ndarray, end: np.ndarray) -> bytes:
    s, e = _merged(start, end)
    return np.stack([s, e], 1).astype("<u4").tobytes()


def _equal_spans(length: int, table: pa.Table) -> pa.Table:
    """Repeats among spans dealt to a part; and the first of each span of anchors with several, to be asked for their bytes."""
    blobs = {k: table.column(k).to_pylist() for k in ("anchors", "windows", "spans")}
    spans = [_load(blobs["spans"], _SPAN)]
    a = _load(blobs["anchors"], _ANCHOR)
    order, new, later = _later(a, ("h", "f"), ("id", "start"))
    a = {k: v[order] for k, v in a.items()}
    spans.append({"id": a["id"][later], "start": a["start"][later], "end": a["start"][later] + a["n"][later].astype("<u4") + np.uint32(length - 1)})
    w = _load(blobs["windows"], _WINDOW)
    order, _, later = _later(w, ("f", "g"), ("id", "start"))
    spans.append({"id": w["id"][order][later], "start": w["start"][order][later], "end": w["start"][order][later] + np.uint32(length)})
    a = {k: v[new] for k, v in a.items()}
    many = np.zeros(len(a["h"]), bool)
    same = a["h"][1:] == a["h"][:-1]
    many[1:] |= same
    many[:-1] |= same
    a = {k: v[many] for k, v in a.items()}
    ids, blobs_s, blobs_a = [], [], []
    s = {k: np.concatenate([x[k] for x in spans]) for k, _ in _SPAN}
    for doc, (start, end) in _by_document(s["id"], s["start"], s["end"]):
        ids.append(doc), blobs_s.append(_span_blob(start, end)), blobs_a.append(None)
    for doc, (h, start, n) in _by_document(a["id"], a["h"], a["start"], a["n"]):
        ids.append(doc), blobs_s.append(None), blobs_a.append(_dump({"h": h, "start": start, "n": n}, _ASKED))
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "spans": pa.array(blobs_s, pa.binary()), "asked": pa.array(blobs_a, pa.binary())})


# --- deep-shallow sort -----------------------------------------------------------------------

_ASKED = (("h", "<u8"), ("start", "<u4"), ("n", "u1"))
_CONTEXT = "part int, asked binary, ids binary, texts binary"


def _contexts(parts: int, length: int, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the spans asked for, dealt out by anchor hash; each padded to ``width``."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        ids = batch.column("doc_id").to_numpy()
        asked, owner = [], []
        for k, blobs in enumerate(batch.column("asked").to_pylist()):
            asked.append(_load(blobs, _ASKED))
            owner.append(np.full(len(asked[-1]["h"]), k))
        if not asked:
            continue
        a = {k: np.concatenate([x[k] for x in asked]) for k, _ in _ASKED}
        owner = np.concatenate(owner)
        part = (a["h"] % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        rows: list[tuple] = []
        for p in np.unique(part).tolist():
            mine = order[edges[p] : edges[p + 1]]
            if len(mine):
                begin = offsets[owner[mine]] + a["start"][mine]
                at = begin[:, None] + np.arange(width)
                inside = np.arange(width) < (a["n"][mine].astype(np.int64) + length - 1)[:, None]
                texts = np.where(inside, data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)
                rows.append((p, _dump(a, _ASKED, mine), ids[owner[mine]].astype("<i8").tobytes(), texts.tobytes()))
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=["part", "asked", "ids", "texts"])


def _regroup(group: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, number): rows sorted by group and keys, and the number of the finer group each sorted row is in."""
    order = np.lexsort((*reversed(keys), group))
    new = np.zeros(len(order), bool)
    for k in (group, *keys):
        c = k[order]
        new[1:] |= c[1:] != c[:-1]
    return order, np.cumsum(new)


def deep_shallow(group: np.ndarray, words: np.ndarray, shallow: int = SHALLOW) -> np.ndarray:
    """Sorts strings within groups; returns for each string the number, in sorted order, of its class of equal strings.

    ``words``: (n, m) big-endian 8-byte characters.  Shallow: each level of a multikey
    quicksort sorts by one character what is equal so far.  Deep: the first string of a group
    is a path of a blind trie; the others leave it after their common prefix, to the left or
    right, and those that leave it at one place by one character are the next group.
    """
    n, m = words.shape
    rank = np.zeros(n, np.int64)
    rows, number = np.arange(n), np.unique(group, return_inverse=True)[1] if n else np.zeros(0, np.int64)
    # a string's rank is that of its group's first place; finer groups count on from there
    sizes = np.bincount(number)
    base = (np.cumsum(sizes) - sizes)[number] if n else number

    def settle(order: np.ndarray, fine: np.ndarray) -> None:
        nonlocal rows, base, number
        rows, base, number = rows[order], base[order], number[order]
        sizes = np.bincount(fine)
        first = np.cumsum(sizes) - sizes
        coarse = np.flatnonzero(np.diff(base, prepend=-1))
        start = coarse[np.cumsum(np.diff(base, prepend=-1) != 0) - 1]
        base = base + (first[fine] - start)
        number = fine
        rank[rows] = base
        open_ = sizes[fine] > 1
        rows, base, number = rows[open_], base[open_], number[open_]

    for level in range(min(shallow, m)):
        if not len(rows):
            return rank
        settle(*_regroup(base, words[rows, level]))
    done = np.zeros(0, bool)
    while len(rows):
        first = np.flatnonzero(np.diff(base, prepend=-1))
        pivot = rows[first[np.cumsum(np.diff(base, prepend=-1) != 0) - 1]]
        other = words[rows, shallow:] != words[pivot, shallow:]
        leaves = np.where(other.any(1), other.argmax(1), m)  # character at which a string leaves the path
        at = np.minimum(leaves + shallow, m - 1)
        mine, path = words[rows, at], words[pivot, at]
        side = np.where(leaves == m, 0, np.where(mine < path, -1, 1))
        depth = np.where(side < 0, leaves, np.where(side > 0, -leaves, 0))
        order, fine = _regroup(base, side, depth, np.where(side == 0, np.uint64(0), mine))
        equal = (side == 0)[order]
        rows_before = rows[order]
        settle(order, fine)
        done = np.zeros(n, bool)
        done[rows_before[equal]] = True
        keep = ~done[rows]
        rows, base, number = rows[keep], base[keep], number[keep]
    return rank


def _sort_windows(length: int, width: int, table: pa.Table) -> pa.Table:
    """Repeats among all windows of the spans dealt to a part."""
    a = _load(table.column("asked").to_pylist(), _ASKED)
    ids = np.concatenate([np.frombuffer(b, "<i8") for b in table.column("ids").to_pylist()])
    texts = np.concatenate([np.frombuffer(b, np.uint8).reshape(-1, width) for b in table.column("texts").to_pylist()])
    order = np.argsort(a["h"], kind="stable")
    h, start, n, ids, texts = a["h"][order], a["start"][order].astype(np.int64), a["n"][order].astype(np.int64), ids[order], texts[order]
    group = np.cumsum(np.diff(h, prepend=h[:1]) != 0)
    total = np.cumsum(n)
    ends = np.flatnonzero(np.append(np.diff(group) != 0, True)) + 1  # chunks end with a group
    found_id, found_start = [], []
    lo = 0
    while lo < len(h):
        limit = (total[lo - 1] if lo else 0) + CHUNK
        hi = int(max(ends[min(np.searchsorted(ends, lo, "right"), len(ends) - 1)], ends[max(0, np.searchsorted(total[ends - 1], limit, "right") - 1)]))
        hi = max(hi, int(ends[np.searchsorted(ends, lo, "right")]))
        row = np.repeat(np.arange(lo, hi), n[lo:hi])
        offset = np.arange(len(row)) - np.repeat(np.cumsum(n[lo:hi]) - n[lo:hi], n[lo:hi])
        m = -(-length // 8)
        words = np.zeros((len(row), m), np.uint64)
        for c in range(length):  # character by character: no (windows x length) copy of single bytes
            words[:, c // 8] |= texts[row, offset + c].astype(np.uint64) << np.uint64(56 - 8 * (c % 8))
        rank = deep_shallow(group[row], words)
        columns = {"r": rank, "id": ids[row], "start": start[row] + offset}
        by, _, later = _later(columns, ("r",), ("id", "start"))
        found_id.append(columns["id"][by][later]), found_start.append(columns["start"][by][later])
        lo = hi
    all_ids = np.concatenate(found_id) if found_id else np.zeros(0, np.int64)
    all_starts = np.concatenate(found_start) if found_start else np.zeros(0, np.int64)
    out_ids, out_spans = [], []
    for doc, (s,) in _by_document(all_ids, all_starts):
        out_ids.append(doc), out_spans.append(_span_blob(s, s + length))
    return pa.table({"doc_id": pa.array(out_ids, pa.int64()), "spans": pa.array(out_spans, pa.binary())})


# --- result ----------------------------------------------------------------------------------

_REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<s:long,e:long>>, kept binary"


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        sizes, removed, spans, digests, kept = np.diff(offsets), [], [], [], []
        for k, blobs in enumerate(batch.column("spans").to_pylist()):
            pairs = np.concatenate([np.frombuffer(b, "<u4").reshape(-1, 2) for b in blobs]) if blobs else np.zeros((0, 2), "<u4")
            s, e = _merged(pairs[:, 0], pairs[:, 1])
            text = data[offsets[k] : offsets[k + 1]]
            stay = b"".join(text[x:y].tobytes() for x, y in zip([0, *e.tolist()], [*s.tolist(), len(text)], strict=True))
            removed.append(int((e - s).sum()) if len(s) else 0)
            spans.append([{"s": x, "e": y} for x, y in zip(s.tolist(), e.tolist(), strict=True)])
            digests.append(hashlib.sha256(stay).hexdigest())
            kept.append(stay)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array([len(s) for s in spans], pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(spans, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
                pa.array(kept, pa.binary()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"],
        )


def _hot(docs: DataFrame, count: int, length: int, gram: int, hot_rows: int, sample: int) -> np.ndarray:
    """Anchor hashes that occur in more than ``hot_rows`` documents, estimated on a sample."""
    share = min(1.0, sample / max(1, count))
    least = max(2, int(hot_rows * share))
    if count <= hot_rows:
        return np.zeros(0, np.uint64)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, found in _batch_anchors(batch, length, gram):
                once = np.unique(np.stack([found["h"], found["id"].astype(np.uint64)]), axis=1)[0] if len(found["h"]) else found["h"]
                h, n = np.unique(once, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], names=["h", "n"])

    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0 < share)
    rows = some.mapInArrow(hashes, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h").collect()
    return np.array([r[0] for r in rows], np.int64).view(np.uint64)


def _unique_ids(documents: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(doc_id, text) with ids that tell rows apart, and for repeated or null ids a map (doc_id, row_hash, new id)."""
    docs = slim(documents, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    counts = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1)
    if counts.isEmpty():
        return docs, None
    hashed = docs.withColumn("row_hash", F.xxhash64("text"))
    keys = hashed.select("doc_id", "row_hash").distinct().orderBy(F.col("doc_id").asc_nulls_first(), "row_hash")
    schema = T.StructType([T.StructField("old", T.LongType()), T.StructField("row_hash", T.LongType()), T.StructField("new", T.LongType())])
    numbered = stash(documents.sparkSession.createDataFrame(keys.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1])), schema), "numbers")
    renamed = hashed.join(numbered, F.col("doc_id").eqNullSafe(F.col("old")) & (hashed["row_hash"] == numbered["row_hash"])).select(F.col("new").alias("doc_id"), "text")
    return renamed, numbered.select("new", "old")


def dedup_substrings(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_rows: int = HOT_ROWS, hot_sample: int = HOT_SAMPLE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept (remaining bytes) of every row.

    Null and empty texts have no bytes, texts under ``length`` bytes lose none.  Rows equal in
    doc_id and text are one document; other rows that repeat a doc_id are documents of their
    own, in the order of their hashes; a null doc_id comes before all others.  Other columns
    are ignored.
    """
    spark = documents.sparkSession
    docs, numbers = _unique_ids(documents)
    count, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    parts = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size or 0) // PART_BYTES))
    hot = spark.sparkContext.broadcast(_hot(docs, count, length, gram, hot_rows, hot_sample))
    dealt = docs.mapInArrow(lambda b: _deal(parts, length, gram, hot.value, b), _DEALT)
    found = stash(dealt.groupBy("part").applyInArrow(lambda t: _equal_spans(length, t), _FOUND), "equal-spans")
    asked = found.where("asked IS NOT NULL").groupBy("doc_id").agg(F.collect_list("asked").alias("asked"))
    width = 2 * length - gram  # the most bytes that an anchor's windows cover
    contexts = docs.join(asked, "doc_id").select("doc_id", "text", "asked").mapInArrow(lambda b: _contexts(parts, length, width, b), _CONTEXT)
    sorted_ = stash(contexts.groupBy("part").applyInArrow(lambda t: _sort_windows(length, width, t), "doc_id long, spans binary"), "equal-windows")
    spans = found.where("spans IS NOT NULL").select("doc_id", "spans").unionByName(sorted_).groupBy("doc_id").agg(F.collect_list("spans").alias("spans"))
    rows = docs.join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(_report, _REPORT)
    if numbers is None:
        return rows
    return rows.join(numbers.withColumnRenamed("new", "doc_id"), "doc_id").drop("doc_id").select(F.col("old").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept")


ORACLE = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, i, substr(x, CAST(2 * i + 1 AS BIGINT), 200) AS s FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 99)) AS i FROM d WHERE length(x) >= 200)),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS rn FROM w),
r AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM f WHERE rn > 1),
g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM r),
sp AS (SELECT doc_id, min(i) AS s, max(i) + 100 AS e FROM g GROUP BY doc_id, run),
k AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS p FROM sp),
kp AS (SELECT k.doc_id, string_agg(substr(x, CAST(2 * p + 1 AS BIGINT), CAST(2 * (s - p) AS BIGINT)), '' ORDER BY s) || substr(any_value(x), CAST(2 * max(e) + 1 AS BIGINT)) AS kept, sum(e - s) AS n_removed, count(*) AS n_spans
  FROM k JOIN d ON k.doc_id = d.doc_id GROUP BY k.doc_id)
SELECT d.doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN kp ON d.doc_id = kp.doc_id
"""

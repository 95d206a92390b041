"""Variable-capacity best-fit packing of token sequences.

Several sequence lengths (capacities) are permitted at once.  Pieces are placed longest
first.  A piece goes to the open bin whose free room is least among those that hold it; if
none does, a bin is opened.  For that, every permitted capacity that holds the piece is filled
on trial from the lengths still to come, longest first, and the one whose downsized bin costs
least per token it holds is opened: which capacity pays depends on what is left to fill it.
At the end each bin is downsized to the smallest permitted capacity that holds its contents.

Only (doc_id, length) rows are packed, never texts, and packing is independent in hash
partitions of a bounded number of tokens: the waste of a partition is at most that of its last
few open bins, so the partitioning costs next to nothing while no task grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.shared import slim, text_bytes
from pagewright.llm.tokens import Encoder, tokenizer_path

#: Permitted sequence lengths.
CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: Cost of a sequence of c tokens: c + c * c / SPAN + OVERHEAD (work per token, attention over pairs, fixed work).
OVERHEAD = 64.0
SPAN = 16_384.0
#: Words whose ids a worker keeps while it counts tokens.
REMEMBER = 200_000
#: Rows of a packing group, in expectation.
GROUP_ROWS = 50_000


def cost(capacity: float, overhead: float = OVERHEAD, span: float = SPAN) -> float:
    return capacity + capacity * capacity / span + overhead


class Left:
    """Lengths still to be placed: how often each occurs, and which occur, as bits."""

    def __init__(self, lengths: np.ndarray):
        self.counts = np.bincount(lengths).tolist() if len(lengths) else [0]
        self.bits = 0
        for n in np.unique(lengths).tolist():
            self.bits |= 1 << n

    def take(self, n: int) -> None:
        self.counts[n] -= 1
        if not self.counts[n]:
            self.bits &= ~(1 << n)

    def fill(self, room: int) -> int:
        """Tokens that fill a room, longest pieces first; nothing is taken."""
        used = 0
        while room > 0 and (n := (self.bits & ((1 << room + 1) - 1)).bit_length() - 1) > 0:
            k = min(self.counts[n], room // n)
            used += k * n
            room = min(room - k * n, n - 1)  # shorter ones from here on
        return used


def least_cost_capacity(piece: int, left: Left, capacities: Sequence[int], overhead: float = OVERHEAD, span: float = SPAN) -> int:
    """The capacity (at least ``piece``) whose bin, filled from ``left`` (without the piece) and downsized, costs least per token.  Ties go to the larger."""

    def per_token(c: int) -> float:
        used = piece + left.fill(c - piece)
        return cost(min(s for s in capacities if s >= used), overhead, span) / used

    return min((c for c in capacities if c >= piece), key=lambda c: (per_token(c), -c))


def pack(lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, overhead: float = OVERHEAD, span: float = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packs pieces of 1 .. max(capacities) tokens: (bin, offset) of each piece and the capacity of each bin.

    Best fit in O(1) per piece: bins are listed by free room, and an integer bit mask says
    which rooms occur.  Pieces of one length keep their order; of bins with the same room the last used goes first.
    """
    capacities = sorted(set(capacities))
    lengths = np.asarray(lengths, np.int64)
    order = np.argsort(-lengths, kind="stable")
    left = Left(lengths)
    by_room: list[list[int]] = [[] for _ in range(capacities[-1] + 1)]
    mask = 0
    used: list[int] = []
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for k in order.tolist():
        n = int(lengths[k])
        left.take(n)
        fitting = mask >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask &= ~(1 << room)
        else:
            b = len(used)
            room = least_cost_capacity(n, left, capacities, overhead, span)
            used.append(0)
        bins[k], offsets[k] = b, used[b]
        used[b] += n
        room -= n
        if room:
            by_room[room].append(b)
            mask |= 1 << room
    final = np.asarray(capacities)[np.searchsorted(capacities, used)] if used else np.zeros(0, np.int64)
    return bins, offsets, final


def cut(length: int, capacities: Sequence[int]) -> list[int]:
    """Pieces of one document: full pieces of the largest capacity, then the rest."""
    top = max(capacities)
    return [top] * (length // top) + ([length % top] if length % top else [])


_OUT = "doc_id long, piece int, piece_start long, n_tokens long, bin_id long, bin_offset long, bin_capacity long, bin_used long"


def _pack_group(capacities: Sequence[int], overhead: float, span: float, table: pa.Table) -> pa.Table:
    ids, lengths = table.column("doc_id").to_pylist(), table.column("n_tokens").to_pylist()
    group = int(table.column("_group")[0].as_py())
    rows = sorted(zip(ids, lengths, strict=True), key=lambda r: (r[0] is None, r[0] or 0, r[1] or 0))
    doc, piece, start, size = [], [], [], []
    for doc_id, length in rows:
        at = 0
        for k, n in enumerate(cut(length or 0, capacities) or [0]):
            doc.append(doc_id), piece.append(k), start.append(at), size.append(n)
            at += n
    size = np.asarray(size, np.int64)
    some = np.flatnonzero(size > 0)
    bins, offsets, final = pack(size[some], capacities, overhead, span)
    used = np.bincount(bins, weights=size[some], minlength=len(final)).astype(np.int64)

    def column(values: np.ndarray) -> pa.Array:
        out, there = np.zeros(len(size), np.int64), np.zeros(len(size), bool)
        out[some], there[some] = values, True
        return pa.array(out, mask=~there)

    return pa.table(
        {
            "doc_id": pa.array(doc, pa.int64()),
            "piece": pa.array(piece, pa.int32()),
            "piece_start": pa.array(start, pa.int64()),
            "n_tokens": pa.array(size),
            "bin_id": column(group * (1 << 32) + bins),
            "bin_offset": column(offsets),
            "bin_capacity": column(final[bins] if len(bins) else bins),
            "bin_used": column(used[bins] if len(bins) else bins),
        }
    )


def best_fit(sized: DataFrame, capacities: Sequence[int] = CAPACITIES, overhead: float = OVERHEAD, span: float = SPAN, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Packs (doc_id, n_tokens) rows; one row per piece.

    Returns doc_id, piece (from 0), piece_start, n_tokens, bin_id, bin_offset, bin_capacity,
    bin_used.  Documents longer than the largest capacity are cut into full pieces and a rest.
    Null and zero lengths keep one row without a bin; repeated rows are packed each; null ids
    are allowed; other columns are ignored; an empty table gives no rows.  Groups are hash
    partitions of rows: their number is the row count over ``group_rows``, so no key, however
    frequent, makes a large group.  In a group rows are packed in order of length, then
    doc_id.  Which rows share a group follows from doc_id and, so that repeated ids spread,
    from the file the row is read from: the bins of several groups may differ between layouts
    of the same rows, a single group's don't.
    """
    rows = slim(sized, "doc_id", "n_tokens").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("n_tokens").cast("long").alias("n_tokens"))
    groups = max(1, -(-rows.select(F.count(F.lit(1))).first()[0] // group_rows))
    spread = F.pmod(F.coalesce(F.xxhash64("doc_id"), F.lit(0)) + F.monotonically_increasing_id() % 1_000_003, F.lit(groups)) if groups > 1 else F.lit(0).cast("long")
    return rows.withColumn("_group", spread).groupBy("_group").applyInArrow(lambda t: _pack_group(capacities, overhead, span, t), _OUT)


def _lengths(path: str | None, extra: int, release: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder = Encoder.of(path or tokenizer_path(), REMEMBER)
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        counts: list[int] = []
        for at in range(0, batch.num_rows, 256):
            spans = offsets[at : at + 257].tolist()
            texts = [data[s:e].tobytes() for s, e in zip(spans, spans[1:], strict=False)]
            counts += [len(ids) // 4 for ids in encoder.encode(texts)]
        full = np.asarray(counts, np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.where(full > 0, full + extra, 0))], names=["doc_id", "n_tokens"])
    if release:
        encoder.forget()


def token_lengths(documents: DataFrame, path: str | None = None, extra: int = 1, release: bool = False) -> DataFrame:
    """(doc_id, n_tokens) of whole texts with the tokenizer at ``path``; ``extra`` for an end id.

    Null and empty texts, and texts without tokens, have 0.  Repeated rows, null and repeated
    ids have a row each; texts of any length are counted whole; other columns are ignored; an
    empty table gives no rows.

    With ``release`` a worker forgets the words it has met at a task's end: slower, but it leaves memory to later stages.
    """
    rows = slim(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lambda b: _lengths(path, extra, release, b), "doc_id long, n_tokens long")

"""Substring dedup by paragraph MinHash banding.

Paragraphs are compared on two levels.  Lines of ``MIN_WORDS`` words or more are hashed into
bands tuned for high recall; equal ones collapse to one before any pairing, colliding ones
are joined and verified by the exact Jaccard of their word shingles, and the verified links'
components are the groups of repeats.  Of each group the first line (least doc_id, then
position) stays, all others are removed.

Below the line, and across line breaks, every run of ``WINDOW`` words is a paragraph too
(see :mod:`pagewright.llm.passages`): one MinHash register bands them, equality verifies
them, and the words they cover go from all documents but the first.  Lines of fewer than
``MIN_WORDS`` words are only removed as part of such a run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.minhash import SHINGLE, SIMILARITY, components_by_signature, prob_minhash
from pagewright.llm.passages import WINDOW, cut, repeated_windows
from pagewright.llm.shared import BROADCAST_BYTES, Words, document_key, fresh, scratch, slices, slim, stash, text_bytes

MIN_WORDS = 20
RECALL = 0.999
#: Share of pairs of similarity UNLIKE that may collide.
UNLIKE, FALSE_SHARE = 0.2, 0.1


def tune_bands(similarity: float = SIMILARITY, recall: float = RECALL, unlike: float = UNLIKE, false_share: float = FALSE_SHARE) -> tuple[int, int]:
    """(bands, rows): the fewest bands that find a pair at the threshold with the given recall while
    pairs of similarity ``unlike`` collide with at most the given share."""
    for rows in range(1, 33):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))
        if 1 - (1 - unlike**rows) ** bands <= false_share:
            return bands, rows
    raise ValueError("no banding has that recall and that share of false candidates")


_PARTS = "doc_id long, row_hash long, position int, k1 long, k2 long, size long, signature binary, text string"


def _paragraphs(k: int, min_words: int, registers: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for lo, hi in slices(offsets):
            part, own = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            breaks = np.flatnonzero(part == 10)
            starts = np.union1d(own, breaks + 1)
            words = Words(part, starts)
            keep = np.flatnonzero(words.counts >= min_words)
            hashes, first = words.shingles(k)
            counts = np.diff(first)
            wanted = np.zeros(len(counts), bool)
            wanted[keep] = True
            number = np.cumsum(wanted) - 1
            chosen = np.repeat(wanted, counts)
            paragraph = np.repeat(np.arange(len(counts)), counts)[chosen]
            elements = hashes[chosen]
            # repeated shingles of a paragraph draw the same arrivals: the sets' plain Jaccard
            signature = prob_minhash(elements, np.ones(len(elements)), number[paragraph], len(keep), registers)
            k1, k2 = words.sequence_keys()
            begin, end = starts[keep], starts[keep + 1]
            doc = np.searchsorted(own, begin, "right") - 1
            position = np.searchsorted(breaks, begin) - np.searchsorted(breaks, own[doc])
            clean = end - ((end > 0) & (part[np.maximum(end - 1, 0)] == 10))
            texts = [part[s:e].tobytes() for s, e in zip(begin.tolist(), clean.tolist(), strict=True)]
            at = pa.array(lo + doc)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at),
                    batch.column("row_hash").take(at),
                    pa.array(position, pa.int32()),
                    pa.array(k1[keep].view(np.int64)),
                    pa.array(k2[keep].view(np.int64)),
                    pa.array(end - begin),
                    pa.array([row.tobytes() for row in signature], pa.binary()),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "row_hash", "position", "k1", "k2", "size", "signature", "text"],
            )


def repeated_paragraphs(documents: DataFrame, min_words: int = MIN_WORDS, k: int = SHINGLE, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """(doc_id, row_hash, position, kept_doc_id, kept_position) of every paragraph to remove.

    ``row_hash`` is xxhash64 of the row's text, which tells rows apart that share a doc_id;
    equal rows are one document.
    """
    bands, rows = tune_bands(similarity, recall)
    source = slim(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_hash"), "text").where("text IS NOT NULL")
    found = source.mapInArrow(lambda b: _paragraphs(k, min_words, bands * rows, b), _PARTS)
    parts = stash(found.withColumn("id", F.monotonically_increasing_id()), "paragraphs")
    # equal paragraphs collapse to the first
    same = parts.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    firsts = stash(same.select("id", "n", "k1", "k2"), "distinct-paragraphs")
    texts = parts.select("id", "text")
    signed = parts.select("id", "signature", "size").join(firsts.select("id"), "id", "left_semi")
    components = components_by_signature(stash(signed, "signed"), texts, bands, rows, k, similarity)
    # written, as below, so that the joins with them deal out their rows anew and can split hot keys
    grouped = stash(firsts.join(components.withColumnRenamed("node", "id"), "id", "left").where("component IS NOT NULL OR n > 1").select("k1", "k2", F.coalesce("component", "id").alias("component")), "grouped")
    members = stash(parts.select("doc_id", "row_hash", "position", "k1", "k2").join(grouped, ["k1", "k2"]).select("component", "doc_id", "row_hash", "position"), "repeats")
    # ids first, positions second: both minima are computed before the shuffle
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "position", "row_hash")
    kept = stash(members.groupBy("component").agg(F.min(order).alias("kept")), "kept")
    removed = members.join(kept, "component").where(~(F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("row_hash") == F.col("kept.row_hash")) & (F.col("position") == F.col("kept.position"))))
    return removed.select("doc_id", "row_hash", "position", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.position").alias("kept_position"))


_CUT = "struct<text:string,words:long,spans:long>"


def _cutter(window: int):
    @F.arrow_udf(_CUT)
    def without(text: pa.Array, lines: pa.Array, spans: pa.Array) -> pa.Array:
        found = []
        for t, gone, span in zip(text.to_pylist(), lines, spans, strict=True):
            at = [np.asarray(span.values.field(f), np.int64) for f in ("start", "n")] if span.is_valid else [np.zeros(0, np.int64)] * 2
            found.append(None if t is None else cut(t, np.asarray(gone.values if gone.is_valid else [], np.int64), *at, window))
        columns = list(zip(*(x or (None, 0, 0) for x in found), strict=True)) or [[], [], []]
        return pa.StructArray.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["text", "words", "spans"])

    return without


def _near(documents: DataFrame, table: DataFrame, size: int, on: list) -> DataFrame:
    """Left join with a table of that many bytes, broadcast if they are few."""
    return documents.join(F.broadcast(table) if size <= BROADCAST_BYTES else table, on, "left")


def dedup_paragraphs(documents: DataFrame, count_column: str | None = None, window: int = WINDOW, **options) -> DataFrame:
    """All columns of ``documents`` with repeats removed from ``text``, and n_removed, n_spans, removed, kept_in.

    What goes: lines of ``min_words`` words or more that are alike (Jaccard) to one that
    stays, and words covered by ``window`` consecutive words that an earlier document holds
    too, wherever lines break.  ``n_removed`` are words, ``n_spans`` maximal runs of them,
    ``removed`` the positions (from 0) of lines that go as wholes by their likeness,
    ``kept_in`` the doc_ids that keep what goes.  All else stays byte for byte.

    Null and empty texts, and texts without repeats, stay as they are; a text may become
    empty.  Rows equal in doc_id and text are one document, of which every row is treated
    alike; rows that only share a doc_id are different documents.  Null doc_ids come last in
    the order of documents.  Ties between documents go to the least text hash.  Existing
    columns of the four new names are replaced, all others pass through.  ``count_column``, if the
    input has it, is set to the code points of each changed text.  An empty table gives none.
    """
    own_id, own_key, lines, lines_in, spans, spans_in, result = fresh(documents, "own_id", "own_key", "lines", "lines_in", "spans", "spans_in", "result")
    with scratch() as keep:
        found = repeated_paragraphs(documents, **options).groupBy("doc_id", "row_hash").agg(F.collect_set("position").alias("removed"), F.collect_set("kept_doc_id").alias("kept_docs"))
        removed = keep(stash(found.withColumn("key", document_key(F.col("doc_id"), F.col("row_hash"))).select("doc_id", "key", F.array_sort("removed").alias("removed"), "kept_docs"), "removals"))
        few = removed.agg(F.sum(48 + 4 * F.size("removed") + 8 * F.size("kept_docs"))).first()[0] or 0
        source = slim(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
        source = source.withColumn("key", document_key(F.col("doc_id"), F.xxhash64("text")))
        marked = _near(source, removed.select("key", "removed"), few, "key")
        passages = keep(stash(repeated_windows(marked, window), "passages"))
        more = passages.agg(F.sum(48 + 4 * 2 * F.size("spans") + 8 * F.size("kept_docs"))).first()[0] or 0
    joined = documents.withColumns({own_id: F.col("doc_id").cast("long"), own_key: F.when(F.col("text").isNotNull(), document_key(F.col("doc_id").cast("long"), F.xxhash64("text")))})
    for table, size, values, docs in ((removed.withColumnRenamed("removed", "values"), few, lines, lines_in), (passages.withColumnRenamed("spans", "values"), more, spans, spans_in)):
        other_id, other_key = fresh(joined, "other_id", "other_key")
        table = table.select(F.col("doc_id").alias(other_id), F.col("key").alias(other_key), F.col("values").alias(values), F.col("kept_docs").alias(docs))
        joined = _near(joined, table, size, [F.col(own_key) == F.col(other_key), F.col(own_id).eqNullSafe(F.col(other_id))]).drop(other_id, other_key)
    touched = F.col(lines).isNotNull() | F.col(spans).isNotNull()
    joined = joined.withColumn(result, _cutter(window)(F.when(touched, F.col("text")), F.col(lines), F.col(spans)))
    none = F.array().cast("array<long>")
    counted = {}
    if count_column in documents.columns:
        counted = {count_column: F.when(touched, F.length(F.col(result)["text"]).cast(documents.schema[count_column].dataType)).otherwise(F.col(f"`{count_column}`"))}
    return joined.withColumns(
        counted
        | {
            "n_removed": F.coalesce(F.col(result)["words"], F.lit(0).cast("long")),
            "n_spans": F.coalesce(F.col(result)["spans"], F.lit(0).cast("long")),
            "removed": F.coalesce(F.col(lines), F.array().cast("array<int>")),
            "kept_in": F.array_sort(F.array_union(F.coalesce(F.col(lines_in), none), F.coalesce(F.col(spans_in), none))),
            "text": F.when(touched, F.col(result)["text"]).otherwise(F.col("text")),
        }
    ).drop(own_id, own_key, lines, lines_in, spans, spans_in, result)

"""Toxicity by nearest labelled examples.

Labelled examples are TF-IDF vectors over words and word beginnings.  A term's weight is
(1 + ln tf) * idf * relevance, where relevance is 1 - penalty / G: G is the term's likelihood
ratio (G statistic) with the label over the n examples, and a term whose G does not pay the
penalty of the extended Bayesian information criterion (ln n + 2 * GAMMA * ln(terms tried))
has weight zero.  No term is cut by a fixed count or a fixed number of terms.  The words of a
text are pooled in one more term, so that one accidental hit in a long text is near to long
texts; texts without any term of weight have no vector.  An inverted index holds a posting for every term of every
example, and the largest weight of each term in each block of examples; blocks are visited
by falling upper bound until no block can change the k best, which makes the cosines exact.
Votes weighted by distance are calibrated by isotonic regression on leave-one-out votes of
the examples.

Bounded by parameters: the examples (``TOXIC_EXAMPLES``, ``CLEAN_EXAMPLES``, in expectation),
and so their terms and postings.  Document frequencies count all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.shared import Words, crc_mod3, prefix_sums, scratch, slices, slim, span_hashes, stash, text_bytes

TOXIC_EXAMPLES = 2_000
CLEAN_EXAMPLES = 4_000
#: Bytes of the word beginnings that are terms beside the word.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
#: Share of the penalty for the number of terms that are tried.
GAMMA = 0.5
NEIGHBOURS = 15
BLOCK = 64
CUT = 0.7
_EVIDENCE = 5


#: Hash of the pooled term.
_POOLED = np.uint64(0)


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of each occurrence of a term in lower-cased texts; each word also is one of the pooled term."""
    words = Words(data, offsets)
    doc = np.repeat(np.arange(len(words.counts)), words.counts)
    if not len(words.hashes):
        return np.zeros(0, np.uint64), doc
    sums = prefix_sums(words.lowered)
    hashes, docs = [words.hashes, np.full(len(doc), _POOLED)], [doc, doc]
    for n in BEGINNINGS:
        long_ = np.flatnonzero(words.ends - words.starts > n)
        starts = words.starts[long_]
        hashes.append(~span_hashes(sums, starts, starts + n))
        docs.append(doc[long_])
    return np.concatenate(hashes), np.concatenate(docs)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = text_bytes(pc.utf8_lower(pc.fill_null(batch.column("text"), "")))
    for lo, hi in slices(offsets):
        yield lo, hi, *_terms(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])


def _example_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic, n): in how many examples of a partition a term occurs."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        for lo, _, hashes, doc in _texts(batch):
            pair = np.unique(np.stack([hashes, doc.astype(np.uint64)]), axis=1) if len(hashes) else np.zeros((2, 0), np.uint64)
            term, label = pair[0].view(np.int64), toxic[lo + pair[1].astype(np.int64)]
            for y in (0, 1):
                seen, n = np.unique(term[label == y], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(np.full(len(seen), y, np.int32)), pa.array(n, pa.int64())], names=["term", "toxic", "n"])


class Vocabulary:
    """Sorted term hashes with a bit table in front of the search."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.gate = np.zeros(1 << 20, bool)
        self.gate[self.hashes & np.uint64(0xFFFFF)] = True

    def counts(self, hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, term, count), sorted by document and term."""
        width = max(1, len(self.hashes))
        maybe = np.flatnonzero(self.gate[hashes & np.uint64(0xFFFFF)])
        hashes, doc = hashes[maybe], doc[maybe]
        place = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        hit = self.hashes[place] == hashes if len(self.hashes) else np.zeros(0, bool)
        keys, n = np.unique(doc[hit] * width + place[hit], return_counts=True)
        return keys // width, keys % width, n


def _document_frequencies(vocabulary: Vocabulary, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(len(vocabulary.hashes) + 1, np.int64)
    for batch in batches:
        df[-1] += batch.num_rows
        for _, _, hashes, doc in _texts(batch):
            _, column, _ = vocabulary.counts(hashes, doc)
            df[:-1] += np.bincount(column, minlength=len(df) - 1)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(df)), pa.int32()), pa.array(df)], names=["column", "n"])


def relevance(toxic: Column, all_: Column, n_toxic: int, n: int, penalty: float) -> Column:
    """max(0, 1 - penalty / G) of a term in ``toxic`` of ``n_toxic`` and ``all_`` of ``n`` examples."""
    if not 0 < n_toxic < n:
        return F.lit(0.0)
    cells = [(toxic, all_ * (n_toxic / n)), (all_ - toxic, all_ * (1 - n_toxic / n))]
    cells += [(n_toxic - toxic, (n - all_) * (n_toxic / n)), (n - n_toxic - all_ + toxic, (n - all_) * (1 - n_toxic / n))]
    g = sum((F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0) for seen, expected in cells), F.lit(0.0))
    return F.when(g > penalty, 1 - penalty / g).otherwise(0.0)


def _weights(scale: np.ndarray, doc: np.ndarray, column: np.ndarray, count: np.ndarray, n_docs: int) -> np.ndarray:
    """Unit-length (1 + ln tf) * scale weights."""
    w = (1 + np.log(count)) * scale[column]
    norm = np.sqrt(np.bincount(doc, weights=w * w, minlength=n_docs))
    return w / norm[doc]


#: Bits of an example's number in a neighbour's key; more examples than these allow are refused.
_BITS = 20
#: Steps of a cosine in a neighbour's key.
_STEPS = 1e12


class BlockMaxIndex:
    """Postings of examples, the largest weight of each term in each block of them, and exact k-nearest search.

    (example, term, weight) are rows of unit vectors.  Examples are in order of their
    strongest terms, so that blocks hold like ones.  Many texts are searched at once: each
    visits its blocks by falling upper bound, and those at the same block are scored together
    from the block's postings.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, example: np.ndarray, term: np.ndarray, weight: np.ndarray, terms: int, block: int = BLOCK):
        if len(ids) >= 1 << _BITS:
            raise ValueError("too many examples")
        strongest = np.zeros((len(ids), 2))
        order = np.lexsort((np.where(term > 0, weight, 0.0), example))  # the pooled term says little
        last = np.flatnonzero(np.diff(example[order], append=-1)) if len(order) else order
        strongest[example[order][last]] = np.stack([term[order][last], weight[order][last]], 1)
        self.rank = np.lexsort((ids, strongest[:, 1], strongest[:, 0]))
        place = np.empty(len(ids), np.int64)
        place[self.rank] = np.arange(len(ids))
        self.ids, self.labels, self.terms, self.block, self.blocks = ids[self.rank], labels[self.rank], terms, block, -(-len(ids) // block)
        #: the smaller an id, the larger its number: keys of equal cosines fall with the id
        self.number = np.empty(len(ids), np.int64)
        self.number[np.argsort(self.ids, kind="stable")] = (1 << _BITS) - 1 - np.arange(len(ids))
        self.by_number = np.argsort(self.ids, kind="stable")
        order = np.lexsort((term, place[example] // block))
        at, term, weight = place[example][order], term[order], weight[order]
        edges = np.searchsorted(at // block, np.arange(self.blocks + 1))
        #: of each block: its terms, and the postings as (row among the terms, place in the block, weight)
        self.postings = []
        self.block_max = np.zeros((terms, self.blocks))
        for b in range(self.blocks):
            part = slice(edges[b], edges[b + 1])
            own, row = np.unique(term[part], return_inverse=True)
            self.postings.append((own, row, at[part] - b * block, weight[part]))
            np.maximum.at(self.block_max[:, b], term[part], weight[part])

    def nearest(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, k: int, leave_out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(n, k) positions and cosines of the examples nearest to n texts that share a term, nearest first, ties to the smaller id; -1 where there are fewer.

        ``leave_out`` is a position for each text that doesn't count, or -1.
        """
        x = np.zeros((n, self.terms))
        x[row, term] = weight
        bounds = x @ self.block_max
        falling = np.argsort(-bounds, axis=1, kind="stable")
        best = np.zeros((n, k), np.int64)  # keys: steps of the cosine, then the example's number
        open_ = np.arange(n)
        for step in range(self.blocks):
            block = falling[open_, step]
            bound, worst = bounds[open_, block], best[open_, k - 1]
            going = (bound > 0) & ((worst == 0) | (bound >= (worst >> _BITS) / _STEPS - 2 / _STEPS))
            open_, block = open_[going], block[going]
            if not len(open_):
                break
            for b in np.unique(block).tolist():
                rows = open_[block == b]
                own, at_term, at, w = self.postings[b]
                size = min(self.block, len(self.ids) - b * self.block)
                dense = np.zeros((len(own), size))
                dense[at_term, at] = w
                cosine = x[np.ix_(rows, own)] @ dense
                keys = np.rint(cosine * _STEPS).astype(np.int64) << _BITS | self.number[b * self.block : b * self.block + size]
                keys[cosine <= 0] = 0
                if leave_out is not None:
                    mine = leave_out[rows] - b * self.block
                    here = np.flatnonzero((mine >= 0) & (mine < size))
                    keys[here, mine[here]] = 0
                both = np.concatenate([best[rows], keys], axis=1)
                both.partition(both.shape[1] - k, axis=1)
                best[rows] = np.sort(both[:, -k:], axis=1)[:, ::-1]
        number = (1 << _BITS) - 1 - (best & (1 << _BITS) - 1)
        there = best > 0
        place = np.where(there, self.by_number[np.where(there, number, 0)] if len(self.ids) else 0, -1)
        return place, np.where(there, (best >> _BITS) / _STEPS, 0.0)

    def vote(self, place: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Share of label 1 among the neighbours of each text, weighted by 1 / (distance + 0.05); not a number without neighbours."""
        weight = np.where(place >= 0, 1 / (np.maximum(0, 1 - score) + 0.05), 0.0)
        total = weight.sum(1)
        labels = self.labels[np.maximum(place, 0)] if len(self.labels) else np.zeros(place.shape)
        return np.divide((weight * labels).sum(1), total, out=np.full(len(total), np.nan), where=total > 0)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators fit of y on x: knots and their levels, both rising."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # x, sum of w * y, sum of w
    for a, b, w in zip(x[order], y[order], weight[order], strict=True):
        blocks.append([a, w * b, w])
        while len(blocks) > 1 and (blocks[-1][0] == blocks[-2][0] or blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]):
            last = blocks.pop()
            blocks[-1] = [last[0] if last[0] == blocks[-1][0] else (blocks[-1][0] * blocks[-1][2] + last[0] * last[2]) / (blocks[-1][2] + last[2]), blocks[-1][1] + last[1], blocks[-1][2] + last[2]]
    return np.array([b[0] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


class ToxicityModel:
    """Terms (the pooled one first), their scales (idf times relevance), the example index and the calibration.

    ``without`` is the score of texts without a term of weight.
    """

    def __init__(self, vocabulary: Vocabulary, scale: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], without: float, clean_weight: float):
        self.vocabulary, self.scale, self.without = vocabulary, scale, without
        # of equal vectors only the first few ids can be among the nearest, whatever the text
        met: dict[bytes, int] = {}
        kept = []
        for k, (terms, weights) in enumerate(vectors):
            key = terms.tobytes() + np.round(weights, 12).tobytes()
            met[key] = met.get(key, 0) + 1
            if len(terms) and met[key] <= NEIGHBOURS + 1:
                kept.append(k)
        def flat(rows: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            row = np.repeat(np.arange(len(rows)), [len(vectors[k][0]) for k in rows])
            return row, *(np.concatenate([np.zeros(0, kind), *[vectors[k][c] for k in rows]]) for c, kind in ((0, np.int64), (1, np.float64)))

        self.index = BlockMaxIndex(ids[kept], labels[kept], *flat(kept), len(scale))
        own = dict(zip(np.array(kept, np.int64)[self.index.rank].tolist(), range(len(kept)), strict=True))
        judged = [k for k, (terms, _) in enumerate(vectors) if len(terms) > 1]
        leave_out = np.array([own.get(k, -1) for k in judged], np.int64)
        votes = self.index.vote(*self.index.nearest(*flat(judged), len(judged), NEIGHBOURS, leave_out))
        at = np.array(judged, np.int64)[~np.isnan(votes)]
        fitted = isotonic(votes[~np.isnan(votes)], labels[at].astype(float), np.where(labels[at] > 0, 1.0, clean_weight)) if len(at) else None
        self.knots, self.levels = fitted or (np.zeros(1), np.full(1, without))

    def calibrated(self, votes: np.ndarray) -> np.ndarray:
        return np.where(np.isnan(votes), self.without, np.clip(np.interp(votes, self.knots, self.levels), 0, 1))


def fit(documents: DataFrame, labels: DataFrame, toxic_examples: int = TOXIC_EXAMPLES, clean_examples: int = CLEAN_EXAMPLES) -> ToxicityModel:
    """Fits on the labelled documents given (the caller leaves the held-out fold out of ``labels``).

    Of a label with more rows than its bound, rows whose hashed id falls below the matching
    share are examples.  Null labels and ids are left out; a doubly labelled id counts as its
    larger label; examples without words are no neighbours.
    """
    known = slim(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {int(r[0]): r[1] for r in known.groupBy("toxic").count().collect()}
    shares = [min(1.0, bound / max(1, sizes.get(y, 0))) for y, bound in ((0, clean_examples), (1, toxic_examples))]
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0
    chosen = known.where(unit < F.when(F.col("toxic") == 1, shares[1]).otherwise(shares[0]))  # bounded, so broadcast
    texts = slim(documents, "doc_id", "text").where("text IS NOT NULL")
    with scratch():
        examples = stash(texts.join(F.broadcast(chosen), "doc_id").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "toxic"), "toxic-examples")
        n1, n0 = (examples.where(f"toxic = {y}").count() for y in (1, 0))
        prior = sizes.get(1, 0) / max(1, sum(sizes.values()))
        per_term = examples.mapInArrow(_example_terms, "term long, toxic int, n long").groupBy("term").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum("n").alias("n"))
        per_term = stash(per_term, "example-terms")
        penalty = float(np.log(max(1, n1 + n0)) + 2 * GAMMA * np.log(max(1, per_term.count())))
        seen = per_term.select("term", relevance(F.col("a"), F.col("n"), n1, n1 + n0, penalty).alias("relevance")).where("relevance > 0").collect()
        terms, relevant = np.array([r[0] for r in seen], np.int64).view(np.uint64), np.array([r[1] for r in seen])
        order = np.argsort(terms)
        terms, relevant = terms[order], relevant[order]
        if len(terms):
            terms, relevant = np.append(_POOLED, terms[terms != _POOLED]), np.append(1.0, relevant[terms != _POOLED])
        vocabulary = Vocabulary(terms)

        sent = documents.sparkSession.sparkContext.broadcast(vocabulary)
        got = slim(documents, "text").mapInArrow(lambda b: _document_frequencies(sent.value, b), "column int, n long").groupBy("column").agg(F.sum("n").alias("n")).collect()
        df = np.zeros(len(terms) + 1)
        for column, n in got:
            df[column] = n
        scale = np.log(1 + df[-1] / np.maximum(1, df[:-1])) * relevant

        rows = examples.select("doc_id", "toxic", "text").mapInArrow(lambda b: _example_vectors(sent.value, b), "doc_id long, toxic int, columns array<int>, counts array<long>").collect()
    rows = sorted((r for r in rows if len(r["columns"])), key=lambda r: (r["doc_id"], r["toxic"], r["columns"], r["counts"]))
    vectors = []
    for r in rows:
        column, count = np.array(r["columns"], np.int64), np.array(r["counts"], np.int64)
        vectors.append((column, _weights(scale, np.zeros(len(column), np.int64), column, count, 1)))
    ids, toxic = np.array([r["doc_id"] for r in rows], np.int64), np.array([r["toxic"] for r in rows], np.int64)
    # examples without a term of weight (but the pooled one): how many of them are toxic, at the labels' true shares
    plain = np.array([len(column) < 2 for column, _ in vectors], bool)
    weight = np.where(toxic[plain] > 0, 1.0, shares[1] / shares[0])
    without = float(weight @ toxic[plain] / weight.sum()) if len(terms) and plain.any() else prior
    return ToxicityModel(vocabulary, scale, ids, toxic, vectors, without, shares[1] / shares[0])


def _example_vectors(vocabulary: Vocabulary, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, hashes, doc in _texts(batch):
            d, column, count = vocabulary.counts(hashes, doc)
            ends = np.searchsorted(d, np.arange(hi - lo + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(lo, hi - lo),
                    batch.column("toxic").slice(lo, hi - lo),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(column, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(count, pa.int64())),
                ],
                names=["doc_id", "toxic", "columns", "counts"],
            )


_EVIDENCE_TYPE = pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())])


def _score(model: ToxicityModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = model.index
    for batch in batches:
        for lo, hi, hashes, doc in _texts(batch):
            d, column, count = model.vocabulary.counts(hashes, doc)
            weight = _weights(model.scale, d, column, count, hi - lo)
            some = np.flatnonzero(np.bincount(d, minlength=hi - lo) > 1)  # more than the pooled term
            number = np.full(hi - lo, -1)
            number[some] = np.arange(len(some))
            own = number[d] >= 0
            place, cosine = index.nearest(number[d[own]], column[own], weight[own], len(some), NEIGHBOURS)
            scores = np.full(hi - lo, model.without)
            scores[some] = model.calibrated(index.vote(place, cosine))
            shown = place[:, :_EVIDENCE] >= 0
            sizes = np.zeros(hi - lo, np.int64)
            sizes[some] = shown.sum(1)
            at = place[:, :_EVIDENCE][shown]
            listed = pa.StructArray.from_arrays([pa.array(index.ids[at], pa.int64()), pa.array(np.minimum(1.0, cosine[:, :_EVIDENCE][shown])), pa.array(index.labels[at], pa.int32())], fields=list(_EVIDENCE_TYPE))
            evidence = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), listed)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(scores, pa.float64()), evidence], names=["doc_id", "score", "evidence"])


def score(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score, predicted, evidence) of every row, whole texts, without a shuffle.

    ``evidence`` are the nearest examples; those at the same cosine come in order of doc_id, and
    the smaller ids are the neighbours.  Texts without a term of weight (null, empty and wordless
    ones too) have as score the share of label 1 among the examples like them, or the labels'
    share where there are none, and no evidence.  Repeated rows are each scored; very long
    texts are read whole; other columns are ignored; an empty table gives no rows.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    rows = slim(documents, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    scored = rows.mapInArrow(lambda b: _score(sent.value, b), "doc_id long, score double, evidence array<struct<doc_id:long,cosine:double,toxic:int>>")
    return scored.select("doc_id", "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "evidence")


def predict_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Fits on labels outside the held-out fold and scores all documents: doc_id, held_out, score, predicted, evidence."""
    model = fit(documents, labels.where(crc_mod3("doc_id") != 1))
    return score(documents, model).select("doc_id", (crc_mod3("doc_id") == 1).alias("held_out"), "score", "predicted", "evidence")

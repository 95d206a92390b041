"""Language identification by multilingual mixture inference.

A document is a mixture of languages: every short run of text is drawn from one language,
which is drawn from the document's proportions.  Run likelihoods come from hashed character
trigram models (counts of labelled text, add-alpha smoothing).  Expectation-maximisation
estimates the proportions; the language set is chosen by penalised likelihood: starting
from the best single language, languages join while the log-likelihood rises by more than
``penalty * log(runs)``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.shared import crc_mod3, map_rows, slices, slim, text_bytes

#: Buckets of the hashed trigram models.
BUCKETS = 1 << 16
#: Documents of a language that a model is fitted on, in expectation (a documented bound, not a cap on scoring).
TRAIN_DOCS = 2_000
#: Trigrams in a run.
RUN = 24
UNDETERMINED = "und"


def _codepoints(lowered: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets) of strings."""
    data, offsets = text_bytes(lowered)
    lead = (data & 0xC0) != 0x80
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    ends = np.concatenate([[0], np.cumsum(lead)])
    return points, ends[offsets]


def _trigrams(points: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of the trigram that begins at each code point (the last two are padded); what isn't a letter counts as one blank."""
    letters = np.where((points >= 97) & (points <= 122) | (points > 127), points, 32).astype(np.uint32)
    padded = np.concatenate([letters, np.full(2, 32, np.uint32)])
    h = padded[:-2] * np.uint32(2654435761) + padded[1:-1] * np.uint32(2246822519) + padded[2:] * np.uint32(3266489917)
    h ^= h >> np.uint32(15)
    h *= np.uint32(2654435761)
    return (h >> np.uint32(8)) & np.uint32(buckets - 1)


def _partition_counts(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts of a partition's labelled texts: (lang, bucket, n)."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        lowered = pc.utf8_lower(batch.column("text"))
        points, ends = _codepoints(lowered)
        grams = _trigrams(points, buckets)
        for k, lang in enumerate(langs):
            counts.setdefault(lang, np.zeros(buckets, np.int64))
            counts[lang] += np.bincount(grams[ends[k] : ends[k + 1]], minlength=buckets)
    for lang, c in counts.items():
        seen = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(c[seen], pa.int64())], names=["lang", "bucket", "n"])


class LanguageModel:
    """Log-likelihoods of trigram buckets, a column per language."""

    def __init__(self, languages: list[str], log_p: np.ndarray):
        self.languages, self.log_p = languages, log_p


def fit(labelled: DataFrame, train_docs: int = TRAIN_DOCS, buckets: int = BUCKETS, alpha: float = 0.5) -> LanguageModel:
    """Fits the trigram models on (doc_id, text, lang), null langs and texts left out.

    Of a language with more than ``train_docs`` documents, those whose hashed id falls below
    the matching share are used.
    """
    rows = slim(labelled, "doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.zeros((buckets, 0), np.float32))
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, train_docs / n)))])
    sample = rows.where((F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0) < share[F.col("lang")]).select("text", "lang")
    counted = sample.mapInArrow(lambda b: _partition_counts(buckets, b), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.full((buckets, len(languages)), alpha)
    got = counted.toPandas()  # at most buckets x languages rows
    counts[got["bucket"], got["lang"].map(languages.index)] += got["n"]
    return LanguageModel(languages, np.log(counts / counts.sum(0)).astype(np.float32))


def _em(ll: np.ndarray, doc: np.ndarray, first: np.ndarray, allowed: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of every document over its allowed languages, and its log-likelihood.

    ll: run x language log-likelihoods; doc: document of each run; first: first run of each document.
    """
    top = ll.max(1, keepdims=True)
    like = np.exp(ll - top)
    pi = allowed / allowed.sum(1, keepdims=True)
    for _ in range(steps):
        joint = like * pi[doc]
        evidence = np.maximum(joint.sum(1, keepdims=True), 1e-300)
        pi = np.add.reduceat(joint / evidence, first, axis=0)
        pi /= np.maximum(pi.sum(1, keepdims=True), 1e-300)
    evidence = np.maximum((like * pi[doc]).sum(1), 1e-300)
    total = np.add.reduceat(np.log(evidence) + top[:, 0], first)
    return pi, total


def infer(ll: np.ndarray, runs: np.ndarray, penalty: float = 2.0, steps: int = 12) -> np.ndarray:
    """Language proportions of documents with ``runs`` runs each (all > 0).

    Greedy forward selection, all documents at once: in each round a document tries its
    likeliest missing language and keeps it if the penalised likelihood rises.
    """
    first = np.concatenate([[0], np.cumsum(runs)[:-1]])
    doc = np.repeat(np.arange(len(runs)), runs)
    n_lang = ll.shape[1]
    whole = np.add.reduceat(ll, first, axis=0)
    best = whole.argmax(1)
    allowed = np.zeros((len(runs), n_lang))
    allowed[np.arange(len(runs)), best] = 1
    pi, total = allowed.copy(), whole[np.arange(len(runs)), best]
    full, _ = _em(ll, doc, first, np.ones_like(allowed), 4)
    open_ = np.ones(len(runs), bool)
    for _ in range(n_lang - 1):
        rest = np.where(allowed > 0, -1.0, full)
        candidate = rest.argmax(1)
        open_ &= rest.max(1) > 0.5 / runs  # less than half a run can't pay for a language
        pick = np.flatnonzero(open_)
        if not len(pick):
            break
        keep = np.repeat(open_, runs)
        renumber = np.cumsum(open_) - 1
        tried = allowed[pick].copy()
        tried[np.arange(len(pick)), candidate[pick]] = 1
        f = np.concatenate([[0], np.cumsum(runs[pick])[:-1]])
        p, t = _em(ll[keep], renumber[doc[keep]], f, tried, steps)
        better = t - total[pick] > penalty * np.log(runs[pick] + 1)
        won = pick[better]
        allowed[won], pi[won], total[won] = tried[better], p[better], t[better]
        open_[pick[~better]] = False
    return pi


_OUT = "doc_id long, lang_pred string, score double, languages array<struct<lang:string,share:double>>"


def _predict(model: LanguageModel, run: int, penalty: float, texts: pa.Array) -> tuple[list[str], np.ndarray, list[list[dict]]]:
    """(language, share of it, all shares) of each text."""
    import regex

    letter = regex.compile(r"\p{L}")
    _, offsets = text_bytes(texts)
    preds, scores, shares = [UNDETERMINED] * len(texts), np.zeros(len(texts)), [[] for _ in range(len(texts))]
    for lo, hi in slices(offsets):
        part = pc.fill_null(texts.slice(lo, hi - lo), "")
        known = np.array([bool(letter.search(t)) for t in part.to_pylist()]) & (len(model.languages) > 0)
        if known.any():
            rows = np.flatnonzero(known)
            points, ends = _codepoints(pc.utf8_lower(part.take(pa.array(rows))))
            ll = model.log_p[_trigrams(points, len(model.log_p))]
            sizes = np.diff(ends)
            runs = np.maximum(1, sizes // run)  # the last run takes the rest
            doc = np.repeat(np.arange(len(runs)), runs)
            starts = ends[:-1][doc] + run * (np.arange(len(doc)) - (np.cumsum(runs) - runs)[doc])
            pi = infer(np.add.reduceat(ll, starts, axis=0).astype(np.float64), runs, penalty)
            top = pi.argmax(1)
            for r, k, p in zip(lo + rows, top, pi, strict=True):
                preds[r], scores[r] = model.languages[k], min(1.0, float(p[k]))
                shares[r] = [{"lang": model.languages[j], "share": float(p[j])} for j in np.argsort(-p, kind="stable") if p[j] > 0]
    return preds, scores, shares


def _score(model: LanguageModel, run: int, penalty: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        preds, scores, shares = _predict(model, run, penalty, batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(preds, pa.string()), pa.array(scores), pa.array(shares, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))],
            names=["doc_id", "lang_pred", "score", "languages"],
        )


def _accept(model: LanguageModel, run: int, penalty: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if not len(model.languages):
        yield from batches
        return
    for batch in batches:
        preds = pa.array(_predict(model, run, penalty, batch.column("text"))[0], pa.string())
        if "lang" in batch.schema.names:
            at = batch.schema.get_field_index("lang")
            batch = batch.set_column(at, batch.schema.field(at), pc.coalesce(batch.column(at), preds))
        yield batch.filter(pc.not_equal(preds, UNDETERMINED))


def accepted(documents: DataFrame, model: LanguageModel, run: int = RUN, penalty: float = 2.0) -> DataFrame:
    """Rows of ``documents`` (all columns) whose language is determined; a null ``lang`` is filled in.  No shuffle.

    Null, empty and letterless texts go, however long; repeated rows are each judged; ties go
    to the alphabetically first language.  Where the model knows no language nothing is rejected:
    all rows pass as they are.  Columns of any name pass through; an empty table gives none.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    return map_rows(documents, lambda b: _accept(sent.value, run, penalty, b))


def identify(documents: DataFrame, model: LanguageModel, run: int = RUN, penalty: float = 2.0) -> DataFrame:
    """(doc_id, lang_pred, score, languages) of every row, whole texts, without a shuffle.

    ``languages`` are the chosen languages with their shares, ``lang_pred`` the largest (ties:
    the alphabetically first), ``score`` its share.  Null, empty and letterless texts, and any
    text where the model knows no language, are ``und`` with score 0 and no languages.
    Repeated rows are each scored; other columns are ignored.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    return slim(documents, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(lambda b: _score(sent.value, run, penalty, b), _OUT)


def predict_languages(documents: DataFrame) -> DataFrame:
    """Fits on the documents outside the held-out fold and scores all: doc_id, held_out, lang_pred, score, languages."""
    model = fit(documents.where(crc_mod3("doc_id") != 1))
    return identify(documents, model).select("doc_id", (crc_mod3("doc_id") == 1).alias("held_out"), "lang_pred", "score", "languages")

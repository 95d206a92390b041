"""From raw documents to packed training sequences: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm import decontaminate, langid, minhash, packing, paragraphs
from pagewright.llm.shared import crc_mod3, fresh, stash, table, unstash


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of undetermined language: no text, no letter.  A null ``lang`` becomes the predicted one.

    Null, empty and letterless texts go, repeated rows are each judged, very long texts are
    read whole, ties go to the alphabetically first language, null ids and columns of any name
    pass through.  Where no document has a language, and so on an empty table, nothing is rejected.
    """
    model = langid.fit(docs.where(crc_mod3("doc_id") != 1))
    return langid.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: the one with the least doc_id.

    Null, empty and wordless texts and rows without a doc_id stay; of rows equal in doc_id and
    text one stays; rows that only share a doc_id are different documents, the least text hash
    first; very long texts are compared whole; columns of any name pass through; an empty table
    gives none.
    """
    return minhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines and passages that an earlier document holds go; ``n_chars`` follows the text.  A text may become empty.

    Null and empty texts stay as they are; of equal ones the least doc_id comes first, null ids
    last; rows equal in doc_id and text are one document and change alike; very long texts are
    compared whole; columns of any name pass through; an empty table gives none.
    """
    aside = _aside(docs)
    left = paragraphs.dedup_paragraphs(docs.withColumnsRenamed(aside), count_column="n_chars").drop(*REPORT)
    return left.withColumnsRenamed({v: k for k, v in aside.items()}).select(*[F.col(f"`{c}`") for c in docs.columns])


#: Columns that the report of repeated passages adds; columns of the input of these names are kept aside.
REPORT = ("n_removed", "n_spans", "removed", "kept_in")


def _aside(docs: DataFrame) -> dict[str, str]:
    own = [c for c in docs.columns if c.lower() in REPORT]
    return dict(zip(own, fresh(docs, *[f"own_{c}" for c in own]), strict=True))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go.

    Null, empty and wordless texts and null ids stay; repeated rows are each judged; very long
    texts are searched whole; columns of any name pass through; an empty table gives none, an
    empty benchmark removes none.
    """
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' tokens in training sequences.

    Null and empty texts have a row without a place; repeated rows, null and repeated ids are
    packed each; longer texts than the largest sequence are cut into pieces; of equal lengths the
    least doc_id comes first; other columns are left out; an empty table gives none.
    """
    return packing.best_fit(stash(packing.token_lengths(docs, release=True), "lengths"))


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: Trained models, components and packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result but the last is written, read again, and deleted when its successor is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        after = stash(stage(spark, docs, sf_dir), f"stage-{name}")
        unstash(docs)
        docs = after
    result = STAGES[-1][1](spark, docs, sf_dir)  # reads a table of lengths of its own
    unstash(docs)
    return result

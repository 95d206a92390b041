"""The thin production queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.llm import ann, decontaminate, html_text, langid, minhash, packing, paragraphs, suffix_dedup, tokens, toxicity
from pagewright.llm.shared import stash, table


def op1_best_fit_packing(spark, sf_dir):
    return packing.best_fit(stash(packing.token_lengths(table(spark, sf_dir, "documents")), "lengths"))


def op2_html_extraction(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_toxicity(spark, sf_dir):
    return toxicity.predict_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_token_files(spark, sf_dir):
    return tokens.read_token_files(tokens.write_token_files(table(spark, sf_dir, "documents")))


def op5_nearest_neighbours(spark, sf_dir):
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_suffix_dedup(spark, sf_dir):
    return suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents")).drop("spans", "kept")


def op7_decontaminate(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("runs", "matches")


def op8_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_language_id(spark, sf_dir):
    return langid.predict_languages(table(spark, sf_dir, "documents"))


def op10_paragraph_dedup(spark, sf_dir):
    return paragraphs.dedup_paragraphs(table(spark, sf_dir, "documents").select("doc_id", "text"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return {
        "op1_best_fit_packing": op1_best_fit_packing,
        "op2_html_extraction": op2_html_extraction,
        "op3_toxicity": op3_toxicity,
        "op4_token_files": op4_token_files,
        "op5_nearest_neighbours": op5_nearest_neighbours,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_decontaminate": op7_decontaminate,
        "op8_minhash": op8_minhash,
        "op9_language_id": op9_language_id,
        "op10_paragraph_dedup": op10_paragraph_dedup,
        "pipeline": pipeline,
    }


def oracle_sql():
    return {"op6_suffix_dedup": suffix_dedup.ORACLE, "op7_decontaminate": decontaminate.ORACLE}

"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteora.llm import (
    bpe, fim, fingerprint, html, langid, linededup, lmscore, packing, pii, quality, resampling, rules, simhash,
)
from meteora.llm.common import fold, held_out, table


def vocabulary() -> str:
    """The byte-level BPE vocabulary of the registered queries."""
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all ``documents``; labels are learnt where fold 4 is not 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"), fold(F.col("doc_id"), 4) != 2)
    return quality.with_quality(docs, model, keep_text=False).select(
        "doc_id", held_out(F.col("doc_id"), 4).alias("held_out"), "score", "predicted")


def op2_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition counts and verdicts of all ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.with_rules(docs, keep_text=False)


def op3_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all ``documents``, learnt where fold 7 is not 2."""
    return lmscore.score(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 7), held_fold=2, tune_fold=3)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all ``documents``, learnt where fold 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, fold(F.col("doc_id"), 4) != 2)
    return langid.with_language(docs.select("doc_id", "text"), model, keep_text=False).select(
        "doc_id", held_out(F.col("doc_id"), 4).alias("held_out"), "lang_pred", "score", "rejected")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of ``documents`` packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), 2048, wide=True)


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` encoded, then decoded from its ids."""
    coded = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary(), wide=True)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all ``pages``."""
    pages = table(spark, sf_dir, "pages")
    return html.with_main_text(pages.select("page_id", "url", "html"), html.fit(pages))


def op8_sketch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of ``documents`` and of their edited texts, and how alike they are."""
    return fingerprint.compare_versions(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of ``documents`` (4-word shingles, at most 4 bits)."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with one line kept of each group of equal or similar lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.without_duplicate_lines(docs).select("doc_id", "text", "n_lines", "n_removed")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` cut and reordered (seed 7), and their texts rebuilt from that."""
    cut = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"), seed=7, rate=100, spm_rate=50)
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                      digest(fim.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` weighed by their likeness to ``benchmark``, and the tenth that is drawn."""
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), seed=2024)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all ``documents``: counts, and where it is."""
    found = pii.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)
    return found.select("doc_id", *[f"n_{k}" for k in pii.BASE_KINDS],
                        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_repetition_rules": op2_repetition_rules,
    "op3_deleted_interpolation": op3_deleted_interpolation,
    "op4_language_id": op4_language_id,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_bpe_codec": op6_bpe_codec,
    "op7_html_extraction": op7_html_extraction,
    "op8_sketch_fingerprints": op8_sketch_fingerprints,
    "op9_simhash": op9_simhash,
    "op10_fuzzy_line_dedup": op10_fuzzy_line_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_personal_data": op13_personal_data,
}

#: DuckDB SQL where SQL can express the operator.
ORACLES: dict[str, str] = {
    "op2_repetition_rules": rules.oracle_sql(),
    "op11_fill_in_middle": fim.oracle_sql(),
    "op12_importance_resampling": resampling.oracle_sql(),
}

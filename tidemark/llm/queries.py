"""Registered queries of the training-data operators: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import ann, base, brown, html_text, kneser_ney, line_dedup, mixing, near_dup, packing, quality_rules, ranked, toxicity, warc, whitening
from .oracle import ORACLES


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(base.table(spark, sf_dir, "documents"), base.table(spark, sf_dir, "labels"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality_rules(base.table(spark, sf_dir, "documents"), base.table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.quality_classifier(base.table(spark, sf_dir, "documents"), base.table(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(base.table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(base.table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(base.table(spark, sf_dir, "pages"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its lines, how many go, and which (their places in the text)."""
    out = line_dedup.dropped_lines(base.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"),
                      F.array_join("dropped", ",").alias("dropped"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(base.table(spark, sf_dir, "documents"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(base.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = base.scratch(spark, "warc")
    warc.write_archive(base.table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked_search(base.table(spark, sf_dir, "documents"), base.table(spark, sf_dir, "benchmark"))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(brown.FOLDS)) == brown.HELD_OUT
    return brown.score(base.table(spark, sf_dir, "documents"), held_out)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(base.table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_toxicity, op2_quality_rules, op3_quality_classifier, op4_packing, op5_mixing, op6_html_extraction,
        op7_line_dedup, op8_minhash_near_dedup, op9_nearest_neighbours, op10_warc, op11_ranked_search,
        op12_lm_scoring, op13_embedding_whitening)}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLES.items() if k in queries()}

"""The registered queries of the dealt operators: thin projections of each operator onto its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm.bottom_k import bottom_k_classes
from quotemill.llm.decontaminate import contaminated_items
from quotemill.llm.hard_negatives import mine_hard_negatives
from quotemill.llm.license_scan import scan_licences
from quotemill.llm.line_dedup import line_report
from quotemill.llm.mixture import mix_sources
from quotemill.llm.ngram_join import jaccard_classes
from quotemill.llm.oracles import ORACLE_SQL  # noqa: F401
from quotemill.llm.quality_classifier import quality_report
from quotemill.llm.quality_rules import apply_quality_rules
from quotemill.llm.span_dedup import removed_sentences
from quotemill.llm.spelling import spelling_variants
from quotemill.llm.storage import read_table
from quotemill.llm.toxicity import score_toxicity
from quotemill.llm.url_filter import judge_urls


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(read_table(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each contaminated document and benchmark item."""
    return contaminated_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_quality_rules(read_table(spark, sf_dir, "documents"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = jaccard_classes(read_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "n_shingles", "component_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(read_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document that loses sentences, and the documents that keep them."""
    found = removed_sentences(read_table(spark, sf_dir, "documents"))
    as_text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return found.select(
        "doc_id",
        F.size("removed").cast("long").alias("n_removed"),
        as_text("removed").alias("removed"),
        as_text("kept_ids").alias("kept_ids"),
    )


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf_dir, "documents"))


def op12_bottom_k_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom_k_classes(read_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_hard_negatives(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scans,
        op2_benchmark_decontamination,
        op3_quality_rules,
        op4_source_mixing,
        op5_ngram_jaccard_join,
        op6_line_dedup,
        op7_toxicity,
        op8_substring_dedup,
        op9_url_filters,
        op10_quality_classifier,
        op11_spelling_variants,
        op12_bottom_k_dedup,
        op13_hard_negatives,
    )
}

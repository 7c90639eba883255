"""Corpus pipeline: quality, line dedup, near duplicates, benchmark decontamination, source mixing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm.decontaminate import without_contaminated
from quotemill.llm.folded import parted
from quotemill.llm.line_dedup import dedup_lines
from quotemill.llm.mixture import mix_sources
from quotemill.llm.ngram_join import jaccard_classes
from quotemill.llm.quality_classifier import score_quality
from quotemill.llm.storage import kept, read_table, stored, working_tables

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Null and empty texts get the score of a text without n-grams, repeated rows stay or go together, an empty table
    gives an empty one, columns beside those of documents are left out; without labels all stay (a score of 0.5).
    """
    scored = score_quality(docs, read_table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*COLUMNS)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; one that loses all its words goes.

    Null texts, and texts that had no words before, stay as they are; rows that repeat id and text lose the same lines;
    ``n_chars`` is counted again where the text changed; an empty table gives an empty one.
    """
    cut = dedup_lines(docs.select(*COLUMNS).withColumn("was", F.length("text")))
    kept_rows = cut.where((F.col("was") == F.length("text")) | F.col("text").rlike(r"[^\x20\x09-\x0D]") | F.col("text").isNull())
    n_chars = F.when(F.col("was") == F.length("text"), F.col("n_chars")).when(F.col("text").isNull(), F.col("n_chars"))
    return kept_rows.withColumn("n_chars", n_chars.otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class: the one with the smallest doc_id (null last).

    Documents without shingles are in no class and all stay. Rows are told apart by id and text, so that neither
    null ids nor ids with several texts lose a row of another class; of rows that repeat both, one stays. An empty
    table gives an empty one. Only rows that a Bloom filter of the copies lets through are shuffled.
    """
    row = docs.select(F.xxhash64("doc_id", "text").alias("row"), *COLUMNS)
    with working_tables(spark):
        classes = jaccard_classes(row.select(F.col("row").alias("doc_id"), "text")).where("node is not null")
        members = classes.groupBy(F.col("doc_id").alias("row")).agg(F.min("component_id").alias("class"), F.count("*").alias("n"))
        ids = row.groupBy("row").agg(F.min(F.col("doc_id").cast("long")).alias("id"))
        members = stored(members.join(ids, "row"), "pipeline-members")
        place = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
        first = members.groupBy("class").agg(F.min(place)["row"].alias("row")).select("row", F.lit(True).alias("stays"))
        marks = members.join(first, "row", "left").where("stays is null or n > 1").select("row", "stays")
        marks = kept(marks, "pipeline-copies")
    likely, others = parted(row, F.col("row"), marks.select("row"))
    once = likely.join(marks, "row", "left_anti").select(*COLUMNS)
    repeated = likely.join(marks.where("stays"), "row", "left_semi").groupBy("row").agg(F.min(F.struct(*COLUMNS)).alias("r"))
    return others.select(*COLUMNS).union(once).union(repeated.select("r.*"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item; null and empty texts stay, repeated rows stay or go together."""
    return without_contaminated(docs, read_table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: a row for each, null and empty texts of size 0; see ``mix_sources``."""
    return mix_sources(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", cut_repeated_lines),
    ("n-gram Jaccard join", one_of_each_class),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources", mix),
]

#: The classifier of the first stage is learned, and SQL can't express it.
ORACLE_SQL = None


def _after(spark: SparkSession, sf_dir: str, stages: int) -> DataFrame:
    """The documents that the first ``stages`` stages leave; what the stage before has written is deleted then."""
    if not stages:
        return read_table(spark, sf_dir, "documents")
    name, stage = STAGES[stages - 1]
    with working_tables(spark):
        return kept(stage(spark, _after(spark, sf_dir, stages - 1), sf_dir), f"pipeline-{name.replace(' ', '-')}")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return STAGES[-1][1](spark, _after(spark, sf_dir, len(STAGES) - 1), sf_dir)

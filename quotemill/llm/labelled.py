"""Bounded samples of labelled documents, and the held-out fifth of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text is divisible by 5; a null id counts as an empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % 5 == 0


def training_rows(documents: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled rows that are not held out.

    The rows with the smallest hashes of their ids: the same on every run, and spread over the labels. Of
    several labels of an id the largest counts, and of several texts of an id the smallest, so that repeated rows do
    not add to the sample. At most ``most`` ids are joined, so Spark may broadcast them.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))

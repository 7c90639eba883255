"""Tables in the folder that all executors share, the input tables, and names for joined columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quotemill.sources.scratch import kept, shared_folder, stored, working_tables

__all__ = ["fresh", "kept", "read_table", "shared_folder", "stored", "working_tables"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name

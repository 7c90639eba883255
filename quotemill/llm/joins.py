"""Joins with keys that may have most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_join(rows: DataFrame, table: DataFrame, on: str, salts: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has a row for each ``on``: a key with most rows is dealt to ``salts`` parts."""
    salted = rows.withColumn("salt_", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)))
    copies = table.withColumn("salt_", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return salted.join(copies, [on, "salt_"], how).drop("salt_")


def dealt_pairs(rows: DataFrame, key: str, name: str, most: int) -> DataFrame:
    """Pairs of rows with an equal ``key``, columns ending in ``_a`` and ``_b``, the first with the smaller ``name``.

    Keys with one row are left out before rows are dealt; of a key with more than ``most`` rows one side is dealt to parts.
    """
    sizes = rows.groupBy(key).agg(F.count("*").alias("size_")).where("size_ > 1")
    sizes = sizes.select(key, F.ceil(F.col("size_") / F.lit(most)).alias("parts_"))
    sized = rows.join(sizes, key)
    side = lambda df, end: df.select(key, "part_", *[F.col(c).alias(c + end) for c in rows.columns if c != key])
    one = side(sized.withColumn("part_", F.pmod(F.xxhash64(name), F.col("parts_"))), "_a")
    two = side(sized.withColumn("part_", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts_") - 1))), "_b")
    return one.join(two, [key, "part_"]).where(F.col(f"{name}_a") < F.col(f"{name}_b")).drop("part_")

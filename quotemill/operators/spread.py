"""Exact percentiles and running sums of groups of any size: no task holds all rows of a group."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quotemill.functions.expr import finite
from quotemill.sources.scratch import kept, stored, working_tables

#: Cells that values are counted in at once, for a group and column: what a task of a window holds at most.
CELLS = 1 << 16
#: Parts that the rows of one group are dealt to where bounds are joined to them.
SALTS = 8


def beside_keys(df: DataFrame, few: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``df`` joined with ``few``, which has a row for each of the keys; NULL keys are keys."""
    named = few.select(*[F.col(k).alias(f"{k}_of") for k in keys], *[c for c in few.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}_of")) for k in keys])
    return df.join(named, on, how).drop(*[f"{k}_of" for k in keys])


def _beside_spread(df: DataFrame, few: DataFrame, keys: list[str]) -> DataFrame:
    """``beside_keys`` for any number of groups: a group with most of the rows is dealt to parts."""
    dealt = df.withColumn("salt_", F.pmod(F.xxhash64("x", F.monotonically_increasing_id()), F.lit(SALTS)))
    copies = few.withColumn("salt_", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return beside_keys(dealt, copies, [*keys, "salt_"]).drop("salt_")


def log_cell(x: Column) -> Column:
    """A whole number that never falls as ``x`` rises, the same for numbers of one sign within about 5 %: at most 2**16 of them."""
    size = 1 + F.floor((F.log2(F.abs(x)) + 1075) * 15)
    return F.when(x == 0, 0).otherwise(F.signum(x).cast("long") * size)


def _counted(values: DataFrame, keys: list[str], place: Column, same: tuple[str, ...] = ()) -> DataFrame:
    """(keys, place, here, least, most): values by place, counted on the map side."""
    within = values.withColumn("place", place).groupBy(*keys, "place")
    return within.agg(F.count("*").alias("here"), F.min("x").alias("least"), F.max("x").alias("most"), *[F.max(c).alias(c) for c in same])


def _up_to(counts: DataFrame, keys: list[str]) -> DataFrame:
    """``counts`` with the number of values up to each place."""
    earlier = W.partitionBy(*keys).orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    return counts.withColumn("up_to", F.sum("here").over(earlier))


def _bounds(counts: DataFrame, keys: list[str]) -> DataFrame:
    """The places that hold the two values wanted: (keys, column, share, n, below, lo, hi, left).

    ``left`` is the number of values between lo and hi among which the two are; 0 if lo and hi are the two themselves.
    """
    at = F.col("share") * (F.col("n") - 1)
    cell = F.struct("place", "least", "most", (F.col("up_to") - F.col("here")).alias("below"), "here")
    first = lambda k: F.min(F.when(F.col("up_to") > k(at), cell))
    both = counts.groupBy(*keys).agg(*[F.max(c).alias(c) for c in ("column", "share", "n")], first(F.floor).alias("a"), first(F.ceil).alias("b"))
    one = F.col("a.place") == F.col("b.place")
    return both.select(
        *keys, "column", "share", "n", "a.below",
        F.when(one, F.col("a.least")).otherwise(F.col("a.most")).alias("lo"),
        F.when(one, F.col("a.most")).otherwise(F.col("b.least")).alias("hi"),
        F.when(one & (F.col("a.least") < F.col("a.most")), F.col("a.here")).otherwise(0).alias("left"),
    )


def _narrowed(values: DataFrame, bounds: DataFrame, by: list[str], place: Column) -> DataFrame:
    """``bounds`` moved closer; ``place`` rises with the value ``x`` between lo and hi."""
    open_ = bounds.where("left > 0")
    within = _beside_spread(values, open_, [*by, "column"]).where("x between lo and hi")
    counts = _up_to(_counted(within, [*by, "name"], place, ("column", "share", "n", "below")), [*by, "name"])
    moved = _bounds(counts.withColumn("up_to", F.col("up_to") + F.col("below")), [*by, "name"])
    return moved.unionByName(bounds.where("left = 0"))


def exact_percentiles(df: DataFrame, columns: dict[str, tuple[str, float]], by: list[str] | None = None) -> DataFrame:
    """A row for each group with name: (column, share): exact percentiles, linear between neighbours; NULL, NaN left out.

    Values are counted in cells of their logarithm, which tails of any length don't fill up; the cell with the two
    neighbours is cut into equal cells, again if need be, until at most ``CELLS`` values are left, which are counted
    one by one. What is shuffled is counts, and no task holds more than ``CELLS`` of a group. ``df`` is read twice if
    the cells found hold no more values than that, and once more for each cut; here, and not when the result is read.
    Columns are counted once, whatever the number of their shares. A group without values has NULL, a table without
    rows no groups (without ``by``: NULL).
    """
    groups_by, by = by or [], [f"key{k}_" for k in range(len(by or []))]  # own names, which no name below clashes with
    used = list(dict.fromkeys(c for c, _ in columns.values()))
    with working_tables(df.sparkSession):
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), finite(c).alias("x")) for c in used])
        values = df.select(*[F.col(c).alias(k) for c, k in zip(groups_by, by, strict=True)], F.inline(pairs))
        counts = stored(_counted(values, [*by, "column"], log_cell(F.col("x"))), "percentile-cells")
        groups = counts.select(*by).distinct()
        known = _up_to(counts.where("place is not null"), [*by, "column"])
        n = F.max("up_to").over(W.partitionBy(*by, "column"))
        wanted = F.array(*[F.struct(F.lit(c).alias("of"), F.lit(name).alias("name"), F.lit(float(q)).alias("share")) for name, (c, q) in columns.items()])
        own = F.filter(wanted, lambda w: w["of"] == F.col("column"))
        named = known.withColumn("n", n).select("*", F.inline(own))
        bounds = stored(_bounds(named, [*by, "name"]), "percentile-bounds")
        values = values.where("x is not null")
        cell = F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * CELLS)
        while (left := bounds.agg(F.max("left")).first()[0]) or 0:
            bounds = stored(_narrowed(values, bounds, by, cell if left > CELLS else F.col("x")), "percentile-bounds")
        at = F.col("share") * (F.col("n") - 1)
        between = (F.ceil(at) - at) * F.col("lo") + (at - F.floor(at)) * F.col("hi")
        found = bounds.withColumn("value", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(between))
        wide = found.groupBy(*by).agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in columns])
        out = beside_keys(groups, wide, by, "left") if by else wide
        return kept(out.select(*[F.col(k).alias(c) for c, k in zip(groups_by, by, strict=True)], *columns), "percentiles")


def stats_by(df: DataFrame, by: list[str], aggregates: list[Column], percents: dict[str, tuple[str, float]]) -> DataFrame:
    """A row for each group: ``aggregates``, and exact percentiles as ``exact_percentiles`` makes them; ``df`` is made once."""
    with working_tables(df.sparkSession):
        rows = stored(df, "stats-rows")
        found, cuts = rows.groupBy(*by).agg(*aggregates), exact_percentiles(rows, percents, by)
        return kept(beside_keys(found, cuts, by, "left") if by else found.crossJoin(cuts), "stats")


def running(df: DataFrame, by: list[str], order: list[Column], sums: dict[str, Column], label: str) -> DataFrame:
    """``df`` with name: the sum of a column up to and with the row in ``order``, and all_name, the group's sum.

    Rows are dealt by ranges of the order, so that a big group is many tasks; each range is given the sums of those
    before it. ``order`` must tell all rows of a group apart.
    """
    dealt = stored(df.repartitionByRange(*by, *order).withColumn("range_", F.spark_partition_id()), label)
    ranges = dealt.groupBy(*by, "range_").agg(*[F.sum(c).alias(f"own_{n}") for n, c in sums.items()])
    group = W.partitionBy(*by)
    earlier = group.orderBy("range_").rowsBetween(W.unboundedPreceding, -1)
    offsets = {f"before_{n}": F.coalesce(F.sum(f"own_{n}").over(earlier), F.lit(0)) for n in sums}
    ranges = ranges.withColumns({**offsets, **{f"all_{n}": F.sum(f"own_{n}").over(group) for n in sums}}).drop(*[f"own_{n}" for n in sums])
    within = W.partitionBy(*by, "range_").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    rows = dealt.withColumns({n: F.sum(c).over(within) for n, c in sums.items()})
    rows = beside_keys(rows, ranges, [*by, "range_"])
    return rows.withColumns({n: F.col(n) + F.col(f"before_{n}") for n in sums}).drop("range_", *[f"before_{n}" for n in sums])

"""As-of and range joins, planned as equi joins on time bins so that none is a nested loop.

Left rows are kept apart by all their columns; give them an id where rows repeat.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from quotemill.functions.expr import micros


def _us(seconds: float) -> int:
    return int(round(seconds * 1_000_000))


def asof(left: DataFrame, right: DataFrame, take: list[str], order: list[str], forward: bool = False, part_seconds: int = 86400, key: str = "symbol", ts: str = "timestamp") -> DataFrame:
    """Every left row with ``take`` of the last right row at or before it (``forward``: the first at or after).

    Rows of a key meet in parts of the time line; what a part hands on to the next is one row, so that a key with
    most rows is spread over its parts. ``order`` breaks ties among right rows of one time. Unmatched rows get NULL.
    """
    part = F.floor(micros(ts) / F.lit(part_seconds * 1_000_000))
    value = F.struct(*[F.col(c) for c in take])
    rows = right.select(key, F.col(ts).alias("at_"), part.alias("part_"), value.alias("hit_"), F.struct(*order).alias("tie_"), F.lit(0 if not forward else 1).alias("side_"))
    mine = F.struct(*[F.col(c) for c in left.columns])
    probes = left.select(key, F.col(ts).alias("at_"), part.alias("part_"), mine.alias("row_"), F.lit(1 if not forward else 0).alias("side_"))
    both = rows.unionByName(probes, allowMissingColumns=True)
    # Forward: from the latest row on, so that what is next is the last one seen.
    turn = F.desc if forward else F.asc
    near = F.last("hit_", True).over(W.partitionBy(key, "part_").orderBy(*[turn(c) for c in ("at_", "side_", "tie_")]).rowsBetween(W.unboundedPreceding, 0))
    place = F.when(F.col("side_") == int(forward), F.struct("at_", "tie_"))  # of right rows only
    edge = F.min_by("hit_", place) if forward else F.max_by("hit_", place)
    parts = both.groupBy(key, "part_").agg(edge.alias("edge_"))
    carried = F.last("edge_", True).over(W.partitionBy(key).orderBy(turn("part_")).rowsBetween(W.unboundedPreceding, -1))
    carried = parts.select(key, "part_", carried.alias("carried_"))
    found = both.withColumn("near_", near).where(F.col("row_").isNotNull()).join(carried, [key, "part_"])
    return found.select("row_.*", *[F.coalesce("near_", "carried_")[c].alias(c if c not in left.columns else f"{c}_r") for c in take])


def asof_nearest(left: DataFrame, right: DataFrame, take: list[str], tolerance: float, left_id: list[str], tie: str, key: str = "symbol", ts: str = "timestamp") -> DataFrame:
    """Every left row with ``take`` of the right row nearest in time, if one is within ``tolerance`` seconds.

    Of rows equally near the earlier side wins; of right rows of one time the last by ``tie`` on the earlier side,
    the first on the later side. Rows meet in parts of the time line, and right rows within the tolerance of a
    part's ends in both: a left row looks at the last row before it and the first after it, however many are near.
    Left rows travel whole, so that ``left_id`` isn't joined again.
    """
    tol = _us(tolerance)
    width = F.lit(max(1, 16 * tol))
    us = micros(ts)
    parts = F.array_distinct(F.array(F.floor((us - tol) / width), F.floor((us + tol) / width)))
    hit = F.struct(us.alias("right_us_"), F.col(ts).alias("matched_ts"), *take)
    rows = right.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(key, us.alias("us_"), F.explode(parts).alias("part_"), F.col(tie).alias("tie_"), hit.alias("hit_"), F.lit(0).alias("side_"))
    probes = left.select(key, us.alias("us_"), F.floor(us / width).alias("part_"), F.struct(*[F.col(c) for c in left.columns]).alias("row_"), F.lit(1).alias("side_"))
    both = rows.unionByName(probes, allowMissingColumns=True)
    seen = lambda turn: F.last("hit_", True).over(W.partitionBy(key, "part_").orderBy(*[turn(c) for c in ("us_", "side_", "tie_")]).rowsBetween(W.unboundedPreceding, 0))
    gap = lambda c: F.abs(F.col(c)["right_us_"] - F.col("us_"))
    both = both.withColumns({"before_": seen(F.asc), "after_": seen(F.desc)}).where(F.col("row_").isNotNull())
    both = both.withColumns({c: F.when(gap(c) <= tol, F.col(c)) for c in ("before_", "after_")})
    best = F.when(F.col("before_").isNull() | (gap("after_") < gap("before_")), F.col("after_")).otherwise(F.col("before_"))
    found = both.select("row_", best.alias("hit_"))
    return found.select("row_.*", F.col("hit_.matched_ts").alias("matched_ts"), *[F.col("hit_")[c].alias(c if c not in left.columns else f"{c}_r") for c in take])


def binned(start: Column, end: Column, width: int) -> Column:
    """The bins of ``width`` microseconds that [start, end] touches."""
    return F.explode(F.sequence(F.floor(micros(start) / F.lit(width)), F.floor(micros(end) / F.lit(width))))


def range_join(left: DataFrame, right: DataFrame, before: float, after: float, key: str = "symbol", ts: str = "timestamp") -> DataFrame:
    """Pairs of a left row and the right rows within [t - before, t + after], both ends closed.

    Right columns get the suffix _r; keys are of one type. Rows are dealt by parts of a key's time line, four ranges long;
    only right rows that a range of the next part reaches are dealt twice. Left rows go to the bins that their range
    touches, at most five, in the task that joins them: what is shuffled is little more than the rows.
    """
    lo, hi = _us(before), _us(after)
    width, part = F.lit(max(1, (lo + hi) // 4)), F.lit(max(1, 4 * (lo + hi)))
    # A set number of tasks: pairs, not bytes, are the work, so that none are put together.
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lambda k, p: F.pmod(F.hash(k, p), F.lit(n))
    us = micros(ts)
    own = left.withColumns({"us_": us, "part_": F.floor(us / part)}).withColumn("task_", dealt(key, "part_"))
    bins = F.sequence(F.floor((F.col("us_") - lo) / width), F.floor((F.col("us_") + hi) / width))
    own = own.repartitionById(n, "task_").withColumn("bin_", F.explode(bins))
    parts = F.array_distinct(F.array(F.floor((us - hi) / part), F.floor((us + lo) / part)))
    other = right.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    other = other.select(F.col(key).alias(f"{key}_k"), F.explode(parts).alias("part_k"), *[F.col(c).alias(f"{c}_r") for c in right.columns])
    other = other.withColumn("task_k", dealt(f"{key}_k", "part_k")).repartitionById(n, "task_k")
    other = other.withColumn("bin_k", F.floor(micros(f"{ts}_r") / width))
    on = (own["task_"] == other["task_k"]) & (own[key] == other[f"{key}_k"]) & (own["part_"] == other["part_k"]) & (own["bin_"] == other["bin_k"])
    pairs = own.join(other, on).where(micros(f"{ts}_r").between(F.col("us_") - lo, F.col("us_") + hi))
    return pairs.select(*left.columns, *[f"{c}_r" for c in right.columns if c != key])


def by_parts(left: DataFrame, right: DataFrame, before: float, after: float, walk: Callable[[pa.Table, pa.Table], pa.Table], schema: StructType, key: str = "symbol", ts: str = "timestamp") -> DataFrame:
    """``walk`` (left rows, right rows) of every part of a key's time line, as long as two ranges [t - before, t + after].

    Both sides have ``us_``, microseconds; right rows are sorted by it, and go to each part from which a range reaches
    them, two at most. No pairs are made: ``walk`` finds the ends of a range among the sorted rows.
    """
    lo, hi = _us(before), _us(after)
    width = F.lit(max(1, 2 * (lo + hi)))
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()
    own = left.withColumn("us_", micros(ts)).withColumn("part_", F.floor(F.col("us_") / width))
    near = right.where(known).withColumn("us_", micros(ts)).drop(ts)
    near = near.withColumn("part_", F.explode(F.array_distinct(F.array(F.floor((F.col("us_") - hi) / width), F.floor((F.col("us_") + lo) / width)))))
    made = lambda a, b: walk(a.drop_columns(["part_"]), b.sort_by("us_"))
    return own.groupBy(key, "part_").cogroup(near.groupBy(key, "part_")).applyInArrow(made, schema)


def ranges_of(left: pa.Table, us: np.ndarray, before: float, after: float) -> tuple[np.ndarray, np.ndarray]:
    """First and last row of the sorted times ``us`` in the closed range of each left row; the last is before the first where there is none."""
    at = left["us_"].fill_null(np.iinfo(np.int64).max // 2).to_numpy()
    return np.searchsorted(us, at - _us(before), "left"), np.searchsorted(us, at + _us(after), "right") - 1


def levels(values: np.ndarray, pick: np.ufunc, longest: int) -> list[np.ndarray]:
    """At level j the extreme (``pick``) of 2**j values from each one on, for ranges of at most ``longest`` values."""
    out = [values]
    while 2 ** len(out) <= longest:
        half = 2 ** (len(out) - 1)
        out.append(pick(out[-1][:-half], out[-1][half:]))
    return out


def extreme_of(tops: list[np.ndarray], pick: np.ufunc, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The extreme of each range of rows, none of them empty: of two runs that overlap, whatever its length."""
    out = np.empty(len(first), tops[0].dtype)
    level = np.frexp(last - first + 1)[1] - 1
    for j, top in enumerate(tops):
        m = level == j
        out[m] = pick(top[first[m]], top[last[m] - 2**j + 1])
    return out


def range_stats(left: DataFrame, right: DataFrame, before: float, after: float, left_id: str, total: str, least: str, key: str = "symbol", ts: str = "timestamp") -> DataFrame:
    """(left_id, n, total, least) of the right rows within [t - before, t + after] of each left row that has any.

    ``total`` is a sum, a difference of running ones; ``least``, a whole number, the least. A row costs the logarithm
    of the rows in its range.
    """

    def walk(mine: pa.Table, rows: pa.Table) -> pa.Table:
        first, last = ranges_of(mine, rows["us_"].to_numpy(), before, after)
        some = last >= first
        first, last = first[some], last[some]
        none = np.iinfo(np.int64).max
        x, low = rows[total].to_numpy().astype("f8"), rows[least].fill_null(none).to_numpy()
        up_to = lambda v, t: np.concatenate([np.zeros(1, t), np.cumsum(v, dtype=t)])
        within = lambda sums: sums[last + 1] - sums[first]
        sums, known = within(up_to(np.nan_to_num(x), np.longdouble)).astype("f8"), within(up_to(~np.isnan(x), "i8"))
        lows = extreme_of(levels(low, np.minimum, int((last - first + 1).max(initial=1))), np.minimum, first, last)
        return pa.table(
            {
                left_id: mine[left_id].filter(pa.array(some)),
                "n": pa.array(last - first + 1, pa.int64()),
                total: pa.array(sums, pa.float64(), mask=known == 0),
                least: pa.array(lows, pa.int64(), mask=lows == none),
            }
        )

    fields = [left.schema[left_id], StructField("n", LongType()), StructField(total, DoubleType()), StructField(least, LongType())]
    rows = right.select(key, ts, F.col(total).cast("double").alias(total), F.col(least).cast("long").alias(least))
    return by_parts(left.select(left_id, key, ts), rows, before, after, walk, StructType(fields), key, ts)


def merged_windows(events: DataFrame, before: float, after: float, key: str = "symbol", ts: str = "timestamp") -> DataFrame:
    """[t - before, t + after] of all events of a key; those that overlap or touch are one. Ends are closed."""
    gap = f"{_us(before + after) + 1} microseconds"
    sessions = events.groupBy(key, F.session_window(ts, gap)).agg(F.min(ts).alias("a"), F.max(ts).alias("b"), F.count("*").alias("n_events"))
    span = lambda s: F.make_dt_interval(secs=F.lit(s).cast("decimal(18,6)"))
    return sessions.select(key, (F.col("a") - span(before)).alias("start"), (F.col("b") + span(after)).alias("end"), "n_events")


def in_windows(rows: DataFrame, windows: DataFrame, width: float, anti: bool = False, half_open: bool = False, key: str | None = "symbol", ts: str = "timestamp") -> DataFrame:
    """Rows inside any window (``anti``: inside none) of their key; an equi join on bins of ``width`` seconds."""
    us = _us(width)
    wide = windows.withColumn("bin_", binned(F.col("start"), F.col("end"), us)).select("start", "end", "bin_", *([F.col(key).alias("key_")] if key else []))
    inside = (F.col(ts) >= F.col("start")) & ((F.col(ts) < F.col("end")) if half_open else (F.col(ts) <= F.col("end")))
    on = (F.floor(micros(ts) / F.lit(us)) == F.col("bin_")) & inside
    if key:
        on = on & (F.col(key) == F.col("key_"))
    return rows.join(wide, on, "left_anti" if anti else "left_semi")

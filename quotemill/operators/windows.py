"""Ordered features: rolling sums, medians and ranges, sign persistence, run lengths.

A window over all rows of one big symbol would be one task. ``row_chunks`` numbers a symbol's rows by parts of its
time line, cuts them into chunks of fixed length and repeats the rows that reach into the next chunk; ``time_parts``
does so for windows of time. What has no bounded reach (persistence, runs) is made within parts, and one row of each
part is handed on to the later ones.
"""

from __future__ import annotations

from heapq import heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import DoubleType, StructField, StructType

from quotemill.functions.expr import SMALL, TINY, micros
from quotemill.operators.spread import beside_keys


def numbered(df: DataFrame, order: list[str], part_seconds: int = 86400, key: str = "symbol", name: str = "row_no") -> DataFrame:
    """Rows of each ``key`` numbered from 0 in ``order`` (time first): counts of parts, then numbers within."""
    part = F.floor(F.unix_seconds(order[0]) / F.lit(part_seconds))
    marked = df.withColumn("part_", part)
    counts = marked.groupBy(key, "part_").agg(F.count("*").alias("n_"))
    before = counts.withColumn("n_", F.sum("n_").over(W.partitionBy(key).orderBy("part_")) - F.col("n_"))
    within = F.row_number().over(W.partitionBy(key, "part_").orderBy(*order)) - 1
    return marked.withColumn("in_", within).join(before, [key, "part_"]).withColumn(name, F.col("n_") + F.col("in_")).drop("part_", "n_", "in_")


def row_chunks(df: DataFrame, order: list[str], halo: int, chunk: int = 1 << 20, key: str = "symbol") -> DataFrame:
    """``df`` with row_no, chunk_ and own_: every row in its chunk, the last ``halo`` of a chunk also in the next."""
    rows = numbered(df, order, key=key)
    home = F.floor(F.col("row_no") / F.lit(chunk))
    also = F.when(F.col("row_no") % chunk >= chunk - halo, F.array(home, home + 1)).otherwise(F.array(home))
    return rows.withColumn("chunk_", F.explode(also)).withColumn("own_", F.col("chunk_") == home)


def over_rows(df: DataFrame, order: list[str], columns: dict[str, tuple[Column, int]], extremes: dict[str, tuple[str, int]] | None = None, key: str = "symbol") -> DataFrame:
    """Adds columns (aggregate, rows): the aggregate over that many rows up to and with the current one.

    Extremes (value, rows) add <name>_hi, <name>_lo and <name>_n, in a few steps for a row whatever the number of rows:
    rows are cut into blocks of that many, and the last rows are the end of one block and the start of the next, so
    that two running extremes, from the ends of both blocks, are all that is needed.
    """
    extremes = extremes or {}
    chunks = row_chunks(df, order, max(n for _, n in [*columns.values(), *extremes.values()]) - 1, key=key)
    by = W.partitionBy(key, "chunk_").orderBy("row_no")
    wide = chunks.withColumns({name: agg.over(by.rowsBetween(1 - n, 0)) for name, (agg, n) in columns.items()})
    for name, (value, n) in extremes.items():
        wide = wide.withColumn("block_", F.floor(F.col("row_no") / F.lit(n)))
        block = W.partitionBy(key, "chunk_", "block_")
        from_start, from_end = (block.orderBy(o).rowsBetween(W.unboundedPreceding, 0) for o in (F.asc("row_no"), F.desc("row_no")))
        kinds = {"hi": F.max(value), "lo": F.min(value), "n": F.count(value)}
        wide = wide.withColumns({f"{k}end_": agg.over(from_end) for k, agg in kinds.items()} | {f"{k}start_": agg.over(from_start) for k, agg in kinds.items()})
        # The window's first row, n - 1 rows ago: what its block has from there on. With it in the current block, that is the block.
        wide = wide.withColumns({f"{k}end_": F.lag(f"{k}end_", n - 1).over(by) for k in kinds})
        split = F.col("row_no") % n != n - 1
        wide = wide.withColumns(
            {
                f"{name}_hi": F.greatest("hiend_", "histart_"),
                f"{name}_lo": F.least("loend_", "lostart_"),
                f"{name}_n": F.col("nstart_") + F.when(split, F.coalesce("nend_", F.lit(0))).otherwise(0),
            }
        ).drop("block_", *[f"{k}{e}_" for k in kinds for e in ("start", "end")])
    return wide.where("own_").drop("chunk_", "own_", "row_no")


def flow_rates(wide: DataFrame, seconds: float) -> DataFrame:
    """Trade imbalance, trades and notional per second, of the rolled sums *_w of ``seconds``."""
    total = F.col("notional_buy_w") + F.col("notional_sell_w")
    return wide.withColumns(
        {
            "ti": (F.col("notional_buy_w") - F.col("notional_sell_w")) / (total + SMALL),
            "nps": F.col("ntr_w") / F.lit(float(seconds)),
            "notional_ps": total / F.lit(float(seconds)),
        }
    )


def flow_features(buckets: DataFrame, rows: int, seconds: float) -> DataFrame:
    """Flow sums over the last ``rows`` existing buckets, and their rates."""
    names = ["notional_buy", "notional_sell", "ntr"]
    return flow_rates(over_rows(buckets, ["bucket"], {f"{c}_w": (F.sum(c), rows) for c in names}), seconds)


def time_parts(df: DataFrame, halo: float, part: float, ts: str = "bucket") -> DataFrame:
    """``df`` with part_ and own_: every row in its part of ``part`` seconds, the last ``halo`` seconds also in the next."""
    width, reach = int(part * 1_000_000), int(halo * 1_000_000)
    home = F.floor(micros(ts) / F.lit(width))
    also = F.when(F.pmod(micros(ts), F.lit(width)) >= width - reach, F.array(home, home + 1)).otherwise(F.array(home))
    return df.withColumn("part_", F.explode(also)).withColumn("own_", F.col("part_") == F.floor(micros(ts) / F.lit(width)))


class SlidingMedian:
    """The median of the values of a window whose two ends only move on: two heaps, the lower and the upper half.

    Values that the window has left are dropped when they come to the top, so that a step costs the logarithm of the window.
    """

    def __init__(self) -> None:
        self.low: list[tuple[float, int]] = []  # negated values: the largest of the lower half is on top
        self.high: list[tuple[float, int]] = []
        self.n = [0, 0]
        self.side: dict[int, int] = {}

    def _top(self, side: int) -> float:
        heap = self.high if side else self.low
        while heap[0][1] not in self.side or self.side[heap[0][1]] != side:
            heappop(heap)
        return heap[0][0]

    def _move(self, side: int) -> None:
        value, i = -self._top(side), (self.high if side else self.low)[0][1]
        heappop(self.high if side else self.low)
        heappush(self.low if side else self.high, (value, i))
        self.side[i] = 1 - side
        self.n[side] -= 1
        self.n[1 - side] += 1

    def _balance(self) -> None:
        while self.n[0] > self.n[1] + 1:
            self._move(0)
        while self.n[1] > self.n[0]:
            self._move(1)

    def add(self, i: int, value: float) -> None:
        side = int(self.n[0] > 0 and value > -self._top(0))
        heappush(self.high if side else self.low, (value if side else -value, i))
        self.side[i] = side
        self.n[side] += 1
        self._balance()

    def remove(self, i: int) -> None:
        self.n[self.side.pop(i)] -= 1
        self._balance()

    def median(self) -> float | None:
        if not self.n[0]:
            return None
        return -self._top(0) if self.n[0] > self.n[1] else (self._top(1) - self._top(0)) / 2


def sliding_medians(times: list[int], values: list[float | None], reach: int) -> tuple[list[float | None], list[int]]:
    """Median and number of the known values in (t - reach, t] for each of the rising ``times``, rows of the same time included."""
    medians: list[float | None] = []
    counts: list[int] = []
    window, first, at = SlidingMedian(), 0, 0
    while at < len(times):
        now, start = times[at], at
        while at < len(times) and times[at] == now:
            if values[at] is not None:
                window.add(at, values[at])
            at += 1
        while times[first] <= now - reach:
            if values[first] is not None:
                window.remove(first)
            first += 1
        medians += [window.median()] * (at - start)
        counts += [sum(window.n)] * (at - start)
    return medians, counts


def time_medians(
    df: DataFrame, short: float, long: float, depths: dict[str, str], depth_seconds: float, least_rows: int = 10, part: float | None = None, ts: str = "bucket", key: str = "symbol"
) -> DataFrame:
    """Relative spread and thinning, from medians over time.

    ``spread_1s`` is the median of spread_bps over ``short`` seconds, ``spread_med`` its own median over ``long`` and
    ``spread_rel`` their ratio; with fewer than ``least_rows`` rows in the long frame the long median is the short one
    and the ratio 1. ``depths``: name to depth column, (median - depth) / median over ``depth_seconds``. A symbol's time
    line is cut into parts of ``part`` seconds (eight times what the windows reach back), so that none is one task; a
    part is one group, and each of its rows a few steps in two heaps.
    """
    halo = max(short + long, depth_seconds)
    rows = time_parts(df, halo, part or 8 * halo, ts).withColumn("us_", micros(ts))
    made = ["spread_1s", "med_", *[f"{n}_" for n in depths]]

    def slide(table: pa.Table) -> pa.Table:
        table = table.sort_by("us_")
        times = table["us_"].to_pylist()
        known = lambda c: [None if v is None or v != v else float(v) for v in table[c].to_pylist()]
        near, _ = sliding_medians(times, known("spread_bps"), int(short * 1_000_000))
        far, n = sliding_medians(times, near, int(long * 1_000_000))
        columns = [near, [m if k >= least_rows else None for m, k in zip(far, n, strict=True)]]
        columns += [sliding_medians(times, known(c), int(depth_seconds * 1_000_000))[0] for c in depths.values()]
        for name, values in zip(made, columns, strict=True):
            table = table.append_column(name, pa.array(values, pa.float64()))
        return table.filter(pc.field("own_")).drop_columns(["part_", "own_", "us_"])

    fields = [f for f in rows.schema.fields if f.name not in ("part_", "own_", "us_")] + [StructField(n, DoubleType()) for n in made]
    rows = rows.groupBy(key, "part_").applyInArrow(slide, StructType(fields))
    out = rows.withColumns(
        {
            "spread_med": F.coalesce("med_", "spread_1s"),
            "spread_rel": F.coalesce(F.col("spread_1s") / (F.col("med_") + TINY), F.lit(1.0)),
            **{n: (F.col(f"{n}_") - F.col(c)) / (F.col(f"{n}_") + SMALL) for n, c in depths.items()},
        }
    )
    return out.drop("med_", *[f"{n}_" for n in depths])


def range_bps(value: str, rows: int, name: str) -> Column:
    """(max - min) / value in bps over ``rows`` rows; 0 until there are that many."""
    full = (F.col(f"{name}_hi") - F.col(f"{name}_lo")) / (F.col(value) + TINY) * 1e4
    return F.when(F.col(f"{name}_n") >= rows, full).otherwise(0.0)


def _handed_on(df: DataFrame, values: dict[str, Column], key: str) -> DataFrame:
    """(key, part_, names): of each part the last known values of the parts before it; ``values`` are aggregates of a part."""
    before = W.partitionBy(key).orderBy("part_").rowsBetween(W.unboundedPreceding, -1)
    parts = df.groupBy(key, "part_").agg(*[c.alias(n) for n, c in values.items()])
    return parts.select(key, "part_", *[F.last(n, True).over(before).alias(n) for n in values])


def with_previous(df: DataFrame, values: dict[str, str], order: list[str], by: list[str] | None = None, part_seconds: int = 7 * 86400) -> DataFrame:
    """Adds name: the value of a column in the row before in ``order`` (time first), NULL in the first row of a group.

    A group is made in parts of its time line; each gets the last row of the part before it.
    """
    by = by or ["symbol"]
    rows = df.withColumn("part_", F.floor(F.unix_micros(order[0]) / F.lit(part_seconds * 1_000_000)))
    lasts = rows.groupBy(*by, "part_").agg(F.max_by(F.struct(*values.values()), F.struct(*order)).alias("row_"))
    earlier = W.partitionBy(*by).orderBy("part_")
    lasts = lasts.select(*by, "part_", F.lag("row_").over(earlier).alias("row_"))
    within = W.partitionBy(*by, "part_").orderBy(*order)
    rows = rows.withColumns({"first_": F.row_number().over(within) == 1, **{n: F.lag(c).over(within) for n, c in values.items()}})
    rows = beside_keys(rows, lasts, [*by, "part_"])
    return rows.withColumns({n: F.when(F.col("first_"), F.col("row_")[c]).otherwise(F.col(n)) for n, c in values.items()}).drop("part_", "first_", "row_")


def with_persistence(df: DataFrame, signs: dict[str, str], cap_ms: int, order: list[str], part_seconds: int = 7 * 86400, ts: str = "bucket", key: str = "symbol") -> DataFrame:
    """Adds name: milliseconds since the sign column last changed or was 0, at most ``cap_ms``; 0 in the first row.

    A symbol is made in parts of its time line, each of which gets two values for a sign from those before it.
    """
    rows = df.withColumn("part_", F.floor(F.unix_seconds(ts) / F.lit(part_seconds)))
    by, place = W.partitionBy(key, "part_").orderBy(*order), F.struct(*order)
    rows = rows.join(_handed_on(rows, {f"last_{n}": F.max_by(c, place) for n, c in signs.items()}, key), [key, "part_"])
    resets = {}
    for n, c in signs.items():
        before = F.coalesce(F.lag(c).over(by), F.col(f"last_{n}"))
        resets[f"reset_{n}"] = F.when(before.isNull() | (F.col(c) == 0) | (F.col(c) != before), micros(ts))
    rows = rows.withColumns(resets)
    rows = rows.join(_handed_on(rows, {f"since_{n}": F.max(f"reset_{n}") for n in signs}, key), [key, "part_"])
    up_to = by.rowsBetween(W.unboundedPreceding, 0)
    since = {n: F.coalesce(F.last(f"reset_{n}", True).over(up_to), F.col(f"since_{n}")) for n in signs}
    out = rows.withColumns({n: F.least((micros(ts) - s) / 1000.0, F.lit(float(cap_ms))) for n, s in since.items()})
    return out.drop("part_", *[f"{k}_{n}" for n in signs for k in ("last", "reset", "since")])


def run_lengths(df: DataFrame, flag: str, order: list[str], part_seconds: int = 7 * 86400, key: str = "symbol") -> DataFrame:
    """Runs of rows with ``flag``: key, first and last order value, number of rows. Parts are given the breaks before them."""
    rows = df.withColumn("part_", F.floor(F.unix_seconds(order[0]) / F.lit(part_seconds)))
    breaks = (~F.col(flag)).cast("int")
    parts = rows.groupBy(key, "part_").agg(F.sum(breaks).alias("n_"))
    before = F.coalesce(F.sum("n_").over(W.partitionBy(key).orderBy("part_").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = rows.join(parts.select(key, "part_", before.alias("before_")), [key, "part_"])
    within = W.partitionBy(key, "part_").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("island_", F.col("before_") + F.sum(breaks).over(within))
    runs = rows.where(flag).groupBy(key, "island_")
    return runs.agg(F.min(order[0]).alias("first"), F.max(order[0]).alias("last"), F.count("*").alias("n")).drop("island_")

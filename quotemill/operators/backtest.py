"""Labels and backtests: T-horizon profit, gates and exits, path labels, configurations, routing."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from quotemill.functions.expr import TINY, exit_pnl, mid
from quotemill.operators.spread import exact_percentiles, stats_by
from quotemill.operators.timejoins import asof, asof_nearest, by_parts, extreme_of, levels, ranges_of

HORIZONS = (30, 45, 60, 120, 180)


def horizon_pnl(events: DataFrame, book: DataFrame, horizons: tuple[int, ...] = HORIZONS, unit: float = 60.0, tolerance: float = 1800.0) -> DataFrame:
    """Events with ``raw_<T>``: (exit mid / entry mid - 1) in bps, T units after the event; NULL if a leg is missing.

    All legs are one as-of join: the entry (T = 0) and the exits are rows of one probe table. The direction is left
    out, so that configurations that trade either way share the join. Results are as many as events: neither is broadcast.
    """
    legs = events.select("event_id", "symbol", "timestamp", F.explode(F.array(*[F.lit(t) for t in (0, *horizons)])).alias("T"))
    legs = legs.withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(secs=(F.col("T") * unit).cast("decimal(18,6)")))
    prices = book.select("symbol", "timestamp", "seq", mid().alias("mid"))
    hits = asof_nearest(legs, prices, ["mid"], tolerance, ["event_id", "T"], "seq")
    wide = hits.groupBy("event_id").agg(*[F.max(F.when(F.col("T") == t, F.when(F.col("mid") > 0, F.col("mid")))).alias(f"mid_{t}") for t in (0, *horizons)])
    raws = [((F.col(f"mid_{t}") / F.col("mid_0") - 1) * 1e4).alias(f"raw_{t}") for t in horizons]
    return events.join(wide.select("event_id", F.col("mid_0").alias("entry"), *raws).hint("merge"), "event_id", "left")


def net_pnl(T: int, direction: Column) -> Column:
    """Net bps of a horizon: direction times the raw return, less fees and slippage; NULL without a direction."""
    cost = F.col("fees_rt_bps").cast("double") + F.col("slip_bps").cast("double")
    return F.when(direction != 0, direction * F.col(f"raw_{T}") - cost)


@dataclass(frozen=True)
class Config:
    name: str
    mode: str  # BO with the signal, MR against it
    gate: str  # T45>0, T60>0 or none
    early: int
    late: int
    runaway_min: float = -15.0
    runaway: int = 30


def config_table(spark, configs: list[Config]) -> DataFrame:
    rows = [(c.name, c.mode, c.gate, c.early, c.late, float(c.runaway_min)) for c in configs]
    return spark.createDataFrame(rows, "config string, mode string, gate string, early int, late int, runaway_min double")


def needed_horizons(configs: DataFrame) -> DataFrame:
    """(config, T) of every horizon a configuration looks at, and those all must have."""
    gate = F.when(F.col("gate") == "T45>0", 45).when(F.col("gate") == "T60>0", 60)
    own = F.array(F.lit(30), F.col("early"), F.col("late"), gate)
    every = F.array_compact(F.concat(own, F.array(*map(F.lit, HORIZONS))))
    return configs.select("config", F.explode(F.array_sort(F.array_distinct(every))).alias("T"))


def evaluated(pnl: DataFrame, configs: DataFrame) -> DataFrame:
    """One row for each event and configuration: legs, whether it is kept, and the net result.

    Kept: every horizon is known, the runaway leg is above its limit, and the gate's leg is positive. The
    configurations are rows of a table of a few, beside every event.
    """
    both = pnl.crossJoin(F.broadcast(configs))
    direction = F.when(F.col("mode") == "BO", F.col("dir0")).otherwise(-F.col("dir0"))
    both = both.withColumns({f"pnl_{t}": net_pnl(t, direction) for t in HORIZONS})
    leg = lambda c: F.coalesce(*[F.when(F.col(c) == t, F.col(f"pnl_{t}")) for t in HORIZONS])
    known = F.lit(True)
    for t in HORIZONS:
        known = known & F.col(f"pnl_{t}").isNotNull()
    gate = F.when(F.col("gate") == "T45>0", F.col("pnl_45") > 0).when(F.col("gate") == "T60>0", F.col("pnl_60") > 0).otherwise(True)
    calm = F.col("pnl_30") > F.col("runaway_min")
    flags = {"known": known, "calm": F.coalesce(calm, F.lit(False)), "gated": F.coalesce(gate, F.lit(False))}
    out = both.withColumns(flags)
    out = out.withColumn("kept", F.col("known") & F.col("calm") & F.col("gated"))
    return out.withColumn("pnl_net_bps", F.when(F.col("kept"), exit_pnl(leg("early"), leg("late"))))


def config_stats(trades: DataFrame, by: list[str]) -> DataFrame:
    """Counts of each drop and of known legs, and n, mean and percentiles of the kept results."""
    counts = [
        F.count("*").alias("n_events"),
        *[F.count(f"pnl_{t}").alias(f"ok_{t}") for t in HORIZONS],
        F.count_if(~F.col("known")).alias("drop_unknown"),
        F.count_if(F.col("known") & ~F.col("calm")).alias("drop_runaway"),
        F.count_if(F.col("known") & F.col("calm") & ~F.col("gated")).alias("drop_gate"),
        F.count("pnl_net_bps").alias("n"),
        F.avg("pnl_net_bps").alias("ev"),
    ]
    used = [*by, *[f"pnl_{t}" for t in HORIZONS], "known", "calm", "gated", "pnl_net_bps"]
    return stats_by(trades.select(*used), by, counts, {f"p{q:02d}": ("pnl_net_bps", q / 100) for q in (5, 50, 95)})


def monthly_pivot(stats: DataFrame, months: list[str]) -> DataFrame:
    """Mean by configuration and month, one column for each month."""
    return stats.groupBy("config").pivot("month", months).agg(F.avg("ev"))


def stability(stats: DataFrame) -> DataFrame:
    """Mean, deviation and share of positive months of each configuration."""
    return stats.groupBy("config").agg(
        F.avg("ev").alias("mean_ev"),
        F.stddev_samp("ev").alias("std_ev"),
        F.count_if(F.col("ev") > 0).alias("pos_months"),
        F.count("ev").alias("n_months"),
        F.try_divide(F.count_if(F.col("ev") > 0), F.count("ev")).alias("pos_rate"),
    )


def router_pick(trades: DataFrame, middle: str = "b2") -> DataFrame:
    """The rows whose configuration is the one of their bucket: MR in the middle, BO elsewhere."""
    return trades.where(F.col("router_pick") == F.when(F.col("vol_bucket") == middle, "MR").otherwise("BO"))


def atr_bps(candles: DataFrame, n: int, key: str = "symbol") -> DataFrame:
    """Average true range of the last ``n`` bars in bps of the close; NULL until there are n true ranges.

    The first bar has no previous close and so no true range.
    """
    by = W.partitionBy(key).orderBy("timestamp")
    before = F.lag("close").over(by)
    tr = F.when(before.isNotNull(), F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before)))
    rows = candles.withColumn("tr", tr)
    last = by.rowsBetween(1 - n, 0)
    atr = F.when(F.count("tr").over(last) == n, F.avg("tr").over(last))
    return rows.withColumn("atr_bps", atr / F.col("close") * 1e4)


def path_labels(candidates: DataFrame, book: DataFrame, horizon: float, target: float, wide_spread: float | None = None, block_rows: int = 256) -> DataFrame:
    """What comes first on a candidate's path: the net target, or a spread expansion that goes on.

    Long: (bid - entry ask) / entry ask; short: (entry bid - ask) / entry bid; net of fees and slippage. An expansion
    is a spread of at least max(p99, median + 5 MAD) of the book (``wide_spread`` fixes it), confirmed if the raw
    result two rows later (the last row, if the path ends) is higher. A tie is the target's. Candidates without a
    path, or without a direction, have reason 'none' and NULL times.

    Candidates and book meet in parts of the time line, where a path is the rows between two row numbers. Its extremes
    are those of two runs of 2**j rows, and its first hit is found by leaving out runs that don't reach the target: a
    candidate costs the logarithm of its path. ``block_rows`` * 4096 candidates are looked at together.
    """
    if wide_spread is None:
        spreads = book.select(((F.col("ask_0_price") - F.col("bid_0_price")) / (mid() + TINY) * 1e4).alias("s"))
        m = exact_percentiles(spreads, {"m": ("s", 0.5), "p99": ("s", 0.99)})
        off = spreads.crossJoin(F.broadcast(m)).select(F.abs(F.col("s") - F.col("m")).alias("off"))
        mad = exact_percentiles(off, {"mad": ("off", 0.5)})
        limit = m.crossJoin(mad).select(F.greatest("p99", F.col("m") + 5 * F.col("mad")).alias("limit"))
    else:
        limit = book.sparkSession.range(1).select(F.lit(float(wide_spread)).alias("limit"))
    spread = (F.col("ask") - F.col("bid")) / ((F.col("ask") + F.col("bid")) / 2 + TINY) * 1e4
    rows = book.select("symbol", "timestamp", "seq", *[F.col(f"{s}_0_price").cast("double").alias(s) for s in ("bid", "ask")])
    rows = rows.crossJoin(F.broadcast(limit)).withColumn("wide", F.coalesce(spread >= F.col("limit"), F.lit(False))).drop("limit")
    cost = {"side_": F.coalesce(F.signum(F.col("dir0")), F.lit(0.0)), **{f"{c}_": F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in ("fees_rt_bps", "slip_bps")}}
    made = [StructField(c, t) for c, t in _PATH.items()]
    walk = _path_walk(horizon, target, block_rows * 4096)
    return by_parts(candidates.withColumns(cost), rows, 0.0, horizon, walk, StructType([*candidates.schema.fields, *made]))


_PATH = {
    **{c: DoubleType() for c in ("raw_max", "raw_min", "net_max", "net_min")},
    **{c: LongType() for c in ("us_hit", "us_wide")},
    "label": IntegerType(), "reason": StringType(), "seconds": DoubleType(),
}


def _path_walk(horizon: float, target: float, at_once: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """What ``path_labels`` adds to the candidates of a part of the time line."""

    def walk(mine: pa.Table, book: pa.Table) -> pa.Table:
        book = book.sort_by([("us_", "ascending"), ("seq", "ascending")])
        price = {c: book[c].to_numpy() for c in ("us_", "bid", "ask", "wide")}
        us, wide_rows = price["us_"], np.flatnonzero(price["wide"])
        first, last = ranges_of(mine, us, 0.0, horizon)
        side, fees, slip = (mine[c].to_numpy() for c in ("side_", "fees_rt_bps_", "slip_bps_"))
        on = first <= last
        longest = int((last - first + 1)[on].max(initial=1))
        high, low = (np.full(len(side), np.nan) for _ in range(2))
        us_hit, us_wide = (np.full(len(side), -1, "i8") for _ in range(2))
        hits, widens = (np.zeros(len(side), bool) for _ in range(2))
        for way, c, entry_of, best, worst in ((1, "bid", "ask", np.fmax, np.fmin), (-1, "ask", "bid", np.fmin, np.fmax)):
            own = np.flatnonzero(on & (side == way))
            if not len(own):
                continue
            tops, bottoms = levels(price[c], best, longest), levels(price[c], worst, longest)
            for own in np.split(own, range(at_once, len(own), at_once)):
                a, b = first[own], last[own]
                entry = price[entry_of][a]
                raw = lambda x, e: (x - e) / e * 1e4 if way > 0 else (e - x) / e * 1e4  # noqa: B023, E731
                high[own], low[own] = raw(extreme_of(tops, best, a, b), entry), raw(extreme_of(bottoms, worst, a, b), entry)
                k = a.copy()
                for j in reversed(range(len(tops))):
                    at = np.flatnonzero(k + 2**j - 1 <= b)
                    net = raw(tops[j][k[at]], entry[at]) - fees[own[at]] - slip[own[at]]
                    k[at[~(net >= target)]] += 2**j
                hit = k <= b
                w = np.append(wide_rows, len(us))[np.searchsorted(wide_rows, a)]
                seen = np.flatnonzero(w <= b)
                later = np.minimum(w[seen] + 2, b[seen])
                seen = seen[raw(price[c][later], entry[seen]) > raw(price[c][w[seen]], entry[seen])]
                hits[own], widens[own[seen]] = hit, True
                us_hit[own[hit]], us_wide[own[seen]] = us[k[hit]], us[w[seen]]
                # A tie of rows, not of times, is the target's.
                late = seen[hit[seen] & (w[seen] < k[seen])]
                hits[own[late]] = False
        reason = np.where(hits, "pnl_net", np.where(widens, "spread", "none"))
        net_max, net_min = high - fees - slip, low - fees - slip
        seconds = (np.where(hits, us_hit, us_wide) - mine["us_"].fill_null(0).to_numpy()) / 1e6
        known = lambda v: pa.array(v, pa.float64(), mask=np.isnan(v))
        values = [known(high), known(low), known(net_max), known(net_min), *[pa.array(v, pa.int64(), mask=v == -1) for v in (us_hit, us_wide)]]
        values += [pa.array((net_max >= target).astype("i4")), pa.array(reason.tolist(), pa.string()), pa.array(seconds, pa.float64(), mask=reason == "none")]
        out = mine.drop_columns(["side_", "fees_rt_bps_", "slip_bps_", "us_"])
        for name, v in zip(_PATH, values, strict=True):
            out = out.append_column(name, v)
        return out

    return walk


def with_volatility(trades: DataFrame, candles: DataFrame, bar_seconds: int, n: int, label: str = "right") -> DataFrame:
    """Trades with the ATR of the last bar at or before them; trades before the first known ATR are dropped.

    ``label`` right: a bar counts from its end on, so that no trade sees a bar still in progress.
    """
    from quotemill.operators.bucketing import resample

    bars = atr_bps(resample(candles, bar_seconds), n)
    if label == "right":
        bars = bars.withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(secs=F.lit(bar_seconds)))
    bars = bars.withColumn("t_atr_bar", F.col("timestamp"))
    return asof(trades, bars, ["atr_bps", "t_atr_bar"], ["timestamp"]).where("atr_bps is not null")

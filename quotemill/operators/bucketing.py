"""Time buckets: last snapshots, trade flow, candles of several lengths, aligned windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quotemill.functions.expr import floor_time
from quotemill.operators.timejoins import asof
from quotemill.operators.windows import row_chunks


def right_edge(ts: Column | str, step: str) -> Column:
    """The end of the half-open bucket of ``ts``: a tick on an edge belongs to the next bucket."""
    return F.window(ts, step)["end"]


def last_snapshots(book: DataFrame, step: str, tie: tuple[str, ...] = ("timestamp", "seq"), bid="bid_0_price", ask="ask_0_price") -> DataFrame:
    """The last row of each (symbol, bucket), dropped if its bid or ask is missing or not positive.

    The check comes after the choice: an invalid last row isn't replaced by an earlier one.
    """
    rows = F.struct(*[c for c in book.columns if c != "symbol"])
    last = book.groupBy("symbol", right_edge("timestamp", step).alias("bucket")).agg(F.max_by(rows, F.struct(*tie)).alias("r"))
    return last.select("symbol", "bucket", "r.*").where(valid_top(bid, ask))


def valid_top(bid: str = "bid_0_price", ask: str = "ask_0_price") -> Column:
    """Both prices are known, finite and positive."""
    valid = lambda c: F.coalesce((F.col(c) > 0) & (F.col(c) < float("inf")) & ~F.isnan(c), F.lit(False))
    return valid(bid) & valid(ask)


def trade_flow(trades: DataFrame, step: str) -> DataFrame:
    """Notional and quantity by aggressor, and the number of trades, of each (symbol, bucket)."""
    return trades.groupBy("symbol", right_edge("timestamp", step).alias("bucket")).agg(*flow_sums())


def flow_sums(is_trade: Column | None = None) -> list[Column]:
    """The aggregates of ``trade_flow``; ``is_trade`` tells its rows from others."""
    buy, notional = F.col("is_aggr_buy"), F.col("price") * F.col("qty")
    split = lambda x, is_buy: F.sum(F.when(buy == is_buy, x).otherwise(0.0))
    return [
        split(notional, True).alias("notional_buy"),
        split(notional, False).alias("notional_sell"),
        split(F.col("qty"), True).alias("qty_buy"),
        split(F.col("qty"), False).alias("qty_sell"),
        (F.count("*") if is_trade is None else F.count_if(is_trade)).alias("ntr"),
    ]


FLOW = ["notional_buy", "notional_sell", "qty_buy", "qty_sell", "ntr"]


def with_flow(book: DataFrame, flow: DataFrame) -> DataFrame:
    """Book buckets with their trade flow; buckets without trades have flow 0."""
    joined = book.join(flow, ["symbol", "bucket"], "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in FLOW})


def _candle_aggregates(order: str = "timestamp") -> list[Column]:
    return [
        F.min_by("open", order).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", order).alias("close"),
        F.sum("volume").alias("volume"),
    ]


def resample(candles: DataFrame, seconds: int, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Candles of ``seconds``, labelled by their start; empty ones don't exist."""
    slot = floor_time("timestamp", seconds).alias("bar")
    return candles.groupBy(*keys, slot).agg(*_candle_aggregates()).withColumnRenamed("bar", "timestamp")


def resample_many(candles: DataFrame, seconds: list[int]) -> DataFrame:
    """Candles of several lengths (column ``tf``, in seconds) in one pass and one shuffle."""
    lengths = candles.withColumn("tf", F.explode(F.array(*[F.lit(s) for s in seconds])))
    slot = F.timestamp_seconds(F.floor(F.unix_seconds("timestamp") / F.col("tf")) * F.col("tf")).alias("bar")
    return lengths.groupBy("symbol", "tf", slot).agg(*_candle_aggregates()).withColumnRenamed("bar", "timestamp")


def aligned_windows(candles: DataFrame, tf_bars: dict[int, int], step: int, warmup: int = 0, closed_only: bool = False) -> DataFrame:
    """At each step, the last bars of every length; only where each length has warmup + bars of them.

    A bar counts if it started by the step (with ``closed_only``: ended by it). Columns: symbol, step_ts and an
    array ``bars_<tf>`` of structs, oldest first.

    Bars are numbered by parts of the time line and listed in chunks that repeat the last bars of the one before; a step
    finds the number of its last bar by an as-of join. No symbol is one task.
    """
    many = resample_many(candles, list(tf_bars))
    steps = candles.select("symbol", floor_time("timestamp", step).alias("step_ts")).distinct()
    out = steps
    for tf, n in tf_bars.items():
        bars = row_chunks(many.where(F.col("tf") == tf).drop("tf"), ["timestamp"], n - 1)
        back = W.partitionBy("symbol", "chunk_").orderBy("row_no").rowsBetween(1 - n, 0)
        bar = F.struct("timestamp", "open", "high", "low", "close", "volume")
        name = f"bars_{tf}"
        lists = bars.withColumn(name, F.collect_list(bar).over(back)).where(F.col("own_") & (F.col("row_no") >= warmup + n - 1))
        ready = F.col("timestamp") + F.make_dt_interval(secs=F.lit(tf if closed_only else 0))
        last = asof(steps, lists.select("symbol", ready.alias("step_ts"), "row_no"), ["row_no"], ["row_no"], part_seconds=7 * 86400, ts="step_ts")
        found = last.where("row_no is not null").join(lists.select("symbol", "row_no", name), ["symbol", "row_no"])
        out = out.join(found.drop("row_no"), ["symbol", "step_ts"])
    return out


def gap_ratio(ticks: DataFrame, value: str, keys: tuple[str, ...] = ("symbol",), seconds: int = 1) -> DataFrame:
    """Share of the slots between first and last tick that have no known value; no dense grid is made."""
    slot = F.floor(F.unix_seconds("timestamp") / F.lit(seconds))
    span = F.max(slot) - F.min(slot) + 1
    filled = F.count_distinct(F.when(F.col(value).isNotNull(), slot))
    return ticks.groupBy(*keys).agg((1 - filled / span).alias("gap_ratio"), span.alias("slots"))

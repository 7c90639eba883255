"""Streaming forms of buckets, features, tags and the drawdown governor; batch and stream share the expressions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quotemill.operators.bucketing import flow_sums, valid_top
from quotemill.operators.windows import sliding_medians

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_buckets(ticks: DataFrame, step: str, lateness: str) -> DataFrame:
    """Last price, flow by aggressor and trades of each (symbol, bucket); a bucket comes out once, when it is closed.

    ``ticks``: symbol, timestamp, trade_id, price, qty, is_aggr_buy. Ticks later than ``lateness`` are dropped.
    """
    out = ticks.withWatermark("timestamp", lateness).groupBy("symbol", F.window("timestamp", step).alias("w"))
    out = out.agg(F.max_by("price", F.struct("timestamp", "trade_id")).alias("last_price"), *flow_sums())
    return out.select("symbol", F.col("w.end").alias("bucket"), "last_price", "notional_buy", "notional_sell", "ntr")


def stream_book_buckets(book: DataFrame, trades: DataFrame, step: str, lateness: str) -> DataFrame:
    """Closed buckets of book and trade streams: the last snapshot, dropped if invalid, with its flow (0 without trades).

    Both streams are one, and a bucket of it is both sides of the join: one watermark and one state for a bucket
    instead of two aggregations and a join of streams, and a bucket without trades comes out as early as any other.
    """
    snapshot = F.struct(*[c for c in book.columns if c != "symbol"]).alias("snapshot")
    one = book.select("symbol", "timestamp", snapshot, *[F.lit(None).cast(t).alias(c) for c, t in _TRADE.items()])
    two = trades.select("symbol", "timestamp", F.lit(None).cast(one.schema["snapshot"].dataType).alias("snapshot"), *[F.col(c).cast(t).alias(c) for c, t in _TRADE.items()])
    both = one.union(two).withWatermark("timestamp", lateness).groupBy("symbol", F.window("timestamp", step).alias("w"))
    place = F.when(F.col("snapshot").isNotNull(), F.struct("snapshot.timestamp", "snapshot.seq"))
    out = both.agg(F.max_by("snapshot", place).alias("r"), *flow_sums(F.col("qty").isNotNull()))
    flow = [F.coalesce(c, F.lit(0)).alias(c) for c in ("notional_buy", "notional_sell", "qty_buy", "qty_sell", "ntr")]
    return out.where("r is not null").select("symbol", F.col("w.end").alias("bucket"), "r.*", *flow).where(valid_top())


_TRADE = {"price": "double", "qty": "double", "is_aggr_buy": "boolean"}


@dataclass(frozen=True)
class Reach:
    """How far the live features look back, in rows and seconds."""

    flow_rows: int
    flow_seconds: float
    range_rows: int
    long_range_rows: int
    spread_short: float
    spread_long: float
    thin_seconds: float
    persist_cap_ms: int
    least_rows: int = 10


_HELD = "us long, mid double, notional_buy double, notional_sell double, ntr long, spread_bps double, spread_1s double, opp3 double, opp10 double"
LIVE_FEATURES = (
    "symbol string, bucket timestamp, notional_buy_w double, notional_sell_w double, ti double, nps double, dir0 double, "
    "range60_bps double, range600_bps double, spread_rel double, thin3 double, thin10 double, persist_micro_ms double, persist_obi_ms double, "
    "spread_bps double, spread_ticks double, micro_bias double, obi10 double"
)


class RollingFeatures(StatefulProcessor):
    """The features of a symbol's closed buckets, from a bounded state: the last rows that a window can still reach.

    Buckets come in the order of time, as a stream of closed buckets gives them.
    """

    def __init__(self, reach: Reach):
        self.reach = reach

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getListState("held", _HELD)
        self.since = handle.getValueState("since", "micro double, micro_us long, obi double, obi_us long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        c = self.reach
        new = pd.concat(list(rows)).sort_values("us")
        names = [x.strip().split(" ")[0] for x in _HELD.split(",")]
        past = pd.DataFrame([tuple(r) for r in self.held.get()], columns=names)
        n, k = len(past), len(new)
        times = [*past["us"].astype(int), *new["us"].astype(int)]
        of = lambda name: [*past[name], *new[name]]
        known = lambda values: [None if v is None or v != v else float(v) for v in values]

        mids, flow = of("mid"), {x: of(x) for x in ("notional_buy", "notional_sell", "ntr")}
        last = lambda values, i, rows: values[max(0, i - rows + 1) : i + 1]
        out = {x: [] for x in ("notional_buy_w", "notional_sell_w", "ti", "nps", "dir0", "range60_bps", "range600_bps")}
        opp = {3: list(past["opp3"]), 10: list(past["opp10"])}
        sign = lambda x: 0.0 if x is None or x != x else float((x > 0) - (x < 0))
        for i, row in zip(range(n, n + k), new.itertuples(index=False), strict=True):
            buy, sell, ntr = (sum(last(flow[x], i, c.flow_rows)) for x in ("notional_buy", "notional_sell", "ntr"))
            ti = (buy - sell) / (buy + sell + 1e-9)
            direction = sign(ti + 0.5 * sign(row.micro_bias))
            for name, value in zip(out, (buy, sell, ti, ntr / c.flow_seconds, direction), strict=False):
                out[name].append(value)
            for name, rows_ in (("range60_bps", c.range_rows), ("range600_bps", c.long_range_rows)):
                w = last(mids, i, rows_)
                out[name].append((max(w) - min(w)) / (mids[i] + 1e-12) * 1e4 if len(w) == rows_ else 0.0)
            for level in opp:
                opp[level].append(getattr(row, f"da{level}") if direction > 0 else getattr(row, f"db{level}"))

        micros = lambda seconds: int(seconds * 1_000_000)
        near = [*known(past["spread_1s"]), *sliding_medians(times, known(of("spread_bps")), micros(c.spread_short))[0][n:]]
        far, count = sliding_medians(times, near, micros(c.spread_long))
        out["spread_rel"] = [a / (m + 1e-12) if q >= c.least_rows and a is not None else 1.0 for a, m, q in list(zip(near, far, count, strict=True))[n:]]
        for level, name in ((3, "thin3"), (10, "thin10")):
            med = sliding_medians(times, known(opp[level]), micros(c.thin_seconds))[0]
            out[name] = [(m - x) / (m + 1e-9) for m, x in list(zip(med, opp[level], strict=True))[n:]]

        kept = self.since.get() or (None, None, None, None)
        state = {"micro": [kept[0], kept[1]], "obi": [kept[2], kept[3]]}
        for name, column in (("micro", "micro_bias"), ("obi", "obi10")):
            ages = []
            for us, value in zip(new["us"], new[column], strict=True):
                now, (before, start) = sign(value), state[name]
                start = us if before is None or now == 0 or now != before else start
                state[name] = [now, start]
                ages.append(min((us - start) / 1000.0, float(c.persist_cap_ms)))
            out[f"persist_{name}_ms"] = ages
        self.since.update((state["micro"][0], int(state["micro"][1]), state["obi"][0], int(state["obi"][1])))

        first = min(len(times) - max(c.long_range_rows, c.flow_rows) + 1, next(i for i, t in enumerate(times) if t > times[-1] - micros(max(c.spread_short, c.spread_long, c.thin_seconds))))
        columns = [times, mids, *flow.values(), of("spread_bps"), near, opp[3], opp[10]]
        cell = lambda v, whole: None if v is None or v != v else int(v) if whole else float(v)
        self.held.put([tuple(cell(v[i], j in (0, 4)) for j, v in enumerate(columns)) for i in range(max(0, first), len(times))])

        same = new[["bucket", "spread_bps", "spread_ticks", "micro_bias", "obi10"]].reset_index(drop=True)
        result = pd.concat([same, pd.DataFrame(out)], axis=1).assign(symbol=key[0])
        yield result[[x.strip().split(" ")[0] for x in LIVE_FEATURES.split(",")]]

    def close(self) -> None:
        pass


def stream_features(buckets: DataFrame, reach: Reach) -> DataFrame:
    """Features of the funnel for a stream of closed buckets (symbol, bucket, us, mid, notional_buy, notional_sell, ntr,
    spread_bps, spread_ticks, micro_bias, obi10, da3, db3, da10, db10). Needs the RocksDB state store."""
    return buckets.groupBy("symbol").transformWithStateInPandas(RollingFeatures(reach), LIVE_FEATURES, "Append", "None")


def stream_scored(features: DataFrame, fitted: DataFrame, conditions: list[Column], score: Column) -> DataFrame:
    """Features beside the one frozen row of thresholds: pass flag and score, without state."""
    ok = F.lit(True)
    for c in conditions:
        ok = ok & F.coalesce(c, F.lit(False))
    return features.crossJoin(F.broadcast(fitted)).withColumn("pass_all", ok).withColumn("live_score", F.when(F.col("pass_all"), score))


class Governor(StatefulProcessor):
    """State of a day: its trades until the watermark passes the day's end. A timer folds them in order and frees the state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.trades = handle.getListState("trades", "us long, event_id long, pnl double, z double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows))
        self.trades.appendList([(int(r.us), int(r.event_id), float(r.pnl), float(r.z)) for r in batch.itertuples(index=False)])
        self.handle.registerTimer(int(batch["day_end_ms"].iloc[0]))
        yield pd.DataFrame(columns=["day", "event_id", "size_used", "before"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        total, out = 0.0, []
        for _, event_id, pnl, z in sorted(self.trades.get()):
            m = 1.0 if total >= 0 else 0.9 if total > -5 else 0.75 if total > -10 else 0.5
            out.append((key[0], event_id, z * m, total))
            total += pnl * z * m
        self.trades.clear()
        yield pd.DataFrame(out, columns=["day", "event_id", "size_used", "before"])

    def close(self) -> None:
        pass


def stream_governor(trades: DataFrame, lateness: str) -> DataFrame:
    """(day, event_id, size_used, before) of trades (day, event_id, timestamp, pnl, z) in any order within ``lateness``.

    A day comes out once, folded in the order of time, when the watermark has passed its end.
    Needs the RocksDB state store: spark.sql.streaming.stateStore.providerClass.
    """
    end = (F.unix_seconds("day") + 86400) * 1000
    rows = trades.withWatermark("timestamp", lateness).withColumns({"us": F.unix_micros("timestamp"), "day_end_ms": end})
    return rows.groupBy("day").transformWithStateInPandas(Governor(), "day timestamp, event_id long, size_used double, before double", "Append", "EventTime")


def run_to_end(out: DataFrame, name: str, checkpoint: str) -> DataFrame:
    """All that a stream over files gives until its input is used up."""
    query = out.writeStream.format("parquet").option("path", f"{checkpoint}/{name}-out").option("checkpointLocation", f"{checkpoint}/{name}-state").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return out.sparkSession.read.schema(out.schema).parquet(f"{checkpoint}/{name}-out")


def run_with_state(out: DataFrame, name: str, checkpoint: str) -> DataFrame:
    """``run_to_end`` on the state store that processors need; the session's own is put back."""
    spark, key = out.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)
    try:
        return run_to_end(out, name, checkpoint)
    finally:
        spark.conf.set(key, before)


__all__ = ["Governor", "Reach", "RollingFeatures", "run_to_end", "run_with_state", "stream_book_buckets", "stream_buckets", "stream_features", "stream_governor", "stream_scored"]

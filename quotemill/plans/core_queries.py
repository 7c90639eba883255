"""Queries of buckets, features, thresholds and the funnel (T, P, W, A03-A06, F01-F06)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quotemill.functions import expr as x
from quotemill.operators import bucketing as b
from quotemill.operators import funnel as fn
from quotemill.operators import thresholds as th
from quotemill.operators import windows as w
from quotemill.plans.registry import query, r, rounded, us
from quotemill.plans.stage0 import FEATURES_SQL, FITTED_SQL, TAGS_SQL, is_train, tape_features
from quotemill.sources.scratch import kept, stored, working_tables
from quotemill.sources.views import tape, view

HOUR = "1 hour"


@query("T01_right_edge", "select event_id, epoch_us(date_trunc('hour', ts) + interval 1 hour) as bucket from tape")
def right_edge(spark, sf):
    t = tape(spark, sf)
    return us(t.select("event_id", b.right_edge("ts", HOUR).alias("bucket")), "bucket")


@query("T02_last_snapshot", f"with {FEATURES_SQL} select symbol, epoch_us(bucket) as bucket, seq, round(bid_0_price, 6) as bid, round(ask_0_price, 6) as ask from joined")
def last_snapshot(spark, sf):
    out = b.last_snapshots(view(spark, sf, "book_v"), HOUR)
    return us(out.select("symbol", "bucket", "seq", r("bid_0_price").alias("bid"), r("ask_0_price").alias("ask")), "bucket")


@query("T03_trade_flow", f"with {FEATURES_SQL} select symbol, epoch_us(bucket) as bucket, round(notional_buy, 6) as notional_buy, round(notional_sell, 6) as notional_sell, qty_buy, qty_sell, ntr from flow")
def trade_flow(spark, sf):
    return us(rounded(b.trade_flow(view(spark, sf, "trades_v"), HOUR)), "bucket")


@query("T04_book_with_flow", f"with {FEATURES_SQL} select symbol, epoch_us(bucket) as bucket, seq, round(notional_buy, 6) as notional_buy, round(notional_sell, 6) as notional_sell, ntr from joined")
def book_with_flow(spark, sf):
    out = b.with_flow(b.last_snapshots(view(spark, sf, "book_v"), HOUR), b.trade_flow(view(spark, sf, "trades_v"), HOUR))
    return us(rounded(out.select("symbol", "bucket", "seq", "notional_buy", "notional_sell", "ntr")), "bucket")


_BARS = "min_by(open, timestamp) as open, max(high) as high, min(low) as low, max_by(close, timestamp) as close, sum(volume) as volume"


@query("T05_resample", f"select symbol, (epoch_us(timestamp) // 14400000000) * 14400000000 as timestamp, {_BARS} from candles_v group by 1, 2")
def resample(spark, sf):
    return us(b.resample(view(spark, sf, "candles_v"), 4 * 3600), "timestamp")


@query("T06_resample_many", f"select symbol, tf, (epoch_us(timestamp) // (tf * 1000000)) * (tf * 1000000) as timestamp, {_BARS} from candles_v cross join (values (7200::bigint), (14400), (86400)) v(tf) group by 1, 2, 3")
def resample_many(spark, sf):
    return us(b.resample_many(view(spark, sf, "candles_v"), [7200, 14400, 86400]), "timestamp")


@query(
    "T07_aligned_windows",
    f"""with bars as (
      select symbol, tf, (epoch_us(timestamp) // (tf * 1000000)) * (tf * 1000000) as bar, {_BARS}
      from candles_v cross join (values (7200::bigint), (14400)) v(tf) group by 1, 2, 3),
    steps as (select distinct symbol, (epoch_us(timestamp) // 14400000000) * 14400000000 as step_ts from candles_v),
    seen as (
      select s.symbol, s.step_ts, tf, close, bar, row_number() over (partition by s.symbol, s.step_ts, tf order by bar desc) as k,
             count(*) over (partition by s.symbol, s.step_ts, tf) as n
      from steps s join bars b on b.symbol = s.symbol and b.bar <= s.step_ts)
    select symbol, step_ts, round(sum(close) filter (where tf = 7200 and k <= 4), 6) as sum_short, round(sum(close) filter (where tf = 14400 and k <= 3), 6) as sum_long
    from seen group by symbol, step_ts
    having max(n) filter (where tf = 7200) >= 6 and max(n) filter (where tf = 14400) >= 5""",
)
def aligned_windows(spark, sf):
    out = b.aligned_windows(view(spark, sf, "candles_v"), {7200: 4, 14400: 3}, 14400, warmup=2)
    total = lambda c: r(F.aggregate(F.transform(c, lambda s: s["close"]), F.lit(0.0), lambda a, v: a + v))
    return us(out.select("symbol", "step_ts", total("bars_7200").alias("sum_short"), total("bars_14400").alias("sum_long")), "step_ts")


@query("T08_gap_ratio", "select symbol, round(1 - count(distinct epoch_us(timestamp) // 3600000000) / (max(epoch_us(timestamp) // 3600000000) - min(epoch_us(timestamp) // 3600000000) + 1), 6) as gap_ratio, max(epoch_us(timestamp) // 3600000000) - min(epoch_us(timestamp) // 3600000000) + 1 as slots from trades_v group by symbol")
def gap_ratio(spark, sf):
    return rounded(b.gap_ratio(view(spark, sf, "trades_v"), "price", seconds=3600))


@query("T09_calendar_floors", "select event_id, epoch_us(date_trunc('day', ts)) as day, epoch_us(date_trunc('hour', ts)) as hour, strftime(ts, '%Y-%m') as month from tape")
def calendar_floors(spark, sf):
    t = tape(spark, sf)
    return t.select("event_id", *[x.micros(F.date_trunc(u, "ts")).alias(u) for u in ("day", "hour")], F.date_format("ts", "yyyy-MM").alias("month"))


_FEATURE_QUERIES = {
    "P01_mid_spread": ["mid", "spread_bps"],
    "P02_microprice_bias": ["micro_bias"],
    "P03_depth_imbalance": ["db1", "da1", "db3", "da3", "db10", "da10", "obi1", "obi3", "obi5", "obi10", "obi14"],
    "P04_spread_ticks": ["spread_ticks"],
    "P05_direction": ["dir0"],
    "P06_flow_rates": ["ti", "nps", "notional_ps"],
    "P07_opposite_depth": ["opp3", "opp10"],
    "W01_rolling_flow": ["notional_buy_w", "notional_sell_w", "ntr_w"],
    "W02_short_spread_median": ["spread_1s"],
    "W03_relative_spread": ["spread_med", "spread_rel"],
    "W04_price_range": ["range60_bps", "range600_bps"],
    "W05_thinning": ["thin3", "thin10"],
    "W06_sign_persistence": ["persist_micro_ms", "persist_obi_ms"],
}


def _feature_query(names):
    def run(spark, sf):
        return us(rounded(tape_features(spark, sf).select("symbol", "bucket", *names), 5), "bucket")

    return run


for _name, _columns in _FEATURE_QUERIES.items():
    _out = ", ".join(f"{c}::bigint as {c}" if c == "ntr_w" else f"round({c}::double, 5) + 0.0 as {c}" for c in _columns)
    query(_name, f"with {FEATURES_SQL} select symbol, epoch_us(bucket) as bucket, {_out} from feat")(_feature_query(_columns))


@query("P08_absolute_features", f"with {FEATURES_SQL} select symbol, epoch_us(bucket) as bucket, round(coalesce(abs(micro_bias), 0), 5) as abs_micro, round(coalesce(abs(obi10), 0), 5) as abs_obi10 from feat")
def absolute_features(spark, sf):
    f = tape_features(spark, sf)
    clean = lambda c: F.coalesce(F.abs(x.finite(c)), F.lit(0.0))
    return us(rounded(f.select("symbol", "bucket", clean("micro_bias").alias("abs_micro"), clean("obi10").alias("abs_obi10")), 5), "bucket")


_REGIME = "case when spread_bps_entry <= lo then 'CALM' when spread_bps_entry <= hi then 'NORMAL' when spread_bps_entry is not null then 'VOLATILE' end"


@query("P09_quantile_regime", f"with q as (select quantile_cont(spread_bps_entry, 0.4) as lo, quantile_cont(spread_bps_entry, 0.75) as hi from grid_v where day(t) <= 20) select event_id, {_REGIME} as regime, 'sym' as source from grid_v cross join q")
def quantile_regime(spark, sf):
    g = view(spark, sf, "grid_v")
    edges = th.regime_edges(g.where(is_train("t")), "spread_bps_entry", least_rows=1)
    out = g.crossJoin(F.broadcast(edges))
    return out.select("event_id", x.quantile_regime("spread_bps_entry", F.col("lo"), F.col("hi")).alias("regime"), F.lit("sym").alias("source"))


@query("P10_regime_of_bucket", "select event_id, case when vol_bucket in ('b0', 'b1') then 'low' when vol_bucket = 'b2' then 'mid' else 'high' end as regime3 from router_v")
def regime_of_bucket(spark, sf):
    return view(spark, sf, "router_v").select("event_id", x.vol_regime3("vol_bucket").alias("regime3"))


@query("P11_split", "select event_id, case when day(ts) <= 15 then 'train' when day(ts) <= 22 then 'val' when day(ts) <= 28 then 'test' else 'other' end as split from tape")
def split(spark, sf):
    day = F.date_format("ts", "dd")
    return tape(spark, sf).select("event_id", x.month_split(day, ("01", "15"), ("16", "22"), ("23", "28")).alias("split"))


@query("P12_router_branch", "select event_id, case when vol_bucket = 'b2' then 'MR' else 'BO' end as branch from router_v")
def router_branch(spark, sf):
    return view(spark, sf, "router_v").select("event_id", x.router_branch("vol_bucket").alias("branch"))


@query("P13_branch_direction", "select event_id, case when event_id % 2 = 0 then -dir0 else dir0 end as dir_use from signals_v")
def branch_direction(spark, sf):
    s = view(spark, sf, "signals_v").withColumn("branch", F.when(F.col("event_id") % 2 == 0, "MR").otherwise("BO"))
    return s.select("event_id", x.branch_direction("branch", "dir0").alias("dir_use"))


@query("P16_size_steps", "select event_id, case when score is null then 0.5 when score >= 0.8 then 1.5 when score >= 0.6 then 1.2 when score >= 0.4 then 1.0 else 0.5 end as size_a, case when score is null then 0.0 when score >= 0.7 then 1.0 else 0.25 end as size_b, case when score is null then 1.0 when score >= 0.9 then 2.0 when score >= 0.5 then 1.0 else 0.0 end as size_c from router_v")
def size_steps(spark, sf):
    v = view(spark, sf, "router_v")
    return v.select(
        "event_id",
        x.size_steps("score", [(0.8, 1.5), (0.6, 1.2), (0.4, 1.0)], 0.5, 0.5).alias("size_a"),
        x.size_steps("score", [(0.7, 1.0)], 0.25, 0.0).alias("size_b"),
        x.size_steps("score", [(0.9, 2.0), (0.5, 1.0)], 0.0, 1.0).alias("size_c"),
    )


@query("P18_robust_score", f"with {TAGS_SQL} select symbol, epoch_us(bucket) as bucket, round(ms, 4) as ms from tags where ms is not null")
def robust_score(spark, sf):
    return us(rounded(_tags(spark, sf).where("ms is not null").select("symbol", "bucket", "ms"), 4), "bucket")


@query("P19_costs", "select event_id, fees_rt_bps, 4.0 + fees_rt_bps + slip_bps as thr_exec_bps from signals_v")
def costs(spark, sf):
    return view(spark, sf, "signals_v").select("event_id", F.col("fees_rt_bps").cast("double").alias("fees_rt_bps"), (F.lit(4.0) + F.col("fees_rt_bps") + F.col("slip_bps")).cast("double").alias("thr_exec_bps"))


_FREQUENCIES = {"click": "1m", "view": "15m", "purchase": "1h", "error": "4h"}


@query("P20_frequencies", "with f as (select event_id, case event_type " + " ".join(f"when '{k}' then '{v}'" for k, v in _FREQUENCIES.items()) + " else '1d' end as f from tape) select event_id, f, case right(f, 1) when 'm' then 60000 when 'h' then 3600000 else 86400000 end * left(f, len(f) - 1)::bigint as ms, case when right(f, 1) = 'm' then left(f, len(f) - 1) || 'min' else f end as resample from f")
def frequencies(spark, sf):
    f = F.coalesce(F.create_map(*[F.lit(v) for kv in _FREQUENCIES.items() for v in kv])[F.col("event_type")], F.lit("1d"))
    return tape(spark, sf).withColumn("f", f).select("event_id", "f", x.frequency_ms("f").alias("ms"), x.resample_name("f").alias("resample"))


@query("P21_label_return", "select event_id, case event_id % 3 - 1 when 1 then 1.3 when -1 then -1.0 when 0 then 0.0 end as ret from tape")
def label_return(spark, sf):
    return tape(spark, sf).select("event_id", x.label_return((F.col("event_id") % 3 - 1)).alias("ret"))


@query("P22_to_bps", 'select event_id, round("pnl_net_rr1.00_rf10_ts60" * 1e4, 6) as bps, try_cast(case when event_id % 2 = 0 then \'x\' else \'0.5\' end as double) * 1e4 as mixed from grid_v')
def to_bps(spark, sf):
    g = view(spark, sf, "grid_v")
    mixed = F.when(F.col("event_id") % 2 == 0, "x").otherwise("0.5")
    return g.select("event_id", r(x.to_bps(F.col("`pnl_net_rr1.00_rf10_ts60`"))).alias("bps"), x.to_bps(mixed).alias("mixed"))


@query("P23_coerce_and_drop", "select event_id, try_cast(replace(case when event_id % 5 = 0 then 'n/a' else value::varchar end, ',', '') as double) as x from tape where event_id % 5 <> 0 and event_type is not null")
def coerce_and_drop(spark, sf):
    t = tape(spark, sf).withColumn("raw", F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.col("value").cast("string")))
    return t.withColumn("x", x.finite("raw")).dropna(subset=["x", "event_type"]).select("event_id", "x")


@query("P24_training_columns", f"with {FEATURES_SQL} select count(*) as n, round(sum(spread_rel), 4) as a, round(sum(nps), 4) as b from feat where day(bucket) <= 20")
def training_columns(spark, sf):
    need = ["bucket", *{c for _, c, _ in th.ThresholdPlan().cuts}, "spread_bps"]
    train = tape_features(spark, sf).select(*need).where(is_train())
    return train.agg(F.count("*").alias("n"), r(F.sum("spread_rel"), 4).alias("a"), r(F.sum("nps"), 4).alias("b"))


def _train(spark, sf):
    return kept(tape_features(spark, sf).where(is_train()), "train")


def _tags(spark, sf):
    """Features made once, thresholds fitted on the training days, all other days tagged; what only they need is deleted."""
    with working_tables(spark):
        f = stored(tape_features(spark, sf), "features")
        fitted = stored(th.fit_thresholds(f.where(is_train())), "fitted")
        return kept(fn.tagged(fn.with_thresholds(f.where(~is_train()), fitted)), "tags")


@query("A03_percentiles", f"with {FEATURES_SQL} select symbol, round(quantile_cont(spread_bps, 0.1), 5) as p10, round(quantile_cont(spread_bps, 0.5), 5) as p50, round(quantile_cont(spread_bps, 0.97), 5) as p97 from feat group by symbol")
def percentiles(spark, sf):
    f = tape_features(spark, sf)
    return rounded(th.percentiles(f, {"p10": ("spread_bps", 0.1), "p50": ("spread_bps", 0.5), "p97": ("spread_bps", 0.97)}, ["symbol"]), 5)


@query("A04_median_mad", f"with {FITTED_SQL} select round(med_abs_micro, 5) as med_abs_micro, round(mad_abs_micro, 5) as mad_abs_micro, round(med_nps, 5) as med_nps, round(mad_nps, 5) as mad_nps from fitted")
def median_mad(spark, sf):
    out = th.median_mad(_train(spark, sf), ["abs_micro", "nps"])
    return rounded(out.select("med_abs_micro", "mad_abs_micro", "med_nps", "mad_nps"), 5)


_FIT = [n for n, _, _ in th.ThresholdPlan().cuts] + [f"{p}_{c}" for p in ("med", "mad") for c in th.ThresholdPlan().scored]


@query("A05_fit_thresholds", f"with {FITTED_SQL} select {', '.join(f'round({c}, 5) as {c}' for c in _FIT)} from fitted")
def fit_thresholds(spark, sf):
    return rounded(th.fit_thresholds(_train(spark, sf)).select(*_FIT), 5)


#: Fewer training rows give no edges; the guard of a live tape, 50 000, at the fixture's scale.
LEAST_ROWS = 500


@query("A06_regime_edges", f"with {FEATURES_SQL} select case when count(*) >= {LEAST_ROWS} then round(quantile_cont(range600_bps, 0.4), 5) end as lo, case when count(*) >= {LEAST_ROWS} then round(quantile_cont(range600_bps, 0.75), 5) end as hi, count(*) as n_rows from feat where day(bucket) <= 20")
def regime_edges(spark, sf):
    return rounded(th.regime_edges(_train(spark, sf), "range600_bps", least_rows=LEAST_ROWS), 5)


_FLAGS = ", ".join(f"pass_{n}" for n in fn.MASKS)


@query("F01_hard_masks", f"with {TAGS_SQL} select symbol, epoch_us(bucket) as bucket, {_FLAGS} from tags")
def hard_masks(spark, sf):
    return us(_tags(spark, sf).select("symbol", "bucket", *[f"pass_{n}" for n in fn.MASKS]), "bucket")


@query("F02_apply_masks", f"with {TAGS_SQL} select symbol, epoch_us(bucket) as bucket from tags where pass_all_hard")
def apply_masks(spark, sf):
    f = kept(tape_features(spark, sf), "features")
    fitted = th.fit_thresholds(f.where(is_train()))
    return us(fn.passing(fn.with_thresholds(f.where(~is_train()), fitted)).select("symbol", "bucket"), "bucket")


@query("F03_tagged", f"with {TAGS_SQL} select symbol, epoch_us(bucket) as bucket, pass_all_hard, pass_up_to_persist, round(ms, 4) as ms, round(ms_cut, 4) as ms_cut, pass_ms_keep from tags")
def tagged(spark, sf):
    return us(rounded(_tags(spark, sf).select("symbol", "bucket", "pass_all_hard", "pass_up_to_persist", "ms", "ms_cut", "pass_ms_keep"), 4), "bucket")


_COUNTS = " union all ".join(f"select {k} as step_no, '{n}' as step, count(*) filter (where pass_{n}) as n_pass, count(*) filter (where pass_up_to_{n}) as n_up_to from tags" for k, n in enumerate(fn.MASKS))


@query("F04_funnel_counts", f"with {TAGS_SQL} {_COUNTS}")
def funnel_counts(spark, sf):
    return fn.funnel_counts(_tags(spark, sf))


@query("F06_label_mask", f"with {TAGS_SQL} select symbol, epoch_us(bucket) as bucket from tags where case when (select count(*) from tags where pass_all_hard) between 1 and 50000 then pass_all_hard when (select count(*) from tags where pass_ms_keep) between 1 and 50000 then pass_ms_keep else pass_up_to_sign_ti end")
def label_mask(spark, sf):
    return us(fn.labelled_rows(_tags(spark, sf), 50_000, ["symbol", "bucket"]).select("symbol", "bucket"), "bucket")


@query("F06_sampled_mask", f"with {TAGS_SQL}, l as (select symbol, epoch_us(bucket) as bucket from tags where pass_up_to_obi) select symbol, bucket from l order by md5('42|' || symbol || '|' || bucket::varchar), symbol, bucket limit 2")
def sampled_mask(spark, sf):
    """No flag holds for so few rows: a sample of the last one."""
    t = _tags(spark, sf).where("pass_up_to_obi").withColumn("bucket", F.unix_micros("bucket"))
    every = t.withColumns({c: F.lit(True) for c in ("pass_all_hard", "pass_ms_keep", "pass_up_to_sign_ti")})
    return fn.labelled_rows(every, 2, ["symbol", "bucket"]).select("symbol", "bucket")


@query("A13_sampled_rows", "select event_id, month from (select *, strftime(ts, '%Y-%m') as month, row_number() over (partition by strftime(ts, '%Y-%m') order by md5('7|' || event_id::varchar), event_id) as k from tape) where k <= 300")
def sampled_rows(spark, sf):
    t = tape(spark, sf).withColumn("month", F.date_format("ts", "yyyy-MM"))
    return fn.sampled(t, 300, [F.col("month")], ["event_id"], 7).select("event_id", "month")


@query("A12_dedup_by_key", "select symbol, epoch_us(hour) as hour, trade_id from (select symbol, date_trunc('hour', timestamp) as hour, trade_id, row_number() over (partition by symbol, date_trunc('hour', timestamp) order by timestamp, trade_id) as k from trades_v) where k = 1")
def dedup_by_key(spark, sf):
    t = view(spark, sf, "trades_v").withColumn("hour", F.date_trunc("hour", "timestamp"))
    first = t.groupBy("symbol", "hour").agg(F.min_by("trade_id", F.struct("timestamp", "trade_id")).alias("trade_id"))
    return us(first, "hour")


@query("W07_run_lengths", "with f as (select *, coalesce(price > lag(price) over (partition by symbol order by timestamp, trade_id), false) as up from trades_v), i as (select *, sum((not up)::int) over (partition by symbol order by timestamp, trade_id) as island from f) select symbol, epoch_us(min(timestamp)) as first, epoch_us(max(timestamp)) as last, count(*) as n from i where up group by symbol, island")
def run_lengths(spark, sf):
    by = W.partitionBy("symbol").orderBy("timestamp", "trade_id")
    t = view(spark, sf, "trades_v").withColumn("up", F.coalesce(F.col("price") > F.lag("price").over(by), F.lit(False)))
    return us(w.run_lengths(t, "up", ["timestamp", "trade_id"]), "first", "last")


@query("W08_lag_change", "select symbol, trade_id, round(price - lag(price) over w, 6) as diff, round(price / lag(price) over w - 1, 6) as pct from trades_v window w as (partition by symbol order by timestamp, trade_id)")
def lag_change(spark, sf):
    rows = w.with_previous(view(spark, sf, "trades_v"), {"before": "price"}, ["timestamp", "trade_id"])
    return rows.select("symbol", "trade_id", r(F.col("price") - F.col("before")).alias("diff"), r(F.col("price") / F.col("before") - 1).alias("pct"))


@query("W09_row_numbers", "select symbol, trade_id, row_number() over (partition by symbol order by timestamp, trade_id) - 1 as row_no from trades_v")
def row_numbers(spark, sf):
    return w.numbered(view(spark, sf, "trades_v"), ["timestamp", "trade_id"]).select("symbol", "trade_id", F.col("row_no").cast("long").alias("row_no"))

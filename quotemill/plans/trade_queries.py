"""Queries of time joins, labels, backtests and bootstraps (J, P13-P15, F05, F13, W10, A02, A07-A11, A15-A21, M03-M08)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quotemill.functions import expr as x
from quotemill.operators import backtest as bt
from quotemill.operators import bootstrap as bs
from quotemill.operators import thresholds as th
from quotemill.operators import timejoins as tj
from quotemill.operators.bucketing import resample
from quotemill.operators.spread import exact_percentiles, stats_by
from quotemill.plans import core_queries
from quotemill.plans import intervals as iv
from quotemill.plans.registry import query, r, rounded, us
from quotemill.plans.stage0 import TAGS_SQL
from quotemill.sources.scratch import stored
from quotemill.sources.views import view

UNIT = 60.0  # the fixture's horizons are minutes
TOL = 1800.0
PRE, POST = 120.0, 185 * 60.0

CONFIGS = [
    bt.Config("bo_60_180", "BO", "T45>0", 60, 180),
    bt.Config("bo_60_120", "BO", "none", 60, 120),
    bt.Config("mr_45_180", "MR", "T60>0", 45, 180),
]
_CONFIGS_SQL = "configs(config, mode, gate, early, late, runaway_min) as (values " + ", ".join(f"('{c.name}', '{c.mode}', '{c.gate}', {c.early}, {c.late}, {c.runaway_min})" for c in CONFIGS) + ")"

_MIDS = "mids as (select symbol, timestamp, seq, (bid_0_price + ask_0_price) / 2 as mid from book_v)"

#: raw_<T> of every signal: expressions up to ``pnl``.
PNL_SQL = f"""{_MIDS},
legs as (select event_id, symbol, dir0, T, epoch_us(timestamp) + T * 60000000::bigint as u
         from signals_v cross join (values (0), (30), (45), (60), (120), (180)) h(T)),
near as (
  select event_id, T, mid, row_number() over (partition by event_id, T order by abs(epoch_us(m.timestamp) - u), (epoch_us(m.timestamp) > u)::int,
         case when epoch_us(m.timestamp) > u then seq else -seq end) as k
  from legs l join mids m on m.symbol = l.symbol and abs(epoch_us(m.timestamp) - u) <= 1800000000),
wide as (select event_id, {", ".join(f"max(case when T = {t} and mid > 0 then mid end) as mid_{t}" for t in (0, *bt.HORIZONS))} from near where k = 1 group by event_id),
pnl as (select s.*, mid_0 as entry, {", ".join(f"(mid_{t} / mid_0 - 1) * 1e4 as raw_{t}" for t in bt.HORIZONS)} from signals_v s left join wide using (event_id))
"""

_leg = lambda c: "case " + " ".join(f"when {c} = {t} then pnl_{t}" for t in bt.HORIZONS) + " end"

#: Kept results of every signal and configuration: expressions up to ``trades``.
TRADES_SQL = f"""{PNL_SQL}, {_CONFIGS_SQL},
legged as (select *, {", ".join(f"(case when mode = 'BO' then dir0 else -dir0 end) * raw_{t} - 10.0 as pnl_{t}" for t in bt.HORIZONS)} from pnl cross join configs),
flagged as (select *, ({" and ".join(f"pnl_{t} is not null" for t in bt.HORIZONS)}) as known, coalesce(pnl_30 > runaway_min, false) as calm,
  coalesce(case when gate = 'T45>0' then pnl_45 > 0 when gate = 'T60>0' then pnl_60 > 0 else true end, false) as gated from legged),
trades as (select *, known and calm and gated as kept, case when known and calm and gated then case when ({_leg("early")}) < 0 then ({_leg("early")}) else ({_leg("late")}) end end as pnl_net_bps,
  date_trunc('day', timestamp) as day, 'w' || ((day(timestamp) - 1) // 10)::varchar as month from flagged)
"""


def _pnl(spark, sf):
    return bt.horizon_pnl(view(spark, sf, "signals_v"), view(spark, sf, "book_v"), bt.HORIZONS, UNIT, TOL)


def _trades(spark, sf):
    out = bt.evaluated(_pnl(spark, sf), bt.config_table(spark, CONFIGS))
    third = F.floor((F.dayofmonth("timestamp") - 1) / 10).cast("string")
    return out.withColumns({"day": F.date_trunc("day", "timestamp"), "month": F.concat(F.lit("w"), third)})


_BARS_SQL = """bars as (select symbol, (epoch_us(timestamp) // 14400000000) * 14400000000 as bar, max(high) as high, min(low) as low, max_by(close, timestamp) as close from candles_v group by 1, 2),
lagged as (select *, lag(close) over (partition by symbol order by bar) as pc from bars),
tr as (select *, case when pc is not null then greatest(high - low, abs(high - pc), abs(low - pc)) end as tr from lagged),
atr as (select symbol, bar, case when count(tr) over w = 14 then avg(tr) over w end / close * 1e4 as atr_bps from tr window w as (partition by symbol order by bar rows between 13 preceding and current row))"""


@query("A07_atr", f"with {_BARS_SQL} select symbol, bar as timestamp, round(atr_bps, 5) as atr_bps from atr")
def atr(spark, sf):
    out = bt.atr_bps(resample(view(spark, sf, "candles_v"), 4 * 3600), 14)
    return us(rounded(out.select("symbol", "timestamp", "atr_bps"), 5), "timestamp")


@query("J01_asof_backward", f"with {_BARS_SQL}, hit as (select s.event_id, a.atr_bps, row_number() over (partition by s.event_id order by a.bar desc) as k from signals_v s join atr a on a.symbol = s.symbol and a.bar + 14400000000 <= epoch_us(s.timestamp)) select event_id, round(atr_bps, 5) as atr_bps from hit where k = 1 and atr_bps is not null")
def asof_backward(spark, sf):
    out = bt.with_volatility(view(spark, sf, "signals_v"), view(spark, sf, "candles_v"), 4 * 3600, 14)
    return rounded(out.select("event_id", "atr_bps"), 5)


@query(
    "J02_asof_nearest",
    f"with {PNL_SQL} select l.event_id, coalesce(epoch_us(m.timestamp), -1) as matched_us, round(m.mid, 6) as mid from (select * from legs where T = 60) l left join (select event_id, T, k, mid, ts as timestamp from (select event_id, T, mid, m.timestamp as ts, row_number() over (partition by event_id, T order by abs(epoch_us(m.timestamp) - u), (epoch_us(m.timestamp) > u)::int, case when epoch_us(m.timestamp) > u then seq else -seq end) as k from legs l join mids m on m.symbol = l.symbol and abs(epoch_us(m.timestamp) - u) <= 1800000000)) m on m.event_id = l.event_id and m.T = 60 and m.k = 1",
)
def asof_nearest(spark, sf):
    s = view(spark, sf, "signals_v").withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(hours=F.lit(1)))
    prices = view(spark, sf, "book_v").select("symbol", "timestamp", "seq", x.mid().alias("mid"))
    out = tj.asof_nearest(s, prices, ["mid"], TOL, ["event_id"], "seq")
    return out.select("event_id", F.coalesce(F.unix_micros("matched_ts"), F.lit(-1)).alias("matched_us"), r("mid").alias("mid"))


@query("J03_asof_forward", "select event_id, seq from (select s.event_id, b.seq, row_number() over (partition by s.event_id order by b.timestamp, b.seq) as k from (select event_id, symbol, timestamp + interval 1 second as timestamp from signals_v) s left join book_v b on b.symbol = s.symbol and b.timestamp >= s.timestamp) where k = 1")
def asof_forward(spark, sf):
    s = view(spark, sf, "signals_v").withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(secs=F.lit(1)))
    return tj.asof(s, view(spark, sf, "book_v"), ["seq"], ["seq"], forward=True).select("event_id", "seq")


@query("J04_forward_range", "select s.event_id, b.seq from signals_v s join book_v b on b.symbol = s.symbol and b.timestamp between s.timestamp and s.timestamp + interval 180 minute")
def forward_range(spark, sf):
    book = view(spark, sf, "book_v").select("symbol", "timestamp", "seq")
    return tj.range_join(view(spark, sf, "signals_v"), book, 0.0, 180 * 60.0).select("event_id", F.col("seq_r").alias("seq"))


_WINDOWS_SQL = """spans as (select symbol, timestamp - interval 120 second as a, timestamp + interval 185 minute as b from signals_v where ms >= 150),
ordered as (select *, max(b) over (partition by symbol order by a rows between unbounded preceding and 1 preceding) as reach from spans),
island as (select *, sum(case when reach is null or a > reach then 1 else 0 end) over (partition by symbol order by a rows unbounded preceding) as g from ordered),
windows as (select symbol, min(a) as s, max(b) as e, count(*) as n_events from island group by symbol, g)"""


@query("J06_merged_windows", f"with {_WINDOWS_SQL} select symbol, epoch_us(s) as start, epoch_us(e) as \"end\", n_events from windows")
def merged_windows(spark, sf):
    return us(tj.merged_windows(view(spark, sf, "signals_v").where("ms >= 150"), PRE, POST), "start", "end")


@query("J05_rows_in_windows", f"with {_WINDOWS_SQL} select symbol, seq from book_v b where exists (select 1 from windows w where w.symbol = b.symbol and b.timestamp between w.s and w.e)")
def rows_in_windows(spark, sf):
    windows = tj.merged_windows(view(spark, sf, "signals_v").where("ms >= 150"), PRE, POST)
    return tj.in_windows(view(spark, sf, "book_v"), windows, POST).select("symbol", "seq")


@query("S04_book_in_windows", f"with {_WINDOWS_SQL} select symbol, seq, round((bid_0_price + ask_0_price) / 2, 6) as mid from book_v b where bid_0_price > 0 and ask_0_price > 0 and exists (select 1 from windows w where w.symbol = b.symbol and b.timestamp between w.s and w.e)")
def book_in_windows(spark, sf):
    windows = tj.merged_windows(view(spark, sf, "signals_v").where("ms >= 150"), PRE, POST)
    book = view(spark, sf, "book_v").where("bid_0_price > 0 and ask_0_price > 0").select("symbol", "timestamp", "seq", r(x.mid()).alias("mid"))
    return tj.in_windows(book, windows, POST).select("symbol", "seq", "mid")


@query("F07_exclusion_windows", "select trade_id from trades_v t where not exists (select 1 from signals_v s where s.ms >= 200 and s.symbol = t.symbol and t.timestamp >= s.timestamp and t.timestamp < s.timestamp + interval 6 hour)")
def exclusion_windows(spark, sf):
    s = view(spark, sf, "signals_v").where("ms >= 200")
    bad = s.select("symbol", F.col("timestamp").alias("start"), (F.col("timestamp") + F.make_dt_interval(hours=F.lit(6))).alias("end"))
    return tj.in_windows(view(spark, sf, "trades_v"), bad, 6 * 3600, anti=True, half_open=True).select("trade_id")


@query("J07_equi_join", "select t.symbol, epoch_us(t.timestamp) as timestamp, trade_id, seq from trades_v t join book_v b on b.symbol = t.symbol and b.timestamp = t.timestamp")
def equi_join(spark, sf):
    book = view(spark, sf, "book_v").select("symbol", "timestamp", "seq")
    return us(view(spark, sf, "trades_v").join(book, ["symbol", "timestamp"]).select("symbol", "timestamp", "trade_id", "seq"), "timestamp")


@query("J08_left_join", "select r.event_id, s.ms from router_v r left join signals_v s on s.event_id = r.event_id")
def left_join(spark, sf):
    s = view(spark, sf, "signals_v").select("event_id", "ms")
    return view(spark, sf, "router_v").join(s, "event_id", "left").select("event_id", "ms")


@query("J09_full_join", "select event_id, r.pnl_net_bps as pnl, s.ms from (select event_id, pnl_net_bps from router_v where pnl_net_bps > 0) r full join (select event_id, ms from signals_v where dir0 > 0) s using (event_id)")
def full_join(spark, sf):
    a = view(spark, sf, "router_v").where("pnl_net_bps > 0").select("event_id", F.col("pnl_net_bps").cast("double").alias("pnl"))
    return a.join(view(spark, sf, "signals_v").where("dir0 > 0").select("event_id", "ms"), "event_id", "full_outer").select("event_id", "pnl", "ms")


@query("J10_events_by_config", f"with {TRADES_SQL} select event_id, config, kept, round(pnl_net_bps, 5) as pnl_net_bps from trades")
def events_by_config(spark, sf):
    return rounded(_trades(spark, sf).select("event_id", "config", "kept", "pnl_net_bps"), 5)


@query("J11_event_windows", "select s.event_id, count(*) as n, round(sum(t.qty), 6) as qty, min(t.trade_id) as first_id from signals_v s join trades_v t on t.symbol = s.symbol and t.timestamp between s.timestamp - interval 2 minute and s.timestamp + interval 185 minute group by s.event_id")
def event_windows(spark, sf):
    found = tj.range_stats(view(spark, sf, "signals_v"), view(spark, sf, "trades_v"), PRE, POST, "event_id", "qty", "trade_id")
    return found.groupBy("event_id").agg(F.sum("n").alias("n"), r(F.sum("qty")).alias("qty"), F.min("trade_id").alias("first_id"))


@query("M05_horizon_pnl", f"with {PNL_SQL} select event_id, {', '.join(f'round(dir0 * raw_{t} - 10.0, 5) as pnl_{t}' for t in bt.HORIZONS)} from pnl")
def horizon_pnl(spark, sf):
    return rounded(_pnl(spark, sf).select("event_id", *[bt.net_pnl(t, F.col("dir0")).alias(f"pnl_{t}") for t in bt.HORIZONS]), 5)


@query("P14_exit_rule", f"with {PNL_SQL} select event_id, round(case when dir0 * raw_60 - 10.0 < 0 then dir0 * raw_60 - 10.0 else dir0 * raw_180 - 10.0 end, 5) as pnl from pnl")
def exit_rule(spark, sf):
    p = _pnl(spark, sf)
    return rounded(p.select("event_id", x.exit_pnl(bt.net_pnl(60, F.col("dir0")), bt.net_pnl(180, F.col("dir0"))).alias("pnl")), 5)


@query("P15_go_labels", f"with {PNL_SQL} select event_id, coalesce(dir0 * raw_60 - 10.0 > 0, false)::int as y_go, coalesce(dir0 * raw_60 - 10.0 > 4, false)::int as y_strong, (raw_60 is not null)::int as is_tradeable from pnl")
def go_labels(spark, sf):
    p = _pnl(spark, sf).withColumn("p", bt.net_pnl(60, F.col("dir0")))
    return p.select("event_id", x.positive("p").alias("y_go"), x.positive("p", 4.0).alias("y_strong"), F.col("p").isNotNull().cast("int").alias("is_tradeable"))


@query("F05_gates", f"with {TRADES_SQL} select event_id, config, known, calm, gated from trades")
def gates(spark, sf):
    return _trades(spark, sf).select("event_id", "config", "known", "calm", "gated")


@query("F13_needed_horizons", "select config, T, (select count(*) from signals_v) as n_events from (values ('bo_60_180'), ('bo_60_120'), ('mr_45_180')) c(config) cross join (values (30), (45), (60), (120), (180)) h(T)")
def needed_horizons(spark, sf):
    n = view(spark, sf, "signals_v").agg(F.count("*").alias("n_events"))
    return bt.needed_horizons(bt.config_table(spark, CONFIGS)).crossJoin(F.broadcast(n)).select("config", "T", "n_events")


_STATS = f"select month, config, count(*) as n_events, {', '.join(f'count(pnl_{t}) as ok_{t}' for t in bt.HORIZONS)}, count(*) filter (where not known) as drop_unknown, count(*) filter (where known and not calm) as drop_runaway, count(*) filter (where known and calm and not gated) as drop_gate, count(pnl_net_bps) as n, avg(pnl_net_bps) as ev, quantile_cont(pnl_net_bps, 0.05) as p05, quantile_cont(pnl_net_bps, 0.5) as p50, quantile_cont(pnl_net_bps, 0.95) as p95 from trades group by month, config"


@query("A02_config_stats", f"with {TRADES_SQL} select * replace (round(ev, 5) as ev, round(p05, 5) as p05, round(p50, 5) as p50, round(p95, 5) as p95) from ({_STATS})")
def config_stats(spark, sf):
    return rounded(bt.config_stats(_trades(spark, sf), ["month", "config"]), 5)


@query("A10_monthly_pivot", f"with {TRADES_SQL}, st as ({_STATS}) select config, round(max(case when month = 'w0' then ev end), 5) as w0, round(max(case when month = 'w1' then ev end), 5) as w1, round(max(case when month = 'w2' then ev end), 5) as w2 from st group by config")
def monthly_pivot(spark, sf):
    return rounded(bt.monthly_pivot(bt.config_stats(_trades(spark, sf), ["month", "config"]), ["w0", "w1", "w2"]), 5)


@query("A11_stability", f"with {TRADES_SQL}, st as ({_STATS}) select config, round(avg(ev), 5) as mean_ev, round(stddev_samp(ev), 5) as std_ev, count(*) filter (where ev > 0) as pos_months, count(ev) as n_months, round(count(*) filter (where ev > 0) / count(ev), 5) as pos_rate from st group by config")
def stability(spark, sf):
    return rounded(bt.stability(bt.config_stats(_trades(spark, sf), ["month", "config"])), 5)


_ATR_TRADES = f"""{TRADES_SQL}, {_BARS_SQL},
hit as (select s.*, a.atr_bps, row_number() over (partition by s.event_id, s.config order by a.bar desc) as k from (select * from trades where kept) s join atr a on a.symbol = s.symbol and a.bar + 14400000000 <= epoch_us(s.timestamp)),
vol as (select * from hit where k = 1 and atr_bps is not null),
edges as (select quantile_cont(atr_bps, 0.2) as e1, quantile_cont(atr_bps, 0.4) as e2, quantile_cont(atr_bps, 0.6) as e3, quantile_cont(atr_bps, 0.8) as e4 from vol),
bucketed as (select v.*, 'b' || ((atr_bps > e1)::int + (atr_bps > e2)::int + (atr_bps > e3)::int + (atr_bps > e4)::int)::varchar as vol_bucket from vol v cross join edges)"""


def _bucketed(spark, sf):
    kept = _trades(spark, sf).where("kept").select("event_id", "config", "symbol", "timestamp", "day", "month", "mode", "pnl_net_bps")
    vol = bt.with_volatility(kept, view(spark, sf, "candles_v"), 4 * 3600, 14)
    vol = stored(vol, "volatility")
    edges = th.bucket_edges(vol, "atr_bps", 5)
    out = vol.crossJoin(F.broadcast(edges.select("edges")))
    return out.withColumn("vol_bucket", th.bucket_of(F.col("atr_bps"), F.col("edges"))).drop("edges")


@query("A08_vol_buckets", f"with {_ATR_TRADES} select event_id, config, vol_bucket from bucketed")
def vol_buckets(spark, sf):
    return _bucketed(spark, sf).select("event_id", "config", "vol_bucket")


@query("A09_bucket_edges", f"with {_BARS_SQL} select round(quantile_cont(atr_bps, 1/3), 5) as e1, round(quantile_cont(atr_bps, 2/3), 5) as e2, count(atr_bps) as n, round(avg(atr_bps), 5) as mean, round(min(atr_bps), 5) as least, round(max(atr_bps), 5) as most from atr")
def bucket_edges(spark, sf):
    out = th.bucket_edges(bt.atr_bps(resample(view(spark, sf, "candles_v"), 4 * 3600), 14), "atr_bps", 3)
    return rounded(out.select(F.col("edges")[0].alias("e1"), F.col("edges")[1].alias("e2"), "n", "mean", "least", "most"), 5)


@query("A18_bucket_summary", f"with {_ATR_TRADES} select config, vol_bucket, count(*) as n, count(distinct day) as n_days, round(avg(pnl_net_bps), 5) as mean, round(median(atr_bps), 5) as med_atr from bucketed group by config, vol_bucket")
def bucket_summary(spark, sf):
    return bucket_summary_intervals(spark, sf).select("config", "vol_bucket", "n", "n_days", "mean", "med_atr")


_SETS_SQL = "sets as (select 'b' || i || '-b' || j as name, i, j, -1 as skip from range(5) a(i), range(5) b(j) where i <= j union all select 'not b' || i, 0, 4, i from range(5) a(i))"
_IN_SETS = "right(vol_bucket, 1)::int between i and j and right(vol_bucket, 1)::int <> skip"


@query(
    "A18_bucket_summary_intervals",
    f"with {_ATR_TRADES}, {iv.factors()}, {iv.days('bucketed', 'pnl_net_bps', 'config, vol_bucket', 'by_day')}, {iv.iid('bucketed', 'pnl_net_bps', 'event_id', 'config, vol_bucket', 'by_row')}, st as (select config, vol_bucket, avg(pnl_net_bps) as mean, count(*) as n, count(distinct day) as n_days, median(atr_bps) as med_atr from bucketed group by 1, 2) select config, vol_bucket, n, n_days, round(mean, 5) as mean, round(med_atr, 5) as med_atr, round(d.ci_lo, 5) as day_lo, round(d.ci_hi, 5) as day_hi, round(i.ci_lo, 5) as iid_lo, round(i.ci_hi, 5) as iid_hi from st join by_day d using (config, vol_bucket) join by_row i using (config, vol_bucket)",
)
def bucket_summary_intervals(spark, sf):
    """The summary with both intervals: rows drawn one by one, and whole days."""
    t = _bucketed(spark, sf)
    by = ["config", "vol_bucket"]
    days = bs.day_interval(t, "pnl_net_bps", "day", by).withColumnsRenamed({"ci_lo": "day_lo", "ci_hi": "day_hi"})
    rows = bs.iid_interval(t, "pnl_net_bps", "event_id", by).select(*by, F.col("ci_lo").alias("iid_lo"), F.col("ci_hi").alias("iid_hi"))
    med = exact_percentiles(t, {"med_atr": ("atr_bps", 0.5)}, by)
    return rounded(days.join(rows, by).join(med, by), 5)


def _results(spark, sf):
    return view(spark, sf, "router_v").withColumn("v", F.col("pnl_net_bps").cast("double"))


@query("A15_iid_interval", f"with {iv.factors()}, {iv.iid('router_v', 'pnl_net_bps', 'event_id', 'router_pick', 'ci')} select router_pick, round(avg(pnl_net_bps), 10) as mean, count(*) as n, round(min(ci_lo), 6) as ci_lo, round(min(ci_hi), 6) as ci_hi from router_v join ci using (router_pick) group by router_pick")
def iid_interval(spark, sf):
    out = bs.iid_interval(_results(spark, sf), "v", "event_id", ["router_pick"])
    return out.withColumns({"mean": r("mean", 10), "ci_lo": r("ci_lo"), "ci_hi": r("ci_hi")})


@query("A16_day_interval", f"with {iv.factors()}, {iv.days('router_v', 'pnl_net_bps', 'router_pick', 'ci')} select router_pick, round(avg(pnl_net_bps), 10) as mean, count(*) as n, count(distinct day) as n_days, round(min(ci_lo), 6) as ci_lo, round(min(ci_hi), 6) as ci_hi from router_v join ci using (router_pick) group by router_pick")
def day_interval(spark, sf):
    out = bs.day_interval(_results(spark, sf), "v", "day", ["router_pick"])
    return out.withColumns({"mean": r("mean", 10), "ci_lo": r("ci_lo"), "ci_hi": r("ci_hi")})


_DELTA = "avg(pnl_net_bps) filter (where {0} = 'MR') - avg(pnl_net_bps) filter (where {0} = 'BO')"


@query("A17_day_delta", f"with {iv.factors()}, {iv.factors(8)}, {iv.delta('router_v', 'pnl_net_bps', 'router_pick', 'MR', 'BO', 'symbol', 'ci')} select symbol, round({_DELTA.format('router_pick')}, 10) as delta, round(min(ci_lo), 6) as ci_lo, round(min(ci_hi), 6) as ci_hi from router_v join ci using (symbol) group by symbol")
def day_delta(spark, sf):
    out = bs.day_delta(_results(spark, sf), "v", "day", "router_pick", "MR", "BO", ["symbol"])
    return out.withColumns({"delta": r("delta", 10), "ci_lo": r("ci_lo"), "ci_hi": r("ci_hi")})


@query("A19_router_pick", "select event_id, vol_bucket, router_pick from router_v where router_pick = case when vol_bucket = 'b2' then 'MR' else 'BO' end")
def router_pick(spark, sf):
    return bt.router_pick(view(spark, sf, "router_v")).select("event_id", "vol_bucket", "router_pick")


def candidate_sets(n: int) -> list[tuple[str, list[str]]]:
    """Bucket sets that the router may trade: singles, contiguous ranges, all but one."""
    names = [f"b{i}" for i in range(n)]
    out = {f"{names[i]}-{names[j]}": names[i : j + 1] for i in range(n) for j in range(i, n)}
    out |= {f"not {b}": [c for c in names if c != b] for b in names}
    return list(out.items())


@query("A20_router_search", f"with {_SETS_SQL} select name, count(*) as n, round(avg(pnl_net_bps), 10) as mean, count(distinct day) as n_days from router_v join sets on {_IN_SETS} group by name")
def router_search(spark, sf):
    return router_search_ranked(spark, sf).select("name", "n", "mean", "n_days")


@query("A20_router_search_ranked", f"with {_SETS_SQL}, members as (select name, day, pnl_net_bps from router_v join sets on {_IN_SETS}), {iv.factors()}, {iv.days('members', 'pnl_net_bps', 'name', 'ci')} select name, round(avg(pnl_net_bps), 10) as mean, count(*) as n, count(distinct day) as n_days, round(min(ci_lo), 6) as ci_lo, round(min(ci_hi), 6) as ci_hi from members join ci using (name) group by name")
def router_search_ranked(spark, sf):
    """Bucket sets from the highest lower bound on, with their intervals."""
    return _ranked_sets(spark, _results(spark, sf), "v")


def _ranked_sets(spark, trades, value):
    sets = spark.createDataFrame([(n, b) for n, bs_ in candidate_sets(5) for b in bs_], "name string, vol_bucket string")
    out = bs.day_interval(trades.join(F.broadcast(sets), "vol_bucket"), value, "day", ["name"])
    out = out.withColumns({"mean": r("mean", 10), "ci_lo": r("ci_lo"), "ci_hi": r("ci_hi")})
    return out.orderBy(F.desc_nulls_last("ci_lo"), F.desc("mean"), "name")


@query("A21_bucket_delta", f"select vol_bucket, round({_DELTA.format('router_pick')}, 10) as delta from router_v group by vol_bucket")
def bucket_delta(spark, sf):
    return bucket_delta_interval(spark, sf).select("vol_bucket", "delta")


@query("A21_bucket_delta_interval", f"with {iv.factors()}, {iv.factors(8)}, {iv.delta('router_v', 'pnl_net_bps', 'router_pick', 'MR', 'BO', 'vol_bucket', 'ci')} select vol_bucket, round({_DELTA.format('router_pick')}, 10) as delta, round(min(ci_lo), 6) as ci_lo, round(min(ci_hi), 6) as ci_hi from router_v join ci using (vol_bucket) group by vol_bucket")
def bucket_delta_interval(spark, sf):
    out = bs.day_delta(_results(spark, sf), "v", "day", "router_pick", "MR", "BO", ["vol_bucket"])
    return out.withColumns({"delta": r("delta", 10), "ci_lo": r("ci_lo"), "ci_hi": r("ci_hi")})


_PATH_SQL = """spr as (select (ask_0_price - bid_0_price) / ((ask_0_price + bid_0_price) / 2 + 1e-12) * 1e4 as s from book_v),
lim as (select greatest(quantile_cont(s, 0.99), (select median(s) from spr) + 5 * median(abs(s - (select median(s) from spr)))) as lim from spr),
path as (
  select s.event_id, s.dir0, s.timestamp as t0, b.timestamp as t, b.bid_0_price as bid, b.ask_0_price as ask, row_number() over w - 1 as k,
         first_value(b.bid_0_price) over w as ebid, first_value(b.ask_0_price) over w as eask
  from signals_v s join book_v b on b.symbol = s.symbol and b.timestamp between s.timestamp and s.timestamp + interval 360 minute
  window w as (partition by s.event_id order by b.timestamp, b.seq)),
valued as (select *, case when dir0 > 0 then (bid - eask) / eask * 1e4 else (ebid - ask) / ebid * 1e4 end as raw,
  (ask - bid) / ((ask + bid) / 2 + 1e-12) * 1e4 >= (select lim from lim) as wide from path),
ahead as (select *, raw - 10.0 as net, coalesce(lead(raw, 2) over (partition by event_id order by k), last_value(raw) over (partition by event_id order by k rows between current row and unbounded following)) as later from valued),
per as (select event_id, max(net) as net_max, min(net) as net_min, min(k) filter (where net >= 20) as k_hit, min(epoch_us(t)) filter (where net >= 20) as us_hit,
  min(k) filter (where wide) as k_w, min(epoch_us(t)) filter (where wide) as us_w, arg_min(later > raw, k) filter (where wide) as goes_on, min(epoch_us(t0)) as u0 from ahead group by event_id),
res as (select *, case when k_hit is not null and (not coalesce(goes_on, false) or k_hit <= k_w) then 'pnl_net' when goes_on then 'spread' else 'none' end as reason from per)"""


@query("W10_path_labels", f"with {_PATH_SQL} select event_id, round(net_max, 5) as net_max, round(net_min, 5) as net_min, coalesce((net_max >= 20)::int, 0) as label, coalesce(reason, 'none') as reason, round(case reason when 'pnl_net' then us_hit - u0 when 'spread' then us_w - u0 end / 1e6, 3) as seconds from signals_v left join res using (event_id)")
def path_labels(spark, sf):
    out = bt.path_labels(view(spark, sf, "signals_v"), view(spark, sf, "book_v"), 360 * 60.0, 20.0, block_rows=8)
    return rounded(out.select("event_id", F.col("net_max").cast("double"), F.col("net_min").cast("double"), "label", "reason", r("seconds", 3).alias("seconds")), 5)


@query("M04_eval_ready", f"with {TAGS_SQL} select symbol, epoch_us(bucket) as timestamp, dir0, 8.0::double as fees_rt_bps, 2.0::double as slip_bps, round(ms, 4) as ms from tags where pass_all_hard and ms is not null")
def eval_ready(spark, sf):
    """What the funnel passes, with the columns of an evaluation; rows with an unknown number are left out."""
    t = core_queries._tags(spark, sf).where("pass_all_hard").withColumns({"fees_rt_bps": F.lit(8.0), "slip_bps": F.lit(2.0)})
    out = t.select("symbol", F.col("bucket").alias("timestamp"), "dir0", *[x.finite(c).alias(c) for c in ("fees_rt_bps", "slip_bps", "ms")])
    return us(rounded(out.dropna(), 4), "timestamp")


_DATASET_SQL = f"""{PNL_SQL}, {_BARS_SQL},
hit as (select s.*, a.atr_bps, row_number() over (partition by s.event_id order by a.bar desc) as k from pnl s join atr a on a.symbol = s.symbol and a.bar + 14400000000 <= epoch_us(s.timestamp)),
vol as (select * from hit where k = 1 and atr_bps is not null),
edges as (select quantile_cont(atr_bps, 0.2) as e1, quantile_cont(atr_bps, 0.4) as e2, quantile_cont(atr_bps, 0.6) as e3, quantile_cont(atr_bps, 0.8) as e4 from vol),
b as (select v.*, 'b' || ((atr_bps > e1)::int + (atr_bps > e2)::int + (atr_bps > e3)::int + (atr_bps > e4)::int)::varchar as vol_bucket from vol v cross join edges),
d as (select *, case when vol_bucket = 'b2' then 'MR' else 'BO' end as router_branch, case when vol_bucket = 'b2' then -dir0 else dir0 end as dir_use from b),
p as (select *, dir_use * raw_60 - 10.0 as p60, dir_use * raw_180 - 10.0 as p180 from d)"""


def stageb_dataset(spark, sf):
    """Signals with volatility bucket, branch, flipped direction, gate, results and labels, in one plan.

    Only book rows that an entry or an exit can use are read.
    """
    signals, book = view(spark, sf, "signals_v"), view(spark, sf, "book_v")
    reach = UNIT * max(bt.HORIZONS) + TOL
    book = tj.in_windows(book, tj.merged_windows(signals, TOL, reach), reach)
    vol = bt.with_volatility(bt.horizon_pnl(signals, book, bt.HORIZONS, UNIT, TOL), view(spark, sf, "candles_v"), 4 * 3600, 14)
    vol = stored(vol, "volatility")
    out = vol.crossJoin(F.broadcast(th.bucket_edges(vol, "atr_bps", 5).select("edges")))
    out = out.withColumn("vol_bucket", th.bucket_of(F.col("atr_bps"), F.col("edges")))
    out = out.withColumn("router_branch", x.router_branch("vol_bucket")).withColumn("dir_use", x.branch_direction("router_branch", "dir0"))
    known = F.lit(True)
    for t in bt.HORIZONS:
        known = known & F.col(f"raw_{t}").isNotNull()
    out = out.withColumn("pnl", x.exit_pnl(bt.net_pnl(60, F.col("dir_use")), bt.net_pnl(180, F.col("dir_use"))))
    return out.withColumns(
        {
            "y_go": x.positive("pnl"),
            "pass_gate": known & F.coalesce(bt.net_pnl(30, F.col("dir_use")) > -15.0, F.lit(False)),
            "is_tradeable": F.col("pnl").isNotNull().cast("int"),
            "split": x.month_split(F.date_format("timestamp", "dd"), ("01", "15"), ("16", "22"), ("23", "31")),
        }
    )


@query("M03_stageb_dataset", f"with {_DATASET_SQL} select event_id, vol_bucket, router_branch, dir_use, round(case when p60 < 0 then p60 else p180 end, 5) as pnl, coalesce(case when p60 < 0 then p60 else p180 end > 0, false)::int as y_go, coalesce(raw_30 is not null and raw_45 is not null and raw_60 is not null and raw_120 is not null and raw_180 is not null and dir_use * raw_30 - 10.0 > -15, false) as pass_gate, case when day(timestamp) <= 15 then 'train' when day(timestamp) <= 22 then 'val' else 'test' end as split from p")
def stageb(spark, sf):
    return rounded(stageb_dataset(spark, sf).select("event_id", "vol_bucket", "router_branch", "dir_use", "pnl", "y_go", "pass_gate", "split"), 5)


@query("M08_backtest", f"with {_ATR_TRADES} select month, vol_bucket, count(*) as n, round(avg(pnl_net_bps), 5) as ev, round(quantile_cont(pnl_net_bps, 0.5), 5) as p50 from bucketed where mode = case when vol_bucket = 'b2' then 'MR' else 'BO' end group by month, vol_bucket")
def backtest(spark, sf):
    picked = bt.router_pick(_bucketed(spark, sf).withColumnRenamed("mode", "router_pick"))
    picked = picked.select("month", "vol_bucket", "pnl_net_bps")
    return rounded(stats_by(picked, ["month", "vol_bucket"], [F.count("*").alias("n"), F.avg("pnl_net_bps").alias("ev")], {"p50": ("pnl_net_bps", 0.5)}), 5)


@query("M08_config_months", f"with {_ATR_TRADES} select config, month, count(*) as n, round(avg(pnl_net_bps), 5) as ev, round(quantile_cont(pnl_net_bps, 0.05), 5) as p05, round(quantile_cont(pnl_net_bps, 0.95), 5) as p95, count(*) filter (where mode = case when vol_bucket = 'b2' then 'MR' else 'BO' end) as n_routed, round(avg(pnl_net_bps) filter (where mode = case when vol_bucket = 'b2' then 'MR' else 'BO' end), 5) as ev_routed from bucketed group by config, month")
def backtest_config_months(spark, sf):
    """The backtest's table of each configuration and month: all trades, and those that the router takes."""
    t = _bucketed(spark, sf)
    routed = F.when(F.col("mode") == F.when(F.col("vol_bucket") == "b2", "MR").otherwise("BO"), F.col("pnl_net_bps"))
    counts = [F.count("*").alias("n"), F.avg("pnl_net_bps").alias("ev"), F.count("routed_").alias("n_routed"), F.avg("routed_").alias("ev_routed")]
    rows = t.select("config", "month", "pnl_net_bps", routed.alias("routed_"))
    return rounded(stats_by(rows, ["config", "month"], counts, {"p05": ("pnl_net_bps", 0.05), "p95": ("pnl_net_bps", 0.95)}), 5)


@query("M08_candidate_search", f"with {_ATR_TRADES}, {_SETS_SQL}, members as (select name, day, pnl_net_bps from bucketed join sets on {_IN_SETS}), {iv.factors()}, {iv.days('members', 'pnl_net_bps', 'name', 'ci')} select name, round(avg(pnl_net_bps), 8) as mean, count(*) as n, count(distinct day) as n_days, round(min(ci_lo), 6) as ci_lo, round(min(ci_hi), 6) as ci_hi from members join ci using (name) group by name")
def backtest_candidate_search(spark, sf):
    """The backtest's router candidates: bucket sets of the trades of all configurations, ranked by their lower bound."""
    return _ranked_sets(spark, _bucketed(spark, sf), "pnl_net_bps").withColumn("mean", r("mean", 8))


@query("M08_router_delta", f"with {_ATR_TRADES}, {iv.factors()}, {iv.factors(8)}, {iv.delta('bucketed', 'pnl_net_bps', 'mode', 'MR', 'BO', 'vol_bucket', 'ci')} select vol_bucket, round({_DELTA.format('mode')}, 5) as delta, round(min(ci_lo), 5) as ci_lo, round(min(ci_hi), 5) as ci_hi from bucketed join ci using (vol_bucket) group by vol_bucket")
def backtest_router_delta(spark, sf):
    """Of each bucket, what trading against the signal earns over trading with it, with its interval."""
    return rounded(bs.day_delta(_bucketed(spark, sf), "pnl_net_bps", "day", "mode", "MR", "BO", ["vol_bucket"]), 5)

"""Queries of score studies, router evaluation and data quality (A01, A14, A22-A39, F08-F12, J12, K, P17, W11-W14)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quotemill.functions import expr as x
from quotemill.operators import quality as ql
from quotemill.operators import routing as rt
from quotemill.operators import study as st
from quotemill.operators import bootstrap as bs
from quotemill.operators.spread import exact_percentiles, stats_by
from quotemill.plans import intervals as iv
from quotemill.plans.registry import query, r, rounded, us
from quotemill.sources.scratch import kept
from quotemill.sources.views import view


def _router(spark, sf):
    return view(spark, sf, "router_v").withColumn("v", F.col("pnl_net_bps").cast("double"))


_STAT = "count(pnl_net_bps) as n, round(avg(pnl_net_bps), 5) as mean, round(quantile_cont(pnl_net_bps, 0.5), 5) as p50, round(quantile_cont(pnl_net_bps, 0.95), 5) as p95, min(pnl_net_bps)::double as least, max(pnl_net_bps)::double as most"


@query("A01_group_stats", f"select vol_bucket, {_STAT} from router_v group by vol_bucket")
def group_stats(spark, sf):
    return rounded(st.group_stats(_router(spark, sf), ["vol_bucket"], "v"), 5)


@query("A14_counts", "select router_pick, count(distinct day) as n_days, count(*) as n, round(avg((pnl_net_bps > 0)::int), 5) as rate from router_v group by router_pick")
def counts(spark, sf):
    return rounded(_router(spark, sf).groupBy("router_pick").agg(F.count_distinct("day").alias("n_days"), F.count("*").alias("n"), F.avg((F.col("v") > 0).cast("int")).alias("rate")), 5)


_RANKED = "ranked as (select *, row_number() over (partition by symbol order by score desc, event_id) as rank, count(*) over (partition by symbol) as n_all from router_v where score is not null)"


@query("A22_top_shares", f"with {_RANKED}, c as (select * from ranked cross join (values (0.01), (0.05), (0.1), (0.25)) s(share) where rank <= greatest(round_even(n_all * share, 0), 1)) select symbol, share::double as share, count(*) as k, round(avg(pnl_net_bps), 5) as ev, round(quantile_cont(pnl_net_bps, 0.5), 5) as p50, round(quantile_cont(pnl_net_bps, 0.95), 5) as p95, round(min(score), 6) as score_cut from c group by symbol, share")
def top_shares(spark, sf):
    out = st.top_shares(_router(spark, sf), "score", "v", "event_id", [0.01, 0.05, 0.1, 0.25], ["symbol"])
    return out.select("symbol", "share", "k", r("ev", 5).alias("ev"), r("p50", 5).alias("p50"), r("p95", 5).alias("p95"), r("score_cut").alias("score_cut"))


@query("A23_edge_concentration", f"with {_RANKED}, c as (select * from ranked cross join (values (0.1), (0.2), (0.5), (1.0)) s(share) where rank <= floor(n_all * share)) select symbol, share::double as share, count(*) as k, round(avg(pnl_net_bps), 5) as ev from c group by symbol, share")
def edge_concentration(spark, sf):
    out = st.top_shares(_router(spark, sf), "score", "v", "event_id", [0.1, 0.2, 0.5, 1.0], ["symbol"], whole=True)
    return rounded(out.select("symbol", "share", "k", "ev"), 5)


_BINS = f"{_RANKED}, bins as (select *, greatest(ceil((rank - 1) * 10 / greatest(n_all - 1, 1)), 1)::bigint - 1 as bin from ranked)"


@query("A24_score_deciles", f"with {_BINS} select event_id, bin from bins")
def score_deciles(spark, sf):
    return st.score_bins(_router(spark, sf), "score", "event_id", 10, ["symbol"]).select("event_id", F.col("bin").cast("long").alias("bin"))


@query("A25_bin_sizes", f"with {_BINS}, s as (select bin, count(*) as n, avg(pnl_net_bps) as ev, sum(pnl_net_bps) as t from bins group by bin) select bin, n, round(ev, 5) as ev, round(ev / (sum(t) over () / sum(n) over ()), 5) as ratio, round(least(greatest(ev / (sum(t) over () / sum(n) over ()), 0), 2), 5) as size from s")
def bin_sizes(spark, sf):
    bins = st.score_bins(_router(spark, sf), "score", "event_id", 10, ["symbol"]).withColumn("bin", F.col("bin").cast("long"))
    return rounded(st.bin_sizes(bins, "v").select("bin", "n", "ev", "ratio", "size"), 5)


_STRATEGIES = "s as (select 'base' as strategy, day, pnl_net_bps as w, 1.0 as size from sized union all select 'sized', day, pnl_net_bps * size, size from sized union all select 'cut', day, pnl_net_bps, 1.0 from sized where score is null or score >= 0.3)"
_SIZED = "sized as (select *, case when score is null then 0.5 when score >= 0.8 then 1.5 when score >= 0.6 then 1.2 when score >= 0.4 then 1.0 else 0.5 end as size from router_v)"


def _strategies(t, *by):
    """(by, strategy, w, z): each row's result and size in the strategies that take it."""
    every = F.array(
        F.struct(F.lit("base").alias("strategy"), F.col("v").alias("w"), F.lit(1.0).alias("z")),
        F.struct(F.lit("sized").alias("strategy"), (F.col("v") * F.col("size")).alias("w"), F.col("size").alias("z")),
        F.when(F.col("score").isNull() | (F.col("score") >= 0.3), F.struct(F.lit("cut").alias("strategy"), F.col("v").alias("w"), F.lit(1.0).alias("z"))),
    )
    return t.select(*by, F.inline(F.array_compact(every)))


def _sized(spark, sf):
    return _router(spark, sf).withColumn("size", x.size_steps("score", [(0.8, 1.5), (0.6, 1.2), (0.4, 1.0)], 0.5, 0.5))


@query("A26_strategy_summary", f"with {_SIZED}, {_STRATEGIES} select strategy, count(*) as n, count(distinct day) as n_days, round(avg(w), 10) as mean, round(avg(size), 10) as avg_size from s group by strategy")
def strategy_summary(spark, sf):
    return strategy_intervals(spark, sf).select("strategy", "n", "n_days", "mean", "avg_size")


@query("A26_strategy_intervals", f"with {_SIZED}, {_STRATEGIES}, {iv.factors()}, {iv.days('s', 'w', 'strategy', 'ci')} select strategy, round(avg(w), 10) as mean, count(*) as n, count(distinct day) as n_days, round(min(ci_lo), 6) as ci_lo, round(min(ci_hi), 6) as ci_hi, round(avg(size), 10) as avg_size from s join ci using (strategy) group by strategy")
def strategy_intervals(spark, sf):
    """The comparison of strategies with the intervals of their means, whole days drawn."""
    rows = _strategies(_sized(spark, sf), "day")
    out = bs.day_interval(rows, "w", "day", ["strategy"]).join(rows.groupBy("strategy").agg(r(F.avg("z"), 10).alias("avg_size")), "strategy")
    return out.withColumns({"mean": r("mean", 10), "ci_lo": r("ci_lo"), "ci_hi": r("ci_hi")})


@query("A27_gain_description", f"with {_SIZED}, g as (select avg(pnl_net_bps * size) - avg(pnl_net_bps) as gain from sized group by day) select count(*) as n, round(avg(gain), 5) as mean, round(stddev_samp(gain), 5) as std, round(min(gain), 5) as least, round(quantile_cont(gain, 0.25), 5) as p25, round(quantile_cont(gain, 0.5), 5) as p50, round(quantile_cont(gain, 0.75), 5) as p75, round(max(gain), 5) as most from g")
def gain_description(spark, sf):
    """What the daily gains of the policy over the baseline are like: one row."""
    days = _sized(spark, sf).groupBy("day").agg((F.avg(F.col("v") * F.col("size")) - F.avg("v")).alias("gain")).select("gain")
    counts = [F.count("gain").alias("n"), F.avg("gain").alias("mean"), F.stddev_samp("gain").alias("std"), F.min("gain").alias("least"), F.max("gain").alias("most")]
    return rounded(stats_by(days, [], counts, {"p25": ("gain", 0.25), "p50": ("gain", 0.5), "p75": ("gain", 0.75)}), 5)


@query("A27_daily_policy", f"with {_SIZED} select epoch_us(day) as day, round(avg(pnl_net_bps), 5) as base, round(avg(pnl_net_bps * size), 5) as policy, round(avg(pnl_net_bps * size) - avg(pnl_net_bps), 5) as gain from sized group by day")
def daily_policy(spark, sf):
    out = _sized(spark, sf).groupBy("day").agg(F.avg("v").alias("base"), F.avg(F.col("v") * F.col("size")).alias("policy"))
    return us(rounded(out.withColumn("gain", F.col("policy") - F.col("base")), 5), "day")


@query("A28_monthly_policies", f"with {_SIZED}, s as (select day(timestamp) // 10 as month, 'base' as strategy, pnl_net_bps::double as w from sized union all select day(timestamp) // 10, 'sized', pnl_net_bps * size from sized union all select day(timestamp) // 10, 'cut', pnl_net_bps from sized where score is null or score >= 0.3) select month, strategy, count(*) as n, round(avg(w), 10) as ev, round(quantile_cont(w, 0.5), 10) as p50, round(quantile_cont(w, 0.95), 10) as p95 from s group by 1, 2")
def monthly_policies(spark, sf):
    """The three strategies side by side: count, mean and percentiles of each month."""
    t = _strategies(_sized(spark, sf).withColumn("month", F.floor(F.dayofmonth("timestamp") / 10)), "month")
    return rounded(stats_by(t.drop("z"), ["month", "strategy"], [F.count("*").alias("n"), F.avg("w").alias("ev")], {"p50": ("w", 0.5), "p95": ("w", 0.95)}), 10)


@query("A39_classifier_metrics", "with l as (select symbol, score, (pnl_net_bps > 0)::int as y from router_v where score is not null), k as (select *, rank() over (partition by symbol order by score) as lo, count(*) over (partition by symbol, score) as same, sum(y) over (partition by symbol order by score desc range unbounded preceding) as pos, count(*) over (partition by symbol order by score desc range unbounded preceding) as seen, least(greatest(score, 1e-15), 1 - 1e-15) as p from l) select symbol, count(*) as n, round((sum(y * (lo + (same - 1) / 2)) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))), 5) as auc, round(sum(y * pos / seen) / sum(y), 5) as ap, round(-avg(y * ln(p) + (1 - y) * ln(1 - p)), 5) as logloss from k group by symbol")
def classifier_metrics(spark, sf):
    t = _router(spark, sf).withColumn("y", (F.col("v") > 0).cast("int"))
    return rounded(st.metrics(t, "y", "score", ["symbol"]), 5)


@query("F11_policies", "select event_id, not coalesce(router_pick = 'BO' and vol_bucket in ('b3', 'b4') and score < 0.4, false) as kept_threshold, coalesce(score >= 0.3, true) as kept_size from router_v")
def policies(spark, sf):
    drop = (F.col("router_pick") == "BO") & F.col("vol_bucket").isin("b3", "b4") & (F.col("score") < 0.4)
    return view(spark, sf, "router_v").select("event_id", (~F.coalesce(drop, F.lit(False))).alias("kept_threshold"), F.coalesce(F.col("score") >= 0.3, F.lit(True)).alias("kept_size"))


@query("F12_intersection", "with c as (select quantile_cont(score, 0.9) as a, quantile_cont(strength, 0.1) as b from router_v where day(timestamp) <= 20) select event_id from router_v cross join c where day(timestamp) > 20 and score >= a and strength >= b")
def intersection(spark, sf):
    """Rows that pass both filters, their cut-offs learned on the training days; neither looks at a result."""
    t = _router(spark, sf)
    cut = exact_percentiles(t.where(F.dayofmonth("timestamp") <= 20), {"a": ("score", 0.9), "b": ("strength", 0.1)})
    return t.where(F.dayofmonth("timestamp") > 20).crossJoin(F.broadcast(cut)).where("score >= a and strength >= b").select("event_id")


_GOVERNOR = f"""with recursive {_SIZED},
seq as (select *, date_trunc('day', timestamp) as d, row_number() over (partition by date_trunc('day', timestamp) order by timestamp, event_id) as k from sized),
fold as (
  select d, k, event_id, size * 1.0::double as used, 0.0::double as before, pnl_net_bps::double * size as total from seq where k = 1
  union all
  select s.d, s.k, s.event_id, s.size * m, f.total, f.total + s.pnl_net_bps * s.size * m from (
    select f.*, case when total >= 0 then 1.0 when total > -5 then 0.9 when total > -10 then 0.75 else 0.5 end::double as m from fold f) f join seq s on s.d = f.d and s.k = f.k + 1)
select event_id, round(used, 5) as size_used, round(before, 4) as before from fold"""


@query("W11_drawdown_governor", _GOVERNOR)
def drawdown_governor(spark, sf):
    t = _sized(spark, sf)
    out = st.governor(t, "day", ["timestamp", "event_id"], "v", "size", [(0.0, 1.0), (-5.0, 0.9), (-10.0, 0.75)], 0.5)
    return out.select("event_id", r("size_used", 5).alias("size_used"), r("before", 4).alias("before"))


#: Policies of the study as (policy, traded, result) of each row; results have few digits, so that sums are exact.
_POLICIES_SQL = _GOVERNOR.replace(
    "select event_id, round(used, 5) as size_used, round(before, 4) as before from fold",
    """, rows as (select f.event_id, s.d, day(s.d) // 10 as month, s.pnl_net_bps::double as v, s.size, s.score, s.router_pick, s.vol_bucket, f.used from fold f join seq s using (event_id)),
policies as (
  select d, month, 'baseline' as policy, v as w from rows
  union all select d, month, 'threshold', v from rows where not coalesce(router_pick = 'BO' and vol_bucket in ('b3', 'b4') and score < 0.4, false)
  union all select d, month, 'sizing', v * size from rows
  union all select d, month, 'governor', v * used from rows)
select 'day' as grain, epoch_us(d) as period, policy, count(*) as n, round(avg(w), 10) as ev from policies group by d, policy
union all select 'month', month, policy, count(*), round(avg(w), 10) from policies group by month, policy""",
)


@query("M11_policy_study", _POLICIES_SQL)
def policy_study(spark, sf):
    """Daily and monthly mean results of the baseline, the threshold, the learned sizes and the governor."""
    t = _sized(spark, sf)
    g = st.governor(t, "day", ["timestamp", "event_id"], "v", "size", [(0.0, 1.0), (-5.0, 0.9), (-10.0, 0.75)], 0.5)
    rows = t.join(g.select("event_id", "size_used"), "event_id")
    drop = (F.col("router_pick") == "BO") & F.col("vol_bucket").isin("b3", "b4") & (F.col("score") < 0.4)
    policy = lambda name, w: F.struct(F.lit(name).alias("policy"), w.alias("w"))
    every = F.array(
        policy("baseline", F.col("v")), F.when(~F.coalesce(drop, F.lit(False)), policy("threshold", F.col("v"))),
        policy("sizing", F.col("v") * F.col("size")), policy("governor", F.col("v") * F.col("size_used")),
    )
    long = rows.select("day", F.floor(F.dayofmonth("timestamp") / 10).alias("month"), F.inline(F.array_compact(every)))
    table = lambda grain, period: long.groupBy(F.lit(grain).alias("grain"), period.alias("period"), "policy").agg(F.count("*").alias("n"), F.avg("w").alias("ev"))
    return rounded(table("day", F.unix_micros("day")).union(table("month", F.col("month"))), 10)


@query("W14_learned_sizes", "with tr as (select * from router_v where day(timestamp) <= 20 and score is not null), e as (select quantile_cont(score, 0.2) as a, quantile_cont(score, 0.4) as b, quantile_cont(score, 0.6) as c, quantile_cont(score, 0.8) as d, avg(pnl_net_bps) as m from (select * from router_v where day(timestamp) <= 20)), s as (select (score > a)::int + (score > b)::int + (score > c)::int + (score > d)::int as bin, avg(pnl_net_bps) / min(m) as ratio from tr cross join e group by 1), z as (select bin, least(greatest(max(ratio) over (order by bin), 0), 2) as size from s) select event_id, round(size, 5) as size from (select *, case when score is not null then (score > a)::int + (score > b)::int + (score > c)::int + (score > d)::int end as bin from router_v cross join e where day(timestamp) > 20) left join z using (bin)")
def learned_sizes(spark, sf):
    t = _router(spark, sf)
    day = F.dayofmonth("timestamp")
    return rounded(st.learned_sizes(t.where(day <= 20), t.where(day > 20), "score", "v").select("event_id", "size"), 5)


_LONG = """long as (
  select event_id, symbol, t, spread_bps_entry, 1.0::double as rr, 10 as rf, 60 as ts, "pnl_net_rr1.00_rf10_ts60" as pnl from grid_v
  union all select event_id, symbol, t, spread_bps_entry, 1.5, 10, 60, "pnl_net_rr1.50_rf10_ts60" from grid_v
  union all select event_id, symbol, t, spread_bps_entry, 2.0, 20, 90, "pnl_net_rr2.00_rf20_ts90" from grid_v)"""


@query("P17_long_results", f"with {_LONG} select event_id, rr, rf, ts, round(pnl, 6) as pnl from long")
def long_results(spark, sf):
    return rounded(rt.long_results(view(spark, sf, "grid_v"), ["event_id"]))


_REGIME = """cuts as (select symbol, quantile_cont(atr_pct, 0.4) as lo, quantile_cont(atr_pct, 0.75) as hi from grid_v group by symbol),
regimes as (select g.*, case when atr_pct >= hi then 'VOLATILE' when atr_pct <= lo then 'CALM' else 'NORMAL' end as regime from grid_v g join cuts using (symbol))"""


def _regimes(spark, sf):
    return rt.group_regime(view(spark, sf, "grid_v"), "atr_pct", [F.col("symbol")])


@query("W13_group_regime", f"with {_REGIME} select event_id, regime from regimes")
def group_regime(spark, sf):
    return _regimes(spark, sf).select("event_id", "regime")


_BINNED = """edges as (select symbol, day(t) // 10 as part, quantile_cont(atr_pct, 0.4) as lo, quantile_cont(atr_pct, 0.75) as hi from grid_v group by 1, 2),
every as (select quantile_cont(atr_pct, 0.4) as all_lo, quantile_cont(atr_pct, 0.75) as all_hi, median(atr_pct) as med from grid_v),
bins as (select symbol, part, case when lo < hi then lo when all_lo < all_hi then all_lo else med - 1e-12 end as e1, case when lo < hi then hi when all_lo < all_hi then all_hi else med + 1e-12 end as e2 from edges cross join every)"""


@query("W13_binned_regime", f"with {_BINNED} select event_id, case when atr_pct <= e1 then 'CALM' when atr_pct <= e2 then 'NORMAL' else 'VOLATILE' end as regime from grid_v g join bins b on b.symbol = g.symbol and b.part = day(g.t) // 10")
def binned_regime(spark, sf):
    """By symbol and part of the month, with the fall-backs of degenerate groups."""
    part = F.floor(F.dayofmonth("t") / 10)
    return rt.binned_regime(view(spark, sf, "grid_v"), "atr_pct", [F.col("symbol"), part]).select("event_id", "regime")


_PARAMS = [("click", "CALM", 1.2), ("click", "NORMAL", 1.0), ("view", "VOLATILE", 2.0), ("error", "CALM", 3.0), ("purchase", "NORMAL", 1.5)]


@query("J12_param_lookup", f"with {_REGIME}, {_LONG}, params(symbol, regime, rr_min) as (values {', '.join(f'({s!r}, {g!r}, {v})' for s, g, v in _PARAMS)}), fit as (select l.event_id, l.rr, l.pnl, row_number() over (partition by l.event_id order by l.rr) as k from long l join regimes g on g.event_id = l.event_id join params p on p.symbol = g.symbol and p.regime = g.regime where l.rr >= p.rr_min) select event_id, rr, round(pnl, 6) as pnl from fit where k = 1")
def param_lookup(spark, sf):
    params = spark.createDataFrame(_PARAMS, "symbol string, regime string, rr_min double")
    g = _regimes(spark, sf).select("event_id", "symbol", "regime")
    rows = rt.long_results(view(spark, sf, "grid_v"), ["event_id"]).join(g, "event_id")
    return rounded(rt.chosen_result(rows, params, ["symbol", "regime"], ["event_id"]))


_CUTS = [("click", "CALM", "obi_5", -0.5, None), ("click", "CALM", "quote_churn_10s", None, 60.0), ("view", "NORMAL", "obi_5", 0.0, 0.8), ("view", "NORMAL", "quote_churn_10s", 10.0, None), ("error", "CALM", "obi_5", None, 0.5)]
_sql = lambda v: "null" if v is None else repr(v)
_STRICT = f"""{_REGIME}, cutoffs(symbol, regime, feature, least, most) as (values {', '.join('(' + ', '.join(_sql(v) for v in c) + ')' for c in _CUTS)}),
fx as (select event_id, symbol, regime, 'obi_5' as feature, obi_5 as v from regimes union all select event_id, symbol, regime, 'quote_churn_10s', quote_churn_10s from regimes),
judged as (select f.*, case when v is null or (least is null and most is null) then 'na' when v >= coalesce(least, -1e300) and v <= coalesce(most, 1e300) then 'keep' else 'reject' end as verdict from fx f left join cutoffs c using (symbol, regime, feature))"""


def _reasons(spark, sf):
    cuts = spark.createDataFrame(_CUTS, "symbol string, regime string, feature string, least double, most double")
    return rt.strict_reasons(_regimes(spark, sf), cuts, ["obi_5", "quote_churn_10s"], ["event_id"], ["symbol", "regime"])


@query("F08_strict_filter", f"with {_STRICT} select event_id, bool_and(verdict = 'keep') as kept from judged group by event_id")
def strict_filter(spark, sf):
    return rt.strict_filter(_reasons(spark, sf), ["event_id"], ["symbol", "regime"]).select("event_id", "kept")


_FLAGS = [("click", "CALM", "net_delta_15s", None, None, 1), ("view", "NORMAL", "net_delta_15s", None, None, 0), ("error", "CALM", "net_delta_15s", -5.0, None, None)]


@query("F08_binary_cutoffs", f"with {_REGIME}, cutoffs(symbol, regime, feature, least, most, keep) as (values {', '.join('(' + ', '.join(_sql(v) for v in c) + ')' for c in _FLAGS)}) select event_id, case when net_delta_15s is null or (least is null and keep is null) then 'na' when keep is not null then case when (net_delta_15s <> 0) = (keep <> 0) then 'keep' else 'reject' end when net_delta_15s >= least then 'keep' else 'reject' end as verdict from regimes left join cutoffs using (symbol, regime)")
def binary_cutoffs(spark, sf):
    """A feature that must be 0, or must not be, beside one with a range."""
    cuts = spark.createDataFrame(_FLAGS, "symbol string, regime string, feature string, least double, most double, keep int")
    return rt.strict_reasons(_regimes(spark, sf), cuts, ["net_delta_15s"], ["event_id"], ["symbol", "regime"]).select("event_id", "verdict")


@query("F09_reject_reasons", f"with {_STRICT} select symbol, regime, feature, count(*) filter (where verdict = 'keep') as n_keep, count(*) filter (where verdict = 'reject') as n_reject, count(*) filter (where verdict = 'na') as n_na from judged group by all")
def reject_reasons(spark, sf):
    counts_of = [F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("keep", "reject", "na")]
    return _reasons(spark, sf).groupBy("symbol", "regime", "feature").agg(*counts_of)


@query("F09_reasons_by_row", f"with {_STRICT} select event_id, coalesce(string_agg(feature, ';' order by feature) filter (where verdict <> 'keep'), '') as why from judged group by event_id")
def reasons_by_row(spark, sf):
    return rt.strict_filter(_reasons(spark, sf), ["event_id"], ["symbol", "regime"]).select("event_id", "why")


_VOTE = f"""{_REGIME}, q as (select regime, quantile_cont(spread_bps_entry, 0.6) as s, quantile_cont(quote_churn_10s, 0.6) as c, quantile_cont(obi_5, 0.4) as o, quantile_cont(aggr_ratio_10s, 0.4) as f from regimes group by regime),
vote as (select event_id, symbol, regime, t, (spread_bps_entry <= s)::int + (quote_churn_10s <= c)::int + (obi_5 >= o)::int + case when regime = 'CALM' then 0 else (aggr_ratio_10s >= f)::int end as yes,
 case when regime = 'CALM' then 3 else 4 end as there, "pnl_net_rr1.00_rf10_ts60" as pnl from regimes join q using (regime)),
voted as (select *, yes >= case when regime = 'CALM' then there else 3 end as kept from vote)"""


def _voted(spark, sf):
    g = kept(_regimes(spark, sf), "regimes")
    shares = {"s": ("spread_bps_entry", 0.6), "c": ("quote_churn_10s", 0.6), "o": ("obi_5", 0.4), "f": ("aggr_ratio_10s", 0.4)}
    cuts = exact_percentiles(g, shares, ["regime"])
    j = g.join(F.broadcast(cuts), "regime")
    calm = F.col("regime") == "CALM"
    there = lambda n: F.col(n).isNotNull()
    conditions = {
        "spread": (F.col("spread_bps_entry") <= F.col("s"), there("s") & there("spread_bps_entry")),
        "churn": (F.col("quote_churn_10s") <= F.col("c"), there("c") & there("quote_churn_10s")),
        "obi": (F.col("obi_5") >= F.col("o"), there("o") & there("obi_5")),
        "flux": (F.col("aggr_ratio_10s") >= F.col("f"), there("f") & there("aggr_ratio_10s") & ~calm),
    }
    votes = [F.coalesce(c & p, F.lit(False)).cast("int") for c, p in conditions.values()]
    return j.withColumns({"kept": rt.majority_vote(conditions, calm), "yes": votes[0] + votes[1] + votes[2] + votes[3], "pnl": F.col("`pnl_net_rr1.00_rf10_ts60`").cast("double")})


@query("F10_majority_vote", f"with {_VOTE} select event_id, kept from voted")
def majority_vote(spark, sf):
    return _voted(spark, sf).select("event_id", "kept")


@query("A38_vote_shares", f"with {_VOTE} select regime, yes, count(*) as n, round(count(*) / sum(count(*)) over (partition by regime), 5) as share from voted group by regime, yes")
def vote_shares(spark, sf):
    return rounded(rt.shares_by(_voted(spark, sf), ["regime"], "yes"), 5)


_EXPECT = "count(pnl) as n_all, round(avg(pnl) * 1e4, 9) as ev_all, count(pnl) filter (where kept) as n_kept, round(avg(pnl) filter (where kept) * 1e4, 9) as ev_kept, round(avg((pnl > 0)::int) filter (where kept), 5) as winrate, round(count(pnl) filter (where kept) / count(pnl), 5) as coverage"


def _expect(df, by):
    out = rt.expectancy(df, by, "pnl", "kept")
    return out.select(*by, "n_all", r(F.col("ev_all") * 1e4, 9).alias("ev_all"), "n_kept", r(F.col("ev_kept") * 1e4, 9).alias("ev_kept"), r("winrate", 5).alias("winrate"), r("coverage", 5).alias("coverage"))


@query("A34_symbol_expectancy", f"with {_VOTE} select symbol, {_EXPECT}, count(pnl) filter (where kept) < 50 as few from voted group by symbol")
def symbol_expectancy(spark, sf):
    v = _voted(spark, sf)
    few = rt.expectancy(v, ["symbol"], "pnl", "kept", least=50).select("symbol", "few")
    return _expect(v, ["symbol"]).join(few, "symbol")


#: Votes: feature to (op, share); the last one is the flux, which CALM rows don't vote on.
_FEATURES = {"spread_bps_entry": ("<", 0.6), "quote_churn_10s": ("<", 0.6), "obi_5": (">", 0.4), "aggr_ratio_10s": (">", 0.4)}
_N0, _LEAST = 30, 10

#: Thresholds used in each month (of six days): fixed ones of the first days, and rolling ones; expressions up to ``used``.
_ROLLING = f"""{_REGIME},
feats as (select event_id, symbol, regime, t, day(t) // 6 as month, feature, op, q, v from regimes, lateral (values
  {", ".join(f"('{f}', '{op}', {q}, {f}::double)" for f, (op, q) in _FEATURES.items())}) x(feature, op, q, v)),
priors as (select regime, feature, min(op) as op, case when min(q) = 0.6 then quantile_cont(v, 0.6) else quantile_cont(v, 0.4) end as prior from feats where day(t) <= 10 group by regime, feature),
loc as (select symbol, regime, feature, month, case when min(q) = 0.6 then quantile_cont(v, 0.6) else quantile_cont(v, 0.4) end as v, count(v) as n from feats group by symbol, regime, feature, month),
seq as (select l.*, op, prior, row_number() over (partition by symbol, regime, feature order by month) as k from loc l join priors using (regime, feature)),
calc as (select *, n / (n + {_N0})::double as a from seq),
fold as (
  select symbol, regime, feature, op, month, k, n, v, a, prior as used from calc where k = 1
  union all
  select c.symbol, c.regime, c.feature, c.op, c.month, c.k, c.n, c.v, c.a,
    case when f.regime = 'CALM' or f.n < {_LEAST} then f.used
         when f.n >= {_N0} and f.op = '<' then least(f.used, least(greatest((1 - f.a) * f.used + f.a * f.v, f.used - abs(f.used) * 0.07), f.used + abs(f.used) * 0.07))
         when f.n >= {_N0} then greatest(f.used, least(greatest((1 - f.a) * f.used + f.a * f.v, f.used - abs(f.used) * 0.07), f.used + abs(f.used) * 0.07))
         else least(greatest((1 - f.a) * f.used + f.a * f.v, f.used - abs(f.used) * 0.07), f.used + abs(f.used) * 0.07) end
  from fold f join calc c on c.symbol = f.symbol and c.regime = f.regime and c.feature = f.feature and c.k = f.k + 1),
used as (select f.symbol, f.regime, f.feature, f.op, f.month, f.used as rolling, p.prior as fixed from fold f join priors p using (regime, feature))"""


def _thresholds(spark, sf):
    """(symbol, regime, feature, op, month, fixed, rolling), a row for each group and month of the rows."""
    g = _regimes(spark, sf).withColumn("month", F.floor(F.dayofmonth("t") / 6))
    each = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(op).alias("op"), F.lit(q).alias("q"), F.col(f).cast("double").alias("v")) for f, (op, q) in _FEATURES.items()])
    long = g.select("symbol", "regime", "t", "month", F.inline(each))
    shares = {f"c{k}": q for k, q in enumerate(sorted({q for _, q in _FEATURES.values()}))}

    def cut(by, rows):
        found = stats_by(rows, by, [F.min("q").alias("q"), F.min("op").alias("op"), F.count("v").alias("n")], {c: ("v", q) for c, q in shares.items()})
        return found.withColumn("c", F.coalesce(*[F.when(F.col("q") == q, F.col(c)) for c, q in shares.items()]))

    priors = cut(["regime", "feature"], long.where(F.dayofmonth("t") <= 10)).select("regime", "feature", F.col("c").alias("fixed"))
    local = cut(["symbol", "regime", "feature", "month"], long).join(F.broadcast(priors), ["regime", "feature"]).withColumn("on", F.col("regime") != "CALM")
    by = ["symbol", "regime", "feature", "op"]
    out = rt.rolling_thresholds(local, by, "month", "fixed", "c", "n", _N0, _LEAST, enabled="on")
    return out.withColumnRenamed("used", "rolling").join(F.broadcast(priors), ["regime", "feature"])


@query("W12_rolling_thresholds", f"with recursive {_ROLLING} select symbol, regime, feature, op, month, round(fixed, 6) as fixed, round(rolling, 6) as rolling from used")
def rolling_thresholds(spark, sf):
    return rounded(_thresholds(spark, sf).select("symbol", "regime", "feature", "op", "month", "fixed", "rolling"))


_MODES = """wide as (select symbol, regime, month, """ + ", ".join(f"max(case when feature = '{f}' then {c} end) as {c[0]}_{f}" for f in _FEATURES for c in ("fixed", "rolling")) + """ from used group by 1, 2, 3),
ballots as (select g.event_id, g.symbol, g.regime, w.month, "pnl_net_rr1.00_rf10_ts60"::double as pnl, """ + ", ".join(f"coalesce({f} {op}= {c[0]}_{f}, false)::int as {c[0]}{k}" for k, (f, (op, _)) in enumerate(_FEATURES.items()) for c in ("fixed", "rolling")) + """, g.regime = 'CALM' as calm
  from regimes g join wide w on w.symbol = g.symbol and w.regime = g.regime and w.month = day(g.t) // 6),
modes as (
  select *, 'fixed_noflux' as mode, f0 + f1 + f2 >= case when calm then 3 else 2 end as kept from ballots
  union all select *, 'rolling_noflux', r0 + r1 + r2 >= case when calm then 3 else 2 end from ballots
  union all select *, 'fixed_flux', case when calm then f0 + f1 + f2 >= 3 else f0 + f1 + f2 + f3 >= 3 end from ballots
  union all select *, 'rolling_flux', case when calm then r0 + r1 + r2 >= 3 else r0 + r1 + r2 + r3 >= 3 end from ballots)"""


def _moded(spark, sf):
    """Every row in each of four modes: fixed or rolling thresholds, with or without the flux vote."""
    wide = _thresholds(spark, sf).groupBy("symbol", "regime", "month").agg(*[F.max(F.when(F.col("feature") == f, F.col(c))).alias(f"{c}_{f}") for f in _FEATURES for c in ("fixed", "rolling")])
    g = _regimes(spark, sf).withColumns({"month": F.floor(F.dayofmonth("t") / 6), "pnl": F.col("`pnl_net_rr1.00_rf10_ts60`").cast("double")})
    rows = g.join(F.broadcast(wide), ["symbol", "regime", "month"])
    calm = F.col("regime") == "CALM"

    def vote(kind, flux):
        conditions = {}
        for k, (f, (op, _)) in enumerate(_FEATURES.items()):
            limit = F.col(f"{kind}_{f}")
            there = F.col(f).isNotNull() & limit.isNotNull()
            there = there & F.lit(flux) & ~calm if k == 3 else there
            conditions[f] = (F.col(f) <= limit if op == "<" else F.col(f) >= limit, there)
        return rt.majority_vote(conditions, calm)

    modes = F.array(*[F.struct(F.lit(f"{kind}_{'flux' if flux else 'noflux'}").alias("mode"), vote(kind, flux).alias("kept")) for kind in ("fixed", "rolling") for flux in (False, True)])
    return rows.select("event_id", "symbol", "regime", "month", "pnl", F.inline(modes))


@query("A35_monthly_expectancy", f"with recursive {_ROLLING}, {_MODES} select month, mode, {_EXPECT} from modes group by month, mode")
def monthly_expectancy(spark, sf):
    return _expect(_moded(spark, sf), ["month", "mode"])


@query("M09_router_evaluation", f"with recursive {_ROLLING}, {_MODES} select symbol, regime, month, mode, {_EXPECT} from modes group by all")
def router_evaluation(spark, sf):
    """The job's diagnostic table: each symbol, regime, month and mode."""
    return _expect(_moded(spark, sf), ["symbol", "regime", "month", "mode"])


@query("M09_strict_evaluation", f"with {_STRICT}, k as (select event_id, bool_and(verdict = 'keep') as kept from judged group by event_id), j as (select r.symbol, r.regime, k.kept, \"pnl_net_rr1.00_rf10_ts60\"::double as pnl from regimes r join k using (event_id)) select symbol, regime, {_EXPECT} from j group by symbol, regime")
def strict_evaluation(spark, sf):
    """The job with strict cut-offs instead of votes."""
    kept = rt.strict_filter(_reasons(spark, sf), ["event_id"], ["symbol", "regime"]).select("event_id", "kept")
    rows = _regimes(spark, sf).select("event_id", "symbol", "regime", F.col("`pnl_net_rr1.00_rf10_ts60`").cast("double").alias("pnl"))
    return _expect(rows.join(kept, "event_id"), ["symbol", "regime"])


@query("M09_router_column", f"with {_STRICT}, {_LONG}, params(symbol, regime, rr_min) as (values {', '.join(f'({s!r}, {g!r}, {v})' for s, g, v in _PARAMS)}), fit as (select l.event_id, l.pnl, row_number() over (partition by l.event_id order by l.rr) as n from long l join regimes g on g.event_id = l.event_id join params p on p.symbol = g.symbol and p.regime = g.regime where l.rr >= p.rr_min), k as (select event_id, bool_and(verdict = 'keep') as kept from judged group by event_id), j as (select r.symbol, r.regime, k.kept, fit.pnl::double as pnl from regimes r join k using (event_id) join fit on fit.event_id = r.event_id and fit.n = 1) select symbol, regime, {_EXPECT} from j group by symbol, regime")
def router_column(spark, sf):
    """The strict job on the result that its parameters choose for each symbol and regime; rows without one are left out."""
    kept = rt.strict_filter(_reasons(spark, sf), ["event_id"], ["symbol", "regime"]).select("event_id", "kept")
    g = _regimes(spark, sf).select("event_id", "symbol", "regime")
    params = spark.createDataFrame(_PARAMS, "symbol string, regime string, rr_min double")
    rows = rt.long_results(view(spark, sf, "grid_v"), ["event_id"]).join(g, "event_id")
    chosen = rt.chosen_result(rows, params, ["symbol", "regime"], ["event_id"]).drop("rr")
    return _expect(g.join(chosen, "event_id").join(kept, "event_id"), ["symbol", "regime"])


@query("A35_recap", f"with recursive {_ROLLING}, {_MODES}, m as (select month, mode, count(pnl) filter (where kept) as n, avg(pnl) filter (where kept) as e, avg((pnl > 0)::int) filter (where kept) as w from modes group by month, mode) select mode, sum(n)::bigint as n, round(sum(n * e) / sum(case when e is not null then n end) * 1e4, 8) as ev_bps, round(sum(n * w) / sum(case when w is not null then n end), 8) as winrate from m group by mode")
def monthly_recap(spark, sf):
    """The months of each mode put together, weighted by their trades."""
    monthly = rt.expectancy(_moded(spark, sf), ["month", "mode"], "pnl", "kept")
    return rounded(rt.recap(monthly, ["mode"], "n_kept", "ev_kept", "winrate"), 8)


_COMBOS = [("click", "CALM", 1.0, 10, 60), ("click", "NORMAL", 1.2, 10, 60), ("view", "VOLATILE", 2.0, 20, 90), ("error", "CALM", 2.0, 10, 60)]


@query("A36_columns", f"with {_REGIME}, params(symbol, regime, chosen) as (values {', '.join(f'({s!r}, {g!r}, {f"pnl_net_rr{rr:.2f}_rf{rf}_ts{ts}"!r})' for s, g, rr, rf, ts in _COMBOS)}), cutoffs(symbol, regime, feature) as (values {', '.join(f'({c[0]!r}, {c[1]!r}, {c[2]!r})' for c in [*_CUTS, ('click', 'CALM', 'gone_5s')])}), f as (select symbol, regime, count(*) as n_features, count(*) filter (where feature <> 'gone_5s') as n_present, coalesce(string_agg(feature, ';' order by feature) filter (where feature = 'gone_5s'), '') as missing from cutoffs group by all), g as (select symbol, regime, count(*) as n from regimes group by all) select symbol, regime, n, chosen, coalesce(chosen in ('pnl_net_rr1.00_rf10_ts60', 'pnl_net_rr1.50_rf10_ts60', 'pnl_net_rr2.00_rf20_ts90'), false)::int as combo_exists, coalesce(n_features, 0) as n_features, coalesce(n_present, 0) as n_present, coalesce(missing, '') as missing from g left join params using (symbol, regime) left join f using (symbol, regime)")
def column_presence(spark, sf):
    """Whether the chosen result column and the features of the cut-offs exist, for each symbol and regime."""
    params = spark.createDataFrame(_COMBOS, "symbol string, regime string, rr_min double, rf int, ts int")
    cuts = spark.createDataFrame([c[:3] for c in _CUTS] + [("click", "CALM", "gone_5s")], "symbol string, regime string, feature string")
    n = _regimes(spark, sf).groupBy("symbol", "regime").agg(F.count("*").alias("n"))
    return rt.presence(n, params, cuts, view(spark, sf, "grid_v").columns, ["symbol", "regime"])


@query("A36_coverage", f"with {_STRICT}, params(symbol, regime, rr_min) as (values {', '.join(f'({s!r}, {g!r}, {v})' for s, g, v in _PARAMS)}) select symbol, regime, count(*) as n, max((rr_min is not null)::int) as has_params, max(coalesce(k, 0)) as n_cuts from regimes left join params using (symbol, regime) left join (select symbol, regime, count(*) as k from cutoffs group by all) using (symbol, regime) group by symbol, regime")
def coverage(spark, sf):
    params = spark.createDataFrame(_PARAMS, "symbol string, regime string, rr_min double")
    cuts = spark.createDataFrame([c[:3] for c in _CUTS], "symbol string, regime string, feature string").groupBy("symbol", "regime").agg(F.count("*").alias("n_cuts"))
    n = _regimes(spark, sf).groupBy("symbol", "regime").agg(F.count("*").alias("n"))
    j = n.join(F.broadcast(params), ["symbol", "regime"], "left").join(F.broadcast(cuts), ["symbol", "regime"], "left")
    return j.select("symbol", "regime", "n", F.col("rr_min").isNotNull().cast("int").alias("has_params"), F.coalesce("n_cuts", F.lit(0)).alias("n_cuts"))


_GRID = {"spread_bps_entry": ("<", [0.3, 0.5, 0.7]), "quote_churn_10s": ("<", [0.4, 0.6, 0.8]), "obi_5": (">", [0.2, 0.4, 0.6])}
_points = lambda k, f, qs: f"p{k} as (select regime, unnest({qs}) as q_{f}, unnest(quantile_cont({f}, {qs})) as l{k} from regimes group by regime)"
_GRID_SQL = f"""{_REGIME}, {", ".join(_points(k, f, qs) for k, (f, (_, qs)) in enumerate(_GRID.items()))},
totals as (select regime, count("pnl_net_rr1.00_rf10_ts60") as all_n from regimes group by regime),
passed as (select g.regime, {", ".join(f"q_{f}" for f in _GRID)}, day(t) // 10 as month, "pnl_net_rr1.00_rf10_ts60"::double as pnl
  from regimes g join p0 using (regime) join p1 using (regime) join p2 using (regime)
  where {" + ".join(f"coalesce({f} {op} l{k}, false)::int" for k, (f, (op, _)) in enumerate(_GRID.items()))} >= 2),
monthly as (select regime, {", ".join(f"q_{f}" for f in _GRID)}, month, count(pnl) as n, sum(pnl) as s, count(*) filter (where pnl > 0) as w from passed group by all)"""


@query("A37_grid_search", f"with {_GRID_SQL} select regime, {', '.join(f'q_{f}::double as q_{f}' for f in _GRID)}, sum(n)::bigint as n, round(sum(n) / min(all_n), 5) as coverage, round(sum(s) / sum(n) * 1e4, 9) as ev, round(sum(w) / sum(n), 5) as winrate, min(n) as least_month from monthly join totals using (regime) group by all having regime <> 'CALM'")
def grid_search(spark, sf):
    """Three features with two votes of three, in the regimes that are searched."""
    g = _regimes(spark, sf).where("regime <> 'CALM'").withColumns({"pnl": F.col("`pnl_net_rr1.00_rf10_ts60`").cast("double"), "month": F.floor(F.dayofmonth("t") / 10)})
    out = rt.grid_search(g, "pnl", _GRID, "month", ["regime"], 2)
    return out.select("regime", *[f"q_{f}" for f in _GRID], "n", r("coverage", 5).alias("coverage"), r(F.col("ev") * 1e4, 9).alias("ev"), r("winrate", 5).alias("winrate"), "least_month")


_FLUX = [0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]


@query("A37_flux_grid", f"with {_REGIME}, p as (select regime, unnest({_FLUX}) as q, unnest(quantile_cont(aggr_ratio_10s, {_FLUX})) as lim from regimes group by regime), totals as (select regime, count(*) as all_n from regimes group by regime), t as (select regime, q::double as q_aggr_ratio_10s, count(*) as n, count(*) / min(all_n)::double as cov, avg(\"pnl_net_rr1.00_rf10_ts60\") as e, avg((\"pnl_net_rr1.00_rf10_ts60\" > 0)::int) as w from regimes join p using (regime) join totals using (regime) where aggr_ratio_10s > lim group by regime, q), k as (select *, row_number() over (partition by regime order by round(e * 1e4, 9) desc, round(w, 5) desc, n desc, q_aggr_ratio_10s) as place from t where n >= 5 and cov between 0.08 and 0.5) select regime, q_aggr_ratio_10s, n, round(cov, 5) as coverage, round(e * 1e4, 9) as ev, round(w, 5) as winrate, place from k where place <= 20")
def flux_grid(spark, sf):
    """The flux alone, in each regime: the best points, twenty at most, whose coverage is in the tunnel."""
    g = _regimes(spark, sf).withColumns({"pnl": F.col("`pnl_net_rr1.00_rf10_ts60`").cast("double"), "month": F.lit(0)})
    out = rt.grid_search(g, "pnl", {"aggr_ratio_10s": (">", _FLUX)}, "month", ["regime"], 1)
    out = out.where("n >= 5 and coverage between 0.08 and 0.5").select(
        "regime", "q_aggr_ratio_10s", "n", r("coverage", 5).alias("coverage"), r(F.col("ev") * 1e4, 9).alias("ev"), r("winrate", 5).alias("winrate")
    )
    best = W.partitionBy("regime").orderBy(F.desc("ev"), F.desc("winrate"), F.desc("n"), "q_aggr_ratio_10s")
    return out.withColumn("place", F.row_number().over(best)).where("place <= 20")


_PROBE = "select symbol, day(timestamp) // 10 as part, count(*) as n_rows, epoch_us(min(timestamp)) as first_us, epoch_us(max(timestamp)) as last_us, epoch_us(min(received_time)) as first_received_us, epoch_us(max(received_time)) as last_received_us, quantile_cont((seq % 7 - 1)::double, 0.5) as latency_p50, quantile_cont((seq % 7 - 1)::double, 0.9) as latency_p90, quantile_cont((seq % 7 - 1)::double, 0.99) as latency_p99, count(*) filter (where seq % 7 = 0) as latency_negative, 1 - count(distinct epoch_us(timestamp) // 3600000000) / (max(epoch_us(timestamp) // 3600000000) - min(epoch_us(timestamp) // 3600000000) + 1) as gap_ratio, count(*) filter (where bid_0_price >= ask_0_price) as crossed, count(*) filter (where seq < before) as seq_falls, quantile_cont(ask_0_price - bid_0_price, 0.1) as spread_p10, quantile_cont(ask_0_price - bid_0_price, 0.5) as spread_p50, quantile_cont(ask_0_price - bid_0_price, 0.9) as spread_p90 from b group by 1, 2"
_ROUNDED = ("latency_p50", "latency_p90", "latency_p99", "gap_ratio", "spread_p10", "spread_p50", "spread_p90")


@query("A29_book_probe", f"""with b as (select *, timestamp + (seq % 7 - 1) * interval 1 millisecond as received_time, lag(seq) over (partition by symbol, day(timestamp) // 10 order by timestamp, seq) as before from book_v), p as ({_PROBE}),
tr as (select symbol, day(timestamp) // 10 as part, count(*) as n_trades from trades_v where timestamp >= timestamp '2024-01-10' group by 1, 2),
grid as (select symbol, part from (select distinct symbol from trades_v union all select 'ghost') cross join (values (0), (1), (2), (3)) v(part))
select grid.symbol, grid.part, coalesce(n_rows, 0) as n_rows, coalesce(n_trades, 0) as n_trades, first_us, last_us, first_received_us, last_received_us, {', '.join(f'round({c}, 5) as {c}' for c in _ROUNDED)}, latency_negative, crossed, seq_falls,
 concat_ws(';', case when n_rows is null then 'no_book' end, case when n_trades is null then 'no_trades' end, case when coalesce(gap_ratio, 1.0) > 0.3 then 'gaps' end, case when latency_p99 > 4 then 'late' end, case when latency_negative > 0 then 'negative_latency' end, case when crossed > 0 then 'crossed' end) as flags
from grid left join p using (symbol, part) left join tr using (symbol, part)""")
def book_probe(spark, sf):
    """Each expected symbol and part of the month, missing ones too."""
    part = F.floor(F.dayofmonth("timestamp") / 10)
    b = view(spark, sf, "book_v").withColumns({"received_time": F.timestamp_micros(F.unix_micros("timestamp") + (F.col("seq") % 7 - 1) * 1000), "part": part})
    t = view(spark, sf, "trades_v").withColumn("part", part)
    symbols = t.select("symbol").distinct().union(spark.createDataFrame([("ghost",)], "symbol string"))
    expected = symbols.select("symbol", F.explode(F.array(*[F.lit(k).cast("long") for k in range(4)])).alias("part"))
    out = ql.io_scan(b, t.where("timestamp >= timestamp '2024-01-10'"), expected, ["symbol", "part"], 3600, 0.3, 4.0)
    return rounded(out, 5)


@query("A30_book_checks", """with b as (select *, lag(timestamp) over (partition by symbol order by timestamp, seq) as before, lag(seq) over (partition by symbol order by timestamp, seq) as seq_before from book_v),
c as (select symbol, count(*) filter (where timestamp = before) as same_time, count(*) filter (where bid_0_price >= ask_0_price) as crossed, count(*) filter (where not (bid_0_price > 0 and ask_0_price > 0)) as no_price, count(*) filter (where (epoch_us(timestamp) - epoch_us(before)) / 1e6 > 7200) as gap, count(*) filter (where seq < seq_before) as seq_falls,
 count(*) filter (where """ + " or ".join(f"bid_{i}_price > bid_{i - 1}_price or ask_{i}_price < ask_{i - 1}_price" for i in range(1, 15)) + """) as levels_out_of_order, count(*) filter (where """ + " or ".join(f"{s}_{i}_size <= 0" for i in range(15) for s in ("bid", "ask")) + """) as no_size, 1::bigint as missing_columns from b group by symbol)
select symbol, "check", n_bad from c unpivot (n_bad for "check" in (same_time, crossed, no_price, gap, seq_falls, levels_out_of_order, no_size, missing_columns))""")
def book_checks(spark, sf):
    return ql.book_checks(view(spark, sf, "book_v"), ["symbol"], ["timestamp", "seq", "received_time"], 15, 7200.0)


@query("A30_spread_stats", "select symbol, count(s) as n, count(*) filter (where s <= 0) as not_positive, count(*) filter (where s = 0) as zero, round(quantile_cont(s, 0.1), 6) as p10, round(quantile_cont(s, 0.5), 6) as p50, round(quantile_cont(s, 0.9), 6) as p90 from (select symbol, (ask_0_price - bid_0_price) / ((ask_0_price + bid_0_price) / 2) * 1e4 as s from book_v) group by symbol")
def spread_stats(spark, sf):
    return rounded(ql.spread_stats(view(spark, sf, "book_v"), ["symbol"]))


@query("A30_probes", "with span as (select symbol, epoch_us(min(timestamp)) as a, epoch_us(max(timestamp)) as b from book_v group by symbol), drawn as (select symbol, probe::int as probe, a + floor((b - a) / 1000 * ('0x' || substr(md5('7|' || symbol || '|' || probe), 1, 8))::bigint / 4294967296)::bigint * 1000 as t from span cross join range(5) r(probe)) select d.symbol, probe, count(k.timestamp) as n_rows, epoch_us(min(k.timestamp)) as first_us, epoch_us(max(k.timestamp)) as last_us from drawn d left join book_v k on k.symbol = d.symbol and epoch_us(k.timestamp) between t - 7200000000 and t + 7200000000 group by 1, 2")
def random_probes(spark, sf):
    """Five random windows of each symbol, two hours to either side."""
    return ql.probes(view(spark, sf, "book_v"), 5, 7200.0)


@query("A30_trade_checks", "select symbol, 'bad_price' as \"check\", count(*) filter (where price <= 100.5) as n_bad, count(*) filter (where price <= 100.5) <= 100 as ok from trades_v group by symbol union all select symbol, 'bad_qty', count(*) filter (where qty <= 0), count(*) filter (where qty <= 0) <= 100 from trades_v group by symbol union all select symbol, 'no_side', count(*) filter (where side is null), count(*) filter (where side is null) <= 100 from trades_v group by symbol")
def trade_checks(spark, sf):
    rules = {"bad_price": F.col("price") <= 100.5, "bad_qty": F.col("qty") <= 0, "no_side": F.col("side").isNull()}
    return ql.checks(view(spark, sf, "trades_v"), rules, ["symbol"], 100)


_ANOMALY = """c as (select symbol, timestamp, open, high, low, round(close, 0) as close, case when extract(hour from timestamp) in (3, 4) then 0 else volume end as volume from candles_v),
f as (select *, lag(close) over (partition by symbol order by timestamp) as pc, coalesce(close - lag(close) over (partition by symbol order by timestamp), 0) = 0 as flat, volume = 0 as still from c),
i as (select *, sum((not flat)::int) over (partition by symbol order by timestamp) as fi, sum((not still)::int) over (partition by symbol order by timestamp) as si from f),
k as (select *, row_number() over (partition by symbol, fi, flat order by timestamp) as fk, lead(timestamp) over (partition by symbol, fi, flat order by timestamp) is null as fe, row_number() over (partition by symbol, si, still order by timestamp) as sk, lead(timestamp) over (partition by symbol, si, still order by timestamp) is null as se from i),
anomalies as (select symbol, timestamp, 'flat_run' as type, 'warn' as severity from k where flat and fk >= 2 and fe
 union all select symbol, timestamp, 'zero_volume', 'warn' from k where still and sk >= 2 and se
 union all select symbol, timestamp, 'jump', 'error' from k where abs(close / pc - 1) > 0.3
 union all select symbol, timestamp, 'inconsistent', 'error' from k where high < greatest(open, close) or low > least(open, close)
 union all select symbol, timestamp, 'invalid', 'error' from k where open <= 0 or high <= 0 or low <= 0 or close <= 0 or volume < 0)"""


def _odd_candles(spark, sf):
    c = view(spark, sf, "candles_v")
    return c.withColumns({"close": F.round("close", 0), "volume": F.when(F.hour("timestamp").isin(3, 4), 0.0).otherwise(F.col("volume"))})


@query("A31_anomalies", f"with {_ANOMALY} select symbol, epoch_us(timestamp) as timestamp, type, severity from anomalies")
def anomalies(spark, sf):
    return us(ql.anomalies(_odd_candles(spark, sf), 2, 0.3), "timestamp")


@query("A32_consecutive_runs", "with i as (select *, epoch(timestamp)::bigint - row_number() over (partition by symbol order by timestamp) * 3600 as g from candles_v), n as (select *, count(*) over (partition by symbol, g) as n from i) select symbol, epoch_us(timestamp) as timestamp from n where n >= 5")
def consecutive_runs(spark, sf):
    return us(ql.consecutive_runs(view(spark, sf, "candles_v"), 3600, 5).select("symbol", "timestamp"), "timestamp")


@query("K05_cleaned", f"with {_ANOMALY} select symbol, epoch_us(timestamp) as timestamp from c where (symbol, timestamp) not in (select symbol, timestamp from anomalies where type in ('zero_volume', 'flat_run'))")
def cleaned(spark, sf):
    c = _odd_candles(spark, sf)
    bad = ql.anomalies(c, 2, 0.3).where(F.col("type").isin("zero_volume", "flat_run"))
    return us(ql.cleaned(c, bad).select("symbol", "timestamp"), "timestamp")


@query("A33_gap_report", "with g as (select *, epoch(timestamp)::bigint - epoch(lag(timestamp) over (partition by symbol order by timestamp))::bigint as gap from candles_v) select symbol, count(*) as n_rows, count(*) filter (where gap > 3600) as n_gaps, max(gap) as largest_gap, count(*) filter (where gap = 0) as duplicates, epoch_us(min(timestamp)) as first_us, epoch_us(max(timestamp)) as last_us from g group by symbol")
def gap_report(spark, sf):
    return ql.gap_report(view(spark, sf, "candles_v"), 3600)


@query("M10_candle_cleaning", f"""with {_ANOMALY},
runs as (select symbol, timestamp, epoch(timestamp)::bigint - row_number() over (partition by symbol order by timestamp) * 3600 as g from (select distinct symbol, timestamp from anomalies where type = 'flat_run')),
long_runs as (select symbol, timestamp from (select *, count(*) over (partition by symbol, g) as n from runs) where n >= 2),
bad as (select symbol, timestamp, 'zero_volume' as why from anomalies where type = 'zero_volume' union all select symbol, timestamp, 'flat_run' from long_runs
 union all select symbol, timestamp, 'excluded' from c where timestamp >= timestamp '2024-01-10' and timestamp < timestamp '2024-01-11 12:00:00' and symbol in ('click', 'view')),
first_of as (select symbol, timestamp, min(why) as why from bad group by all)
select symbol, count(*) as n_all, count(*) filter (where why is null) as n_left, round(coalesce(sum(volume) filter (where why is null), 0), 4) as volume, count(*) filter (where why = 'zero_volume') as n_zero_volume, count(*) filter (where why = 'flat_run') as n_flat_run, count(*) filter (where why = 'excluded') as n_excluded
from c left join first_of using (symbol, timestamp) group by symbol""")
def candle_cleaning(spark, sf):
    """What the cleaning of each symbol leaves, and what it drops for which reason; runs of two hours at the fixture's scale."""
    c = _odd_candles(spark, sf)
    windows = spark.createDataFrame([("click",), ("view",)], "symbol string").select(
        "symbol", F.lit("2024-01-10").cast("timestamp").alias("start"), F.lit("2024-01-11 12:00:00").cast("timestamp").alias("end")
    )
    out = ql.auto_cleaned(c, ql.anomalies(c, 2, 0.3), 3600, 2, windows)
    dropped = [F.count_if(F.col("why") == w).alias(f"n_{w}") for w in ("zero_volume", "flat_run", "excluded")]
    left = F.coalesce(F.sum(F.when(F.col("why").isNull(), F.col("volume"))), F.lit(0.0)).alias("volume")
    return rounded(out.groupBy("symbol").agg(F.count("*").alias("n_all"), F.count_if(F.col("why").isNull()).alias("n_left"), left, *dropped), 4)


@query("K01_sorted", "select symbol, trade_id, round(price, 6) as price from trades_v")
def sorted_rows(spark, sf):
    t = view(spark, sf, "trades_v").orderBy("timestamp", "symbol", "trade_id")
    return rounded(t.select("symbol", "trade_id", "price"))


@query("K02_top_days", "select * from (select epoch_us(day) as day, round(avg(pnl_net_bps), 5) as ev from router_v group by day order by avg(pnl_net_bps) desc, day limit 10)")
def top_days(spark, sf):
    d = _router(spark, sf).groupBy("day").agg(F.avg("v").alias("ev")).orderBy(F.desc("ev"), "day").limit(10)
    return us(rounded(d, 5), "day")


@query("K03_multi_key_rank", "select symbol, vol_bucket, row_number() over (order by avg(score) desc nulls last, avg((pnl_net_bps > 0)::int) desc, count(*) desc, symbol, vol_bucket) as place from router_v group by symbol, vol_bucket")
def multi_key_rank(spark, sf):
    g = _router(spark, sf).groupBy("symbol", "vol_bucket").agg(F.avg("score").alias("s"), F.avg((F.col("v") > 0).cast("int")).alias("w"), F.count("*").alias("n"))
    order = W.orderBy(F.desc_nulls_last("s"), F.desc("w"), F.desc("n"), "symbol", "vol_bucket")
    return g.select("symbol", "vol_bucket", F.row_number().over(order).alias("place"))


@query("K04_union", "select event_id, 'base' as strategy from router_v union all select event_id, 'mr' from router_v where router_pick = 'MR'")
def union(spark, sf):
    t = view(spark, sf, "router_v")
    a = t.select("event_id", F.lit("base").alias("strategy"))
    return a.unionByName(t.where("router_pick = 'MR'").select("event_id", F.lit("mr").alias("strategy")))

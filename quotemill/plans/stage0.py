"""Walk-forward tagging: buckets, features, thresholds of the training days, funnel and labels of the test days."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.functions import expr as x
from quotemill.operators import windows as w
from quotemill.operators.bucketing import last_snapshots, trade_flow, with_flow
from quotemill.sources.scratch import stored
from quotemill.sources.views import view


@dataclass(frozen=True)
class Stage0:
    """Time constants; the defaults suit the derived tape (see sources.views), LIVE an exchange feed."""

    step: str = "1 hour"
    flow_rows: int = 8
    flow_seconds: float = 8 * 3600.0
    spread_short: float = 2 * 3600.0
    spread_long: float = 24 * 3600.0
    range_rows: int = 12
    long_range_rows: int = 48
    persist_cap_ms: int = 6 * 3600 * 1000
    thin_seconds: float = 4 * 3600.0
    tick: float = 0.1


LIVE = Stage0("250 milliseconds", 8, 2.0, 1.0, 300.0, 240, 2400, 800, 2.0, 0.1)


def features(book: DataFrame, trades: DataFrame, c: Stage0 = Stage0()) -> DataFrame:
    """One row for each (symbol, bucket) with a valid last snapshot, with all features of the funnel.

    Buckets, and the features that need no time windows, are written once: several branches read each.
    """
    out = stored(with_flow(last_snapshots(book, c.step), trade_flow(trades, c.step)).withColumn("mid", x.mid()), "buckets")
    flow = {f"{n}_w": (F.sum(n), c.flow_rows) for n in ("notional_buy", "notional_sell", "ntr")}
    ranges = {"range60": ("mid", c.range_rows), "range600": ("mid", c.long_range_rows)}
    out = w.flow_rates(w.over_rows(out, ["bucket"], flow, ranges), c.flow_seconds)
    out = out.withColumns(snapshot_columns(c))
    out = out.withColumns({f"obi{k}": x.imbalance(F.col(f"db{k}"), F.col(f"da{k}")) for k in _K})
    out = out.withColumns({"dir0": x.direction("ti", "micro_bias"), "sign_micro": x.sign("micro_bias"), "sign_obi": x.sign("obi10")})
    out = out.withColumns({f"opp{k}": F.when(F.col("dir0") > 0, F.col(f"da{k}")).otherwise(F.col(f"db{k}")) for k in (3, 10)})
    out = out.withColumns({"range60_bps": w.range_bps("mid", c.range_rows, "range60"), "range600_bps": w.range_bps("mid", c.long_range_rows, "range600")})
    out = stored(out, "bucket-features")
    out = w.with_persistence(out, {"persist_micro_ms": "sign_micro", "persist_obi_ms": "sign_obi"}, c.persist_cap_ms, ["bucket"])
    out = w.time_medians(out, c.spread_short, c.spread_long, {"thin3": "opp3", "thin10": "opp10"}, c.thin_seconds)
    return out.withColumns({"abs_micro": F.abs("micro_bias"), "abs_obi10": F.abs("obi10"), "abs_ti": F.abs("ti")})


def snapshot_columns(c: Stage0 = Stage0()) -> dict[str, Column]:
    """What a snapshot has by itself: spread, bias of the microprice, and depths."""
    depths = {f"{'db' if s == 'bid' else 'da'}{k}": x.depth(s, k) for s in ("bid", "ask") for k in _K}
    return {"spread_bps": x.spread_bps(), "spread_ticks": x.spread_ticks(c.tick), "micro_bias": x.micro_bias_bps(), **depths}


def tape_features(spark: SparkSession, sf_dir: str, c: Stage0 = Stage0()) -> DataFrame:
    return features(view(spark, sf_dir, "book_v"), view(spark, sf_dir, "trades_v"), c)


def is_train(ts="bucket"):
    """The fixture's split: days up to the 20th are for fitting."""
    return F.dayofmonth(ts) <= 20


_sum = lambda s, k: " + ".join(f"{s}_{i}_size" for i in range(k + 1))
_K = (1, 3, 5, 10, 14)

#: The same features in SQL: common table expressions up to ``feat``.
FEATURES_SQL = f"""
b0 as (
  select *, date_trunc('hour', timestamp) + interval 1 hour as bucket,
         row_number() over (partition by symbol, date_trunc('hour', timestamp) order by timestamp desc, seq desc) as rn
  from book_v),
flow as (
  select symbol, date_trunc('hour', timestamp) + interval 1 hour as bucket,
         sum(case when is_aggr_buy then price * qty else 0 end) as notional_buy,
         sum(case when not is_aggr_buy then price * qty else 0 end) as notional_sell,
         sum(case when is_aggr_buy then qty else 0 end) as qty_buy,
         sum(case when not is_aggr_buy then qty else 0 end) as qty_sell, count(*) as ntr
  from trades_v group by all),
joined as (
  select b0.* exclude (rn), coalesce(notional_buy, 0) as notional_buy, coalesce(notional_sell, 0) as notional_sell,
         coalesce(qty_buy, 0) as qty_buy, coalesce(qty_sell, 0) as qty_sell, coalesce(ntr, 0) as ntr
  from b0 left join flow using (symbol, bucket) where rn = 1 and bid_0_price > 0 and ask_0_price > 0),
rolled as (
  select *, sum(notional_buy) over w as notional_buy_w, sum(notional_sell) over w as notional_sell_w, sum(ntr) over w as ntr_w
  from joined window w as (partition by symbol order by bucket rows between 7 preceding and current row)),
priced as (
  select *, (notional_buy_w - notional_sell_w) / (notional_buy_w + notional_sell_w + 1e-9) as ti,
         ntr_w / 28800.0 as nps, (notional_buy_w + notional_sell_w) / 28800.0 as notional_ps,
         (bid_0_price + ask_0_price) / 2 as mid,
         (ask_0_price - bid_0_price) / ((bid_0_price + ask_0_price) / 2 + 1e-12) * 1e4 as spread_bps,
         (ask_0_price - bid_0_price) / (0.1 + 1e-12) as spread_ticks,
         ((ask_0_price * bid_0_size + bid_0_price * ask_0_size) / (bid_0_size + ask_0_size + 1e-12)
          - (bid_0_price + ask_0_price) / 2) / ((bid_0_price + ask_0_price) / 2 + 1e-12) * 1e4 as micro_bias,
         {", ".join(f"{_sum('bid', k)} as db{k}, {_sum('ask', k)} as da{k}" for k in _K)}
  from rolled),
signed as (
  select *, {", ".join(f"(db{k} - da{k}) / (db{k} + da{k} + 1e-9) as obi{k}" for k in _K)},
         sign(ti + 0.5 * sign(micro_bias)) as dir0, sign(micro_bias) as sign_micro,
         sign((db10 - da10) / (db10 + da10 + 1e-9)) as sign_obi
  from priced),
opposed as (
  select *, case when dir0 > 0 then da3 else db3 end as opp3, case when dir0 > 0 then da10 else db10 end as opp10,
         case when count(*) over r12 >= 12 then (max(mid) over r12 - min(mid) over r12) / (mid + 1e-12) * 1e4 else 0 end as range60_bps,
         case when count(*) over r48 >= 48 then (max(mid) over r48 - min(mid) over r48) / (mid + 1e-12) * 1e4 else 0 end as range600_bps,
         median(spread_bps) over (partition by symbol order by epoch_us(bucket) range between 7199999999 preceding and current row) as spread_1s,
         lag(sign_micro) over (partition by symbol order by bucket) as before_micro,
         lag(sign_obi) over (partition by symbol order by bucket) as before_obi
  from signed
  window r12 as (partition by symbol order by bucket rows between 11 preceding and current row),
         r48 as (partition by symbol order by bucket rows between 47 preceding and current row)),
rel as (
  select *, count(spread_1s) over d as n_d, median(spread_1s) over d as med_d,
         last_value(case when before_micro is null or sign_micro = 0 or sign_micro <> before_micro then epoch_us(bucket) end ignore nulls)
           over (partition by symbol order by bucket rows between unbounded preceding and current row) as since_micro,
         last_value(case when before_obi is null or sign_obi = 0 or sign_obi <> before_obi then epoch_us(bucket) end ignore nulls)
           over (partition by symbol order by bucket rows between unbounded preceding and current row) as since_obi,
         median(opp3) over h as med3, median(opp10) over h as med10
  from opposed
  window d as (partition by symbol order by epoch_us(bucket) range between 86399999999 preceding and current row),
         h as (partition by symbol order by epoch_us(bucket) range between 14399999999 preceding and current row)),
feat as (
  select *, case when n_d >= 10 then med_d else spread_1s end as spread_med,
         case when n_d >= 10 then spread_1s / (med_d + 1e-12) else 1.0 end as spread_rel,
         least((epoch_us(bucket) - since_micro) / 1000.0, 21600000.0) as persist_micro_ms,
         least((epoch_us(bucket) - since_obi) / 1000.0, 21600000.0) as persist_obi_ms,
         (med3 - opp3) / (med3 + 1e-9) as thin3, (med10 - opp10) / (med10 + 1e-9) as thin10,
         abs(micro_bias) as abs_micro, abs(obi10) as abs_obi10, abs(ti) as abs_ti
  from rel)
"""

_CUTS = (
    ("thr_spread_rel", "spread_rel", 0.60), ("thr_spread_ticks", "spread_ticks", 0.80), ("thr_range60", "range60_bps", 0.40),
    ("thr_obi", "abs_obi10", 0.50), ("thr_micro", "abs_micro", 0.50), ("thr_ti", "abs_ti", 0.40), ("thr_nps", "nps", 0.30),
    ("thr_persist_micro", "persist_micro_ms", 0.30), ("thr_persist_obi", "persist_obi_ms", 0.30), ("thr_thin", "thin3", 0.30),
)
_SCORED = (("abs_micro", 1.0), ("abs_obi10", 0.9), ("abs_ti", 0.9), ("thin3", 0.7), ("spread_bps", -0.4), ("nps", 0.2))

#: Thresholds of the training days: expressions up to ``fitted``.
FITTED_SQL = (
    FEATURES_SQL
    + f""",
train as (select * from feat where day(bucket) <= 20),
cuts as (select {", ".join(f"quantile_cont({c}, {q}) as {n}" for n, c, q in _CUTS)}, {", ".join(f"median({c}) as med_{c}" for c, _ in _SCORED)} from train),
mads as (select {", ".join(f"median(abs({c} - med_{c})) as mad_{c}" for c, _ in _SCORED)} from train cross join cuts),
fitted as (select * from cuts cross join mads)
"""
)

_MASKS_SQL = (
    ("dir", "dir0 <> 0"), ("spread_rel", "spread_rel <= thr_spread_rel"), ("spread_ticks", "spread_ticks <= thr_spread_ticks"),
    ("range60", "range60_bps >= thr_range60"), ("obi", "abs_obi10 >= thr_obi"), ("micro", "abs_micro >= thr_micro"),
    ("flow", "notional_buy_w + notional_sell_w > 0"), ("ti", "abs_ti >= thr_ti"), ("nps", "nps >= thr_nps"),
    ("persist", "(persist_micro_ms >= thr_persist_micro or persist_obi_ms >= thr_persist_obi)"), ("thin", "thin3 >= thr_thin"),
    ("sign_micro", "sign(micro_bias) = dir0"), ("sign_ti", "sign(ti) = dir0"),
)

#: Tagged test days: expressions up to ``tags``.
TAGS_SQL = (
    FITTED_SQL
    + f""",
flags as (
  select *, {", ".join(f"coalesce({m}, false) as pass_{n}" for n, m in _MASKS_SQL)}
  from feat cross join fitted where day(bucket) > 20),
upto as (
  select *, {", ".join(" and ".join(f"pass_{n}" for n, _ in _MASKS_SQL[:k + 1]) + f" as pass_up_to_{_MASKS_SQL[k][0]}" for k in range(len(_MASKS_SQL)))}
  from flags),
scored as (
  select *, pass_up_to_sign_ti as pass_all_hard,
         case when pass_up_to_sign_ti then {" + ".join(f"({w} * (({c} - med_{c}) / (mad_{c} + 1e-12)))" for c, w in _SCORED)} end as ms
  from upto),
tags as (
  select *, (select quantile_cont(ms, 0.97) from scored) as ms_cut,
         coalesce(ms >= (select quantile_cont(ms, 0.97) from scored), false) as pass_ms_keep
  from scored)
"""
)

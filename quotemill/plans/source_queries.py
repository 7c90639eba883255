"""Queries of sources and sinks, jobs, the model and streams (S, M, X)."""

from __future__ import annotations

import time
import uuid

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotemill.operators import funnel as fn
from quotemill.operators import study as st
from quotemill.functions import expr as x
from quotemill.operators import thresholds as th
from quotemill.operators import timejoins as tj
from quotemill.plans.core_queries import LEAST_ROWS
from quotemill.plans.registry import query, r, rounded, us
from quotemill.plans.stage0 import FEATURES_SQL, TAGS_SQL, Stage0, is_train, snapshot_columns, tape_features
from quotemill.plans.study_queries import _GOVERNOR, _sized
from quotemill.plans.trade_queries import _DATASET_SQL, _PATH_SQL, stageb_dataset
from quotemill.operators import backtest as bt
from quotemill.sources import ingest as ig
from quotemill.sources.scratch import kept, shared_folder, stored, working_tables
from quotemill.sources.views import tape, view
from quotemill.streaming import live


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/quotemill/{name}-{uuid.uuid4().hex}"


@query("S01_projection_scan", "select event_id, value from events")
def projection_scan(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", "value")


@query("S02_month_range", "select event_id from tape where ts >= timestamp '2024-01-01' and ts < timestamp '2024-02-01'")
def month_range(spark, sf):
    return ig.in_months(tape(spark, sf), ig.months_between("2024-01", "2024-01"), "ts").select("event_id")


@query("S03_yearly_candles", "select symbol, epoch_us(timestamp) as timestamp, round(close, 6) as close from candles_v where year(timestamp) = 2024")
def yearly_candles(spark, sf):
    path = _folder(spark, "yearly")
    ig.write_yearly(view(spark, sf, "candles_v"), path)
    return us(rounded(spark.read.parquet(path).where("year = 2024").select("symbol", "timestamp", "close")), "timestamp")


@query("S05_optional_columns", "select seq, round(bid_0_price, 6) as bid_0_price, 0.0::double as bid_15_size from book_v")
def optional_columns(spark, sf):
    b = ig.normalize_book(view(spark, sf, "book_v"), 16)
    return rounded(b.select("seq", "bid_0_price", F.coalesce("bid_15_size", F.lit(0.0)).alias("bid_15_size")))


@query("S06_zipped_candles", "select symbol, epoch_us(timestamp) as timestamp, round(open, 6) as open, round(close, 6) as close, volume from candles_v")
def zipped_candles(spark, sf):
    path = _folder(spark, "zips")
    packed = ig.zipped_candles(view(spark, sf, "candles_v"))
    # Spark has no sink for raw files: the archives go through a table, and the reader's parser takes its rows.
    packed.write.parquet(path)
    rows = spark.read.parquet(path).select(F.concat("symbol", F.lit("-"), "day", F.lit(".zip")).alias("path"), "content")
    return us(rounded(ig.parse_zipped(rows).select("symbol", "timestamp", "open", "close", "volume")), "timestamp")


@query("S07_csv_round_trip", "select event_id, symbol, dir0 from signals_v")
def csv_round_trip(spark, sf):
    path = _folder(spark, "csv")
    view(spark, sf, "signals_v").select("event_id", "symbol", "dir0").write.option("header", True).csv(path)
    return spark.read.option("header", True).schema("event_id long, symbol string, dir0 int").csv(path)


@query("S08_json_or_empty", "select symbol, count(*) as n, 0::bigint as n_missing from signals_v group by symbol")
def json_or_empty(spark, sf):
    path = _folder(spark, "json")
    view(spark, sf, "signals_v").groupBy("symbol").agg(F.count("*").alias("n")).write.json(path)
    none = ig.read_json_or_empty(spark, f"{path}-absent", "symbol string, k long").groupBy().agg(F.count("*").alias("n_missing"))
    return ig.read_json_or_empty(spark, path, "symbol string, n long").crossJoin(none)


@query("S09_run_outputs", "select symbol, count(*) as n from router_v group by symbol")
def run_outputs(spark, sf):
    out = view(spark, sf, "router_v").groupBy("symbol").agg(F.count("*").alias("n"))
    return spark.read.parquet(ig.write_run(out, _folder(spark, "runs"), "r1", "counts")).select("symbol", "n")


@query("S10_monthly_sink", "select symbol, strftime(timestamp, '%Y-%m') as month, count(*) as n, round(sum(price), 3) as price from trades_v group by all")
def monthly_sink(spark, sf):
    path = _folder(spark, "monthly")
    ig.write_monthly(view(spark, sf, "trades_v"), path)
    return spark.read.parquet(path).groupBy("symbol", F.col("month").cast("string").alias("month")).agg(F.count("*").alias("n"), r(F.sum("price"), 3).alias("price"))


@query("S11_annual_sink", "select symbol, year(timestamp)::int as year, count(*) as n from candles_v group by all")
def annual_sink(spark, sf):
    path = _folder(spark, "annual")
    ig.write_yearly(view(spark, sf, "candles_v"), path)
    return spark.read.parquet(path).groupBy("symbol", "year").agg(F.count("*").alias("n"))


@query("S12_normalize_l1", "select symbol, epoch_us(timestamp) // 1000 * 1000 as timestamp, round(bid_0_price, 6) as best_bid, round(ask_0_price - bid_0_price, 6) as spread from book_v")
def normalize_l1(spark, sf):
    raw = view(spark, sf, "book_v").withColumn("origin_time", F.unix_millis("timestamp"))
    return us(rounded(ig.normalize_l1(raw).select("symbol", "timestamp", "best_bid", "spread")), "timestamp")


@query("S13_normalize_trades", "select trade_id, round(price, 6) as price, qty, is_aggr_buy, side from trades_v")
def normalize_trades(spark, sf):
    raw = view(spark, sf, "trades_v").select("symbol", F.col("timestamp").alias("origin_time"), F.col("price").cast("string").alias("price"), F.col("qty").alias("quantity"), F.upper("side").alias("side"), F.col("trade_id").cast("string").alias("trade_id"))
    return rounded(ig.normalize_trades(raw).select("trade_id", "price", "qty", "is_aggr_buy", "side"))


@query("S14_trade_aliases", "select trade_id, round(price, 6) as price, is_aggr_buy, epoch_us(timestamp) as received_us from trades_v")
def trade_aliases(spark, sf):
    raw = view(spark, sf, "trades_v").select("symbol", "timestamp", F.col("price").alias("last_price"), "qty", (~F.col("is_aggr_buy")).alias("is_buyer_maker"), "trade_id")
    return rounded(ig.normalize_trades(raw).select("trade_id", "price", "is_aggr_buy", F.unix_micros("received_time").alias("received_us")))


@query("S15_normalize_book", "select case when seq % 4 = 0 then -1 else seq end as seq, round(ask_0_price - bid_0_price, 6) as spread_top, ask_14_size::float as ask_14_size, epoch_us(timestamp) // 1000 * 1000 + 3000 as received_us from book_v")
def normalize_book(spark, sf):
    raw = view(spark, sf, "book_v").withColumns({"sequence_number": F.when(F.col("seq") % 4 != 0, F.col("seq")), "received_time": F.unix_millis("timestamp") + 3}).drop("seq")
    return rounded(ig.normalize_book(raw).select("seq", "spread_top", "ask_14_size", F.unix_micros("received_time").alias("received_us")))


@query("S16_conform", "select trade_id, round(price, 6) as price, null::timestamp is null as no_received from trades_v")
def conform(spark, sf):
    t = ig.conform(view(spark, sf, "trades_v"), ig.TRADES)
    return rounded(t.select("trade_id", "price", F.col("received_time").isNull().alias("no_received")))


@query("S16_conform_book", "select seq, round(bid_0_price, 6) as bid_0_price, bid_3_size::float as bid_3_size, true as no_spread, 65::bigint as n_columns from book_v")
def conform_book(spark, sf):
    """Reordered, cast, and what is missing added as typed NULLs."""
    b = ig.conform(view(spark, sf, "book_v").withColumn("bid_0_price", F.col("bid_0_price").cast("string")), ig.book_schema())
    return rounded(b.select("seq", "bid_0_price", "bid_3_size", F.col("spread_top").isNull().alias("no_spread"), F.lit(len(b.columns)).cast("long").alias("n_columns")))


@query("S17_contract_check", "select symbol, count(*) as n, '' as missing_trades, 'received_time' as missing_strict from trades_v group by symbol")
def contract_check(spark, sf):
    t = view(spark, sf, "trades_v")
    lost = [",".join(ig.missing_columns(t, need)) for need in (["timestamp", "price", "qty"], ["timestamp", "received_time"])]
    return t.groupBy("symbol").agg(F.count("*").alias("n")).select("symbol", "n", F.lit(lost[0]).alias("missing_trades"), F.lit(lost[1]).alias("missing_strict"))


_DAY_KINDS = "case when d % 7 = 3 then 'qty' else '' end as missing, case when d % 7 = 5 then 'price' else '' end as other_type"


def _days(spark, sf):
    """The trades as a folder for each day, some of which lack a column or have prices as text."""
    t = view(spark, sf, "trades_v").select("trade_id", "symbol", "timestamp", "price", "qty", F.date_format("timestamp", "yyyy-MM-dd").alias("day"))
    path, turn = _folder(spark, "days"), F.dayofmonth("timestamp") % 7
    for rows in (t.where(~turn.isin(3, 5)), t.where(turn == 3).drop("qty"), t.where(turn == 5).withColumn("price", F.col("price").cast("string"))):
        rows.repartition("day").write.mode("append").partitionBy("day").parquet(path)
    need = T.StructType().add("trade_id", "long").add("symbol", "string").add("timestamp", "timestamp").add("price", "double").add("qty", "double")
    return ig.checked_days(spark, path, need)


@query("S17_checked_days", "select trade_id, round(price, 6) as price, qty from trades_v where day(timestamp) % 7 not in (3, 5)")
def checked_days(spark, sf):
    """The rows of the days that keep the contract."""
    return rounded(_days(spark, sf)[0].select("trade_id", "price", "qty"))


@query("S17_quarantine", f"select day, {_DAY_KINDS} from (select distinct strftime(timestamp, '%Y-%m-%d') as day, day(timestamp) as d from trades_v) where d % 7 in (3, 5)")
def quarantine(spark, sf):
    """The days that don't, and why."""
    return _days(spark, sf)[1]


@query("S18_epoch_units", "select trade_id, epoch_us(timestamp) // 1000 * 1000 as ms_us, epoch_us(timestamp) as ns_us, epoch_us(timestamp) // 1000 * 1000 as text_us from trades_v")
def epoch_units(spark, sf):
    t = view(spark, sf, "trades_v").select("trade_id", F.unix_millis("timestamp").alias("ms"), (F.unix_micros("timestamp") * 1000).alias("ns"), F.unix_millis("timestamp").cast("string").alias("text"))
    for c in ("ms", "ns", "text"):
        t = ig.epoch_timestamp(t, c)
    return t.select("trade_id", *[F.unix_micros(c).alias(f"{c}_us") for c in ("ms", "ns", "text")])


@query("S19_normalize_candles", "select symbol, epoch_us(timestamp) as timestamp, round(close, 6) as close from candles_v where timestamp >= timestamp '2024-01-05' and timestamp < timestamp '2024-01-20'")
def normalize_candles(spark, sf):
    c = view(spark, sf, "candles_v")
    return us(rounded(ig.normalize_candles(c.union(c), "2024-01-05", "2024-01-20").select("symbol", "timestamp", "close")), "timestamp")


@query("S20_symbol_inventory", "select upper(symbol) || '-usdt-PERP' as symbol, count(distinct timestamp::date) as n_days from trades_v where epoch(timestamp)::bigint // 86400 % 3 = 0 and symbol in ('click', 'view') group by symbol")
def symbol_inventory(spark, sf):
    t = view(spark, sf, "trades_v")
    named = F.when(F.col("symbol").isin("click", "view"), F.concat(F.upper("symbol"), F.lit("-usdt-PERP"))).otherwise(F.concat("symbol", F.lit("-EUR")))
    return ig.symbols_like(t.withColumn("symbol", named), "USDT", "-PERP", 3)


@query("S21_time_slice", "select trade_id, round(price, 6) as price from trades_v where timestamp between timestamp '2024-01-10 06:00:00' and timestamp '2024-01-12 18:00:00'")
def time_slice(spark, sf):
    return rounded(ig.in_slice(view(spark, sf, "trades_v"), "2024-01-10 06:00:00", "2024-01-12 18:00:00", ["trade_id", "price"]))


@query("S22_trailing_months", "select symbol, count(*) as n from candles_v where timestamp >= timestamp '2023-11-01' and timestamp < timestamp '2024-02-01' group by symbol")
def trailing_months(spark, sf):
    return ig.in_months(view(spark, sf, "candles_v"), ig.trailing_months("2024-02", 3)).groupBy("symbol").agg(F.count("*").alias("n"))


_FEATS = ["ms", "micro_bias", "abs_micro", "obi10", "abs_obi10", "ti", "abs_ti", "thin3", "persist_micro_ms", "persist_obi_ms", "range60_bps", "atr_bps"]
LEAST_TRAINING_ROWS = 80
TREES = 200


def _scored(spark, sf):
    """Boosted trees on the tradeable breakout rows of one volatility regime, twelve features; all splits scored.

    The features are those of the last bucket that ended by the signal. Too few training rows: no model.
    """
    data = stageb_dataset(spark, sf).where("is_tradeable = 1 and router_branch = 'BO'").withColumn("regime3", x.vol_regime3("vol_bucket"))
    signals = data.where("regime3 = 'high'").select("event_id", "symbol", "timestamp", "split", "vol_bucket", "pnl", "y_go", "atr_bps", F.col("ms").cast("double").alias("ms"))
    buckets = tape_features(spark, sf).withColumn("timestamp", F.col("bucket"))
    near = tj.asof(signals, buckets, [c for c in _FEATS if c not in ("ms", "atr_bps")], ["seq"])
    rows = near.select("event_id", "split", "vol_bucket", "pnl", F.col("y_go").cast("double").alias("label"), *[F.coalesce(x.finite(c), F.lit(0.0)).alias(c) for c in _FEATS])
    rows = stored(VectorAssembler(inputCols=_FEATS, outputCol="features").transform(rows), "model-rows")
    train = rows.where("split = 'train'")
    if train.count() < LEAST_TRAINING_ROWS:
        return None, rows.withColumn("score", F.lit(None).cast("double"))
    model = GBTClassifier(maxDepth=3, stepSize=0.03, maxIter=TREES, subsamplingRate=0.8, seed=7).fit(train.orderBy("event_id"))
    return model, model.transform(rows).withColumn("score", vector_to_array("probability")[1])


@query("M01_boosted_trees")
def boosted_trees(spark, sf):
    _, scored = _scored(spark, sf)
    counts = scored.groupBy("split").agg(F.count("*").alias("n_rows"))
    return rounded(counts.join(st.metrics(scored.withColumn("y", F.col("label").cast("int")), "y", "score", ["split"]), "split", "left"))


@query("M01_model_rows", f"with {_DATASET_SQL} select case when day(timestamp) <= 15 then 'train' when day(timestamp) <= 22 then 'val' else 'test' end as split, count(*) as n_rows, sum(coalesce(case when p60 < 0 then p60 else p180 end > 0, false)::int)::bigint as n_go from p where router_branch = 'BO' and vol_bucket in ('b3', 'b4') and case when p60 < 0 then p60 else p180 end is not null group by 1")
def model_rows(spark, sf):
    """The rows that the model is fitted on and judged by, and how many of them are worth a trade."""
    data = stageb_dataset(spark, sf).where("is_tradeable = 1 and router_branch = 'BO'").withColumn("regime3", x.vol_regime3("vol_bucket"))
    return data.where("regime3 = 'high'").groupBy("split").agg(F.count("*").alias("n_rows"), F.sum("y_go").cast("long").alias("n_go"))


@query("M02_feature_importance")
def feature_importance(spark, sf):
    """The weight of each feature in the model; without a model (``fitted`` false) it is unknown."""
    model, scored = _scored(spark, sf)
    found = model.featureImportances.toArray().tolist() if model else [None] * len(_FEATS)
    weights = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(w).cast("double").alias("importance")) for f, w in zip(_FEATS, found, strict=True)])
    return rounded(scored.agg(F.count("*").alias("n")).select("n", F.lit(model is not None).alias("fitted"), F.inline(weights)))


#: The months that a fit for ``REFERENCE`` looks back on.
REFERENCE, TRAILING = "2024-02", 3
_TRAILING_SQL = "where bucket >= timestamp '2023-11-01' and bucket < timestamp '2024-02-01'"
_RECORD_SQL = TAGS_SQL.replace("from feat cross join fitted where day(bucket) > 20", f"from feat cross join fitted {_TRAILING_SQL}").replace("from feat where day(bucket) <= 20", f"from feat {_TRAILING_SQL}")


@query("M06_production_thresholds", f"""with {_RECORD_SQL}, reg as (select quantile_cont(range600_bps, 0.4) as lo, quantile_cont(range600_bps, 0.75) as hi from train)
select 'hard' as record, thr_spread_rel as a, thr_nps as b, null::double as c from (select round(thr_spread_rel, 5) as thr_spread_rel, round(thr_nps, 5) as thr_nps from fitted)
union all select 'score', round(med_nps, 5), round(mad_nps, 5), (select round(max(ms_cut), 4) from tags) from fitted
union all select 'regime', case when (select count(*) from train) >= {LEAST_ROWS} then round(lo, 5) end, case when (select count(*) from train) >= {LEAST_ROWS} then round(hi, 5) end, null from reg""")
def production_thresholds(spark, sf):
    """Fitted on a sample of each of the months before the reference month; three JSON records: hard cut-offs, score
    with its cut, regime edges.

    The sample takes all rows of the fixture, whose months have fewer.
    """
    train = ig.in_months(tape_features(spark, sf), ig.trailing_months(REFERENCE, TRAILING), "bucket")
    train = stored(fn.sampled(train, 250_000, [F.date_format("bucket", "yyyy-MM")], ["symbol", "bucket"], 7), "production-train")
    fitted = th.fit_thresholds(train)
    cut = fn.tagged(fn.with_thresholds(train, fitted)).agg(F.max("ms_cut").alias("ms_cut"))
    regime = th.regime_edges(train, "range600_bps", least_rows=LEAST_ROWS)
    path = _folder(spark, "thresholds")
    names = [n for n, _, _ in th.ThresholdPlan().cuts]
    records = {
        "hard": fitted.select(*names),
        "score": fitted.select(*[f"{k}_{c}" for k in ("med", "mad") for c in th.ThresholdPlan().scored]).crossJoin(F.broadcast(cut)),
        "regime": regime,
    }
    for name, record in records.items():
        record.write.json(f"{path}/{name}")
    read = lambda name: spark.read.schema(", ".join(f"{c} {t}" for c, t in records[name].dtypes)).json(f"{path}/{name}")
    none = F.lit(None).cast("double")
    shown = {"hard": ("thr_spread_rel", "thr_nps", none), "score": ("med_nps", "mad_nps", r("ms_cut", 4)), "regime": ("lo", "hi", none)}
    rows = [read(n).select(F.lit(n).alias("record"), F.col(a).alias("a"), F.col(b).alias("b"), c.alias("c")) for n, (a, b, c) in shown.items()]
    return rounded(rows[0].union(rows[1]).union(rows[2]), 5)


#: Each third of the month is tagged with what the thirds before it gave; expressions up to ``tags``.
_WALK_SQL = (
    FEATURES_SQL
    + f""",
fit_on as (select f.*, t.target from feat f join (values (1), (2), (3)) t(target) on (day(bucket) - 1) // 10 between t.target - 2 and t.target - 1),
cuts as (select target, {", ".join(f"quantile_cont({c}, {q}) as {n}" for n, c, q in th.ThresholdPlan().cuts)}, {", ".join(f"median({c}) as med_{c}" for c in th.ThresholdPlan().scored)} from fit_on group by target),
mads as (select target, {", ".join(f"median(abs({c} - med_{c})) as mad_{c}" for c in th.ThresholdPlan().scored)} from fit_on join cuts using (target) group by target),
fitted as (select * from cuts join mads using (target)),
flags as"""
    + TAGS_SQL.split("flags as", 1)[1]
    .replace("from feat cross join fitted where day(bucket) > 20", "from feat join fitted on (day(bucket) - 1) // 10 = target")
    .replace("(select quantile_cont(ms, 0.97) from scored)", "(select quantile_cont(s2.ms, 0.97) from scored s2 where s2.target = scored.target)")
)


def _walk(spark, sf, months: int = 2):
    """Tags of every month that has a month before it: fitted on the ``months`` before, in one plan for all of them.

    Months are thirds of one at the fixture's scale. A row is in the fits of the months that follow it, and is tagged
    with its own month's thresholds.
    """
    with working_tables(spark):
        f = stored(tape_features(spark, sf).withColumn("month", F.floor((F.dayofmonth("bucket") - 1) / 10).cast("int")), "walk-features")
        fits = f.withColumn("target", F.explode(F.array(*[F.col("month") + k for k in range(1, months + 1)])))
        fitted = stored(th.fit_thresholds(fits, by=["target"]), "walk-thresholds")
        return kept(fn.tagged(fn.with_thresholds(f.withColumn("target", F.col("month")), fitted, ["target"]), by=["target"]), "walk-tags")


@query("M07_walk_forward", f"with {_WALK_SQL} select target as month, symbol, count(*) as n, count(*) filter (where pass_all_hard) as n_all, count(*) filter (where pass_up_to_obi) as n_obi, count(*) filter (where pass_ms_keep) as n_keep, round(min(thr_spread_rel), 5) as thr_spread_rel, round(min(ms_cut), 4) as ms_cut from tags group by target, symbol")
def walk_forward(spark, sf):
    """Walk-forward tagging: each month by the thresholds of the months before it."""
    t = _walk(spark, sf)
    counts = [F.count_if(c).alias(n) for c, n in (("pass_all_hard", "n_all"), ("pass_up_to_obi", "n_obi"), ("pass_ms_keep", "n_keep"))]
    return t.groupBy(F.col("target").alias("month"), "symbol").agg(F.count("*").alias("n"), *counts, r(F.min("thr_spread_rel"), 5).alias("thr_spread_rel"), r(F.min("ms_cut"), 4).alias("ms_cut"))


_WALK_PATH_SQL = _PATH_SQL.replace("from signals_v", "from cands")


@query("M07_walk_labels", f"with {_WALK_SQL}, cands as (select seq as event_id, symbol, bucket as timestamp, dir0, 8.0::double as fees_rt_bps, 2.0::double as slip_bps, target from tags where pass_up_to_obi), {_WALK_PATH_SQL} select target as month, coalesce(reason, 'none') as reason, count(*) as n, sum(coalesce((net_max >= 20)::int, 0))::bigint as hits from cands left join res using (event_id) group by 1, 2")
def walk_labels(spark, sf):
    """Labels of the tagged candidates of each month, from the book that follows them."""
    c = _walk(spark, sf).where("pass_up_to_obi").select(F.col("seq").alias("event_id"), "symbol", F.col("bucket").alias("timestamp"), "dir0", F.lit(8.0).alias("fees_rt_bps"), F.lit(2.0).alias("slip_bps"), "target")
    out = bt.path_labels(c, view(spark, sf, "book_v"), 360 * 60.0, 20.0, block_rows=8)
    return out.groupBy(F.col("target").alias("month"), "reason").agg(F.count("*").alias("n"), F.sum("label").cast("long").alias("hits"))


@query("M07_label_summary", f"with {_PATH_SQL} select coalesce(reason, 'none') as reason, count(*) as n, sum(coalesce((net_max >= 20)::int, 0))::bigint as hits from signals_v left join res using (event_id) group by 1")
def label_summary(spark, sf):
    out = bt.path_labels(view(spark, sf, "signals_v"), view(spark, sf, "book_v"), 360 * 60.0, 20.0, block_rows=8)
    return out.groupBy("reason").agg(F.count("*").alias("n"), F.sum("label").cast("long").alias("hits"))


def _stream(spark, df, name, parts: int = 4, ts: str = "timestamp", mixed: bool = False):
    """``df`` as files in the order of time, read as a stream in that order, in about ``parts`` micro-batches.

    A stream of files takes them by the time they were written: files are ranges of time, written at once by many
    tasks, and given times of writing in their order. ``mixed``: half of the rows come one part later than their day,
    and no file is sorted.
    """
    path = _folder(spark, name)
    at_once = max(1, spark.sparkContext.defaultParallelism // parts)
    order = [F.col(ts)]
    if mixed:
        day = F.date_diff(F.to_date(ts), F.lit("1970-01-01").cast("date"))
        ends = df.agg(F.coalesce(F.min(day), F.lit(0)).alias("a"), F.coalesce(F.max(day), F.lit(0)).alias("b")).first()
        draw = F.xxhash64(*[c for c, t in df.dtypes if t != "void"])
        order = [F.floor((day - ends["a"]) * parts / (ends["b"] - ends["a"] + 1)) + F.pmod(draw, F.lit(2)), draw]
    df.repartitionByRange(parts * at_once, *order).sortWithinPartitions(*order).write.parquet(path)
    _written_in_order(spark, path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", at_once).parquet(path)


def _written_in_order(spark, path: str) -> None:
    """Gives the files of ``path`` times of writing a second apart, by their names; fails on a file system that keeps none."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    listed = lambda: sorted((f for f in files.listStatus(where) if f.getPath().getName().startswith("part-")), key=lambda f: f.getPath().getName())
    found = listed()
    start = int(time.time() - len(found)) * 1000
    for k, f in enumerate(found):
        files.setTimes(f.getPath(), start + 1000 * k, -1)
    if [f.getModificationTime() for f in listed()] != [start + 1000 * k for k in range(len(found))]:
        raise ValueError(f"{path}: the file system does not keep times of writing")


@query("X01_stream_buckets", "with f as (select symbol, epoch_us(date_trunc('hour', timestamp) + interval 1 hour) as bucket, arg_max(price, (timestamp, trade_id)) as last_price, sum(case when is_aggr_buy then price * qty else 0 end) as notional_buy, sum(case when is_aggr_buy then 0 else price * qty end) as notional_sell, count(*) as ntr from trades_v group by 1, 2) select symbol, bucket, round(last_price, 6) as last_price, round(notional_buy, 6) as notional_buy, round(notional_sell, 6) as notional_sell, ntr from f where bucket <= (select epoch_us(max(timestamp)) - 172800000000 from trades_v)")
def stream_buckets(spark, sf):
    """Closed buckets: all but those that the last watermark, two days before the last tick, has not passed."""
    ticks = _stream(spark, view(spark, sf, "trades_v"), "ticks")
    out = live.stream_buckets(ticks, "1 hour", "2 days")
    return us(rounded(live.run_to_end(out, "buckets", _folder(spark, "stream"))), "bucket")


_CLOSED = "bucket <= (select max(timestamp) - interval 2 day from book_v)"


@query("X01_stream_book", f"with {FEATURES_SQL} select symbol, epoch_us(bucket) as bucket, seq, round((bid_0_price + ask_0_price) / 2, 6) as mid, round(notional_buy, 6) as notional_buy, round(notional_sell, 6) as notional_sell, ntr from joined where {_CLOSED}")
def stream_book(spark, sf):
    """Closed buckets of the book with their trade flow, from two streams."""
    book = view(spark, sf, "book_v").select("symbol", "timestamp", "seq", "bid_0_price", "ask_0_price")
    out = _book_buckets(spark, sf, book).select("symbol", "bucket", "seq", x.mid().alias("mid"), "notional_buy", "notional_sell", "ntr")
    return us(rounded(live.run_to_end(out, "book-buckets", _folder(spark, "stream"))), "bucket")


def _book_buckets(spark, sf, book):
    """Closed buckets of ``book``, with the columns that are used of it and no others: a bucket's state is one of its rows."""
    trades = view(spark, sf, "trades_v").select("symbol", "timestamp", "price", "qty", "is_aggr_buy")
    return live.stream_book_buckets(_stream(spark, book, "book"), _stream(spark, trades, "ticks"), "1 hour", "2 days")


@query("X02_stream_tags", f"with {TAGS_SQL}, e as (select quantile_cont(range600_bps, 1/3) as e1, quantile_cont(range600_bps, 2/3) as e2 from train) select symbol, epoch_us(bucket) as bucket, pass_all_hard as pass_all, round(ms, 4) as live_score, case when range600_bps <= e1 then 'low' when range600_bps <= e2 then 'mid' else 'high' end as vol_bucket from tags cross join e where {_CLOSED}")
def stream_tags(spark, sf):
    """Buckets tagged as they close: rolling features from bounded state, the funnel and score of frozen thresholds.

    The thresholds and the edges of the range are those that the batch job fits on the training days.
    """
    c = Stage0()
    train = stored(tape_features(spark, sf).where(is_train()), "live-train")
    edges = th.bucket_edges(train, "range600_bps", 3).select("edges")
    fitted = stored(th.fit_thresholds(train).crossJoin(edges), "live-thresholds")
    book = view(spark, sf, "book_v").withColumns({"mid": x.mid(), **snapshot_columns(c)}).withColumn("obi10", x.imbalance(F.col("db10"), F.col("da10")))
    own = ["mid", "spread_bps", "spread_ticks", "micro_bias", "obi10", "da3", "db3", "da10", "db10"]
    closed = _book_buckets(spark, sf, book.select("symbol", "timestamp", "seq", "bid_0_price", "ask_0_price", *own))
    closed = closed.withColumns({"us": F.unix_micros("bucket"), "ntr": F.col("ntr").cast("long")})
    names = ["symbol", "bucket", "us", "notional_buy", "notional_sell", "ntr", *own]
    closed = live.run_to_end(closed.select(*names), "closed", _folder(spark, "stream"))
    reach = live.Reach(c.flow_rows, c.flow_seconds, c.range_rows, c.long_range_rows, c.spread_short, c.spread_long, c.thin_seconds, c.persist_cap_ms)
    features = live.stream_features(_stream(spark, closed, "closed", ts="bucket"), reach)
    features = features.withColumns({"abs_micro": F.abs("micro_bias"), "abs_obi10": F.abs("obi10"), "abs_ti": F.abs("ti")}).where(~is_train())
    out = live.stream_scored(features, fitted, [m for _, m in fn.masks()], th.score())
    out = out.withColumn("vol_bucket", th.bucket_of(F.col("range600_bps"), F.col("edges"), ["low", "mid", "high"]))
    tags = live.run_with_state(out.select("symbol", "bucket", "pass_all", "live_score", "vol_bucket"), "tags", _folder(spark, "stream"))
    return us(rounded(tags, 4), "bucket")


@query("X03_stream_governor", _GOVERNOR + " where d + interval 1 day <= (select max(timestamp) - interval 12 day from router_v)")
def stream_governor(spark, sf):
    """Days that are closed, folded in order although their trades come in files that overlap in time."""
    trades = _sized(spark, sf).select("day", "event_id", "timestamp", F.col("v").alias("pnl"), F.col("size").alias("z"))
    out = live.run_with_state(live.stream_governor(_stream(spark, trades, "governed", parts=6, mixed=True), "12 days"), "governor", _folder(spark, "stream"))
    return out.select("event_id", r("size_used", 5).alias("size_used"), r("before", 4).alias("before"))

"""Market tables derived from the ``events`` tape, in SQL that Spark and DuckDB both accept.

Every event type is a symbol. The tape has one tick in about 20 minutes and symbol, so that time constants that
are milliseconds on an exchange feed are minutes and hours here; they are parameters of all operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LEVELS = 15

_level = (
    "100.0 + value/10.0 - 0.05*(1 + user_id % 3) - 0.1*{i} as bid_{i}_price, "
    "100.0 + value/10.0 + 0.05*(1 + event_id % 4) + 0.1*{i} as ask_{i}_price, "
    "cast(1 + (event_id*(7+{i}) + user_id*(3+{i})) % (11+{i}) as double) as bid_{i}_size, "
    "cast(1 + (event_id*(5+{i}) + user_id*(13+{i})) % (13+{i}) as double) as ask_{i}_size"
)

#: Each view reads ``tape``, which is ``events`` with its timestamp as ``ts``.
VIEWS = {
    "trades_v": "select event_type as symbol, ts as timestamp, event_id as trade_id, 100.0 + value/10.0 as price, "
    "cast(1 + user_id % 10 as double) as qty, (event_id % 2 = 0) as is_aggr_buy, "
    "case when event_id % 2 = 0 then 'buy' else 'sell' end as side from tape",
    "book_v": "select event_type as symbol, ts as timestamp, event_id as seq, "
    + ", ".join(_level.format(i=i) for i in range(LEVELS))
    + " from tape",
    "candles_v": "select symbol, date_trunc('hour', timestamp) as timestamp, min_by(price, trade_id) as open, "
    "max(price) as high, min(price) as low, max_by(price, trade_id) as close, sum(qty) as volume "
    "from trades_v group by symbol, date_trunc('hour', timestamp)",
    "signals_v": "select event_id, event_type as symbol, ts as timestamp, "
    "case when event_id % 3 = 0 then -1 else 1 end as dir0, 8.0 as fees_rt_bps, 2.0 as slip_bps, value as ms "
    "from tape",
    "grid_v": "select event_type as symbol, ts as t, event_id, 0.001 + value/10000.0 as atr_pct, "
    "cast(user_id % 50 as double)/10.0 as spread_bps_entry, cast(event_id % 97 as double) as quote_churn_10s, "
    "cast((event_id % 41) - 20 as double)/20.0 as obi_5, cast((event_id % 31) as double)/31.0 as aggr_ratio_10s, "
    "cast((event_id % 61) - 30 as double) as net_delta_15s, "
    "cast((event_id*13 % 101) - 50 as double)/10000.0 as {q}pnl_net_rr1.00_rf10_ts60{q}, "
    "cast((event_id*17 % 103) - 50 as double)/10000.0 as {q}pnl_net_rr1.50_rf10_ts60{q}, "
    "cast((event_id*19 % 107) - 50 as double)/10000.0 as {q}pnl_net_rr2.00_rf20_ts90{q} from tape",
    "router_v": "select event_id, ts as timestamp, date_trunc('day', ts) as day, event_type as symbol, "
    "case when user_id % 3 = 2 then 'MR' else 'BO' end as router_pick, value as strength, "
    "concat('b', cast(event_id % 5 as varchar(9))) as vol_bucket, "
    "cast((event_id*23 % 211) - 100 as double)/10.0 as pnl_net_bps, "
    "case when event_id % 11 = 0 then null else cast((event_id*29 % 997) as double)/997.0 end as score "
    "from tape",
}


def tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` tape with ``ts`` as a timestamp."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", events["ts"].cast("timestamp").alias("ts"), "user_id", "event_type", "value")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name].replace("{q}", "`")
    if name == "candles_v":
        return spark.sql(sql.replace("from trades_v", "from {trades}"), trades=view(spark, sf_dir, "trades_v"))
    return spark.sql(sql.replace("from tape", "from {tape}"), tape=tape(spark, sf_dir))


def oracle(sql: str) -> str:
    """``sql`` for DuckDB with the views it names before it, as common table expressions."""
    names = [n for n in VIEWS if n in sql or (n == "trades_v" and "candles_v" in sql)]
    ctes = ["tape as (select event_id, ts, user_id, event_type, value from events)"]
    ctes += [f"{n} as ({VIEWS[n].replace('{q}', chr(34))})" for n in names]
    body = sql.strip()
    recursive = body.lower().startswith("with recursive")
    if body.lower().startswith("with"):
        return f"with {'recursive ' if recursive else ''}{', '.join(ctes)}, {body[len('with recursive') if recursive else len('with'):].strip()}"
    return f"with {', '.join(ctes)} {body}"

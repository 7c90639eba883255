"""Data quality of ticks and candles: probes, validation rules, anomalies, cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quotemill.functions.expr import finite, mid
from quotemill.operators.spread import stats_by
from quotemill.operators.timejoins import in_windows, range_join
from quotemill.operators.windows import numbered, run_lengths, with_previous
from quotemill.sources.scratch import kept, stored, working_tables


def book_probe(book: DataFrame, by: list[str], ts: str = "timestamp", received: str = "received_time", seq: str = "seq", slot_seconds: int = 1) -> DataFrame:
    """One row a group: rows, time spans, latency percentiles, share of empty slots, crossed rows, falling sequence
    numbers, spread percentiles."""
    rows = with_previous(book, {"before_": seq}, [ts, seq], by)
    rows = rows.withColumns({"d_": (F.unix_micros(received) - F.unix_micros(ts)) / 1000.0, "s_": F.col("ask_0_price") - F.col("bid_0_price")})
    rows = rows.select(*by, ts, received, seq, "before_", "d_", "s_")
    slot = F.floor(F.unix_seconds(ts) / F.lit(slot_seconds))
    counts = [
        F.count("*").alias("n_rows"), F.unix_micros(F.min(ts)).alias("first_us"), F.unix_micros(F.max(ts)).alias("last_us"),
        F.unix_micros(F.min(received)).alias("first_received_us"), F.unix_micros(F.max(received)).alias("last_received_us"),
        F.count_if(F.col("d_") < 0).alias("latency_negative"),
        (1 - F.count_distinct(slot) / (F.max(slot) - F.min(slot) + 1)).alias("gap_ratio"),
        F.count_if(F.col("s_") <= 0).alias("crossed"), F.count_if(F.col(seq) < F.col("before_")).alias("seq_falls"),
    ]
    shares = {f"latency_p{q}": ("d_", q / 100) for q in (50, 90, 99)} | {f"spread_p{q}": ("s_", q / 100) for q in (10, 50, 90)}
    return stats_by(rows, by, counts, shares)


def io_scan(book: DataFrame, trades: DataFrame, expected: DataFrame, by: list[str], slot_seconds: int, most_gaps: float, most_delay_ms: float) -> DataFrame:
    """The probe of each expected group, with its trade rows and flags (``;``-joined): missing groups have 0 rows."""
    counts = trades.groupBy(*by).agg(F.count("*").alias("n_trades"))
    out = expected.join(book_probe(book, by, slot_seconds=slot_seconds), by, "left").join(counts, by, "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_rows", "n_trades")})
    flags = F.array(
        F.when(F.col("n_rows") == 0, "no_book"), F.when(F.col("n_trades") == 0, "no_trades"), F.when(F.coalesce("gap_ratio", F.lit(1.0)) > most_gaps, "gaps"),
        F.when(F.col("latency_p99") > most_delay_ms, "late"), F.when(F.col("latency_negative") > 0, "negative_latency"), F.when(F.col("crossed") > 0, "crossed"),
    )
    return out.withColumn("flags", F.array_join(F.array_compact(flags), ";"))


def book_checks(book: DataFrame, by: list[str], need: list[str], levels: int, gap_seconds: float, ts: str = "timestamp", seq: str = "seq") -> DataFrame:
    """(by, check, n_bad) of book snapshots: missing columns, rows of a time that has others, crossed and empty tops,
    gaps, falling sequence numbers, levels out of price order, levels without size."""
    lost = [c for c in need if c not in book.columns]
    rows = with_previous(book, {"before_": ts, "seq_before_": seq}, [ts, seq], by)
    gap = (F.unix_micros(ts) - F.unix_micros("before_")) / 1e6
    price = lambda s, i: F.col(f"{s}_{i}_price")
    either = lambda conditions: reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])
    rules = {
        "same_time": F.coalesce(F.col(ts) == F.col("before_"), F.lit(False)),
        "crossed": price("ask", 0) <= price("bid", 0),
        "no_price": ~F.coalesce((price("bid", 0) > 0) & (price("ask", 0) > 0), F.lit(False)),
        "gap": gap > gap_seconds,
        "seq_falls": F.col(seq) < F.col("seq_before_"),
        "levels_out_of_order": either([c for i in range(1, levels) for c in (price("bid", i) > price("bid", i - 1), price("ask", i) < price("ask", i - 1))]),
        "no_size": either([F.col(f"{s}_{i}_size") <= 0 for i in range(levels) for s in ("bid", "ask")]),
    }
    counts = rows.groupBy(*by).agg(*[F.count_if(c).alias(n) for n, c in rules.items()], F.lit(len(lost)).cast("long").alias("missing_columns"))
    found = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("n_bad")) for n in (*rules, "missing_columns")])
    return counts.select(*by, F.inline(found))


def probes(book: DataFrame, n: int, seconds: float, seed: int = 7, key: str = "symbol", ts: str = "timestamp") -> DataFrame:
    """(key, probe, n_rows, first_us, last_us): what stands around ``n`` random times of each key, ``seconds`` to either side.

    Times are drawn by md5 from the key's span, the same on any layout; a probe may find nothing.
    """
    span = book.groupBy(key).agg(F.unix_micros(F.min(ts)).alias("a_"), F.unix_micros(F.max(ts)).alias("b_"))
    drawn = span.withColumn("probe", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    u = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), key, F.col("probe").cast("string")).cast("binary")), 1, 8), 16, 10).cast("long")
    at = F.col("a_") + F.floor((F.col("b_") - F.col("a_")) / 1000 * u / (1 << 32)) * 1000
    drawn = drawn.select(key, "probe", F.timestamp_micros(at.cast("long")).alias("timestamp"))
    rows = range_join(drawn, book.select(key, F.col(ts).alias("timestamp")), seconds, seconds, key)
    found = rows.groupBy(key, "probe").agg(F.count("*").alias("n_rows"), F.unix_micros(F.min("timestamp_r")).alias("first_us"), F.unix_micros(F.max("timestamp_r")).alias("last_us"))
    return drawn.drop("timestamp").join(found, [key, "probe"], "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


def spread_stats(book: DataFrame, by: list[str]) -> DataFrame:
    """Spread in bps of each group: known ones, those that are not positive, those that are 0, percentiles."""
    rows = book.select(*by, finite((F.col("ask_0_price") - F.col("bid_0_price")) / mid() * 1e4).alias("s_"))
    counts = [F.count("s_").alias("n"), F.count_if(F.col("s_") <= 0).alias("not_positive"), F.count_if(F.col("s_") == 0).alias("zero")]
    return stats_by(rows, by, counts, {f"p{q}": ("s_", q / 100) for q in (10, 50, 90)})


def checks(df: DataFrame, rules: dict[str, Column], by: list[str], most: int = 0) -> DataFrame:
    """(by, check, n_bad, ok): how many rows break each rule, from one pass."""
    counts = df.groupBy(*by).agg(*[F.count_if(F.coalesce(c, F.lit(True))).alias(n) for n, c in rules.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("n_bad")) for n in rules])
    return counts.select(*by, F.inline(rows)).withColumn("ok", F.col("n_bad") <= most)


def anomalies(candles: DataFrame, run: int, jump: float, key: str = "symbol") -> DataFrame:
    """(key, timestamp, type, severity): flat and zero-volume runs, jumps, inconsistent and invalid candles.

    A run is reported in its last row once it has ``run`` rows; a first row counts as flat. Nothing found: no rows.
    Runs are counted by breaks that parts of the time line hand on, so that one that lasts for years is not one task.
    """
    before = F.col("before_")
    rows = with_previous(candles, {"before_": "close"}, ["timestamp"], [key]).withColumns(
        {
            "flat_": F.coalesce(F.col("close") - before, F.lit(0.0)) == 0,
            "still_": F.coalesce(F.col("volume") == 0, F.lit(False)),
            "move_": F.abs(F.col("close") / before - 1),
        }
    )
    bad_shape = (F.col("high") < F.greatest("open", "close")) | (F.col("low") > F.least("open", "close"))
    prices = [F.col(c) for c in ("open", "high", "low", "close")]
    invalid = F.exists(F.array(*prices), lambda x: x.isNull() | F.isnan(x) | (x <= 0)) | (F.col("volume") < 0)
    found = F.array(
        F.when(F.col("move_") > jump, F.struct(F.lit("jump").alias("type"), F.lit("error").alias("severity"))),
        F.when(bad_shape, F.struct(F.lit("inconsistent").alias("type"), F.lit("error").alias("severity"))),
        F.when(invalid, F.struct(F.lit("invalid").alias("type"), F.lit("error").alias("severity"))),
    )
    with working_tables(candles.sparkSession):
        kind = lambda name, level: F.struct(F.lit(name).alias("type"), F.lit(level).alias("severity"))
        rows = stored(rows.select(key, "timestamp", "flat_", "still_", F.array_compact(found).alias("found_")), "candle-runs")
        out = rows.select(key, "timestamp", F.inline("found_"))
        for flag, event in (("flat_", kind("flat_run", "warn")), ("still_", kind("zero_volume", "warn"))):
            runs = run_lengths(rows, flag, ["timestamp"], key=key).where(F.col("n") >= run)
            out = out.union(runs.select(key, F.col("last").alias("timestamp"), F.inline(F.array(event))))
        return kept(out, "candle-anomalies")


def consecutive_runs(rows: DataFrame, step: int, least: int, key: str = "symbol") -> DataFrame:
    """Rows that belong to runs of at least ``least`` rows ``step`` seconds apart."""
    island = F.unix_seconds("timestamp") - F.col("row_no") * step
    marked = numbered(rows, ["timestamp"], key=key).withColumn("island_", island).drop("row_no")
    return marked.withColumn("n_", F.count("*").over(W.partitionBy(key, "island_"))).where(F.col("n_") >= least).drop("island_", "n_")


def cleaned(candles: DataFrame, flagged: DataFrame, key: str = "symbol") -> DataFrame:
    """``candles`` without the flagged (key, timestamp)."""
    return candles.join(flagged.select(key, "timestamp").distinct(), [key, "timestamp"], "left_anti")


def auto_cleaned(candles: DataFrame, flagged: DataFrame, step: int, least: int = 5, windows: DataFrame | None = None, key: str = "symbol") -> DataFrame:
    """``candles`` with ``why``: NULL for those that stay, else zero_volume, flat_run or excluded.

    Zero-volume events go; candles of flat events go where ``least`` or more follow each other ``step`` seconds apart; what
    an exclusion window (key, start, end; left-closed) holds goes.
    """
    flat = consecutive_runs(flagged.where("type = 'flat_run'").select(key, "timestamp").distinct(), step, least, key)
    bad = flagged.where("type = 'zero_volume'").select(key, "timestamp", F.lit("zero_volume").alias("why_"))
    bad = bad.union(flat.select(key, "timestamp", F.lit("flat_run")))
    if windows is not None:
        inside = in_windows(candles, windows, 6 * 3600, half_open=True, key=key)
        bad = bad.union(inside.select(key, "timestamp", F.lit("excluded")))
    first = bad.groupBy(key, "timestamp").agg(F.min("why_").alias("why"))
    return candles.join(first, [key, "timestamp"], "left")


def gap_report(candles: DataFrame, step: int, key: str = "symbol") -> DataFrame:
    """(key, n_rows, n_gaps, largest gap in seconds, duplicates, first and last time)."""
    gap = F.unix_seconds("timestamp") - F.unix_seconds("before_")
    rows = with_previous(candles, {"before_": "timestamp"}, ["timestamp"], [key]).withColumn("gap_", gap)
    return rows.groupBy(key).agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("gap_") > step).alias("n_gaps"), F.max("gap_").alias("largest_gap"),
        F.count_if(F.col("gap_") == 0).alias("duplicates"), F.unix_micros(F.min("timestamp")).alias("first_us"), F.unix_micros(F.max("timestamp")).alias("last_us"),
    )

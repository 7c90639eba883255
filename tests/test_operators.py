"""Hand-made edge cases of the market operators."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quotemill.operators import bucketing, funnel, quality, routing, study, timejoins, windows
from quotemill.operators import thresholds as th
from quotemill.operators.spread import running
from quotemill.sources import ingest

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_tick_on_an_edge_goes_to_the_next_bucket(spark):
    df = frame(spark, [(at(0.0),), (at(0.249),), (at(0.25),)], "ts timestamp")
    ends = [r[0] for r in df.select(bucketing.right_edge("ts", "250 milliseconds")).collect()]
    assert ends == [at(0.25), at(0.25), at(0.5)]


def test_invalid_last_snapshot_is_not_replaced(spark):
    rows = [("a", at(1), 1, 10.0, 11.0), ("a", at(2), 2, 0.0, 11.0), ("a", at(12), 3, 10.0, 11.0), ("b", at(1), 4, math.nan, 1.0)]
    book = frame(spark, rows, "symbol string, timestamp timestamp, seq long, bid_0_price double, ask_0_price double")
    assert [r.seq for r in bucketing.last_snapshots(book, "10 seconds").collect()] == [3]


def nearest(spark, book, events, tol):
    b = frame(spark, [("a", at(t), s, float(s)) for t, s in book], "symbol string, timestamp timestamp, seq long, mid double")
    e = frame(spark, [("a", at(t), i) for i, t in enumerate(events)], "symbol string, timestamp timestamp, id long")
    out = timejoins.asof_nearest(e, b, ["mid"], tol, ["id"], "seq").orderBy("id").collect()
    return [None if r.mid is None else int(r.mid) for r in out]


def test_asof_nearest_ties_and_tolerance(spark):
    book = [(10, 1), (10, 2), (20, 3), (20, 4)]
    # exact: the last of equal times; in the middle: the earlier side; later side: the first of equal times
    assert nearest(spark, book, [10, 15, 19, 31, -1], 10) == [2, 2, 3, None, None]
    assert nearest(spark, book, [15.1], 10) == [3]


def test_asof_nearest_makes_no_pairs(spark):
    """A row looks at the row before and the one after it, however many are near, also over the ends of parts of the time line."""
    from random import Random

    r = Random(3)
    book = [(r.randrange(400), k) for k in range(300)]
    events = [r.randrange(-20, 420) for _ in range(200)]

    def by_hand(e, tol):
        near = [(abs(t - e), t > e, k if t > e else -k, k) for t, k in book if abs(t - e) <= tol]
        return min(near)[3] if near else None

    for tol in (1, 10):
        assert nearest(spark, book, events, tol) == [by_hand(e, tol) for e in events]
    e = frame(spark, [("a", at(1), 1)], "symbol string, timestamp timestamp, id long")
    b = frame(spark, [("a", at(1), 1, 1.0)], "symbol string, timestamp timestamp, seq long, mid double")
    assert "Join" not in timejoins.asof_nearest(e, b, ["mid"], 5, ["id"], "seq")._jdf.queryExecution().executedPlan().toString()


def test_horizon_results_are_not_broadcast(spark, tmp_path):
    """A row for each event comes back to it by merge, however small Spark takes the table to be: no table of the tape's size goes to the driver."""
    from quotemill.operators import backtest

    events = frame(spark, [(1, "a", at(1))], "event_id long, symbol string, timestamp timestamp")
    book = frame(spark, [("a", at(1), 1, 1.0, 2.0)], "symbol string, timestamp timestamp, seq long, bid_0_price double, ask_0_price double")
    for df, name in ((events, "events"), (book, "book")):
        df.write.parquet(f"{tmp_path}/{name}")
    out = backtest.horizon_pnl(*[spark.read.parquet(f"{tmp_path}/{name}") for name in ("events", "book")])
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.select("entry", "raw_30").first() == (1.5, 0.0)


def test_asof_backward_and_forward_cross_parts(spark):
    right = frame(spark, [("a", at(0), 1), ("a", at(86400 * 3), 2)], "symbol string, timestamp timestamp, v long")
    left = frame(spark, [("a", at(86400 * 2), 1), ("a", at(-5), 2), ("a", at(86400 * 9), 3)], "symbol string, timestamp timestamp, id long")
    back = {r.id: r.v for r in timejoins.asof(left, right, ["v"], ["v"]).collect()}
    ahead = {r.id: r.v for r in timejoins.asof(left, right, ["v"], ["v"], forward=True).collect()}
    assert back == {1: 1, 2: None, 3: 2} and ahead == {1: 2, 2: 1, 3: None}


def test_windows_touching_nested_disjoint(spark):
    e = frame(spark, [("a", at(t)) for t in (0, 10, 100, 101)], "symbol string, timestamp timestamp")
    got = sorted((r.start, r.end, r.n_events) for r in timejoins.merged_windows(e, 4, 6).collect())
    assert got == [(at(-4), at(16), 2), (at(96), at(107), 2)]


def test_range_join_equals_nested_loop(spark):
    left = frame(spark, [("a", at(7 * i), i) for i in range(20)], "symbol string, timestamp timestamp, id long")
    right = frame(spark, [("a", at(3 * i), i) for i in range(60)], "symbol string, timestamp timestamp, k long")
    got = {(r.id, r.k_r) for r in timejoins.range_join(left, right, 5, 11).collect()}
    assert got == {(i, k) for i in range(20) for k in range(60) if -5 <= 3 * k - 7 * i <= 11}


def test_range_join_shuffles_each_row_about_once(spark):
    """What is shuffled are the rows, and once more those that a range of the next part reaches, not a row for every bin."""
    left = spark.range(4000).select((F.col("id") % 1).cast("string").alias("symbol"), F.timestamp_seconds(F.col("id") * 9).alias("timestamp"), "id")
    right = left.withColumnRenamed("id", "k")
    sc = spark.sparkContext._jsc.sc()

    def stages():
        sc.listenerBus().waitUntilEmpty()
        none = spark.sparkContext._jvm.java.util.ArrayList()
        found = sc.statusStore().stageList(none, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), none)
        return {s.stageId(): s.shuffleWriteRecords() for s in (found.apply(i) for i in range(found.size()))}

    seen = stages()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert timejoins.range_join(left, right, 0, 1800).count() == 4000 * 201 - 200 * 201 // 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    made = sum(n for i, n in stages().items() if i not in seen)
    assert 8000 <= made <= 4000 + 1.3 * 4000 + 100  # the count's own few rows


def test_range_join_of_odd_rows(spark):
    """As a nested loop: unknown keys and times, times before 1970, ends of parts and slots, equal rows, ranges of no or odd length."""
    from random import Random

    r = Random(3)
    old = -54 * 366 * 86400  # before 1970
    for before, after in ((0, 0), (0, 0.000007), (2.5, 0.5), (0, 16), (-1, 3)):
        span = max(1, round(4 * (before + after)))
        times = lambda n: [at(o + r.choice((0, span, r.randrange(200) / 4)) + r.choice((0, 0.000001, -0.000001, after, -before))) for o in (0, old) for _ in range(n)]  # noqa: E731,B023
        mine = [(r.choice(("a", "b", None)), r.choice((t, t, t, None)), i // 2) for i, t in enumerate(times(40))]
        rows = [(r.choice(("a", "b", None)), r.choice((t, t, t, None)), i // 2) for i, t in enumerate(times(60))]
        left, right = frame(spark, mine, "symbol string, timestamp timestamp, id long"), frame(spark, rows, "symbol string, timestamp timestamp, k long")
        out = timejoins.range_join(left, right, before, after)
        assert out.columns == ["symbol", "timestamp", "id", "timestamp_r", "k_r"]
        us = lambda t: (t - T0) // dt.timedelta(microseconds=1)
        want = sorted((*x, *y[1:]) for x in mine for y in rows if x[0] and x[0] == y[0] and x[1] and y[1] and -round(before * 1e6) <= us(y[1]) - us(x[1]) <= round(after * 1e6))
        assert want and sorted(map(tuple, out.collect())) == want


def test_range_stats_make_no_pairs(spark):
    """Count, sum and least number of the rows in a range equal a nested loop's, also over parts, with unknown values and ties."""
    from random import Random

    r = Random(5)
    rows = [("a", at(r.randrange(500)), r.choice((None, 1.5, 2.0)), r.choice((None, k))) for k in range(300)]
    events = [("a", at(r.randrange(-50, 600)), i) for i in range(100)] + [("b", at(1), 100), (None, at(1), 101), ("a", None, 102)]
    left, right = frame(spark, events, "symbol string, timestamp timestamp, id long"), frame(spark, rows, "symbol string, timestamp timestamp, q double, k long")
    out = timejoins.range_stats(left, right, 4, 11, "id", "q", "k")
    want = {}
    for symbol, t, i in events:
        near = [x for x in rows if symbol == x[0] and t and -4 <= (x[1] - t).total_seconds() <= 11]
        if near:
            known, ids = [x[2] for x in near if x[2] is not None], [x[3] for x in near if x[3] is not None]
            want[i] = (len(near), sum(known) if known else None, min(ids, default=None))
    assert {x.id: (x.n, x.q, x.k) for x in out.collect()} == want
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_path_labels_make_no_rows_of_paths(spark):
    """No rows are made for the blocks of a path: paths may be as long as the tape is dense."""
    from quotemill.operators import backtest

    b = frame(spark, [("a", at(1), 1, 1.0, 1.1)], "symbol string, timestamp timestamp, seq long, bid_0_price double, ask_0_price double")
    c = frame(spark, [(1, "a", at(1), 1, 0.5, 0.5), (2, None, at(1), 1, 0.5, 0.5), (3, "a", at(1), None, 0.5, 0.5)], "event_id long, symbol string, timestamp timestamp, dir0 int, fees_rt_bps double, slip_bps double")
    out = backtest.path_labels(c, b, 3600.0, 9.0, wide_spread=40.0)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan and plan.count("Join") <= 1  # the limit beside the book
    assert {x.event_id: (x.label, x.reason, x.net_max is None) for x in out.collect()} == {1: (0, "none", False), 2: (0, "none", True), 3: (0, "none", True)}


def test_inventory_takes_days_by_the_nearest_second(spark):
    """As the SQL does: the last half second of a day is taken with the next day."""
    times = [at(86400 * d + s) for d, s in ((0, 5), (1, 86399.7), (2, 86399.2), (4, 86399.5), (5, 86399.9), (6, 7))]
    df = frame(spark, [("x-USDT-PERP", t) for t in times], "symbol string, timestamp timestamp")
    taken = lambda t, every: round((t - dt.datetime(1970, 1, 1)).total_seconds()) // 86400 % every == 0
    for every in (1, 2, 3):
        got = [x.n_days for x in ingest.symbols_like(df, "USDT", "-PERP", every).collect()]
        assert got == [len({t.date() for t in times if taken(t, every)})]
    assert got == [3]  # days 1, 2 and 4; by their own dates 2 and 5


@pytest.mark.parametrize("make", [lambda e, b: timejoins.asof_nearest(e, b, ["mid"], 5, ["id"], "seq"), lambda e, b: timejoins.range_join(e, b, 1, 5), lambda e, b: timejoins.in_windows(b, timejoins.merged_windows(e, 1, 5), 5)])
def test_time_joins_are_equi_joins(spark, make):
    e = frame(spark, [("a", at(1), 1)], "symbol string, timestamp timestamp, id long")
    b = frame(spark, [("a", at(1), 1, 1.0)], "symbol string, timestamp timestamp, seq long, mid double")
    plan = make(e, b)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_persistence_resets_and_caps(spark):
    rows = [("a", at(t), float(s)) for t, s in ((0, 1), (0.5, 1), (1.0, 1), (1.5, -1), (2.0, 0), (2.5, -1), (3.0, -1))]
    df = frame(spark, rows, "symbol string, bucket timestamp, s double")
    for part in (86400, 1):  # one part, and a part for each second
        got = [r[0] for r in windows.with_persistence(df, {"p": "s"}, 800, ["bucket"], part).orderBy("bucket").select("p").collect()]
        assert got == [0, 500, 800, 0, 0, 0, 500]


def test_runs_go_over_parts(spark):
    flags = [True, True, False, True, True, True, False, False, True]
    df = frame(spark, [("a", at(3600 * i), f) for i, f in enumerate(flags)], "symbol string, timestamp timestamp, up boolean")
    for part in (86400 * 99, 7200):
        runs = windows.run_lengths(df, "up", ["timestamp"], part).orderBy("first").collect()
        assert [((r.first - T0).seconds // 3600, r.n) for r in runs] == [(0, 2), (3, 3), (8, 1)]


def test_time_medians_in_parts_equal_whole_ones(spark):
    rows = [("a", at(600 * i * (1 + i % 3)), float(i * i % 17), float(i % 7 + 1)) for i in range(120)]
    df = frame(spark, rows, "symbol string, bucket timestamp, spread_bps double, d double")
    made = [windows.time_medians(df, 3000, 20_000, {"thin": "d"}, 9000, part=p).orderBy("bucket").collect() for p in (10**9, 25_000)]
    assert made[0] == made[1] and len(made[0]) == 120


def test_row_windows_in_chunks_equal_plain_ones(spark):
    df = frame(spark, [("a", at(i * 40000), float(i * i % 17)) for i in range(50)], "symbol string, bucket timestamp, v double")
    chunks = windows.row_chunks(df, ["bucket"], halo=4, chunk=7)
    assert chunks.where("own_").count() == 50
    wide = windows.over_rows(df, ["bucket"], {"s": (F.sum("v"), 5)}).orderBy("bucket").collect()
    values = [float(i * i % 17) for i in range(50)]
    assert [r.s for r in wide] == [sum(values[max(0, i - 4) : i + 1]) for i in range(50)]


def test_row_extremes_equal_plain_ones(spark):
    values = [None if i % 11 == 3 else float(i * 37 % 23) for i in range(60)]
    df = frame(spark, [("a", at(i * 40000), v) for i, v in enumerate(values)], "symbol string, bucket timestamp, v double")
    for n in (1, 4, 7, 80):
        wide = windows.over_rows(df, ["bucket"], {}, {"x": ("v", n), "y": ("v", 3)}).orderBy("bucket").collect()
        last = [[v for v in values[max(0, i - n + 1) : i + 1] if v is not None] for i in range(60)]
        assert [(r.x_hi, r.x_lo, r.x_n) for r in wide] == [(max(w, default=None), min(w, default=None), len(w)) for w in last]


def test_sliding_medians_equal_plain_ones():
    from random import Random
    from statistics import median

    r = Random(1)
    for _ in range(60):
        times = sorted(r.randrange(200) for _ in range(r.randrange(1, 150)))
        values = [None if r.random() < 0.1 else float(r.randrange(12)) for _ in times]
        reach = r.choice((1, 5, 30, 500))
        want = [[v for t, v in zip(times, values, strict=True) if now - reach < t <= now and v is not None] for now in times]
        assert windows.sliding_medians(times, values, reach) == ([median(w) if w else None for w in want], [len(w) for w in want])


def test_sliding_medians_take_few_steps_for_a_row(monkeypatch):
    """Heap moves of 20 000 rows, with windows of 50 and of 5000: about the same number."""
    moved = []
    monkeypatch.setattr(windows, "heappop", lambda h, pop=windows.heappop: moved.append(1) or pop(h))
    counts = []
    for reach in (50, 5000):
        moved.clear()
        windows.sliding_medians(list(range(20_000)), [float(i * 7919 % 10_007) for i in range(20_000)], reach)
        counts.append(len(moved))
    assert max(counts) < 60_000


def test_percentiles_leave_out_nan_and_null(spark):
    df = frame(spark, [(1.0,), (2.0,), (math.nan,), (None,), (math.inf,)], "x double")
    assert th.percentiles(df, {"m": ("x", 0.5)}).first().m == 1.5
    assert th.percentiles(df.where("x > 100 and x < 200"), {"m": ("x", 0.5)}).first().m is None


def test_score_bins_differ_from_ntile(spark):
    for n, want in ((12, [0, 0, 1, 2, 3, 4, 4, 5, 6, 7, 8, 9]), (10, list(range(10)))):
        df = frame(spark, [(float(n - i), i) for i in range(n)], "score double, id long")
        got = [r.bin for r in study.score_bins(df, "score", "id", 10).orderBy("id").collect()]
        assert got[0] == 0 and got[-1] == 9 and sorted(got) == got
        assert n != 10 or got == want


def test_top_share_rounds_half_to_even_and_keeps_one(spark):
    df = frame(spark, [(float(i), float(i), i) for i in range(5)], "score double, v double, id long")
    got = {r.share: r.k for r in study.top_shares(df, "score", "v", "id", [0.5, 0.1]).collect()}
    assert got == {0.5: 2, 0.1: 1}


def test_governor_boundaries(spark):
    pnl = [-5.0, -1.0, -5.0, 1.0]
    df = frame(spark, [(1, i, p, 1.0) for i, p in enumerate(pnl)], "day int, id int, p double, z double")
    out = study.governor(df, "day", ["id"], "p", "z", [(0.0, 1.0), (-5.0, 0.9), (-10.0, 0.75)], 0.5).orderBy("id").collect()
    # before: 0 -> 1; -5 is not above -5 -> 0.75; -5.75 -> 0.75; -9.5 -> 0.75
    assert [r.size_used for r in out] == [1.0, 0.75, 0.75, 0.75]


def test_flat_runs_of_k_and_fewer(spark):
    close = [1.0, 1.0, 1.0, 2.0, 2.0, 3.0]
    df = frame(spark, [("a", at(60 * i), c, c, c, c, 1.0) for i, c in enumerate(close)], "symbol string, timestamp timestamp, open double, high double, low double, close double, volume double")
    flat = [r.timestamp for r in quality.anomalies(df, 3, 9.0).where("type = 'flat_run'").collect()]
    assert flat == [at(120)]
    assert quality.anomalies(df.where("close < 0"), 3, 9.0).count() == 0


def test_runs_that_last_for_weeks(spark):
    """Runs across the 7-day parts of the time line, for flat and for zero-volume candles, against a loop over rows."""
    from random import Random

    r, rows, close, volume = Random(5), [], 1.0, 1.0
    for symbol in ("a", "b"):
        for i in range(120):
            close, volume = (close if r.random() < 0.93 else close + 1), (volume if r.random() < 0.9 else 1 - volume)
            rows.append((symbol, at(6 * 3600 * i), close, close, close, close, volume))
    want = set()
    for symbol in ("a", "b"):
        own = [x for x in rows if x[0] == symbol]
        flags = {"flat_run": [i == 0 or own[i][5] == own[i - 1][5] for i in range(len(own))], "zero_volume": [x[6] == 0 for x in own]}
        for kind, flag in flags.items():
            n = 0
            for i, on in enumerate(flag):
                n = n + 1 if on else 0
                if n >= 3 and not (i + 1 < len(flag) and flag[i + 1]):
                    want.add((symbol, own[i][1], kind))
    df = frame(spark, rows, "symbol string, timestamp timestamp, open double, high double, low double, close double, volume double")
    got = [(x.symbol, x.timestamp, x.type) for x in quality.anomalies(df, 3, 99.0).collect()]
    assert set(got) == want and len(got) == len(want) > 10


@pytest.mark.parametrize("closed_only", [False, True])
def test_aligned_windows_are_the_last_bars_of_each_step(spark, closed_only):
    from random import Random

    r = Random(3)
    hours = {s: sorted(r.sample(range(400), 150)) for s in ("a", "b")}
    rows = [(s, at(3600 * h), float(h), h + 1.0, h - 1.0, h + 0.5, 1.0) for s in hours for h in hours[s]]
    df = frame(spark, rows, "symbol string, timestamp timestamp, open double, high double, low double, close double, volume double")
    got = {(x.symbol, x.step_ts): ([b.close for b in x.bars_7200], [b.close for b in x.bars_14400]) for x in bucketing.aligned_windows(df, {7200: 4, 14400: 3}, 7200, 2, closed_only).collect()}
    want = {}
    for s, own in hours.items():
        for step in {h // 2 * 2 for h in own}:
            lists = []
            for length, n in ((2, 4), (4, 3)):
                bars = {}
                for h in own:
                    bars[h // length * length] = h + 0.5  # hours rise: the last one is the close
                seen = [bars[b] for b in sorted(bars) if b + (length if closed_only else 0) <= step]
                lists.append(seen[-n:] if len(seen) >= 2 + n else None)
            if None not in lists:
                want[s, at(3600 * step)] = tuple(lists)
    assert got == want and len(want) > 100


def test_masks_are_false_for_null(spark):
    fields = ["dir0", "spread_rel", "thr_spread_rel", "spread_ticks", "thr_spread_ticks", "range60_bps", "thr_range60", "abs_obi10", "thr_obi", "abs_micro", "thr_micro", "notional_buy_w", "notional_sell_w", "abs_ti", "thr_ti", "nps", "thr_nps", "persist_micro_ms", "thr_persist_micro", "persist_obi_ms", "thr_persist_obi", "thin3", "thr_thin", "micro_bias", "ti"]
    df = frame(spark, [tuple([None] * len(fields))], ", ".join(f"{f} double" for f in fields))
    row = df.select(*[m.alias(n) for n, m in funnel.masks()]).first()
    assert not any(row)


def test_months(spark):
    assert ingest.months_between("2023-11", "2024-02") == ["2023-11", "2023-12", "2024-01", "2024-02"]
    assert ingest.trailing_months("2024-02", 3) == ["2023-11", "2023-12", "2024-01"]


def test_epoch_texts_and_failures(spark):
    df = frame(spark, [("1704067200000",), ("2024-01-01 00:00:00",), ("nonsense",), (None,)], "t string")
    assert [r.t for r in ingest.epoch_timestamp(df, "t").collect()] == [T0, T0, None, None]


def test_missing_json_gives_an_empty_table(spark, tmp_path):
    assert ingest.read_json_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0


def test_rolling_thresholds_only_get_stricter(spark):
    rows = [(op, m, 10.0, v, n, on) for op, on in (("<", True), (">", True), ("<", False)) for m, (v, n) in enumerate([(20.0, 100), (0.0, 100), (20.0, 20), (5.0, 3), (None, 100)])]
    local = frame(spark, rows, "op string, month int, prior double, v double, n long, on boolean").withColumn("g", F.concat("op", F.col("on").cast("string")))
    out = routing.rolling_thresholds(local, ["g"], "month", "prior", "v", "n", 50, 10, enabled="on").orderBy("g", "month").collect()
    used = {g: [round(r.used, 6) for r in out if r.g == g] for g in ("<true", ">true", "<false")}
    # from n0 rows on: < may only fall, > only rise; fewer than that: either way, by 7 % at most; too few or unknown: kept
    assert used["<true"] == [10, 10, 9.3, 9.951, 9.951] and used[">true"] == [10, 10.7, 10.7, 11.449, 11.449] and used["<false"] == [10] * 5


def test_binned_regime_falls_back(spark):
    flat = [("a", 1.0)] * 4 + [("b", float(k)) for k in range(10)]
    got = routing.binned_regime(frame(spark, flat, "s string, v double"), "v", [F.col("s")]).collect()
    assert {r.regime for r in got if r.s == "a"} == {"CALM"}  # group edges don't rise: those of all rows, 1.2 and 4.75
    assert [r.regime for r in sorted((r for r in got if r.s == "b"), key=lambda r: r.v)] == ["CALM"] * 4 + ["NORMAL"] * 3 + ["VOLATILE"] * 3
    same = routing.binned_regime(frame(spark, [("a", 1.0)] * 4, "s string, v double"), "v", [F.col("s")])
    assert {r.regime for r in same.collect()} == {"NORMAL"}


def test_labelled_rows_sample_the_last_flag(spark):
    rows = [(i, False, False, True) for i in range(30)]
    tags = frame(spark, rows, "id long, pass_all_hard boolean, pass_ms_keep boolean, pass_up_to_sign_ti boolean")
    one = {r.id for r in funnel.labelled_rows(tags, 5, ["id"]).collect()}
    assert len(one) == 5 and one == {r.id for r in funnel.labelled_rows(tags.repartition(7), 5, ["id"]).collect()}
    assert funnel.labelled_rows(tags, 30, ["id"]).count() == 30 and funnel.labelled_rows(tags.where("id < 0"), 30, ["id"]).count() == 0


def test_regime_edges_need_rows(spark):
    df = frame(spark, [(float(i),) for i in range(10)], "x double")
    assert th.regime_edges(df, "x").first().lo is None and th.regime_edges(df, "x", least_rows=10).first().lo == 3.6


def test_frequencies(spark):
    from quotemill.functions import expr as x

    df = frame(spark, [("250ms",), ("5m",), ("1h",), ("1d",), ("soon",)], "f string")
    assert [tuple(r) for r in df.select(x.frequency_ms("f"), x.resample_name("f")).collect()] == [(250, "250ms"), (300_000, "5min"), (3_600_000, "1h"), (86_400_000, "1d"), (None, "soon")]


def test_working_tables_are_deleted(spark):
    import os

    from quotemill.sources.scratch import kept, stored, working_tables

    path = lambda df: df.inputFiles()[0].removeprefix("file:").lstrip("/")
    with working_tables(spark):
        with working_tables(spark):
            gone = path(stored(spark.range(3).coalesce(1), "a"))
            left = kept(spark.range(3).coalesce(1), "b")
        assert not os.path.exists(f"/{gone}") and left.count() == 3
        left = path(left)
    assert not os.path.exists(f"/{left}")
    assert kept(spark.range(3), "c").count() == 3


def test_working_tables_of_threads_and_failures(spark):
    import os
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    from quotemill.sources.scratch import kept, stored, sweep, working_tables

    path = lambda df: "/" + df.inputFiles()[0].removeprefix("file:").lstrip("/")
    both = Barrier(2)

    def build(k):
        with working_tables(spark):
            mine = path(stored(spark.range(3).coalesce(1), f"t{k}"))
            both.wait()
            out = kept(spark.range(k).coalesce(1), f"k{k}")
            assert os.path.exists(mine)
            both.wait()
        return mine, out

    with ThreadPoolExecutor(2) as pool:
        for mine, out in pool.map(build, (4, 5)):
            assert not os.path.exists(mine) and out.count() in (4, 5)
    with pytest.raises(ZeroDivisionError), working_tables(spark):
        lost = path(stored(spark.range(3).coalesce(1), "f"))
        raise ZeroDivisionError
    assert not os.path.exists(lost)
    old = kept(spark.range(3).coalesce(1), "old")
    assert sweep(spark, 3600) == 0 and old.count() == 3 and os.path.exists(path(old))


def test_percentiles_equal_the_aggregate(spark):
    rows = [(s, float(v)) for s, scale in (("a", 1e-9), ("b", 1.0), ("b", 1e9), ("c", 0.0)) for v in (scale * (i * 37 % 101) ** 3 for i in range(300))]
    df = spark.createDataFrame([*rows, ("d", None), (None, 2.0), (None, 5.0), *[("b", 7.0)] * 300], "s string, x double").repartition(7)
    shares = {"p0": 0.0, "p3": 0.3, "p5": 0.5, "p97": 0.97, "p100": 1.0}
    got = {r.s: r.asDict() for r in th.percentiles(df, {n: ("x", q) for n, q in shares.items()}, ["s"]).collect()}
    want = {r.s: r.asDict() for r in df.groupBy("s").agg(*[F.percentile("x", F.lit(q)).alias(n) for n, q in shares.items()]).collect()}
    assert got == want and got["d"]["p5"] is None and got[None]["p5"] == 3.5


def test_running_sums_and_previous_rows_cross_parts(spark):
    rows = spark.range(5000).select((F.col("id") % 2).alias("g"), (F.hash("id") % 1000).alias("v"), "id", F.timestamp_seconds(F.col("id") * 1000).alias("t"))
    rows = rows.withColumn("v", F.when(F.col("id") % 9 != 0, F.col("v")))
    order = W.partitionBy("g").orderBy(F.desc("v"), "id")
    summed = running(rows, ["g"], [F.desc("v"), F.asc("id")], {"up": F.lit(1)}, "test-running")
    assert summed.withColumn("want", F.row_number().over(order)).where("up <> want or all_up <> 2500").count() == 0 and summed.count() == 5000
    before = windows.with_previous(rows, {"b": "v"}, ["t", "id"], ["g"], part_seconds=7777)
    want = F.lag("v").over(W.partitionBy("g").orderBy("t", "id"))
    assert before.withColumn("want", want).where("not b <=> want").count() == 0 and before.count() == 5000


def test_live_features_keep_a_bounded_state():
    """Fed one bucket at a time or all at once, the features are the same, and what is held doesn't grow."""
    import pandas as pd

    from quotemill.streaming.live import Reach, RollingFeatures

    class Kept:
        def __init__(self):
            self.value = None

        def get(self):
            return self.value or ([] if self.rows else None)

        def put(self, value):
            self.value = value

        update = put

    class Handle:
        def __init__(self):
            self.states = []

        def state(self, rows):
            k = Kept()
            k.rows = rows
            self.states.append(k)
            return k

        getListState = lambda self, *a: self.state(True)
        getValueState = lambda self, *a: self.state(False)

    n = 200
    rows = pd.DataFrame({"bucket": pd.date_range("2024-01-01", periods=n, freq="h"), "us": [i * 3_600_000_000 for i in range(n)]})
    for k, c in enumerate(("mid", "notional_buy", "notional_sell", "spread_bps", "spread_ticks", "micro_bias", "obi10", "da3", "db3", "da10", "db10")):
        rows[c] = [float((i * (7 + k)) % 13 - (6 if c in ("micro_bias", "obi10") else 0)) + (1.0 if c == "mid" else 0.0) for i in range(n)]
    rows["ntr"] = [i % 5 for i in range(n)]
    reach = Reach(3, 10800.0, 4, 9, 7200.0, 36000.0, 14400.0, 10**7, 4)
    made = []
    for size in (n, 1, 17):
        processor, handle = RollingFeatures(reach), Handle()
        processor.init(handle)
        parts = [next(iter(processor.handleInputRows(("a",), iter([rows[i : i + size]]), None))) for i in range(0, n, size)]
        made.append(pd.concat(parts, ignore_index=True))
        assert len(handle.states[0].value) <= 12
    pd.testing.assert_frame_equal(made[0], made[1])
    pd.testing.assert_frame_equal(made[0], made[2])


@pytest.mark.parametrize("forward", [False, True])
def test_asof_hands_on_right_rows_past_probes(spark, forward):
    """The last (first) row of a part of the time line is a probe: what is handed on is still the right row of that part."""
    sign = -1 if forward else 1
    right = frame(spark, [("a", at(86400 * 10 + sign * h * 3600), h) for h in (-60, 2, 5)], "symbol string, timestamp timestamp, k long")
    left = frame(spark, [("a", at(86400 * 10 + sign * h * 3600), h) for h in (6, 20, 30, 55)], "symbol string, timestamp timestamp, id long")
    got = {r.id: r.k for r in timejoins.asof(left, right, ["k"], ["k"], forward=forward).collect()}
    assert got == {6: 5, 20: 5, 30: 5, 55: 5}


def path_by_hand(row, book, horizon, target, wide):
    """One candidate's label by walking over its path."""
    path = [b for b in book if row["symbol"] == b["symbol"] and 0 <= (b["t"] - row["t"]) <= horizon]
    if not row["dir0"] or not path:
        return None, None, 0, "none", None
    ea, eb = path[0]["ask"], path[0]["bid"]
    raws = [(b["bid"] - ea) / ea * 1e4 if row["dir0"] > 0 else (eb - b["ask"]) / eb * 1e4 for b in path]
    nets = [x - 1.0 for x in raws]
    hit = next((k for k, x in enumerate(nets) if x >= target), None)
    w = next((k for k, b in enumerate(path) if (b["ask"] - b["bid"]) / ((b["ask"] + b["bid"]) / 2 + 1e-12) * 1e4 >= wide), None)
    if w is not None and not raws[min(w + 2, len(path) - 1)] > raws[w]:
        w = None
    reason = "pnl_net" if hit is not None and (w is None or hit <= w) else "spread" if w is not None else "none"
    k = {"pnl_net": hit, "spread": w}.get(reason)
    return max(nets), min(nets), int(max(nets) >= target), reason, None if k is None else float(path[k]["t"] - row["t"])


@pytest.mark.parametrize("block_rows", [1, 4, 16, 1000])
def test_path_labels_equal_a_walk_along_each_path(spark, block_rows):
    from random import Random

    from quotemill.operators import backtest

    r = Random(block_rows)
    book = [{"symbol": s, "t": t, "seq": t, "bid": 100 + r.choice((-1, 0, 1, 2)) * 0.1, "ask": 0.0} for s in "ab" for t in sorted(r.sample(range(400_000), 120))]
    for b in book:
        b["ask"] = b["bid"] + r.choice((0.1, 0.1, 0.1, 0.5))
    rows = [{"event_id": i, "symbol": r.choice("abc"), "t": r.randrange(400_000), "dir0": r.choice((-1, 0, 1))} for i in range(150)]
    b = frame(spark, [(x["symbol"], at(x["t"]), x["seq"], x["bid"], x["ask"]) for x in book], "symbol string, timestamp timestamp, seq long, bid_0_price double, ask_0_price double")
    c = frame(spark, [(x["event_id"], x["symbol"], at(x["t"]), x["dir0"], 0.5, 0.5) for x in rows], "event_id long, symbol string, timestamp timestamp, dir0 int, fees_rt_bps double, slip_bps double")
    for horizon in (2_000, 90_000):
        got = {x.event_id: x for x in backtest.path_labels(c, b, horizon, 9.0, wide_spread=40.0, block_rows=block_rows).collect()}
        for row in rows:
            x = got[row["event_id"]]
            rounded = lambda values: tuple(round(v, 6) if isinstance(v, float) else v for v in values)
            assert rounded((x.net_max, x.net_min, x.label, x.reason, x.seconds)) == rounded(path_by_hand(row, book, horizon, 9.0, 40.0))

"""Router evaluation over grids of results: regimes, cut-offs, votes, rolling thresholds, grid search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quotemill.functions.expr import finite
from quotemill.operators.spread import beside_keys, exact_percentiles, stats_by

COMBO = r"^pnl_net_rr([0-9.]+)_rf([0-9]+)_ts([0-9]+)$"


def long_results(grid: DataFrame, ids: list[str]) -> DataFrame:
    """Wide result columns as rows (rr, rf, ts, pnl); numbers are compared as numbers, however they are written."""
    names = [c for c in grid.columns if c.startswith("pnl_net_rr")]
    quoted = grid.select(*ids, *[F.col(f"`{c}`").cast("double").alias(c.replace(".", "_")) for c in names])
    stacked = F.array(*[F.struct(F.lit(c).alias("combo"), F.col(c.replace(".", "_")).alias("pnl")) for c in names])
    rows = quoted.select(*ids, F.inline(stacked))
    part = lambda k: F.regexp_extract("combo", COMBO, k)
    return rows.select(*ids, part(1).cast("double").alias("rr"), part(2).cast("int").alias("rf"), part(3).cast("int").alias("ts"), "pnl")


def chosen_result(rows: DataFrame, params: DataFrame, on: list[str], ids: list[str]) -> DataFrame:
    """Of each row the result with the smallest rr that reaches the parameter's ``rr_min``; without one, no row."""
    fit = rows.join(F.broadcast(params), on).where(F.col("rr") >= F.col("rr_min"))
    return fit.groupBy(*ids).agg(F.min_by("pnl", F.struct("rr", "rf", "ts")).alias("pnl"), F.min("rr").alias("rr"))


def group_regime(df: DataFrame, value: str, by: list[Column], lo: float = 0.4, hi: float = 0.75, least_rows: int = 0) -> DataFrame:
    """Regime of each row by its group's percentiles; VOLATILE wins, unknown values and small groups are NORMAL."""
    named = df.withColumns({f"g{i}_": c for i, c in enumerate(by)})
    keys = [f"g{i}_" for i in range(len(by))]
    cuts = stats_by(named.select(*keys, value), keys, [F.count(value).alias("n_")], {"lo_": (value, lo), "hi_": (value, hi)})
    joined = beside_keys(named, cuts, keys)
    regime = F.when(F.col("n_") < least_rows, "NORMAL").when(F.col(value) >= F.col("hi_"), "VOLATILE").when(F.col(value) <= F.col("lo_"), "CALM").otherwise("NORMAL")
    return joined.withColumn("regime", regime).drop(*keys, "lo_", "hi_", "n_")


def binned_regime(df: DataFrame, value: str, by: list[Column], lo: float = 0.4, hi: float = 0.75) -> DataFrame:
    """Regime of each row by right-closed bins: its group's percentiles, where they don't rise those of all rows, and
    where those don't either the median of all. Unknown values have no regime."""
    named = df.withColumns({f"g{i}_": c for i, c in enumerate(by)})
    keys = [f"g{i}_" for i in range(len(by))]
    own = exact_percentiles(named, {"lo_": (value, lo), "hi_": (value, hi)}, keys)
    every = exact_percentiles(df, {"all_lo_": (value, lo), "all_hi_": (value, hi), "med_": (value, 0.5)})
    rises, all_rise = F.col("lo_") < F.col("hi_"), F.col("all_lo_") < F.col("all_hi_")
    pick = lambda a, b, m: F.when(rises, F.col(a)).when(all_rise, F.col(b)).otherwise(m)
    edges = own.crossJoin(F.broadcast(every)).select(
        *keys, pick("lo_", "all_lo_", F.col("med_") - 1e-12).alias("e1_"), pick("hi_", "all_hi_", F.col("med_") + 1e-12).alias("e2_")
    )
    joined = beside_keys(named, edges, keys)
    regime = F.when(F.col(value) <= F.col("e1_"), "CALM").when(F.col(value) <= F.col("e2_"), "NORMAL").when(F.col(value).isNotNull(), "VOLATILE")
    return joined.withColumn("regime", regime).drop(*keys, "e1_", "e2_")


def strict_reasons(df: DataFrame, cuts: DataFrame, features: list[str], ids: list[str], on: list[str]) -> DataFrame:
    """(ids, on, feature, verdict): keep, reject or na of each row and feature against its cut-off.

    A cut-off is a range (``least``, ``most``, each end optional), or binary where ``cuts`` has a ``keep`` that is known:
    whether the value is not 0 must be what it says. A missing cut-off and a missing or infinite value are na, and
    reject the row.
    """
    cuts = cuts if "keep" in cuts.columns else cuts.withColumn("keep", F.lit(None).cast("int"))
    values = F.array(*[F.struct(F.lit(f).alias("feature"), finite(f).alias("x")) for f in features])
    rows = df.select(*ids, *on, F.inline(values))
    both = rows.join(F.broadcast(cuts), [*on, "feature"], "left")
    inside = (F.col("x") >= F.coalesce("least", F.lit(float("-inf")))) & (F.col("x") <= F.coalesce("most", F.lit(float("inf"))))
    inside = F.when(F.col("keep").isNotNull(), (F.col("x") != 0) == (F.col("keep") != 0)).otherwise(inside)
    missing = F.col("x").isNull() | (F.col("least").isNull() & F.col("most").isNull() & F.col("keep").isNull())
    return both.withColumn("verdict", F.when(missing, "na").when(inside, "keep").otherwise("reject"))


def strict_filter(reasons: DataFrame, ids: list[str], on: list[str]) -> DataFrame:
    """(ids, on, kept, why): kept only where every feature is; ``why`` lists the others."""
    bad = F.when(F.col("verdict") != "keep", F.col("feature"))
    return reasons.groupBy(*ids, *on).agg((F.count(bad) == 0).alias("kept"), F.array_join(F.array_sort(F.collect_set(bad)), ";").alias("why"))


def majority_vote(conditions: dict[str, tuple[Column, Column]], all_of: Column) -> Column:
    """Votes (condition, present): four or more present need 3, three need 2, fewer or ``all_of`` need all; none fails."""
    yes = reduce(lambda a, b: a + b, [F.coalesce(c & p, F.lit(False)).cast("int") for c, p in conditions.values()])
    there = reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(False)).cast("int") for _, p in conditions.values()])
    need = F.when(all_of, there).when(there >= 4, 3).when(there == 3, 2).otherwise(there)
    return (there > 0) & (yes >= need)


def rolling_thresholds(
    local: DataFrame, by: list[str], month: str, prior: str, value: str, count: str, n0: int, least: int, clip: float = 0.07, op: str = "op", enabled: str | None = None
) -> DataFrame:
    """Bayesian thresholds: the blend after each month, valid from the next on.

    alpha = n / (n + n0); the new value is (1 - alpha) old + alpha local, moved at most ``clip`` of the old; fewer than
    ``least`` rows or an unknown local value keep the old. From n0 rows on it only gets stricter: for features that
    must be below it (``op`` <) it may only fall, for those above (>) only rise. Groups that ``enabled`` rules out keep
    their prior. A group's months are one array, folded natively.
    """
    on = F.lit(True) if enabled is None else F.first(enabled)
    month_row = F.struct(F.col(month).alias("m"), F.col(value).cast("double").alias("v"), F.col(count).cast("double").alias("n"))
    rows = local.groupBy(*by).agg(F.first(prior).cast("double").alias("p0"), F.first(op).alias("op_"), on.alias("on_"), F.array_sort(F.collect_list(month_row)).alias("t"))

    def step(acc: Column, x: Column) -> Column:
        old, a = acc["cur"], x["n"] / (x["n"] + n0)
        blend = (1 - a) * old + a * x["v"]
        room = F.abs(old) * clip
        moved = F.least(F.greatest(blend, old - room), old + room)
        strict = F.when(F.col("op_") == "<", F.least(moved, old)).when(F.col("op_") == ">", F.greatest(moved, old)).otherwise(moved)
        keeps = ~F.col("on_") | (x["n"] < least) | x["v"].isNull()
        new = F.when(keeps, old).when(x["n"] >= n0, strict).otherwise(moved)
        return F.struct(new.alias("cur"), F.concat(acc["done"], F.array(F.struct(x["m"].alias("m"), old.alias("used"), new.alias("next")))).alias("done"))

    kind = local.schema[month].dataType.simpleString()
    start = F.struct(F.col("p0").alias("cur"), F.array().cast(f"array<struct<m:{kind},used:double,next:double>>").alias("done"))
    return rows.select(*by, F.inline(F.aggregate("t", start, step)["done"])).withColumnRenamed("m", month)


def expectancy(df: DataFrame, by: list[str], value: str, kept: str, least: int = 0) -> DataFrame:
    """Count, mean and win rate of all and of kept rows, uplift and coverage; ``few`` where fewer than ``least`` are kept."""
    k = F.when(F.col(kept), F.col(value))
    return df.groupBy(*by).agg(
        F.count(value).alias("n_all"), F.avg(value).alias("ev_all"), F.count(k).alias("n_kept"), F.avg(k).alias("ev_kept"),
        F.avg((k > 0).cast("int")).alias("winrate"), (F.avg(k) - F.avg(value)).alias("uplift"),
        F.try_divide(F.count(k), F.count(value)).alias("coverage"), (F.count(k) < least).alias("few"),
    )


def grid_search(df: DataFrame, value: str, features: dict[str, tuple[str, list[float]]], month: str, by: list[str], need: int) -> DataFrame:
    """Percentile cut-offs of every point of a grid, in each group: rows with ``need`` votes or more pass.

    ``features``: name to (op, shares); a vote is a value strictly below (<) or above (>) the group's percentile. Columns:
    the group, q_<feature>, n, coverage, ev, winrate (weighted by months' counts), least_month. Points whose cut-off is
    unknown or which let nothing pass are left out. Cut-offs are one pass over all shares, a few rows beside the rows.
    """
    names = {f: [f"c{k}_{f}" for k in range(len(qs))] for f, (_, qs) in features.items()}
    cuts = {n: (f, q) for f, (_, qs) in features.items() for n, q in zip(names[f], qs, strict=True)}
    points = stats_by(df.select(*by, value, *features), by, [F.count(value).alias("all_")], cuts)
    points = points.select(*by, "all_", *[F.array(*ns).alias(f"c_{f}") for f, ns in names.items()])
    for f, (_, qs) in features.items():
        places = F.array(*[F.struct(F.lit(float(q)).alias(f"q_{f}"), F.lit(k).alias("k_")) for k, q in enumerate(qs)])
        points = points.select("*", F.inline(places)).withColumn(f"l_{f}", F.get(f"c_{f}", F.col("k_"))).where(F.col(f"l_{f}").isNotNull()).drop("k_", f"c_{f}")
    rows = df.select(*by, month, value, *features).join(F.broadcast(points), by)
    vote = lambda f, op: F.coalesce(F.col(f) < F.col(f"l_{f}") if op == "<" else F.col(f) > F.col(f"l_{f}"), F.lit(False)).cast("int")
    votes = reduce(lambda a, b: a + b, [vote(f, op) for f, (op, _) in features.items()])
    shares = [*by, "all_", *[f"q_{f}" for f in features]]
    passed = rows.where((votes >= need) & F.col(value).isNotNull())
    monthly = passed.groupBy(*shares, month).agg(F.count("*").alias("n"), F.sum(value).alias("s"), F.count_if(F.col(value) > 0).alias("w"))
    n = F.sum("n")
    return monthly.groupBy(*shares).agg(
        n.alias("n"), F.try_divide(n, F.first("all_")).alias("coverage"), F.try_divide(F.sum("s"), n).alias("ev"), F.try_divide(F.sum("w"), n).alias("winrate"), F.min("n").alias("least_month")
    ).drop("all_")


def recap(monthly: DataFrame, by: list[str], n: str, ev: str, winrate: str) -> DataFrame:
    """Months put together: rows, and mean and win rate weighted by the rows of each month; the mean in bps."""
    weighted = lambda c: F.try_divide(F.sum(F.col(n) * F.col(c)), F.sum(F.when(F.col(c).isNotNull(), F.col(n))))
    return monthly.groupBy(*by).agg(F.sum(n).alias("n"), (weighted(ev) * 1e4).alias("ev_bps"), weighted(winrate).alias("winrate"))


def presence(groups: DataFrame, params: DataFrame, cuts: DataFrame, columns: list[str], on: list[str]) -> DataFrame:
    """Of each group whether its result column and the features of its cut-offs are among ``columns``.

    ``params``: on, rr_min, rf, ts. ``groups`` with chosen, combo_exists, n_features, n_present and missing (``;``-joined).
    """
    chosen = F.format_string("pnl_net_rr%.2f_rf%d_ts%d", "rr_min", "rf", "ts")
    known = F.col("feature").isin(*columns)
    features = cuts.groupBy(*on).agg(F.count("*").alias("n_features"), F.count_if(known).alias("n_present"), F.array_join(F.array_sort(F.collect_set(F.when(~known, F.col("feature")))), ";").alias("missing"))
    named = params.select(*on, chosen.alias("chosen"))
    out = beside_keys(beside_keys(groups, named, on, "left"), features, on, "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_features", "n_present")}
    return out.withColumns({"combo_exists": F.coalesce(F.col("chosen").isin(*columns), F.lit(False)).cast("int"), "missing": F.coalesce("missing", F.lit("")), **zero})


def shares_by(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Counts of each value and their share in the group."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(*by)))

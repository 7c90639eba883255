"""Thresholds fitted on training rows: exact percentiles, medians with deviations, bucket edges, regimes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.functions.expr import finite
from quotemill.operators.spread import exact_percentiles


def percentiles(df: DataFrame, columns: dict[str, tuple[str, float]], by: list[str] | None = None) -> DataFrame:
    """name: (column, share): exact percentiles with linear interpolation, NaN and NULL left out."""
    return exact_percentiles(df, columns, by)


def beside(df: DataFrame, few: DataFrame, by: list[str]) -> DataFrame:
    """``df`` with the row of its group from ``few``, a table of a row for each group (without ``by``: one row)."""
    return df.join(F.broadcast(few), by) if by else df.crossJoin(F.broadcast(few))


def _with_mads(df: DataFrame, fitted: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """``fitted``, which has med_<c>, with mad_<c>."""
    off = {f"off_{c}": F.abs(finite(c) - F.col(f"med_{c}")) for c in columns}
    spread = beside(df.select(*by, *columns), fitted, by).select(*by, *[x.alias(n) for n, x in off.items()])
    return beside(fitted, exact_percentiles(spread, {f"mad_{c}": (f"off_{c}", 0.5) for c in columns}, by), by)


def median_mad(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """A row for each group: med_<c> and mad_<c>, the median of absolute deviations from the median."""
    medians = exact_percentiles(df, {f"med_{c}": (c, 0.5) for c in columns}, by)
    return _with_mads(df, medians, columns, by or [])


@dataclass(frozen=True)
class ThresholdPlan:
    """Which percentiles are fitted; names of the thresholds that the funnel and the score use."""

    cuts: tuple[tuple[str, str, float], ...] = (
        ("thr_spread_rel", "spread_rel", 0.60),
        ("thr_spread_ticks", "spread_ticks", 0.80),
        ("thr_range60", "range60_bps", 0.40),
        ("thr_obi", "abs_obi10", 0.50),
        ("thr_micro", "abs_micro", 0.50),
        ("thr_ti", "abs_ti", 0.40),
        ("thr_nps", "nps", 0.30),
        ("thr_persist_micro", "persist_micro_ms", 0.30),
        ("thr_persist_obi", "persist_obi_ms", 0.30),
        ("thr_thin", "thin3", 0.30),
    )
    scored: tuple[str, ...] = ("abs_micro", "abs_obi10", "abs_ti", "thin3", "spread_bps", "nps")
    #: Weights of the robust z of ``scored``, in order.
    weights: tuple[float, ...] = (1.0, 0.9, 0.9, 0.7, -0.4, 0.2)


def fit_thresholds(train: DataFrame, plan: ThresholdPlan = ThresholdPlan(), by: list[str] | None = None) -> DataFrame:
    """A row for each group (of no columns: one) with all cut-offs, medians and deviations of the plan."""
    cuts = {name: (c, q) for name, c, q in plan.cuts} | {f"med_{c}": (c, 0.5) for c in plan.scored}
    return _with_mads(train, exact_percentiles(train, cuts, by), list(plan.scored), by or [])


def score(plan: ThresholdPlan = ThresholdPlan()) -> Column:
    """The microstructure score over fitted columns: weighted robust z."""
    parts = [w * (F.col(c) - F.col(f"med_{c}")) / (F.col(f"mad_{c}") + 1e-12) for c, w in zip(plan.scored, plan.weights, strict=True)]
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def regime_edges(train: DataFrame, column: str, lo: float = 0.4, hi: float = 0.75, least_rows: int = 50_000) -> DataFrame:
    """One row (lo, hi); NULL where the training rows are fewer than ``least_rows``."""
    counts = train.agg(F.count(finite(column)).alias("n_rows"))
    both = exact_percentiles(train, {"lo": (column, lo), "hi": (column, hi)}).crossJoin(counts)
    return both.select(*[F.when(F.col("n_rows") >= least_rows, F.col(c)).alias(c) for c in ("lo", "hi")], "n_rows")


def bucket_edges(df: DataFrame, column: str, n: int) -> DataFrame:
    """One row: ``edges``, the inner percentiles i/n, finite and never falling; with count, mean, min, max."""
    x, shares = finite(column), {f"e{i}": (column, i / n) for i in range(1, n)}
    stats = df.agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.min(x).alias("least"), F.max(x).alias("most"))
    raw = exact_percentiles(df, shares).select(F.array(*shares).alias("e")).crossJoin(stats)
    rising = F.aggregate(
        "e",
        F.array().cast("array<double>"),
        lambda a, v: F.concat(a, F.array(F.when(F.size(a) == 0, v).otherwise(F.greatest(v, F.element_at(a, F.greatest(F.size(a), F.lit(1))))))),
    )
    return raw.withColumn("edges", F.when(F.col("n") > 0, rising)).drop("e")


def bucket_of(value: Column, edges: Column, names: list[str] | None = None) -> Column:
    """b0, b1 ...: the first edge that is not below the value; NULL stays NULL. Three buckets can be named."""
    k = F.size(F.filter(edges, lambda e: e < value))
    label = F.concat(F.lit("b"), k.cast("string")) if names is None else F.get(F.array(*map(F.lit, names)), k)
    return F.when(value.isNotNull(), label)

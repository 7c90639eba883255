"""Candidate funnel: ordered masks, cumulative flags, counts, score and its cut."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quotemill.operators.spread import exact_percentiles
from quotemill.operators.thresholds import ThresholdPlan, beside, score

MASKS = (
    "dir", "spread_rel", "spread_ticks", "range60", "obi", "micro", "flow", "ti", "nps", "persist", "thin",
    "sign_micro", "sign_ti",
)


def masks() -> list[tuple[str, Column]]:
    """The hard masks in order, over features and fitted thresholds; NULL is false."""
    c = F.col
    conditions = [
        c("dir0") != 0,
        c("spread_rel") <= c("thr_spread_rel"),
        c("spread_ticks") <= c("thr_spread_ticks"),
        c("range60_bps") >= c("thr_range60"),
        c("abs_obi10") >= c("thr_obi"),
        c("abs_micro") >= c("thr_micro"),
        (c("notional_buy_w") + c("notional_sell_w")) > 0,
        c("abs_ti") >= c("thr_ti"),
        c("nps") >= c("thr_nps"),
        (c("persist_micro_ms") >= c("thr_persist_micro")) | (c("persist_obi_ms") >= c("thr_persist_obi")),
        c("thin3") >= c("thr_thin"),
        F.signum("micro_bias") == c("dir0"),
        F.signum("ti") == c("dir0"),
    ]
    return [(n, F.coalesce(x, F.lit(False))) for n, x in zip(MASKS, conditions, strict=True)]


def with_thresholds(features: DataFrame, fitted: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Features beside the fitted row of their group (without ``by``: the only one)."""
    return beside(features, fitted, by or [])


def passing(features: DataFrame) -> DataFrame:
    """Only the rows that pass every mask."""
    return features.where(reduce(lambda a, b: a & b, [m for _, m in masks()]))


def tagged(features: DataFrame, keep_share: float = 0.97, plan: ThresholdPlan = ThresholdPlan(), by: list[str] | None = None) -> DataFrame:
    """All rows, with a flag of each step, the cumulative flags, the score of those that pass all, and its cut.

    ``ms_cut`` is the exact percentile ``keep_share`` of the passers' scores; ``pass_ms_keep`` are those above it.
    """
    out = features.withColumns({f"pass_{n}": m for n, m in masks()})
    flags = {}
    for k, n in enumerate(MASKS):
        flags[f"pass_up_to_{n}"] = reduce(lambda a, b: a & b, [F.col(f"pass_{x}") for x in MASKS[: k + 1]])
    out = out.withColumns(flags).withColumn("pass_all_hard", F.col(f"pass_up_to_{MASKS[-1]}"))
    out = out.withColumn("ms", F.when(F.col("pass_all_hard"), score(plan)))
    cut = exact_percentiles(out, {"ms_cut": ("ms", keep_share)}, by)
    out = beside(out, cut, by or [])
    return out.withColumn("pass_ms_keep", F.coalesce(F.col("ms") >= F.col("ms_cut"), F.lit(False)))


def funnel_counts(tags: DataFrame) -> DataFrame:
    """(step, n_pass, n_up_to): one row for each step, from one pass."""
    counts = tags.agg(*[F.count_if(f"pass_{n}").alias(f"p_{n}") for n in MASKS], *[F.count_if(f"pass_up_to_{n}").alias(f"u_{n}") for n in MASKS])
    rows = F.array(*[F.struct(F.lit(k).alias("step_no"), F.lit(n).alias("step"), F.col(f"p_{n}").alias("n_pass"), F.col(f"u_{n}").alias("n_up_to")) for k, n in enumerate(MASKS)])
    return counts.select(F.inline(rows))


def sampled(df: DataFrame, most: int, by: list[Column], ids: list[str], seed: int = 42) -> DataFrame:
    """At most ``most`` rows of each group: those with the smallest md5 of seed and ids, the same on any layout."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids]))
    place = F.row_number().over(W.partitionBy(*by).orderBy(key, *ids))
    return df.withColumn("place_", place).where(F.col("place_") <= most).drop("place_")


def labelled_rows(tags: DataFrame, cap: int, ids: list[str], seed: int = 42) -> DataFrame:
    """Rows of the first of three flags that holds for some rows, but at most ``cap``; else ``cap`` rows of the last one."""
    choices = ["pass_all_hard", "pass_ms_keep", "pass_up_to_sign_ti"]
    row = tags.agg(*[F.count_if(c).alias(c) for c in choices]).first()
    chosen = next((c for c in choices if 0 < row[c] <= cap), "")
    return tags.where(chosen) if chosen else sampled(tags.where(choices[-1]), cap, [F.lit(0)], ids, seed)

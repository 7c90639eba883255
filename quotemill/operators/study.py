"""Score studies: ranks, deciles, top shares, sizing, daily tables, classifier metrics, ordered folds."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quotemill.operators.spread import exact_percentiles, running, stats_by


def group_stats(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Count, mean, median, 95 % percentile, least and most value of each group."""
    counts = [F.count(value).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("least"), F.max(value).alias("most")]
    return stats_by(df.select(*by, value), by, counts, {"p50": (value, 0.5), "p95": (value, 0.95)})


def _ranked(df: DataFrame, score: str, tie: str, by: list[str]) -> DataFrame:
    """``rank`` from the best score on, equal ones by ``tie``, and ``n_all``; rows without a score are left out."""
    rows = df.where(F.col(score).isNotNull())
    return running(rows, by, [F.desc(score), F.asc(tie)], {"rank": F.lit(1)}, "ranks").withColumnRenamed("all_rank", "n_all")


def score_bins(df: DataFrame, score: str, tie: str, q: int, by: list[str] = []) -> DataFrame:  # noqa: B006
    """``bin``: equal-frequency bins of the score, 0 is the best. Edges lie at (n - 1) i / q, unlike ntile."""
    ranked = _ranked(df, score, tie, by)
    edge = F.ceil((F.col("rank") - 1) * q / F.greatest(F.col("n_all") - 1, F.lit(1)))
    return ranked.withColumn("bin", F.greatest(edge, F.lit(1)) - 1)


def top_shares(df: DataFrame, score: str, value: str, tie: str, shares: list[float], by: list[str] = [], whole: bool = False) -> DataFrame:  # noqa: B006
    """Mean and percentiles of the best ``share`` of rows: at least one, rounded half to even (``whole``: down)."""
    ranked = _ranked(df, score, tie, by)
    cut = ranked.withColumn("share", F.explode(F.array(*map(F.lit, shares))))
    k = F.floor(F.col("n_all") * F.col("share")) if whole else F.greatest(F.bround(F.col("n_all") * F.col("share")), F.lit(1))
    best = cut.where(F.col("rank") <= k).select(*by, "share", value, score)
    counts = [F.count("*").alias("k"), F.avg(value).alias("ev"), F.min(score).alias("score_cut")]
    return stats_by(best, [*by, "share"], counts, {"p50": (value, 0.5), "p95": (value, 0.95)})


def bin_sizes(bins: DataFrame, value: str, most: float = 2.0) -> DataFrame:
    """Mean of each bin over the mean of all, as a size between 0 and ``most``."""
    stats = bins.groupBy("bin").agg(F.count(value).alias("n"), F.avg(value).alias("ev"), F.sum(value).alias("s"))
    every = F.sum("s").over(W.partitionBy()) / F.sum("n").over(W.partitionBy())
    ratio = F.try_divide(F.col("ev"), every)
    return stats.withColumns({"ratio": ratio, "size": F.least(F.greatest(ratio, F.lit(0.0)), F.lit(most))}).drop("s")


def learned_sizes(train: DataFrame, test: DataFrame, score: str, value: str, q: int = 5) -> DataFrame:
    """``size`` of the test rows: train edges of the score, mean of each interval over the train mean, kept from falling."""
    cuts = {f"e{i}_": (score, i / q) for i in range(1, q)}
    edges = exact_percentiles(train, cuts).crossJoin(train.agg(F.avg(value).alias("all_mean"))).select(F.array(*cuts).alias("edges"), "all_mean")
    place = F.size(F.filter("edges", lambda e: e < F.col(score)))
    means = train.crossJoin(F.broadcast(edges)).where(F.col(score).isNotNull()).groupBy(place.alias("bin")).agg((F.avg(value) / F.first("all_mean")).alias("ratio"))
    rising = F.max("ratio").over(W.orderBy("bin").rowsBetween(W.unboundedPreceding, 0))
    sizes = means.select("bin", F.least(F.greatest(rising, F.lit(0.0)), F.lit(2.0)).alias("size"))
    placed = test.crossJoin(F.broadcast(edges.select("edges"))).withColumn("bin", F.when(F.col(score).isNotNull(), place))
    return placed.join(F.broadcast(sizes), "bin", "left").drop("edges")


def governor(trades: DataFrame, day: str, order: list[str], pnl: str, size: str, steps: list[tuple[float, float]], floor: float) -> DataFrame:
    """Drawdown governor: a day's trades in order, each scaled by the running result before it.

    ``steps``: (result above which, multiplier), from the highest. Each result depends on all before it, so a day is folded
    in one task, in time that grows with its trades; days are dealt over the tasks.
    """
    kinds = {c: trades.schema[c].dataType.simpleString() for c in (day, *order)}

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order, kind="stable")
        total, used, before = 0.0, [], []
        for p, z in zip(rows["p_"].to_numpy(), rows["z_"].to_numpy(), strict=True):
            m = next((m for least, m in steps if (total >= least if least == 0 else total > least)), floor)
            used.append(z * m)
            before.append(total)
            total += p * z * m
        return rows[[day, *order]].assign(size_used=used, before=before)

    own = trades.select(day, *order, F.col(pnl).cast("double").alias("p_"), F.col(size).cast("double").alias("z_"))
    schema = ", ".join(f"`{c}` {t}" for c, t in kinds.items()) + ", size_used double, before double"
    return own.groupBy(day).applyInPandas(fold, schema)


def metrics(df: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    """AUC by rank sums (ties share ranks), average precision by steps, log loss; NULL with one class only.

    Rows are counted by score before they are ranked.
    """
    rows = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    counts = rows.groupBy(*by, score).agg(F.count("*").alias("n_"), F.sum(F.col(label).cast("double")).alias("p_"))
    best = running(counts, by, [F.desc(score)], {"seen_": F.col("n_"), "pos_": F.col("p_")}, "score-counts")
    n_, p_ = F.col("n_"), F.col("p_")
    p = F.least(F.greatest(F.col(score), F.lit(1e-15)), F.lit(1 - 1e-15))
    pos, n = F.sum(p_), F.sum(n_)
    # The mean of the ranks that equal scores share, from the lowest score on.
    rank = F.col("all_seen_") - F.col("seen_") + (n_ + 1) / 2
    auc = (F.sum(p_ * rank) - pos * (pos + 1) / 2) / (pos * (n - pos))
    ap = F.sum(p_ * F.col("pos_") / F.col("seen_")) / pos
    loss = -F.sum(p_ * F.log(p) + (n_ - p_) * F.log(1 - p)) / n
    both = (pos > 0) & (pos < n)
    return best.groupBy(*by).agg(n.alias("n"), F.when(both, auc).alias("auc"), F.when(both, ap).alias("ap"), F.when(both, loss).alias("logloss"))

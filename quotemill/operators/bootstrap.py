"""Bootstrap intervals of means, with draws that any engine can repeat and no layout changes.

A row, or the j-th draw of a day, has two words of an MD5 digest (a, b), a replicate has one (c), and the draw is
(a * c + b) mod (2**31 - 1): uniform, independent between rows, and pairwise independent between replicates.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.operators.spread import beside_keys

#: The modulus of the draws.
PRIME = (1 << 31) - 1
#: Groups whose sums a task holds at once; more are sent on in turns.
HELD = 256


def _words(*parts: Column | str) -> list[Column]:
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return [F.conv(F.substring(digest, at, 8), 16, 10).cast("long") % PRIME for at in (1, 9)]


def _word(text: str, at: int = 0) -> int:
    return int(md5(text.encode()).hexdigest()[at : at + 8], 16) % PRIME


def multipliers(seed: int, reps: int) -> np.ndarray:
    return np.array([_word(f"{seed}|rep|{k}") for k in range(reps)], dtype=np.int64)


def poisson_cuts() -> list[int]:
    """Draws below the k-th cut have a Poisson(1) weight of k at most; those above the last have the next weight."""
    out, p, total = [], 0.36787944117144233, 0.0
    for k in range(8):
        total += p
        out.append(int(total * PRIME))
        p /= k + 1
    return out


def interval_ends(means: Column) -> tuple[Column, Column]:
    """The 2.5 % and 97.5 % points of an array of means, linear between neighbours; NULL without any."""
    known = F.array_sort(F.filter(means, lambda x: x.isNotNull() & ~F.isnan(x)))

    def point(q: float) -> Column:
        at = (F.size(known) - 1) * F.lit(q)
        lo, hi = F.get(known, F.floor(at).cast("int")), F.get(known, F.ceil(at).cast("int"))
        return lo + (hi - lo) * (at - F.floor(at))

    return point(0.025), point(0.975)


def _with_ends(replicates: DataFrame) -> DataFrame:
    lo, hi = interval_ends(F.col("means"))
    return replicates.withColumns({"ci_lo": lo, "ci_hi": hi}).drop("means")


def iid_interval(df: DataFrame, value: str, row_id: str, by: list[str], reps: int = 2000, seed: int = 7) -> DataFrame:
    """Mean and 2.5/97.5 % bounds of each group, rows drawn one by one (each with a Poisson weight).

    A task adds its rows up in two vectors of ``reps`` numbers for a group, sums and weights; what is shuffled is these.
    """
    a, b = _words(F.lit(str(seed)), F.col(row_id).cast("string"))
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("v_"), a.alias("a_"), b.alias("b_"))
    factors, cuts = multipliers(seed, reps), np.array(poisson_cuts())
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            columns = {c: pa.array([k[i] for k in held], type=types[c]) for i, c in enumerate(by)}
            parts = {n: pa.array([x[i] for x in held.values()], pa.list_(pa.float64())) for i, n in enumerate(("s_", "w_"))}
            return pa.RecordBatch.from_pydict(columns | parts)

        types: dict[str, pa.DataType] = {}
        for batch in batches:
            types = {c: batch.schema.field(c).type for c in by}
            frame = batch.to_pandas()
            for key, part in frame.groupby(by, dropna=False, sort=False):
                total = held.setdefault(tuple(None if pd.isna(k) else k for k in key), np.zeros((2, reps)))
                for first in range(0, len(part), 512):
                    some = part.iloc[first : first + 512]
                    draws = (some["a_"].to_numpy()[:, None] * factors + some["b_"].to_numpy()[:, None]) % PRIME
                    weights = np.searchsorted(cuts, draws.ravel(), "right").reshape(draws.shape)
                    total += np.stack([some["v_"].to_numpy() @ weights, weights.sum(0)])
            if len(held) > HELD:
                yield out()
                held.clear()
        if held:
            yield out()

    sums = rows.mapInArrow(add, f"{kinds}, s_ array<double>, w_ array<double>").select(*by, F.posexplode(F.arrays_zip("s_", "w_")).alias("rep_", "x_"))
    each = sums.groupBy(*by, "rep_").agg(F.try_divide(F.sum("x_.s_"), F.sum("x_.w_")).alias("mean_"))
    means = each.groupBy(*by).agg(F.collect_list("mean_").alias("means"))
    return beside_keys(df.groupBy(*by).agg(F.avg(value).alias("mean"), F.count(value).alias("n")), _with_ends(means), by)


def _day_means(df: DataFrame, value: str, day: str, by: list[str], reps: int, seed: int) -> DataFrame:
    """(by, means): an array of ``reps`` means over as many days as there are, drawn with replacement.

    Days are summed first, so that a group has a row for each day, in the order of days.
    """
    days = df.where(F.col(value).isNotNull()).groupBy(*by, day).agg(F.sum(value).cast("double").alias("s_"), F.count(value).alias("c_"))
    factors = multipliers(seed, reps)

    def draw(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(day)
        m, s, c = len(rows), rows["s_"].to_numpy(), rows["c_"].to_numpy()
        total, count = np.zeros(reps), np.zeros(reps)
        for j in range(m):
            slot = (_word(f"{seed}|{j}") * factors + _word(f"{seed}|{j}", 8)) % PRIME * m // PRIME
            total += s[slot]
            count += c[slot]
        return rows.iloc[:1][by].assign(means=[total / count])

    kinds = ", ".join(f"`{x}` {df.schema[x].dataType.simpleString()}" for x in by)
    return days.groupBy(*by).applyInPandas(draw, f"{kinds}, means array<double>")


def day_interval(df: DataFrame, value: str, day: str, by: list[str], reps: int = 2000, seed: int = 7) -> DataFrame:
    """Mean and bounds of each group, whole days drawn; days are summed first."""
    stats = df.groupBy(*by).agg(F.avg(value).alias("mean"), F.count(value).alias("n"), F.count_distinct(day).alias("n_days"))
    return beside_keys(stats, _with_ends(_day_means(df, value, day, by, reps, seed)), by)


def day_delta(df: DataFrame, value: str, day: str, side: str, a: str, b: str, by: list[str], reps: int = 2000, seed: int = 7) -> DataFrame:
    """Difference of the means of sides ``a`` and ``b`` with bounds, the sides' days drawn apart."""
    one = _day_means(df.where(F.col(side) == a), value, day, by, reps, seed).withColumnRenamed("means", "means_a")
    two = _day_means(df.where(F.col(side) == b), value, day, by, reps, seed + 1).withColumnRenamed("means", "means_b")
    apart = beside_keys(one, two, by).select(*by, F.zip_with("means_a", "means_b", lambda x, y: x - y).alias("means"))
    mean = lambda s: F.avg(F.when(F.col(side) == s, F.col(value)))
    return beside_keys(df.groupBy(*by).agg((mean(a) - mean(b)).alias("delta")), _with_ends(apart), by)

"""Exact percentiles of any distribution, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotemill.operators import spread
from quotemill.operators.spread import CELLS, exact_percentiles

SHARES = (0.0, 0.05, 0.4, 0.5, 0.75, 0.95, 0.99, 1.0)


def close(got, values):
    for q in SHARES:
        assert got[f"p{int(q * 100)}"] == pytest.approx(np.quantile(values, q), rel=1e-12, abs=0)


def tailed(kind, n):
    r = np.random.default_rng(3)
    if kind == "decades":
        return np.sign(r.random(n) - 0.3) * 10.0 ** r.uniform(-15, 15, n)
    if kind == "outliers":
        return np.concatenate([r.random(n - 2), [1e9, 1e15]])
    if kind == "dense":  # far more values in one cell of the logarithm, and in one cell of that
        return np.concatenate([1 + r.random(n - 2) * 1e-9, [0.5, 1e300]])
    return np.round(r.normal(0, 3, n))


@pytest.mark.parametrize("kind", ["decades", "outliers", "dense", "ties"])
def test_percentiles_of_any_distribution(spark, kind, monkeypatch):
    """What a window gets of a group is never more than ``CELLS`` rows, whatever the values."""
    values = tailed(kind, 150_000)
    seen, plain = [], spread._up_to

    def watched(counts, keys):
        seen.append(counts.groupBy(*keys).count().agg(F.max("count")).first()[0])
        return plain(counts, keys)

    monkeypatch.setattr(spread, "_up_to", watched)
    monkeypatch.setattr(spread, "CELLS", 4096)
    rows = spark.createDataFrame([(float(x),) for x in values], "x double").repartition(4)
    got = exact_percentiles(rows, {f"p{int(q * 100)}": ("x", q) for q in SHARES}).first()
    close(got, values)
    assert seen[0] <= CELLS and all(n <= 4096 + 1 for n in seen[1:]) and len(seen) <= 4


def test_percentiles_by_group(spark):
    rows = [("a", 1.0, 2.0), ("a", float("nan"), 4.0), ("a", None, -6.0), ("a", 3.0, float("inf")), (None, 5.0, 0.0), (None, -0.0, -1e-300), ("b", None, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {r.g: r for r in exact_percentiles(df, {"mx": ("x", 0.5), "my": ("y", 0.5), "ny": ("y", 0.0)}, ["g"]).collect()}
    assert (got["a"].mx, got["a"].my, got["a"].ny) == (2.0, 2.0, -6.0)
    assert (got[None].mx, got[None].my, got["b"].mx, got["b"].my) == (2.5, -5e-301, None, 1.0)
    assert exact_percentiles(df.limit(0), {"m": ("x", 0.5)}, ["g"]).count() == 0
    assert exact_percentiles(df.limit(0), {"m": ("x", 0.5)}).collect()[0].m is None

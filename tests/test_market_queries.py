"""Every market query against its SQL; those without SQL against what must hold for them."""

import pytest

from quotemill.plans import load_queries
from tests.compare import SF, assert_same, database

QUERIES, ORACLES = load_queries()


@pytest.fixture(scope="module")
def db():
    return database()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, db, name):
    assert_same(QUERIES[name](spark, SF).toPandas(), db.sql(ORACLES[name]).df())
    spark.catalog.clearCache()


def test_intervals_hold_the_mean(spark):
    for name, mid in (("A15_iid_interval", "mean"), ("A16_day_interval", "mean"), ("A17_day_delta", "delta")):
        known = QUERIES[name](spark, SF).toPandas().dropna()
        assert len(known) and ((known["ci_lo"] <= known[mid]) & (known[mid] <= known["ci_hi"])).all()


def test_row_weights_are_those_of_a_bootstrap():
    """Draws of many rows: a mean and a variance of one in each replicate, and no two replicates alike."""
    import numpy as np

    from quotemill.operators.bootstrap import PRIME, _word, multipliers, poisson_cuts

    a, b = (np.array([_word(f"7|{i}", at) for i in range(4000)]) for at in (0, 8))
    weights = np.searchsorted(poisson_cuts(), (a[:, None] * multipliers(7, 200) + b[:, None]) % PRIME, "right")
    assert abs(weights.mean() - 1) < 0.01 and abs(weights.var() - 1) < 0.02
    assert np.abs(np.corrcoef(weights.T) - np.eye(200)).max() < 0.09


def test_stream_buckets_agree_with_batch(spark):
    stream = QUERIES["X01_stream_buckets"](spark, SF).toPandas().set_index(["symbol", "bucket"])
    batch = QUERIES["T03_trade_flow"](spark, SF).toPandas().set_index(["symbol", "bucket"])
    assert len(stream) > 0.9 * len(batch)
    both = stream.join(batch, rsuffix="_b", how="left")
    assert ((both["notional_buy"] - both["notional_buy_b"]).abs() < 1e-6).all() and (both["ntr"] == both["ntr_b"]).all()


def test_no_model_of_too_few_rows(spark):
    """62 training rows are too few: no scores, and importances that are unknown, not 0."""
    weights = QUERIES["M02_feature_importance"](spark, SF).toPandas()
    assert len(weights) == 12 and weights["importance"].isna().all() and not weights["fitted"].any()
    assert QUERIES["M01_boosted_trees"](spark, SF).toPandas()["auc"].isna().all()


def test_model_scores_every_split(spark):
    weights = QUERIES["M02_feature_importance"](spark, SF.replace("0.001", "0.01")).toPandas()
    assert abs(weights["importance"].sum() - 1) < 1e-4 and len(weights) == 12 and weights["fitted"].all()


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 13
    assert set(e.oracle_sql()) <= set(e.queries())


def test_streams_of_files_are_in_the_order_of_time(spark, tmp_path, monkeypatch):
    """Files are ranges of time that many tasks write; a stream gets them in that order, a few at a time."""
    from pyspark.sql import functions as F

    from quotemill.plans import source_queries as sq

    df = spark.range(20_000).select(F.col("id"), F.timestamp_seconds(1_704_067_200 + F.pmod(F.col("id") * 7919, F.lit(20_000)) * 60).alias("timestamp"))
    path = str(tmp_path / "ordered")
    monkeypatch.setattr(sq, "_folder", lambda *_: path)
    sq._stream(spark, df, "ordered")
    seen = spark.read.parquet(path).select("timestamp", "_metadata.file_modification_time").groupBy("file_modification_time").agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))
    seen = seen.orderBy("file_modification_time").collect()
    assert len(seen) > 4 and all(x.b < y.a for x, y in zip(seen, seen[1:]))

"""Backtests with several cuts, and models beside loads that count their rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from hearthlake.plans import ml

START = datetime(2024, 1, 1)
INPUTS = sorted(set(ml.OCCUPANCY_FEATURES + ml.CONSUMPTION_FEATURES))


@pytest.fixture(scope="module")
def rows(spark):
    """Ten days of hourly slots of one room: power is one more a day later, occupancy alternates."""
    hours = spark.range(240).withColumn("slot", F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600))
    power = F.floor(F.col("id") / 24).cast("double")
    frame = hours.select(F.lit("apt_a").alias("apartment"), F.lit("Office").alias("room"), "slot", "id", *[F.lit(0.0).alias(c) for c in INPUTS])
    return frame.withColumns(
        {
            "power_w": power,
            "occupied": (F.col("id") % 2).cast("int"),
            "label_power_w": F.when(F.col("id") < 216, power + 1),
            "label_occupied": F.when(F.col("id") < 239, ((F.col("id") + 1) % 2).cast("int")),
        }
    ).drop("id")


def test_folds_are_scored_by_horizon(rows):
    shares = [0.5, 0.75]
    found = ml.rolling_backtest(rows, ml.CONSUMPTION, shares, horizon_days=1).collect()
    cuts = [START + timedelta(seconds=int(239 * 3600 * s / 900) * 900) for s in shares]
    want = {}
    for n in range(216):
        slot = START + timedelta(hours=n)
        fold = 1 if slot >= cuts[1] else 0 if slot >= cuts[0] else None
        if fold is not None:
            want.setdefault((fold, (slot - cuts[fold]).days), []).append(n // 24 + 1)
    assert {(r.fold, r.horizon): (r.slots, r.mean_actual) for r in found} == {k: (len(v), sum(v) / len(v)) for k, v in want.items()}
    assert {r.fold: r.cut for r in found} == dict(enumerate(cuts))
    assert all(r.mae < 0.5 for r in found)  # nearly linear, so every fold must have learnt it


def test_folds_without_known_outcomes(rows):
    found = ml.rolling_backtest(rows, ml.CONSUMPTION, [0.0, 0.5], horizon_days=365).collect()
    assert [r.fold for r in found] == [1]
    with pytest.raises(ValueError):
        ml.rolling_backtest(rows, ml.CONSUMPTION, [0.0])


def test_models_after_an_observation(rows, spark, tmp_path):
    counts = Observation("rows")
    spark.range(3).observe(counts, F.count(F.lit(1)).alias("n")).write.parquet(str(tmp_path / "seen"))
    assert counts.get == {"n": 3}
    path = str(tmp_path / "predictions")
    ml.store_predictions(ml.predict_occupancy(ml.fit_occupancy(rows), rows, F.lit(START).cast("timestamp")), path)
    assert spark.read.parquet(path).filter("predicted_occupied BETWEEN 0 AND 1").count() == 240

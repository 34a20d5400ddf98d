"""Forecast rows: cleaning rules, stage counts, file quarantine."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hearthlake.functions import cleaning
from hearthlake.schemas import WEATHER_COLUMNS, WEATHER_MEASUREMENTS, WEATHER_MIN_YEAR, WEATHER_SENTINEL

_SHORT_MIN, _SHORT_MAX = -32768, 32767


def require_columns(df: DataFrame, required: Iterable[str] = WEATHER_COLUMNS) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def not_before(ts: Column, year: int) -> Column:
    """A plain comparison with a constant, so it reaches a columnar scan as a pushed filter."""
    return ts >= F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp")


def without_sentinel(value: Column, sentinel: float = WEATHER_SENTINEL) -> Column:
    return F.nullif(value, F.lit(sentinel))


def _rules(min_year: int) -> list[tuple[str, Column]]:
    """The row rules in order, each named after the count that follows it."""
    return [
        ("after_timestamp", F.col("timestamp").isNotNull()),
        ("after_year", not_before(F.col("timestamp"), min_year)),
        ("after_measurement", F.col("Measurement").isin(list(WEATHER_MEASUREMENTS))),
        ("after_sentinel", F.col("value").isNotNull() & ~F.isnan("value")),
    ]


def _typed(raw: DataFrame) -> DataFrame:
    require_columns(raw)
    return raw.withColumns(
        {
            "timestamp": F.col("Time").try_cast("timestamp"),
            "value": without_sentinel(cleaning.to_number(F.col("Value"))),
            "run": cleaning.to_number(F.col("Prediction")),
        }
    )


def _bad_run(run: Column) -> Column:
    """A model run that is a number but no small integer makes its whole file unreadable."""
    return F.coalesce((run != F.floor(run)) | ~run.between(_SHORT_MIN, _SHORT_MAX), F.lit(False)) & ~F.isnan(run)


def clean_forecasts(raw: DataFrame, min_year: int = WEATHER_MIN_YEAR) -> DataFrame:
    """Raw forecast rows to typed rows: bad times, early years, other measurements and missing values dropped,
    outliers flagged and kept. ``raw`` carries ``prediction_date``; any ``path`` is kept as ``_path``."""
    kept = _typed(raw)
    for _, rule in _rules(min_year):
        kept = kept.filter(rule)
    bounds = {name: limits for name, (_, limits) in WEATHER_MEASUREMENTS.items()}
    extra = [F.col("path").alias("_path")] if "path" in raw.columns else []
    return kept.select(
        "timestamp",
        F.trim(F.regexp_replace("Site", '"', "")).alias("site"),
        F.col("run").try_cast("smallint").alias("prediction"),
        "prediction_date",
        F.col("Measurement").alias("measurement"),
        "value",
        F.trim("Unit").alias("unit"),
        cleaning.is_outlier(F.col("Measurement"), F.col("value"), bounds).alias("is_outlier"),
        *extra,
    )


def rejected_files(raw: DataFrame, min_year: int = WEATHER_MIN_YEAR) -> DataFrame:
    """Files that cannot be used, with the reason: unreadable, without an issue date in the name, or with a kept row
    whose model run is impossible."""
    typed = _typed(raw)
    usable = F.lit(True)
    for name, rule in _rules(min_year):
        if name != "after_sentinel":
            usable = usable & rule
    error = F.col("file_error") if "file_error" in raw.columns else F.lit(None).cast("string")
    reason = F.coalesce(
        error,
        F.when(F.col("prediction_date").isNull(), "no issue date in the file name"),
        F.when(F.coalesce(usable & _bad_run(F.col("run")), F.lit(False)), "impossible model run"),
    )
    return typed.withColumn("reason", reason).filter("reason IS NOT NULL").groupBy("path").agg(F.min("reason").alias("reason"))


def usable_files(raw: DataFrame, min_year: int = WEATHER_MIN_YEAR) -> DataFrame:
    """Rows of files that are not rejected. Rejected paths are few, so the optimizer broadcasts them."""
    return raw.join(rejected_files(raw, min_year), "path", "left_anti")


def _stage_columns(min_year: int) -> list[Column]:
    """Rows left after each rule."""
    passed = F.lit(True)
    counts = [F.count(F.lit(1)).alias("raw")]
    for name, rule in _rules(min_year):
        passed = passed & F.coalesce(rule, F.lit(False))
        counts.append(F.count_if(passed).alias(name))
    return counts


def stage_counts(raw: DataFrame, min_year: int = WEATHER_MIN_YEAR) -> DataFrame:
    """Rows left after each rule, in one pass over the data."""
    return _typed(raw).agg(*_stage_columns(min_year))


def observed(raw: DataFrame, observation: Observation, min_year: int = WEATHER_MIN_YEAR) -> DataFrame:
    """``raw``, unchanged, whose :func:`stage_counts` the observation holds once it has been written."""
    return _typed(raw).observe(observation, *_stage_columns(min_year)).select(*raw.columns)


def last_forecast_order() -> list[Column]:
    """Equal keys within one issue date: the greater path wins, then the greater value."""
    order = [F.desc_nulls_last("value"), F.desc_nulls_last("unit")]
    return [F.desc("_path"), *order]

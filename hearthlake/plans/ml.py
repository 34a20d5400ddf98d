"""Room occupancy and consumption forecasts on 15-minute slots.

Feature choice and the split by time are this package's own.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthlake import session
from hearthlake.functions import calendar
from hearthlake.schemas import PREDICTION_KEY
from hearthlake.sources import publish, tables

HOUR, DAY = 3600, 86400
LAGS = {"15m": 900, "1h": HOUR, "24h": DAY}
WEATHER = ["temperature_c", "humidity_pct", "precipitation_mm", "radiation_wm2"]
OCCUPANCY_FEATURES = (
    ["occupied", "motion_count"] + [f"occupied_lag_{n}" for n in LAGS] + ["hour", "day_of_week", "weekend"]
)
CONSUMPTION_FEATURES = (
    ["power_w"] + [f"power_w_lag_{n}" for n in LAGS] + ["hour", "day_of_week", "weekend"] + [f"outdoor_{c}" for c in WEATHER]
)


def latest_forecast(weather: DataFrame) -> DataFrame:
    """Per site and hour, the forecast issued last but no later than the day it is for."""
    issued = F.date_format("prediction_date", "yyyyMMdd").cast("int")
    known = weather.filter(issued <= F.col("date_key"))
    newest = F.max_by(F.struct(*WEATHER), "prediction_date").alias("newest")
    hour_key = (F.floor(F.col("datetime_key") / 100)).cast("bigint")
    by_time = known.groupBy("site_key", "datetime_key").agg(newest)
    return by_time.groupBy("site_key", hour_key.alias("hour_key")).agg(
        *[F.avg(f"newest.{c}").alias(f"outdoor_{c}") for c in WEATHER]
    )


def _shifted(column: str, seconds: int, rooms: Window) -> Column:
    """Value exactly ``seconds`` away in time (not a number of rows away), null if that slot has none."""
    return F.max(column).over(rooms.rangeBetween(seconds, seconds))


def features(slots: DataFrame, weather: DataFrame, apartments: DataFrame) -> DataFrame:
    """One row per room and slot: values, lags, calendar, forecast known on the day, and the two labels.

    All lags and labels of a room come from one window, so the slots are shuffled once. A room has at most 96 slots
    a day, whatever its number of readings.
    """
    rooms = Window.partitionBy("apartment_key", "room_key").orderBy("slot_s")
    ts = F.col("slot")
    lagged = slots.withColumn("slot_s", F.unix_timestamp("slot")).withColumns(
        {
            **{f"power_w_lag_{n}": _shifted("power_w", -s, rooms) for n, s in LAGS.items()},
            **{f"occupied_lag_{n}": _shifted("occupied", -s, rooms) for n, s in LAGS.items()},
            "label_occupied": _shifted("occupied", HOUR, rooms),
            "label_power_w": _shifted("power_w", DAY, rooms),
            "hour": F.hour(ts),
            "day_of_week": F.weekday(ts),
            "weekend": calendar.is_weekend(ts).cast("int"),
            "hour_key": F.floor(calendar.datetime_key(ts) / 100).cast("bigint"),
        }
    )
    sites = apartments.select("apartment_key", F.col("weather_site_key").alias("site_key"))
    return (
        lagged.join(sites, "apartment_key", "left")
        .join(latest_forecast(weather), ["site_key", "hour_key"], "left")
        .drop("site_key", "hour_key", "slot_s")
    )


def _inputs(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Missing inputs count as zero, so that every slot gets a prediction."""
    return rows.withColumns({f"in_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})


def _reloaded(model: PipelineModel, spark: SparkSession) -> PipelineModel:
    """The model as it would be read from storage, without the summary of its training.

    The summary refers to the session, which tasks cannot be sent any more once a load has counted its rows.
    """
    path = session.new_path(spark, "model")
    model.save(path)
    try:
        return PipelineModel.load(path)
    finally:
        publish.Folder(spark, path).delete(path.rsplit("/", 1)[0])


def _fit(rows: DataFrame, columns: list[str], label: str, estimator) -> PipelineModel:
    known = _inputs(rows.filter(F.col(label).isNotNull()), columns).withColumn("label", F.col(label).cast("double"))
    stages = [
        VectorAssembler(inputCols=[f"in_{c}" for c in columns], outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features"),
        estimator,
    ]
    return _reloaded(Pipeline(stages=stages).fit(known), rows.sparkSession)


def fit_occupancy(rows: DataFrame) -> PipelineModel:
    """Probability that a room is occupied an hour after the slot."""
    return _fit(rows, OCCUPANCY_FEATURES, "label_occupied", LogisticRegression(maxIter=30, regParam=0.01))


def fit_consumption(rows: DataFrame) -> PipelineModel:
    """Power of a room 24 hours after the slot."""
    return _fit(rows, CONSUMPTION_FEATURES, "label_power_w", LinearRegression(maxIter=30, regParam=0.01))


def _prediction(rows: DataFrame, ahead: int, model: str, target: str, made_at: Column, cells: list[Column]) -> DataFrame:
    return rows.select(
        *cells,
        "apartment",
        "room",
        F.timestamp_seconds(F.unix_timestamp("slot") + ahead).alias("timestamp_rounded"),
        F.lit(model).alias("model_name"),
        F.lit(target).alias("target"),
        made_at.cast("timestamp").alias("prediction_made_at"),
    )


def predict_occupancy(model: PipelineModel, rows: DataFrame, made_at: Column) -> DataFrame:
    scored = model.transform(_inputs(rows, OCCUPANCY_FEATURES))
    cells = [
        vector_to_array("probability")[1].alias("predicted_occupied"),
        F.col("label_occupied").cast("int").alias("actual_occupied"),
    ]
    return _prediction(scored, HOUR, "logistic_regression", "Presence", made_at, cells)


def predict_consumption(model: PipelineModel, rows: DataFrame, made_at: Column) -> DataFrame:
    scored = model.transform(_inputs(rows, CONSUMPTION_FEATURES))
    cells = [F.col("prediction").alias("predicted_power_w"), F.col("label_power_w").alias("actual_power_w")]
    return _prediction(scored, DAY, "linear_regression", "Consumption", made_at, cells)


def store_predictions(predictions: DataFrame, path: str, grain: str = "day") -> None:
    """Upsert predictions; one row per room, slot and model."""
    dated = predictions.withColumn("period", calendar.period(F.col("timestamp_rounded"), grain))
    tables.upsert(dated, path, PREDICTION_KEY, "period")


def split_time(rows: DataFrame, share: float) -> datetime:
    """The slot at which ``share`` of the time that the rows cover has passed."""
    seconds = F.floor((F.min(F.unix_timestamp("slot")) * (1 - share) + F.max(F.unix_timestamp("slot")) * share) / 900) * 900
    return rows.agg(F.timestamp_seconds(seconds).alias("cut")).first()["cut"]


def known_before(rows: DataFrame, cut: datetime, ahead: int) -> DataFrame:
    """Rows whose label, ``ahead`` seconds later, lies before the cut too: nothing of the held-out time is learnt."""
    return rows.filter(F.unix_timestamp("slot") + ahead < F.unix_timestamp(F.lit(cut)))


@dataclass(frozen=True)
class Target:
    """What a model learns and how its predictions are scored."""

    fit: Callable[[DataFrame], PipelineModel]
    predict: Callable[[PipelineModel, DataFrame, Column], DataFrame]
    label: str
    ahead: int
    predicted: str
    actual: str


OCCUPANCY = Target(fit_occupancy, predict_occupancy, "label_occupied", HOUR, "predicted_occupied", "actual_occupied")
CONSUMPTION = Target(fit_consumption, predict_consumption, "label_power_w", DAY, "predicted_power_w", "actual_power_w")


def rolling_backtest(rows: DataFrame, target: Target, shares: list[float], horizon_days: int = 30, threads: int = 4) -> DataFrame:
    """Errors per fold and horizon: at each cut a model is fitted on what was known then and predicts up to the next cut.

    ``rows`` are features, best stored, as every fold reads them. Cuts lie where the given ascending shares of the time
    have passed; the last fold ends with the data. Horizon n holds the slots n times ``horizon_days`` after the cut. Folds are
    fitted side by side, and scored in one job. A fold at whose cut no outcome is known yet has no model and no rows.
    """
    cuts = [split_time(rows, share) for share in shares]
    made_at = F.lit(None).cast("timestamp")

    def fold(n: int) -> DataFrame | None:
        known = known_before(rows, cuts[n], target.ahead).filter(F.col(target.label).isNotNull())
        if known.isEmpty():
            return None
        slot, cut = F.col("slot"), F.lit(cuts[n])
        held_out = rows.filter((slot >= cut) & (slot < F.lit(cuts[n + 1])) if n + 1 < len(cuts) else slot >= cut)
        start = F.unix_timestamp("timestamp_rounded") - target.ahead
        horizon = F.floor((start - F.unix_timestamp(cut)) / (horizon_days * DAY)).cast("int")
        predictions = target.predict(target.fit(known), held_out, made_at)
        return predictions.withColumns({"fold": F.lit(n), "cut": cut.cast("timestamp"), "horizon": horizon})

    with ThreadPoolExecutor(threads) as pool:
        folds = [f for f in pool.map(inheritable_thread_target(rows.sparkSession)(fold), range(len(cuts))) if f is not None]
    if not folds:
        raise ValueError("no outcome is known before any cut")
    return backtest(reduce(DataFrame.unionByName, folds), target.predicted, target.actual, ["fold", "cut", "horizon"])


def backtest(predictions: DataFrame, predicted: str, actual: str, by: list[str] = ()) -> DataFrame:
    """Errors per model and target, and per ``by``, over the slots whose outcome is known."""
    error = F.col(predicted) - F.col(actual)
    return (
        predictions.filter(F.col(actual).isNotNull())
        .groupBy("model_name", "target", *by)
        .agg(
            F.count(F.lit(1)).alias("slots"),
            F.avg(actual).alias("mean_actual"),
            F.avg(F.abs(error)).alias("mae"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.avg(error).alias("bias"),
        )
    )

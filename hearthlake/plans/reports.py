"""The report pages: energy, environment, presence and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.plans import measures


def energy_by_room(tables: dict[str, DataFrame]) -> DataFrame:
    names = ["total_energy_kwh", "avg_power_w", "peak_power_w"]
    return measures.aggregate(names, tables, ["apartment_id", "room_name"])


def energy_trend(tables: dict[str, DataFrame]) -> DataFrame:
    return measures.aggregate(["total_energy_kwh"], tables, ["date"])


def cost_by_apartment(tables: dict[str, DataFrame]) -> DataFrame:
    return measures.aggregate(["total_cost_chf"], tables, ["apartment_id", "year", "month"])


def room_comparison(tables: dict[str, DataFrame]) -> DataFrame:
    """Climate per room, with the minutes that hold an outlier."""
    names = [
        "avg_indoor_temp_c",
        "avg_indoor_humidity_pct",
        "avg_co2_ppm",
        "avg_noise_db",
        "avg_pressure_hpa",
        "outlier_minutes",
        "environment_minutes",
    ]
    return measures.aggregate(names, tables, ["apartment_id", "room_name"])


def presence_heatmap(tables: dict[str, DataFrame]) -> DataFrame:
    """Occupancy and movement per weekday and hour."""
    names = ["occupancy_rate_pct", "total_motion_events"]
    return measures.aggregate(names, tables, ["day_of_week", "hour"])


def occupancy_pattern(tables: dict[str, DataFrame]) -> DataFrame:
    """Occupancy per apartment and hour of the day."""
    return measures.aggregate(["occupancy_rate_pct"], tables, ["apartment_id", "hour"])


def predicted_vs_actual(predictions: DataFrame, predicted: str, actual: str) -> DataFrame:
    """Mean prediction and observation per model, apartment, room and day."""
    day = F.to_date("timestamp_rounded").alias("date")
    return predictions.groupBy("model_name", "apartment", "room", day).agg(
        F.avg(predicted).alias("avg_predicted"),
        F.avg(actual).alias("avg_actual"),
        F.count(actual).alias("slots_with_actual"),
    )

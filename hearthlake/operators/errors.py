"""Registry error log to typed, classified errors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.functions import cleaning
from hearthlake.sources.registry import find_column


def clean_di_errors(
    errors: DataFrame, buildings: DataFrame | None = None, apartment_patterns: dict[str, str] | None = None
) -> DataFrame:
    """Type the text columns, drop rows without a date, classify severity and look up the apartment.

    The apartment comes from the name of the error's building by ``apartment_patterns``; without buildings, or
    without a match, it is null. Sensor and room ids are not in the log and stay null. An id or date that is
    not readable becomes null.
    """
    id_col = find_column(errors, ["idError"])
    building_col = find_column(errors, ["idBuilding"])
    message_col = find_column(errors, ["errorMessage"])
    date_col = find_column(errors, ["creationDate"])
    if not (message_col and date_col):
        raise ValueError("the error log needs a message and a creation date column")

    log = errors.filter(F.col(date_col).isNotNull() & (F.col(date_col) != "")).select(
        (cleaning.blank_to_null(F.col(id_col)).try_cast("int") if id_col else F.lit(None).cast("int")).alias("error_id"),
        F.col(message_col).alias("error_message"),
        F.col(date_col).try_cast("timestamp").alias("timestamp"),
        (F.col(building_col) if building_col else F.lit(None).cast("string")).alias("building"),
    )
    house = None
    if buildings is not None and building_col:
        key, name = find_column(buildings, ["idBuilding"]), find_column(buildings, ["houseName"])
        if key and name:
            house = buildings.select(F.col(key).alias("building"), F.col(name).alias("house"))
    log = log.join(house, "building", "left") if house is not None else log.withColumn("house", F.lit(None).cast("string"))
    return log.select(
        "error_id",
        F.lit(None).cast("string").alias("sensor_id"),
        F.lit(None).cast("int").alias("room_id"),
        cleaning.by_pattern(F.col("house"), apartment_patterns or {}).alias("apartment"),
        "timestamp",
        "error_message",
        cleaning.severity(F.col("error_message")).alias("severity"),
    )

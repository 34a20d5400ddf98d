"""Row-level access, subject access and erasure."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ADMIN = "Admin"
# Tables that say nothing about a home.
SHARED = ("dim_date", "dim_datetime", "dim_tariff", "dim_weather_site", "fact_weather_hour", "weather_forecasts")


def _narrowed(
    tables: dict[str, DataFrame],
    by_key: Callable[[DataFrame], DataFrame],
    by_name: Callable[[DataFrame], DataFrame],
    by_room: Callable[[DataFrame], DataFrame],
) -> dict[str, DataFrame]:
    """Each table through the filter that fits its columns; a table that is neither private nor shared is refused."""

    def one(name: str, df: DataFrame) -> DataFrame:
        if name in SHARED:
            return df
        for column, narrow in (("apartment_key", by_key), ("apartment", by_name), ("room_key", by_room)):
            if column in df.columns:
                return narrow(df)
        raise ValueError(f"{name} has no apartment and is not a shared table")

    return {name: one(name, df) for name, df in tables.items()}


def visible(
    tables: dict[str, DataFrame], grants: DataFrame, role: str, dimensions: dict[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """The tables as ``role`` may see them.

    ``grants`` holds (role, apartment_key). Tables with an apartment key, an apartment name or a room key keep the
    granted apartments only, the tables named in SHARED are seen by all, any other is refused. Names and rooms are
    looked up in ``dim_apartment`` and ``dim_room``, from ``dimensions`` or else from the tables. The admin role sees
    everything.
    """
    if role == ADMIN:
        return tables
    lookup = {**tables, **(dimensions or {})}
    granted = grants.filter(F.col("role") == role).select("apartment_key").distinct()

    def by_name(df: DataFrame) -> DataFrame:
        names = lookup["dim_apartment"].join(granted, "apartment_key", "left_semi")
        return df.join(names.select(F.col("apartment_id").alias("apartment")), "apartment", "left_semi")

    def by_room(df: DataFrame) -> DataFrame:
        rooms = lookup["dim_room"].join(granted, "apartment_key", "left_semi")
        return df.join(rooms.select("room_key"), "room_key", "left_semi")

    return _narrowed(tables, lambda df: df.join(granted, "apartment_key", "left_semi"), by_name, by_room)


def subject_access(readings: DataFrame, apartment: str) -> DataFrame:
    """Everything stored about one apartment."""
    return readings.filter(F.col("apartment") == apartment)


def erase(
    tables: dict[str, DataFrame], apartments: DataFrame, dimensions: dict[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """Every table without the rows of ``apartments`` (column ``apartment``), in silver and gold alike.

    Shared tables stay, and a table whose rows cannot be traced to an apartment is refused instead of kept.
    """
    lookup = {**tables, **(dimensions or {})}
    ids = apartments.select("apartment").distinct()
    gone = lookup["dim_apartment"].join(ids, F.col("apartment_id") == F.col("apartment"), "left_semi")
    keys = gone.select("apartment_key")
    rooms = lookup["dim_room"].join(keys, "apartment_key", "left_semi").select("room_key")
    return _narrowed(
        tables,
        lambda df: df.join(keys, "apartment_key", "left_anti"),
        lambda df: df.join(ids, "apartment", "left_anti"),
        lambda df: df.join(rooms, "room_key", "left_anti"),
    )

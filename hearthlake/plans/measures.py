"""BI measures over the star schema, each with optional grouping and filter.

A measure is kept as partial aggregates that can be merged. The fact is first reduced to its own foreign keys, with
map-side combine, and only those few rows are joined to the dimensions and merged. So a day, room or apartment with
a third of all rows is one row per key by the time of the join, whatever the join strategy.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """Partial aggregates over rows of ``table``, how to merge each, and the value made of the merged ones."""

    table: str
    parts: dict[str, Column]
    merge: Callable[[str], Column]
    value: Callable[[dict[str, Column]], Column]


def _sum(table: str, column: str) -> Measure:
    return Measure(table, {"total": F.sum(column)}, F.sum, lambda p: p["total"])


def _max(table: str, column: str) -> Measure:
    return Measure(table, {"top": F.max(column)}, F.max, lambda p: p["top"])


def _avg(table: str, column: str) -> Measure:
    parts = {"total": F.sum(column), "n": F.count(column)}
    return Measure(table, parts, F.sum, lambda p: p["total"] / F.nullif(p["n"], F.lit(0)))


def _rows(table: str, flag: str | None = None) -> Measure:
    counted = F.count_if(flag) if flag else F.count(F.lit(1))
    return Measure(table, {"n": counted}, F.sum, lambda p: F.coalesce(p["n"], F.lit(0)))


def _share(table: str, flag: str) -> Measure:
    parts = {"hits": F.count_if(flag), "n": F.count(F.lit(1))}
    return Measure(table, parts, F.sum, lambda p: p["hits"] / F.nullif(p["n"], F.lit(0)) * 100)


def measures() -> dict[str, Measure]:
    energy, environment = "fact_energy_minute", "fact_environment_minute"
    presence, weather, health = "fact_presence_minute", "fact_weather_hour", "fact_device_health_day"
    return {
        "total_energy_kwh": _sum(energy, "energy_kwh"),
        "total_cost_chf": _sum("mv_energy_with_cost", "cost_chf"),
        "avg_power_w": _avg(energy, "power_w"),
        "peak_power_w": _max(energy, "power_w"),
        "avg_indoor_temp_c": _avg(environment, "temperature_c"),
        "avg_indoor_humidity_pct": _avg(environment, "humidity_pct"),
        "avg_co2_ppm": _avg(environment, "co2_ppm"),
        "avg_noise_db": _avg(environment, "noise_db"),
        "avg_pressure_hpa": _avg(environment, "pressure_hpa"),
        "anomaly_rate_pct": _share(environment, "is_anomaly"),
        "outlier_minutes": _rows(environment, "is_anomaly"),
        "environment_minutes": _rows(environment),
        "occupancy_rate_pct": _share(presence, "presence_flag"),
        "total_motion_events": _sum(presence, "motion_count"),
        "avg_outdoor_temp_c": _avg(weather, "temperature_c"),
        "avg_outdoor_humidity_pct": _avg(weather, "humidity_pct"),
        "total_precipitation_mm": _sum(weather, "precipitation_mm"),
        "avg_radiation_wm2": _avg(weather, "radiation_wm2"),
        "avg_uptime_pct": _avg(health, "uptime_pct"),
        "total_missing_readings": _sum(health, "missing_readings"),
        "avg_battery_pct": _avg(health, "battery_avg_pct"),
    }


# (dimension, its key, its reporting columns); a fact reaches a dimension when it holds the key
_REACHABLE = [
    ("dim_datetime", "datetime_key", ["timestamp_utc", "hour", "minute"]),
    ("dim_date", "date_key", ["date", "day_of_week", "week", "month", "year", "is_weekend"]),
    ("dim_apartment", "apartment_key", ["apartment_id", "building_id", "building_name"]),
    ("dim_room", "room_key", ["room_name"]),
    ("dim_device", "device_key", ["device_id", "sensor_type"]),
    ("dim_weather_site", "site_key", ["site_name"]),
]


def _needed(fact: DataFrame, columns: list[str]) -> list[tuple[str, str, list[str]]]:
    """The dimensions, among those the fact reaches, that supply ``columns``."""
    needed, found = [], set()
    for name, key, offered in _REACHABLE:
        wanted = [c for c in offered if c in columns]
        if wanted and key in fact.columns:
            needed.append((name, key, wanted))
            found.update(wanted)
    missing = [c for c in columns if c not in found]
    if missing:
        raise ValueError(f"no dimension of this fact has {missing}")
    return needed


def _reduced(
    names: list[str], tables: dict[str, DataFrame], by: list[str], where: dict[str, list] | None
) -> tuple[DataFrame, list[Column]]:
    """Partial aggregates joined to the dimensions and filtered, and the columns that finish the measures."""
    chosen = {n: measures()[n] for n in names}
    sources = {m.table for m in chosen.values()}
    if len(sources) != 1:
        raise ValueError("measures of different tables are aggregated separately and then joined")
    fact, where = tables[sources.pop()], where or {}
    dimensions = _needed(fact, list(dict.fromkeys([*by, *where])))
    parts = [part.alias(f"{n}__{p}") for n, m in chosen.items() for p, part in m.parts.items()]
    rows = fact.groupBy(*[key for _, key, _ in dimensions]).agg(*parts)
    for name, key, wanted in dimensions:
        rows = rows.join(tables[name].select(key, *wanted), key)
    rows = reduce(DataFrame.filter, [F.col(c).isin(values) for c, values in where.items()], rows)
    finished = [
        m.value({p: m.merge(f"{n}__{p}") for p in m.parts}).alias(n) for n, m in chosen.items()
    ]
    return rows, finished


def aggregate(
    names: list[str], tables: dict[str, DataFrame], by: list[str] = (), where: dict[str, list] | None = None
) -> DataFrame:
    """Several measures of the same table in one pass over it."""
    rows, finished = _reduced(names, tables, list(by), where)
    return rows.groupBy(*by).agg(*finished)


def measure(
    name: str, tables: dict[str, DataFrame], by: list[str] = (), where: dict[str, list] | None = None
) -> DataFrame:
    """One measure per group of dimension columns ``by``, over the rows allowed by ``where`` (column -> values)."""
    if name == "daily_cost_chf":
        return daily_cost(tables, list(by), where)
    if name == "temp_delta_c":
        return temperature_delta(tables, list(by), where)
    return aggregate([name], tables, by, where)


def daily_cost(tables: dict[str, DataFrame], by: list[str] = (), where: dict[str, list] | None = None) -> DataFrame:
    """Total cost over the number of calendar dates under the same filter.

    The dates counted are those of dim_date, whether or not anything was consumed on them. Groupings and filters
    on other dimensions do not restrict the dates.
    """
    cost = aggregate(["total_cost_chf"], tables, by, where)
    dates = tables["dim_date"]
    date_by = [c for c in by if c in dates.columns]
    for column, values in (where or {}).items():
        if column in dates.columns:
            dates = dates.filter(F.col(column).isin(values))
    days = dates.groupBy(*date_by).agg(F.count_distinct("date").alias("days"))
    joined = cost.join(days, date_by, "left") if date_by else cost.withColumn("days", days.scalar())
    per_day = F.col("total_cost_chf").cast("double") / F.nullif("days", F.lit(0))
    return joined.select(*by, per_day.alias("daily_cost_chf"))


def temperature_delta(
    tables: dict[str, DataFrame], by: list[str] = (), where: dict[str, list] | None = None
) -> DataFrame:
    """Mean indoor minus mean outdoor temperature; each fact is aggregated before the two meet.

    ``by`` and ``where`` may only use dimensions both facts share.
    """
    indoor = aggregate(["avg_indoor_temp_c"], tables, by, where)
    outdoor = aggregate(["avg_outdoor_temp_c"], tables, by, where)
    both = indoor.join(outdoor, list(by), "full") if by else indoor.withColumn("avg_outdoor_temp_c", outdoor.scalar())
    return both.select(*by, (F.col("avg_indoor_temp_c") - F.col("avg_outdoor_temp_c")).alias("temp_delta_c"))


def drill_down(name: str, tables: dict[str, DataFrame], where: dict[str, list] | None = None) -> DataFrame:
    """A measure at every level of Year > Month > Week > Day; ``level`` counts the columns rolled up.

    Only the per-day partial aggregates are expanded to the levels, not the fact.
    """
    levels = ["year", "month", "week", "date"]
    rows, finished = _reduced([name], tables, levels, where)
    return rows.rollup(*levels).agg(F.bit_count(F.grouping_id()).cast("int").alias("level"), *finished)

"""Gold dimensions. Each takes the existing table, if any, and keeps its keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.functions import calendar, cleaning
from hearthlake.operators import surrogate
from hearthlake.schemas import DIM_APARTMENT, DIM_DEVICE, DIM_ROOM, DIM_TARIFF, DIM_WEATHER_SITE, TARIFFS


def _moments(readings: DataFrame, forecasts: DataFrame | None, grain: str) -> DataFrame:
    """Distinct days or minutes of both silver tables. Truncated first, so each task sends every moment once."""
    sides = [readings] if forecasts is None else [readings, forecasts]
    moments = [side.select(F.date_trunc(grain, "timestamp").alias("moment")).distinct() for side in sides]
    return moments[0] if len(moments) == 1 else moments[0].union(moments[1]).distinct()


def _calendar_columns(moment: Column) -> list[Column]:
    return [
        calendar.weekday_name(moment).alias("day_of_week"),
        F.weekofyear(moment).cast("smallint").alias("week"),
        F.month(moment).cast("smallint").alias("month"),
        F.year(moment).cast("smallint").alias("year"),
        calendar.is_weekend(moment).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    ]


def _absent(rows: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    if existing is None:
        return rows
    return existing.unionByName(rows.join(existing.select(key), key, "left_anti"))


def dim_date(readings: DataFrame, forecasts: DataFrame | None = None, existing: DataFrame | None = None) -> DataFrame:
    """One row per day that occurs in either silver table; weeks are ISO weeks."""
    moment = F.col("moment")
    rows = _moments(readings, forecasts, "day").select(
        calendar.date_key(moment).alias("date_key"), F.to_date(moment).alias("date"), *_calendar_columns(moment)
    )
    return _absent(rows, existing, "date_key")


def dim_datetime(
    readings: DataFrame, forecasts: DataFrame | None = None, existing: DataFrame | None = None
) -> DataFrame:
    """One row per minute that occurs in either silver table."""
    moment = F.col("moment")
    rows = _moments(readings, forecasts, "minute").select(
        calendar.datetime_key(moment).alias("datetime_key"),
        moment.alias("timestamp_utc"),
        calendar.date_key(moment).alias("date_key"),
        F.hour(moment).cast("smallint").alias("hour"),
        F.minute(moment).cast("smallint").alias("minute"),
        *_calendar_columns(moment),
    )
    return _absent(rows, existing, "datetime_key")


def members(readings: DataFrame) -> DataFrame:
    """Distinct (apartment, room, sensor_type): the one scan that apartments, rooms and devices all come from."""
    return readings.select("apartment", "room", "sensor_type").distinct()


def _complete(df: DataFrame, schema) -> DataFrame:
    """All columns of the table, null where nothing fills them."""
    return df.select(
        [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )


def dim_apartment(
    found: DataFrame,
    buildings: DataFrame | None = None,
    patterns: dict[str, str] | None = None,
    existing: DataFrame | None = None,
) -> DataFrame:
    """One row per apartment, enriched from the registry and masked.

    ``patterns`` maps a pattern in a building's name to the apartment it belongs to. The building's id is kept, its
    name is replaced by ``Building <id>`` and no owner is stored.
    """
    apartments = found.select(F.col("apartment").alias("apartment_id")).distinct()
    rows = surrogate.extend(apartments, existing, ["apartment_id"], "apartment_key")
    rows = _complete(rows.withColumn("name", F.col("apartment_id")), DIM_APARTMENT)
    if buildings is not None:
        rows = _enrich(rows, buildings, patterns or {})
    return mask(rows)


def _enrich(rows: DataFrame, buildings: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Building id by name pattern; apartments without a building keep what they had. Of several, the least id."""
    owner = cleaning.by_pattern(F.col("houseName"), patterns)
    match = (
        buildings.select(owner.alias("apartment_id"), F.col("idBuilding").try_cast("int").alias("found_id"))
        .filter("apartment_id is not null")
        .groupBy("apartment_id")
        .agg(F.min("found_id").alias("found_id"))
    )
    joined = rows.join(match, "apartment_id", "left")
    return joined.withColumn("building_id", F.coalesce("found_id", "building_id")).select(*rows.columns)


def mask(apartments: DataFrame) -> DataFrame:
    """Remove what identifies a household: building names become ``Building <id>``, owners become null."""
    label = F.when(F.col("building_id").isNotNull(), F.concat(F.lit("Building "), F.col("building_id").cast("string")))
    return apartments.withColumns({"building_name": label, "owner_user_id": F.lit(None).cast("string")})


def dim_room(found: DataFrame, apartments: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    keys = apartments.select(F.col("apartment_id").alias("apartment"), "apartment_key")
    rooms = found.select("apartment", F.col("room").alias("room_name")).distinct().join(keys, "apartment")
    rows = surrogate.extend(rooms.select("room_name", "apartment_key"), existing, ["apartment_key", "room_name"], "room_key")
    return _complete(rows, DIM_ROOM)


def device_id(apartment: Column, room: Column, sensor_type: Column) -> Column:
    return F.concat(apartment, F.lit("_"), room, F.lit("_"), sensor_type)


def room_keys(apartments: DataFrame, rooms: DataFrame) -> DataFrame:
    """(apartment, room) to (apartment_key, room_key)."""
    return rooms.join(apartments.select("apartment_key", "apartment_id"), "apartment_key").select(
        F.col("apartment_id").alias("apartment"), F.col("room_name").alias("room"), "apartment_key", "room_key"
    )


def dim_device(
    found: DataFrame, apartments: DataFrame, rooms: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """One row per (composed device id, sensor type).

    Two rooms can compose the same id (``a_b`` + ``c``, ``a`` + ``b_c``); the lesser room key then keeps it.
    """
    joined = found.join(room_keys(apartments, rooms), ["apartment", "room"])
    devices = joined.select(
        device_id(F.col("apartment"), F.col("room"), F.col("sensor_type")).alias("device_id"), "room_key", "sensor_type"
    )
    devices = devices.groupBy("device_id", "sensor_type").agg(F.min("room_key").alias("room_key"))
    rows = surrogate.extend(devices, existing, ["device_id", "sensor_type"], "device_key")
    rows = rows.withColumns(
        {"device_type": F.col("sensor_type"), "is_active": F.lit(True) if existing is None else F.coalesce("is_active", F.lit(True))}
    )
    return _complete(rows, DIM_DEVICE)


def dim_tariff(
    spark: SparkSession, tariffs: Iterable[tuple] | DataFrame = TARIFFS, existing: DataFrame | None = None
) -> DataFrame:
    """Configured prices, as tuples or as a table (provider, year, price); a changed price replaces the stored one and
    keeps its key."""
    given = tariffs
    if not isinstance(given, DataFrame):
        rows = [(p, int(y), str(c)) for p, y, c in tariffs]
        given = spark.createDataFrame(rows, "provider string, year int, price string")
    given = given.select(
        "provider", F.col("year").cast("smallint").alias("year"), F.col("price").cast("decimal(6,4)").alias("price")
    )
    rows = surrogate.extend(given.select("provider", "year"), existing, ["provider", "year"], "tariff_key")
    rows = rows.join(given, ["provider", "year"], "left")
    stored = F.col("chf_per_kwh") if existing is not None else F.lit(None).cast("decimal(6,4)")
    return _complete(rows.withColumn("chf_per_kwh", F.coalesce("price", stored)), DIM_TARIFF)


def dim_weather_site(sites: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Configured sites (column ``site_name``)."""
    return _complete(
        surrogate.extend(sites.select("site_name").distinct(), existing, ["site_name"], "site_key"), DIM_WEATHER_SITE
    )


def link_weather_site(apartments: DataFrame, sites: DataFrame, first_site: str) -> DataFrame:
    """Give apartments without a weather site the first configured one."""
    first = sites.filter(F.col("site_name") == first_site).select(F.max("site_key")).scalar()
    return apartments.withColumn("weather_site_key", F.coalesce(F.col("weather_site_key"), first))

"""Gold facts.

Every fact aggregates silver rows by their natural key first and looks surrogate keys up afterwards. The natural
keys are unique in the dimensions, so the result is that of joining first, but the big side is reduced within each
map task before it is shuffled once, and the dimension joins see minute or day rows instead of raw readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthlake.functions import calendar, cleaning
from hearthlake.plans.dimensions import device_id, room_keys
from hearthlake.schemas import MINUTES_PER_DAY, TARIFF_PROVIDER, WEATHER_MEASUREMENTS


def _field(*names: str) -> Column:
    return F.col("field").isin(*names)


def _at_minute() -> Column:
    return calendar.minute(F.col("timestamp")).alias("minute")


def _time_keys(ts: str = "minute") -> list[Column]:
    return [calendar.datetime_key(F.col(ts)).alias("datetime_key"), calendar.date_key(F.col(ts)).alias("date_key")]


def _with_device_keys(df: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Add room_key, apartment_key and device_key: rooms by (apartment, room), devices by composed id and type."""
    rooms = room_keys(dims["dim_apartment"], dims["dim_room"])
    devices = dims["dim_device"].select("device_id", "sensor_type", "device_key")
    composed = device_id(F.col("apartment"), F.col("room"), F.col("sensor_type"))
    located = df.join(rooms, ["apartment", "room"]).withColumn("device_id", composed)
    return located.join(devices, ["device_id", "sensor_type"])


def pivot_fields(df: DataFrame, by: list, fields: dict[str, str], how=F.max, name: str = "field", value: str = "value"):
    """Long to wide: one output column per ``fields`` entry (column -> field), aggregated by ``how``."""
    cells = [how(F.when(F.col(name) == field, F.col(value))).alias(column) for column, field in fields.items()]
    return df.groupBy(*by).agg(*cells)


def energy_minutes(readings: DataFrame, at: Column | None = None) -> DataFrame:
    """Power and energy by natural key; ``at`` is the time to group by (a streaming query passes a window)."""
    energy = readings.filter(F.col("sensor_type").isin("plug", "consumption"))
    return energy.groupBy("apartment", "room", _at_minute() if at is None else at, "sensor_type").agg(
        F.max(F.when(_field("power", "total_power"), F.col("value"))).alias("power_w"),
        F.max(F.when(_field("total"), cleaning.wh_to_kwh(F.col("value")))).alias("energy_kwh"),
        F.bool_and(~F.col("is_outlier")).alias("is_valid"),
    )


def fact_energy_minute(readings: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Power and energy per device and minute.

    ``energy_kwh`` is the meter's ``total`` in kWh. Summing it over minutes, as the energy measures do, counts a
    meter that reports a running total many times over; the definition is kept as it is.
    """
    keyed = _with_device_keys(energy_minutes(readings), dims)
    return keyed.select(
        *_time_keys(), "device_key", "room_key", "apartment_key", "power_w", "energy_kwh", "is_valid"
    )


def environment_minutes(readings: DataFrame, at: Column | None = None) -> DataFrame:
    """Climate and opening state by natural key; flags are null where the room has no such sensor."""
    value = F.col("value")
    relevant = readings.filter(
        F.col("sensor_type").isin("meteo", "humidity", "door", "window")
        & _field(
            "temperature_c", "temperature", "humidity_pct", "humidity", "co2_ppm", "noise_db", "pressure_hpa", "open"
        )
    )
    climate_sensor = F.col("sensor_type").isin("humidity", "meteo")

    def opened(kind: str) -> Column:
        return F.bool_or(F.when((F.col("sensor_type") == kind) & _field("open"), value == 1.0))

    return relevant.groupBy("apartment", "room", _at_minute() if at is None else at).agg(
        F.max(F.when(_field("temperature_c") | (_field("temperature") & climate_sensor), value)).alias("temperature_c"),
        F.max(F.when(_field("humidity_pct") | (_field("humidity") & climate_sensor), value)).alias("humidity_pct"),
        F.max(F.when(_field("co2_ppm"), value)).alias("co2_ppm"),
        F.max(F.when(_field("noise_db"), value)).alias("noise_db"),
        F.max(F.when(_field("pressure_hpa"), value)).alias("pressure_hpa"),
        opened("window").alias("window_open_flag"),
        opened("door").alias("door_open_flag"),
        F.bool_or("is_outlier").alias("is_anomaly"),
    )


def fact_environment_minute(readings: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Climate and opening state per room and minute."""
    minutes = environment_minutes(readings)
    measures = minutes.columns[3:]
    keyed = minutes.join(room_keys(dims["dim_apartment"], dims["dim_room"]), ["apartment", "room"])
    return keyed.select(*_time_keys(), "room_key", "apartment_key", *measures)


def presence_minutes(readings: DataFrame, at: Column | None = None) -> DataFrame:
    """Motion and door state by natural key."""
    relevant = readings.filter(F.col("sensor_type").isin("motion", "door") & _field("motion", "open"))
    moved = (F.col("sensor_type") == "motion") & _field("motion") & (F.col("value") == 1.0)
    door = F.when((F.col("sensor_type") == "door") & _field("open"), F.col("value") == 1.0)
    return relevant.groupBy("apartment", "room", _at_minute() if at is None else at).agg(
        F.count_if(moved).cast("int").alias("motion_count"),
        F.bool_or(door).alias("door_open_flag"),
        F.bool_or(moved).alias("presence_flag"),
    )


def fact_presence_minute(readings: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Motion and door state per room and minute; the probability is left to the occupancy model."""
    minutes = presence_minutes(readings)
    keyed = minutes.join(room_keys(dims["dim_apartment"], dims["dim_room"]), ["apartment", "room"])
    return keyed.select(
        *_time_keys(),
        "room_key",
        "apartment_key",
        "motion_count",
        "door_open_flag",
        "presence_flag",
        F.lit(None).cast("double").alias("presence_prob"),
    )


def fact_device_health_day(readings: DataFrame, errors: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Battery, errors and uptime per device and day, for devices that report a battery that day.

    One pass over the readings gives battery and distinct minutes together. The distinct count is taken in two
    steps, (device, day, minute) and then (device, day), so a device with very many rows is no single task's work.
    """
    battery = F.when(_field("battery"), F.col("value"))
    days = (
        readings.groupBy("apartment", "room", "sensor_type", F.to_date("timestamp").alias("day"))
        .agg(
            F.min(battery).alias("battery_min_pct"),
            F.avg(battery).alias("battery_avg_pct"),
            F.count_if(_field("battery")).alias("battery_rows"),
            F.count_distinct(calendar.minute(F.col("timestamp"))).alias("minutes"),
        )
        .filter("battery_rows > 0")
    )
    errors_by_day = errors.groupBy(
        F.col("sensor_id").alias("device_id"), calendar.date_key(F.col("timestamp")).alias("date_key")
    ).agg(F.count(F.lit(1)).alias("errors"))
    device_errors = (
        errors_by_day.join(dims["dim_device"].select("device_id", "device_key"), "device_id")
        .groupBy("date_key", "device_key")
        .agg(F.sum("errors").alias("error_count"))
    )
    keyed = _with_device_keys(days, dims).withColumn("date_key", calendar.date_key(F.col("day")))
    share = (F.col("minutes") * 100).cast("decimal(20,0)") / F.lit(MINUTES_PER_DAY)
    return keyed.join(device_errors, ["date_key", "device_key"], "left").select(
        "date_key",
        "device_key",
        "room_key",
        "apartment_key",
        F.coalesce("error_count", F.lit(0)).cast("int").alias("error_count"),
        F.greatest(F.lit(MINUTES_PER_DAY) - F.col("minutes"), F.lit(0)).cast("int").alias("missing_readings"),
        F.round(share, 2).cast("double").alias("uptime_pct"),
        "battery_min_pct",
        "battery_avg_pct",
    )


def fact_weather_hour(forecasts: DataFrame, sites: DataFrame, how: str = "avg") -> DataFrame:
    """Forecast per site, time and issue date over the model runs; ``how`` is ``avg`` or ``median``."""
    aggregate = {"avg": F.avg, "median": F.median}[how]
    columns = {column: name for name, (column, _) in WEATHER_MEASUREMENTS.items()}
    cells = [
        aggregate(F.when(F.col("measurement") == name, F.col("value"))).alias(column) for column, name in columns.items()
    ]
    # The site lookup drops sites that are not configured; doing it on the raw rows keeps them out of the shuffle.
    wanted = forecasts.filter(~F.col("is_outlier")).join(
        sites.select(F.col("site_name").alias("site"), "site_key"), "site"
    )
    hours = wanted.groupBy(calendar.minute(F.col("timestamp")).alias("minute"), "site_key", "prediction_date").agg(
        *cells, F.count_distinct("prediction").cast("int").alias("n_model_runs")
    )
    return hours.select(*_time_keys(), "site_key", "prediction_date", *columns, "n_model_runs")


def energy_with_cost(
    energy: DataFrame, dates: DataFrame, tariffs: DataFrame, provider: str = TARIFF_PROVIDER
) -> DataFrame:
    """Energy fact with the year's price and the cost, null where the year has no price."""
    price = tariffs.filter(F.col("provider") == provider).select("year", "chf_per_kwh")
    priced = dates.select("date_key", "year").join(price, "year", "left").select("date_key", "chf_per_kwh")
    cost = (F.col("energy_kwh") * F.col("chf_per_kwh").cast("double")).cast("decimal(38,15)")
    return energy.join(priced, "date_key").select(
        *energy.columns, "chf_per_kwh", F.round(cost, 4).cast("decimal(38,4)").alias("cost_chf")
    )


def room_slots(
    energy: DataFrame, presence: DataFrame, dims: dict[str, DataFrame], minutes: int = 15
) -> DataFrame:
    """Mean power and occupancy per room and fixed slot.

    A room's power at a minute is the sum over its devices. Both facts are aggregated to slots before they meet.
    """

    def slot_of(datetime_key: str) -> Column:
        ts = F.try_to_timestamp(F.col(datetime_key).cast("string"), F.lit("yyyyMMddHHmm"))
        return calendar.slot(ts, minutes).alias("slot")

    keys = ["apartment_key", "room_key", "slot"]
    power = (
        energy.groupBy("apartment_key", "room_key", "datetime_key")
        .agg(F.sum("power_w").alias("power_w"))
        .groupBy("apartment_key", "room_key", slot_of("datetime_key"))
        .agg(F.avg("power_w").alias("power_w"))
    )
    occupied = presence.groupBy("apartment_key", "room_key", slot_of("datetime_key")).agg(
        F.max(F.col("presence_flag").cast("int")).alias("occupied"), F.sum("motion_count").alias("motion_count")
    )
    rooms = room_keys(dims["dim_apartment"], dims["dim_room"])
    return power.join(occupied, keys, "full").join(rooms, ["apartment_key", "room_key"]).select(
        "apartment_key", "room_key", "apartment", "room", "slot", "power_w", "occupied", "motion_count"
    )

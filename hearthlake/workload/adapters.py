"""Sensor payloads, readings, forecasts and registry rows derived from the given tables.

Events and orders stand in for sensor files, order lines for forecast rows, suppliers and documents for the
registry. The mapping is row by row, so all of it grows with the tables. ``oracles.py`` states the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake import session
from hearthlake.functions import calendar, cleaning
from hearthlake.plans import dimensions, facts
from hearthlake.schemas import WEATHER_MEASUREMENTS, WEATHER_MIN_YEAR

APARTMENT_MAP = {"alpha": "apt_a", "beta": "apt_b"}
RAW_ROOMS = ["Bhroom", "Bdroom", "Livingroom", "Office", "Attic"]
SITES = ["A", "N"]
NOW = "2024-02-01 00:00:00"
YEARS_AHEAD = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    session.pin(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """The given tables hold one row group each, which one task reads; what they stand for is a folder of many files."""
    return df.repartition(F.col(key))


def _kind(*names: str) -> Column:
    return F.col("event_type").isin(*names)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    room = F.element_at(F.array(*[F.lit(r) for r in RAW_ROOMS]), (F.col("user_id") % 5 + 1).cast("int"))
    return dealt(table(spark, sf_dir, "events").drop("props"), "event_id").select(
        F.col("event_id").alias("id"),
        F.date_trunc("minute", F.col("ts").cast("timestamp")).alias("ts"),
        F.when(F.col("user_id") % 2 == 0, "apt_a").otherwise("apt_b").alias("apartment"),
        room.alias("room"),
        "event_type",
        F.col("value").alias("v"),
        "user_id",
    )


def _shifted(day: str) -> Column:
    return F.add_months(F.to_date(day), 12 * YEARS_AHEAD).cast("timestamp")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    at_minute = F.unix_timestamp(_shifted("o_orderdate")) + (F.col("o_orderkey") % 1440) * 60
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return dealt(orders, "o_orderkey").select(
        F.col("o_orderkey").alias("id"),
        F.timestamp_seconds(at_minute).alias("ts"),
        F.when(F.col("o_custkey") % 2 == 0, "apt_a").otherwise("apt_b").alias("apartment"),
        F.col("o_totalprice").alias("p"),
    )


def _is_unreadable() -> Column:
    return _kind("click") & (F.col("id") % 101 == 0)


def _file_columns(prefix: str) -> list[Column]:
    owner = F.when(F.col("apartment") == "apt_a", "Alpha").otherwise("Beta")
    name = F.concat(F.date_format("ts", "dd.MM.yyyy HHmm"), F.lit("_"), owner, F.lit("_received.json"))
    folder = F.concat(F.lit(f"bronze/{prefix}"), F.lpad(F.col("id").cast("string"), 12, "0"))
    return [F.concat(folder, F.lit("/"), name).alias("path"), name.alias("name"), F.col("ts").alias("modified")]


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor files (path, name, modified, value), one per event and one per order."""
    events = _events(spark, sf_dir)
    v, room, even = F.col("v"), F.col("room"), F.col("id") % 2 == 0

    def in_room(kind: Column, *cells: Column) -> Column:
        return F.when(kind, F.create_map(room, F.struct(*cells)))

    spelled = F.when(even, F.date_format("ts", "dd.MM.yyyy HH:mm")).otherwise(F.date_format("ts", "d.M.yyyy H:m"))
    when = F.when(F.col("id") % 103 == 0, "31.02.2024 10:00").otherwise(spelled).alias("datetime")
    power = F.when(_is_unreadable(), "n/a").when(_kind("click"), (v * 30).cast("string")).otherwise(v.cast("string"))
    total = F.when(_kind("click"), v * 100).otherwise(v * 10)
    plugs = in_room(_kind("click", "purchase"), power.alias("power"), total.alias("total")).alias("plugs")
    motions = in_room(
        _kind("signup"),
        (F.col("id") % 3 == 0).alias("motion"),
        F.col("user_id").alias("light"),
        v.alias("temperature"),
    ).alias("motions")
    meteo = in_room(
        _kind("view"),
        v.alias("Temperature"),
        (v * 20).alias("CO2"),
        v.alias("Humidity"),
        v.alias("Noise"),
        (v + 850).alias("Pressure"),
        F.lit(900).alias("AbsolutePressure"),
        v.alias("battery_percent"),
    )
    humidities = in_room(
        _kind("error"), (v / 2).alias("temperature"), v.alias("humidity"), v.alias("devicePower")
    ).alias("humidities")
    door = F.struct(
        F.lit("Door").alias("type"),
        F.when(F.col("id") % 5 < 2, "on").otherwise("off").alias("switch"),
        v.alias("battery"),
    )
    window = F.struct(
        F.lit("Window").alias("type"),
        F.when(F.col("id") % 7 == 0, "ON").otherwise("off").alias("switch"),
        F.lit(None).cast("double").alias("battery"),
    )
    listed = F.when(_kind("error"), F.create_map(room, F.array(door, window))).alias("doorsWindows")
    single = in_room(_kind("error"), F.when(F.col("id") % 5 == 0, "on").otherwise("off").alias("switch")).alias(
        "doorsWindows"
    )
    nested = F.when(_kind("view"), F.struct(meteo.alias("meteo"))).alias("meteos")
    payload = F.when(even, F.to_json(F.struct(when, plugs, listed, motions, nested, humidities))).otherwise(
        F.to_json(F.struct(when, plugs, single, motions, meteo.alias("meteos"), humidities))
    )
    from_events = events.select(*_file_columns("e"), payload.alias("value"))

    p = F.col("p")
    house = F.struct(
        (p / 100).alias("total_power"), (p / 300).alias("power1"), (p / 230).alias("current1"), F.lit(230).alias("voltage1")
    )
    kitchen = F.struct((p / 50).alias("power"), p.alias("total"))
    of_order = F.to_json(
        F.struct(
            F.date_format("ts", "dd.MM.yyyy HH:mm").alias("datetime"),
            F.create_map(F.lit("Kitchen"), kitchen).alias("plugs"),
            F.create_map(F.lit("House"), house).alias("consumptions"),
        )
    )
    from_orders = _orders(spark, sf_dir).select(*_file_columns("o"), of_order.alias("value"))
    return from_events.unionByName(from_orders)


def _cells(room: str, *cells: tuple[str, str, str, str]) -> str:
    """SQL array of readings from (sensor_type, field, value, unit)."""
    structs = [
        f"named_struct('room', {room}, 'sensor_type', '{kind}', 'field', '{field}', 'value', double({value}), 'unit', '{unit}')"
        for kind, field, value, unit in cells
    ]
    return f"array({', '.join(structs)})"


_HUMIDITY = [("humidity", "temperature", "v / 2", "C"), ("humidity", "humidity", "v", "%"), ("humidity", "battery", "v", "%")]
_CELLS = {
    "event_type = 'click'": [("plug", "power", "v * 30", "W"), ("plug", "total", "v * 100", "Wh")],
    "event_type = 'purchase'": [("plug", "power", "v", "W"), ("plug", "total", "v * 10", "Wh")],
    "event_type = 'view'": [
        ("meteo", "temperature_c", "v", "C"),
        ("meteo", "co2_ppm", "v * 20", "ppm"),
        ("meteo", "humidity_pct", "v", "%"),
        ("meteo", "noise_db", "v", "dB"),
        ("meteo", "pressure_hpa", "v + 850", "hPa"),
        ("meteo", "abs_pressure_hpa", "900", "hPa"),
        ("meteo", "battery", "v", "%"),
    ],
    "event_type = 'signup'": [
        ("motion", "motion", "int(id % 3 = 0)", "bool"),
        ("motion", "light", "user_id", "lux"),
        ("motion", "temperature", "v", "C"),
    ],
    "event_type = 'error' AND id % 2 = 0": [
        ("door", "open", "int(id % 5 < 2)", "bool"),
        ("door", "battery", "v", "%"),
        ("window", "open", "int(id % 7 = 0)", "bool"),
        *_HUMIDITY,
    ],
    "event_type = 'error' AND id % 2 = 1": [("door", "open", "int(id % 5 = 0)", "bool"), *_HUMIDITY],
}
_KITCHEN = [("plug", "power", "p / 50", "W"), ("plug", "total", "p", "Wh")]
_HOUSE = [
    ("consumption", "total_power", "p / 100", "W"),
    ("consumption", "power1", "p / 300", "W"),
    ("consumption", "current1", "p / 230", "A"),
    ("consumption", "voltage1", "230", "V"),
]


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver readings of the same files, built without going through JSON; equal keys are not yet merged."""
    cases = " ".join(f"WHEN {condition} THEN {_cells('room', *cells)}" for condition, cells in _CELLS.items())
    of_event = F.expr(f"inline(CASE {cases} END)")
    of_order = F.expr(f"inline(concat({_cells(repr('Kitchen'), *_KITCHEN)}, {_cells(repr('House'), *_HOUSE)}))")
    events = _events(spark, sf_dir).filter(~_is_unreadable())
    from_events = events.select("apartment", "ts", *_file_columns("e"), of_event)
    from_orders = _orders(spark, sf_dir).select("apartment", "ts", *_file_columns("o"), of_order)
    return from_events.unionByName(from_orders).select(
        "apartment",
        cleaning.room_name(F.col("room")).alias("room"),
        "sensor_type",
        "field",
        "value",
        "unit",
        F.col("ts").alias("timestamp"),
        cleaning.is_outlier(F.col("field"), F.col("value")).alias("is_outlier"),
        F.col("ts").alias("_file_ts"),
        F.col("path").alias("_path"),
    )


def _forecast_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    q, kind = F.col("l_quantity"), F.col("l_partkey") % 5
    hour = F.unix_timestamp(_shifted("l_shipdate")) + (F.col("l_orderkey") % 24) * 3600
    return dealt(lines, "l_orderkey").join(orders, "l_orderkey").select(
        F.timestamp_seconds(hour).alias("hour"),
        F.when(kind == 0, q * 2 - 30).when(kind == 1, q * 2.5).when(kind == 2, q / 5).otherwise(q * 35).alias("v"),
        (F.col("l_discount") == 0).alias("is_sentinel"),
        ((F.col("l_linenumber") == 7) & (q == 13)).alias("is_bad_time"),
        "l_linenumber",
        "l_returnflag",
        F.when(kind == 0, "PRED_T_2M_ctrl")
        .when(kind == 1, "PRED_RELHUM_2M_ctrl")
        .when(kind == 2, "PRED_TOT_PREC_ctrl")
        .when(kind == 3, "PRED_GLOB_ctrl")
        .otherwise("PRED_OTHER")
        .alias("kind"),
        F.to_date(_shifted("o_orderdate")).alias("issued"),
    )


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver forecasts, built without going through text."""
    bounds = {name: limits for name, (_, limits) in WEATHER_MEASUREMENTS.items()}
    kept = (F.col("kind") != "PRED_OTHER") & ~F.col("is_sentinel") & ~F.col("is_bad_time")
    return (
        _forecast_lines(spark, sf_dir)
        .filter(kept & (F.col("hour") >= F.lit(f"{WEATHER_MIN_YEAR}-01-01").cast("timestamp")))
        .select(
            F.col("hour").alias("timestamp"),
            F.col("l_returnflag").alias("site"),
            F.col("l_linenumber").cast("smallint").alias("prediction"),
            F.col("issued").alias("prediction_date"),
            F.col("kind").alias("measurement"),
            F.col("v").alias("value"),
            F.lit("unit").alias("unit"),
            cleaning.is_outlier(F.col("kind"), F.col("v"), bounds).alias("is_outlier"),
        )
    )


def raw_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast rows as they stand in the CSV files, all text, with the issue date and the file they belong to."""
    spelled = F.concat(F.date_format("hour", "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00"))
    name = F.concat(F.lit("Pred_"), F.date_format("issued", "yyyy-MM-dd"), F.lit(".csv"))
    return _forecast_lines(spark, sf_dir).select(
        F.when(F.col("is_bad_time"), "not a time").otherwise(spelled).alias("Time"),
        F.when(F.col("is_sentinel"), "-99999.0").otherwise(F.col("v").cast("string")).alias("Value"),
        F.lpad(F.col("l_linenumber").cast("string"), 2, "0").alias("Prediction"),
        F.concat(F.lit(' "'), F.col("l_returnflag"), F.lit('" ')).alias("Site"),
        F.col("kind").alias("Measurement"),
        F.lit(" unit ").alias("Unit"),
        name.alias("path"),
        name.alias("name"),
        calendar.prediction_date(name).alias("prediction_date"),
    )


def sites(spark: SparkSession) -> DataFrame:
    return dimensions.dim_weather_site(spark.createDataFrame([(s,) for s in SITES], "site_name string"))


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry buildings, all text, from the suppliers: two of them own the apartments."""
    key = F.col("s_suppkey")
    house = F.when(key == 3, "Villa ALPHA").when(key == 7, "Beta house").otherwise(F.col("s_name"))
    return table(spark, sf_dir, "supplier").select(
        key.cast("string").alias("idBuilding"), house.alias("houseName"), F.col("s_nationkey").cast("string").alias("city")
    )


def di_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry error log, all text, from the error events and the documents."""
    events = table(spark, sf_dir, "events").filter(_kind("error"))
    key = F.col("event_id")
    wording = (
        F.when(key % 4 == 0, "Sensor DOWN, read failed")
        .when(key % 4 == 1, "null value")
        .when(key % 4 == 2, "Exception in poll")
        .otherwise("battery replaced")
    )
    from_events = events.select(
        F.when(key % 11 == 0, "").otherwise(key.cast("string")).alias("idError"),
        (key % 10).cast("string").alias("idBuilding"),
        wording.alias("ErrorMessage"),
        F.when(key % 13 == 0, "").when(key % 17 == 0, None).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias(
            "creationDate"
        ),
    )
    documents = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("9"), F.col("doc_id").cast("string")).alias("idError"),
        (F.col("doc_id") % 10).cast("string").alias("idBuilding"),
        F.col("text").alias("ErrorMessage"),
        F.lit("2024-01-15 12:00:00").alias("creationDate"),
    )
    return from_events.unionByName(documents)


def device_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned errors that do name a device, so that the health fact has something to count."""
    events = _events(spark, sf_dir).filter(_kind("error"))
    device = F.concat("apartment", F.lit("_"), cleaning.room_name(F.col("room")), F.lit("_humidity"))
    return events.select(device.alias("sensor_id"), F.col("ts").alias("timestamp"))


def dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Apartment, room and device dimensions, written so that the facts join against tables of known size."""
    found = session.materialise(dimensions.members(readings(spark, sf_dir)), "members")
    apartments = session.materialise(
        dimensions.dim_apartment(found, buildings(spark, sf_dir), APARTMENT_MAP), "dim_apartment"
    )
    rooms = session.materialise(dimensions.dim_room(found, apartments), "dim_room")
    devices = session.materialise(dimensions.dim_device(found, apartments, rooms), "dim_device")
    return {"dim_apartment": apartments, "dim_room": rooms, "dim_device": devices}


_STORED: dict[tuple[str, str], dict[str, DataFrame]] = {}


def stored_dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The dimension tables as facts and measures find them: built once per session and data folder, and stored.

    Stored tables have a known size, so a join broadcasts them exactly as long as they are small.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        silver, outlook = readings(spark, sf_dir), forecasts(spark, sf_dir)
        gold = dims(spark, sf_dir)
        gold["dim_weather_site"] = session.materialise(sites(spark), "dim_weather_site")
        gold["dim_tariff"] = session.materialise(dimensions.dim_tariff(spark), "dim_tariff")
        linked = dimensions.link_weather_site(gold["dim_apartment"], gold["dim_weather_site"], SITES[0])
        gold["dim_apartment"] = session.materialise(linked, "dim_apartment")
        minutes = session.materialise(dimensions.dim_datetime(silver, outlook), "dim_datetime")
        gold["dim_datetime"] = minutes
        days = minutes.select(F.col("timestamp_utc").alias("timestamp"))
        gold["dim_date"] = session.materialise(dimensions.dim_date(days), "dim_date")
        _STORED[key] = gold
    return dict(_STORED[key])


def star(spark: SparkSession, sf_dir: str, *facts_needed: str) -> dict[str, DataFrame]:
    """The stored dimensions and the facts asked for."""
    gold = stored_dims(spark, sf_dir)
    silver, outlook = readings(spark, sf_dir), forecasts(spark, sf_dir)
    builders = {
        "fact_energy_minute": lambda: facts.fact_energy_minute(silver, gold),
        "fact_environment_minute": lambda: facts.fact_environment_minute(silver, gold),
        "fact_presence_minute": lambda: facts.fact_presence_minute(silver, gold),
        "fact_device_health_day": lambda: facts.fact_device_health_day(silver, device_errors(spark, sf_dir), gold),
        "fact_weather_hour": lambda: facts.fact_weather_hour(outlook, gold["dim_weather_site"]),
        "mv_energy_with_cost": lambda: facts.energy_with_cost(
            facts.fact_energy_minute(silver, gold), gold["dim_date"], gold["dim_tariff"]
        ),
    }
    return gold | {name: builders[name]() for name in facts_needed}

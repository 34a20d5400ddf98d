"""Table schemas and the fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

_STR, _DBL, _LONG, _INT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
_SHORT, _BOOL, _DATE, _TS = T.ShortType(), T.BooleanType(), T.DateType(), T.TimestampType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# ---- Fixed values: sensor payload -------------------------------------------------------------------------------

# payload section -> (payload key, field, unit), in emission order
SECTION_FIELDS = {
    "plugs": [("power", "power", "W"), ("total", "total", "Wh"), ("temperature", "temperature", "C")],
    "motions": [("motion", "motion", "bool"), ("light", "light", "lux"), ("temperature", "temperature", "C")],
    "meteos": [
        ("Temperature", "temperature_c", "C"),
        ("CO2", "co2_ppm", "ppm"),
        ("Humidity", "humidity_pct", "%"),
        ("Noise", "noise_db", "dB"),
        ("Pressure", "pressure_hpa", "hPa"),
        ("AbsolutePressure", "abs_pressure_hpa", "hPa"),
        ("battery_percent", "battery", "%"),
    ],
    "humidities": [("temperature", "temperature", "C"), ("humidity", "humidity", "%"), ("devicePower", "battery", "%")],
    "consumptions": [
        ("total_power", "total_power", "W"),
        ("power1", "power1", "W"),
        ("power2", "power2", "W"),
        ("power3", "power3", "W"),
        ("current1", "current1", "A"),
        ("current2", "current2", "A"),
        ("current3", "current3", "A"),
        ("voltage1", "voltage1", "V"),
        ("voltage2", "voltage2", "V"),
        ("voltage3", "voltage3", "V"),
    ],
}

# payload section -> sensor_type of its readings (doorsWindows takes it from the payload)
SECTION_TYPE = {
    "plugs": "plug",
    "motions": "motion",
    "meteos": "meteo",
    "humidities": "humidity",
    "consumptions": "consumption",
}

# raw room label -> room name; labels not listed pass through
ROOM_NAMES = {
    "Bhroom": "Bathroom",
    "Bdroom": "Bedroom",
    "Livingroom": "Living Room",
    "Office": "Office",
    "Kitchen": "Kitchen",
    "Laundry": "Laundry",
    "Outdoor": "Outdoor",
    "House": "House",
}

# field -> inclusive plausible range; other fields have none
SENSOR_BOUNDS = {
    "temperature_c": (-20.0, 60.0),
    "humidity_pct": (0.0, 100.0),
    "co2_ppm": (300.0, 5000.0),
    "noise_db": (0.0, 140.0),
    "pressure_hpa": (870.0, 1085.0),
    "power": (0.0, 10000.0),
    "battery": (0.0, 100.0),
}

# ---- Fixed values: weather forecasts ----------------------------------------------------------------------------

# kept measurement -> (fact column, inclusive plausible range)
WEATHER_MEASUREMENTS = {
    "PRED_T_2M_ctrl": ("temperature_c", (-50.0, 60.0)),
    "PRED_RELHUM_2M_ctrl": ("humidity_pct", (0.0, 100.0)),
    "PRED_TOT_PREC_ctrl": ("precipitation_mm", (0.0, 500.0)),
    "PRED_GLOB_ctrl": ("radiation_wm2", (0.0, 1500.0)),
}
WEATHER_SENTINEL = -99999.0
WEATHER_MIN_YEAR = 2023
WEATHER_COLUMNS = ["Time", "Value", "Prediction", "Site", "Measurement", "Unit"]

# ---- Fixed values: registry, tariff, operations -----------------------------------------------------------------

# registry table -> silver table
REGISTRY_TABLES = {
    "buildings": "dim_buildings",
    "buildingtype": "dim_building_types",
    "rooms": "dim_rooms",
    "sensors": "dim_sensors",
    "devices": "dim_devices",
    "profilereference": "ref_energy_profiles",
    "profile": "ref_power_snapshots",
    "parameters": "ref_parameters",
    "parameterstype": "ref_parameters_type",
    "dierrors": "log_sensor_errors",
}

# registry tables that hold personal or irrelevant data and are never read
REGISTRY_DENIED = [
    "users",
    "actions",
    "achievements",
    "badges",
    "events",
    "eventsgeneric",
    "eventsignore",
    "categories",
    "userrelationships",
]

# severity -> pattern over the lower-cased message, first match wins, else low
SEVERITY_PATTERNS = [("high", "fatal|crash|down|offline"), ("medium", "fail|error|exception|null")]

# (provider, year, CHF per kWh)
TARIFF_PROVIDER = "OIKEN"
TARIFFS = [(TARIFF_PROVIDER, 2023, "0.3400"), (TARIFF_PROVIDER, 2024, "0.3400"), (TARIFF_PROVIDER, 2025, "0.3400")]

MINUTES_PER_DAY = 1440
EMPTY_MINUTES_STOP = 10

# freshness source -> (seconds below which it is ok, seconds below which it is a warning)
FRESHNESS_SENSORS = (26 * 3600, 7 * 86400)
FRESHNESS_WEATHER = (36 * 3600, 14 * 86400)
FRESHNESS_PREDICTIONS = (48 * 3600, 14 * 86400)

# ---- Keys -------------------------------------------------------------------------------------------------------

READING_KEY = ["apartment", "room", "sensor_type", "field", "timestamp"]
FORECAST_KEY = ["timestamp", "site", "prediction", "prediction_date", "measurement"]

# ---- Silver -----------------------------------------------------------------------------------------------------

READINGS = _schema(
    apartment=_STR, room=_STR, sensor_type=_STR, field=_STR, value=_DBL, unit=_STR, timestamp=_TS, is_outlier=_BOOL
)
FORECASTS = _schema(
    timestamp=_TS,
    site=_STR,
    prediction=_SHORT,
    prediction_date=_DATE,
    measurement=_STR,
    value=_DBL,
    unit=_STR,
    is_outlier=_BOOL,
)
DI_ERRORS = _schema(
    error_id=_INT, sensor_id=_STR, room_id=_INT, apartment=_STR, timestamp=_TS, error_message=_STR, severity=_STR
)
MANIFEST = _schema(filename=_STR, processed_at=_TS)
LOAD_COUNTS = _schema(job=_STR, loaded_at=_TS, stage=_STR, position=_INT, rows=_LONG)
QUARANTINE = _schema(path=_STR, name=_STR, modified=_TS, reason=_STR)

# VARCHAR limits and NOT NULL rules of the silver readings, checked by operators.quality
READING_LENGTHS = {"apartment": 20, "room": 50, "sensor_type": 20, "field": 50, "unit": 10}
READING_REQUIRED = ["apartment", "room", "sensor_type", "field", "timestamp"]

# ---- Gold -------------------------------------------------------------------------------------------------------

DIM_APARTMENT = _schema(
    apartment_key=_LONG,
    apartment_id=_STR,
    name=_STR,
    owner_user_id=_STR,
    building_id=_INT,
    building_name=_STR,
    floor=_INT,
    weather_site_key=_LONG,
)
DIM_ROOM = _schema(room_key=_LONG, room_id=_INT, room_name=_STR, room_type=_STR, apartment_key=_LONG)
DIM_DEVICE = _schema(
    device_key=_LONG,
    device_id=_STR,
    room_key=_LONG,
    device_name=_STR,
    device_type=_STR,
    sensor_type=_STR,
    is_active=_BOOL,
)
DIM_TARIFF = _schema(tariff_key=_LONG, provider=_STR, year=_SHORT, chf_per_kwh=T.DecimalType(6, 4))
DIM_WEATHER_SITE = _schema(site_key=_LONG, site_name=_STR)
PREDICTION_MOTION = _schema(
    predicted_occupied=_DBL,
    actual_occupied=_INT,
    apartment=_STR,
    room=_STR,
    timestamp_rounded=_TS,
    model_name=_STR,
    target=_STR,
    prediction_made_at=_TS,
)
PREDICTION_CONSUMPTION = _schema(
    predicted_power_w=_DBL,
    actual_power_w=_DBL,
    apartment=_STR,
    room=_STR,
    timestamp_rounded=_TS,
    model_name=_STR,
    target=_STR,
    prediction_made_at=_TS,
)
PREDICTION_KEY = ["apartment", "room", "timestamp_rounded", "model_name"]

_MINUTE_KEYS = {"datetime_key": _LONG, "date_key": _INT}
_DEVICE_KEYS = {"device_key": _LONG, "room_key": _LONG, "apartment_key": _LONG}
_ROOM_KEYS = {"room_key": _LONG, "apartment_key": _LONG}
_ENERGY = {**_MINUTE_KEYS, **_DEVICE_KEYS, "power_w": _DBL, "energy_kwh": _DBL, "is_valid": _BOOL}
FACTS = {
    "fact_energy_minute": _schema(**_ENERGY),
    "mv_energy_with_cost": _schema(**_ENERGY, chf_per_kwh=T.DecimalType(6, 4), cost_chf=T.DecimalType(38, 4)),
    "fact_environment_minute": _schema(
        **_MINUTE_KEYS,
        **_ROOM_KEYS,
        temperature_c=_DBL,
        humidity_pct=_DBL,
        co2_ppm=_DBL,
        noise_db=_DBL,
        pressure_hpa=_DBL,
        window_open_flag=_BOOL,
        door_open_flag=_BOOL,
        is_anomaly=_BOOL,
    ),
    "fact_presence_minute": _schema(
        **_MINUTE_KEYS, **_ROOM_KEYS, motion_count=_INT, door_open_flag=_BOOL, presence_flag=_BOOL, presence_prob=_DBL
    ),
    "fact_device_health_day": _schema(
        date_key=_INT,
        **_DEVICE_KEYS,
        error_count=_INT,
        missing_readings=_INT,
        uptime_pct=_DBL,
        battery_min_pct=_DBL,
        battery_avg_pct=_DBL,
    ),
    "fact_weather_hour": _schema(
        **_MINUTE_KEYS,
        site_key=_LONG,
        prediction_date=_DATE,
        temperature_c=_DBL,
        humidity_pct=_DBL,
        precipitation_mm=_DBL,
        radiation_wm2=_DBL,
        n_model_runs=_INT,
    ),
}

# dimension/fact -> child column, parent table, parent column
FOREIGN_KEYS = {
    "dim_room": [("apartment_key", "dim_apartment", "apartment_key")],
    "dim_device": [("room_key", "dim_room", "room_key")],
    "dim_apartment": [("weather_site_key", "dim_weather_site", "site_key")],
    "fact_energy_minute": [
        ("datetime_key", "dim_datetime", "datetime_key"),
        ("date_key", "dim_date", "date_key"),
        ("device_key", "dim_device", "device_key"),
        ("room_key", "dim_room", "room_key"),
        ("apartment_key", "dim_apartment", "apartment_key"),
    ],
    "fact_environment_minute": [
        ("datetime_key", "dim_datetime", "datetime_key"),
        ("date_key", "dim_date", "date_key"),
        ("room_key", "dim_room", "room_key"),
        ("apartment_key", "dim_apartment", "apartment_key"),
    ],
    "fact_presence_minute": [
        ("datetime_key", "dim_datetime", "datetime_key"),
        ("date_key", "dim_date", "date_key"),
        ("room_key", "dim_room", "room_key"),
        ("apartment_key", "dim_apartment", "apartment_key"),
    ],
    "fact_device_health_day": [
        ("date_key", "dim_date", "date_key"),
        ("device_key", "dim_device", "device_key"),
        ("room_key", "dim_room", "room_key"),
        ("apartment_key", "dim_apartment", "apartment_key"),
    ],
    "fact_weather_hour": [
        ("datetime_key", "dim_datetime", "datetime_key"),
        ("date_key", "dim_date", "date_key"),
        ("site_key", "dim_weather_site", "site_key"),
    ],
}

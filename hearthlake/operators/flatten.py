"""Sensor payloads to long readings, with whole-file quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hearthlake.functions import calendar, cleaning
from hearthlake.schemas import READING_KEY, SECTION_FIELDS, SECTION_TYPE

_ROOMS = "map<string,map<string,string>>"
# Every leaf stays text; an unreadable document or a section of the wrong shape lands in _corrupt.
PAYLOAD_SCHEMA = (
    f"datetime string, plugs {_ROOMS}, doorsWindows map<string,string>, motions {_ROOMS}, meteos string, "
    f"humidities {_ROOMS}, consumptions {_ROOMS}, _corrupt string"
)
SECTIONS = ["plugs", "doorsWindows", "motions", "meteos", "humidities", "consumptions"]

# Section columns once parsed: rooms of plain sections, the meteo rooms, and the door and window sensors per room.
_ROOM_COLUMNS = {
    "plugs": "payload.plugs",
    "motions": "payload.motions",
    "meteos": "meteo_rooms",
    "humidities": "payload.humidities",
    "consumptions": "payload.consumptions",
}

# The meteo section may or may not be wrapped in an inner object named meteo.
_METEO_ROOMS = f"""
from_json(
  CASE WHEN map_contains_key(from_json(payload.meteos, 'map<string,string>'), 'meteo')
       THEN from_json(payload.meteos, 'map<string,string>')['meteo'] ELSE payload.meteos END,
  '{_ROOMS}')"""

# Sensors of one room are a list, or a single object standing for a list of one.
_CONTACTS = """
transform(map_entries(payload.doorsWindows), e -> named_struct('room', e.key, 'sensors',
  CASE WHEN startswith(e.value, '[') THEN from_json(e.value, 'array<map<string,string>>')
       ELSE array(from_json(e.value, 'map<string,string>')) END))"""


def _cell(room: str, sensor_type: str, field: str, unit: str, raw: str) -> str:
    return (
        f"named_struct('room', {room}, 'sensor_type', {sensor_type}, 'field', '{field}', 'unit', '{unit}', 'raw', {raw})"
    )


def _room_cells(section: str) -> str:
    """All cells of a room -> object section, whether or not the payload has them."""
    kind = f"'{SECTION_TYPE[section]}'"
    cells = [_cell("e.key", kind, field, unit, f"e.value['{key}']") for key, field, unit in SECTION_FIELDS[section]]
    return f"flatten(transform(map_entries({_ROOM_COLUMNS[section]}), e -> array({', '.join(cells)})))"


def _contact_cells() -> str:
    """Open state of every door and window sensor, and its battery."""
    kind = "lower(coalesce(s['type'], 'door'))"
    opened = "CASE WHEN lower(s['switch']) = 'on' THEN '1' ELSE '0' END"
    cells = [_cell("r.room", kind, "open", "bool", opened), _cell("r.room", kind, "battery", "%", "s['battery']")]
    return f"flatten(transform(contacts, r -> flatten(transform(r.sensors, s -> array({', '.join(cells)})))))"


def _readings() -> str:
    """The cells that hold something, their values read as numbers."""
    per_section = [_contact_cells() if name == "doorsWindows" else _room_cells(name) for name in SECTIONS]
    cells = ", ".join(f"coalesce({cells}, array())" for cells in per_section)
    return f"""transform(filter(concat({cells}), c -> c.raw IS NOT NULL), c -> named_struct(
        'room', c.room, 'sensor_type', c.sensor_type, 'field', c.field, 'unit', c.unit,
        'value', {cleaning.number_sql("c.raw")}))"""


def _bad() -> str:
    """Whether any part of the file cannot be read: the document, a section, a room, a sensor or a value."""
    rooms = [f"exists(map_values({column}), v -> v IS NULL)" for column in _ROOM_COLUMNS.values()]
    # A section that holds null; its keys are listed only when the name occurs although the section is null.
    nulls = [
        f"""CASE WHEN payload.{name} IS NULL AND contains(value, '"{name}"')
            THEN array_contains(json_object_keys(value), '{name}') ELSE false END"""
        for name in SECTIONS
    ]
    sensors = """exists(contacts, r -> r.sensors IS NULL OR exists(r.sensors,
        s -> s IS NULL OR (map_contains_key(s, 'type') AND s['type'] IS NULL)))"""
    parts = [
        "payload IS NULL",
        "payload._corrupt IS NOT NULL",
        "payload.meteos IS NOT NULL AND meteo_rooms IS NULL",
        sensors,
        "exists(readings, r -> r.value IS NULL)",
        *rooms,
        *nulls,
    ]
    return " OR ".join(f"coalesce({part}, false)" for part in parts)


def parse_payloads(raw: DataFrame) -> DataFrame:
    """One row per file with its readings as an array, and ``is_bad`` when any part of it cannot be read.

    ``raw`` has ``path``, ``name``, ``modified``, ``value``, ``apartment``, ``file_ts``. Each payload is parsed once.
    The check needs no shuffle because a file is still one row here. Readings take the payload's own time, else the
    time in the file name, else the file's modification time.
    """
    payload = F.from_json("value", PAYLOAD_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    parsed = (
        raw.withColumn("payload", payload)
        .withColumns({"meteo_rooms": F.expr(_METEO_ROOMS), "contacts": F.expr(_CONTACTS)})
        .withColumn("readings", F.expr(_readings()))
    )
    file_ts = F.coalesce("file_ts", "modified")
    error = F.col("file_error") if "file_error" in raw.columns else F.lit(None).cast("string")
    return parsed.select(
        "path",
        "modified",
        error.alias("file_error"),
        "name",
        "apartment",
        file_ts.alias("file_ts"),
        calendar.parse_sensor_ts(F.col("payload.datetime"), file_ts).alias("timestamp"),
        F.expr(_bad()).alias("is_bad"),
        "readings",
    )


def readings_of(parsed: DataFrame) -> DataFrame:
    """Long readings of the good files, with ``_file_ts`` and ``_path`` to order equal keys by."""
    # A filter on is_bad would be pushed below the projection that parses, and parse every payload again for it.
    good = F.when(~F.col("is_bad"), F.col("readings"))
    long = parsed.select(
        "apartment", "timestamp", F.col("file_ts").alias("_file_ts"), F.col("path").alias("_path"), F.inline(good)
    )
    return long.select(
        "apartment",
        cleaning.room_name(F.col("room")).alias("room"),
        "sensor_type",
        "field",
        "value",
        "unit",
        "timestamp",
        cleaning.is_outlier(F.col("field"), F.col("value")).alias("is_outlier"),
        "_file_ts",
        "_path",
    )


def flatten_sensors(raw: DataFrame) -> DataFrame:
    """Payload files to long readings; files with any unreadable part contribute nothing."""
    return readings_of(parse_payloads(raw))


def observed(parsed: DataFrame, observation: Observation) -> DataFrame:
    """``parsed``, unchanged; once written, the observation holds its files, the good ones, those with readings, and readings."""
    good = ~F.col("is_bad")
    found = F.when(good, F.greatest(F.size("readings"), F.lit(0))).otherwise(0)
    return parsed.observe(
        observation,
        F.count(F.lit(1)).alias("files"),
        F.count_if(good).alias("readable"),
        F.count_if(found > 0).alias("with_readings"),
        F.coalesce(F.sum(found), F.lit(0)).cast("bigint").alias("readings"),
    )


def quarantined(parsed: DataFrame) -> DataFrame:
    """Files rejected as a whole, with the reason; they stay out of the manifest and count as new when they change."""
    reason = F.coalesce("file_error", F.lit("a part of the payload cannot be read")).alias("reason")
    once = F.explode(F.when(F.col("is_bad"), F.array(F.lit(True))))  # not a filter, see readings_of
    return parsed.select("path", "name", "modified", reason, once.alias("is_bad")).drop("is_bad")


def last_reading_order() -> list[Column]:
    """Equal keys: the latest file wins, then the greater path, then the greater value."""
    return [F.desc("_file_ts"), F.desc("_path"), F.desc_nulls_last("value"), F.desc("unit")]


READING_COLUMNS = [*READING_KEY[:4], "value", "unit", "timestamp", "is_outlier"]

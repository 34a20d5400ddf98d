from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hearthlake.operators import flatten
from hearthlake.sources import sensors
from tests.payloads import FULL, plug, write

APARTMENTS = {"alpha": "apt_a", "beta": "apt_b"}
NAME = "31.08.2023 2144_Alpha_received.json"


def parse(spark, root):
    raw = sensors.with_file_keys(sensors.read_sensor_files(spark, str(root)), APARTMENTS)
    return flatten.parse_payloads(raw)


def readings(spark, root):
    return flatten.readings_of(parse(spark, root)).collect()


def test_full_payload_gives_thirty_readings(spark, tmp_path):
    write(tmp_path / "apt" / "2023", NAME, FULL)
    rows = readings(spark, tmp_path)
    assert len(rows) == 30
    by_type = Counter(r.sensor_type for r in rows)
    assert by_type == {
        "plug": 3, "door": 2, "window": 2, "motion": 3, "meteo": 7, "humidity": 3, "consumption": 10,
    }
    assert [r.field for r in rows if r.is_outlier] == ["temperature_c"]
    assert {r.apartment for r in rows} == {"apt_a"}
    assert {r.timestamp for r in rows} == {datetime(2023, 8, 31, 21, 44)}
    named = {(r.room, r.sensor_type, r.field): (r.value, r.unit) for r in rows}
    assert named["Office", "plug", "total"] == (1500.0, "Wh")
    assert named["Bedroom", "door", "open"] == (1.0, "bool")
    assert named["Bedroom", "door", "battery"] == (90.0, "%")
    assert named["Bedroom", "window", "open"] == (0.0, "bool")
    assert named["Kitchen", "window", "open"] == (1.0, "bool")
    assert named["Bathroom", "motion", "motion"] == (1.0, "bool")
    assert named["Living Room", "meteo", "abs_pressure_hpa"] == (955.0, "hPa")
    assert named["Laundry", "humidity", "battery"] == (77.0, "%")
    assert named["House", "consumption", "voltage3"] == (232.0, "V")


def test_gzip_is_read_alike(spark, tmp_path):
    write(tmp_path, NAME, FULL, compress=True)
    assert len(readings(spark, tmp_path)) == 30


def test_meteos_without_inner_object_unknown_room_missing_sections(spark, tmp_path):
    write(tmp_path, NAME, {"datetime": "1.9.2023 7:05", "meteos": {"Attic": {"Temperature": 20, "CO2": None}}})
    (row,) = readings(spark, tmp_path)
    assert (row.room, row.field, row.value) == ("Attic", "temperature_c", 20.0)
    assert row.timestamp == datetime(2023, 9, 1, 7, 5)


@pytest.mark.parametrize("text", ["31.02.2023 10:00", "2023-08-31 21:44", "", "now", "1.9.23 7:05"])
def test_unreadable_time_falls_back_to_the_file_name(spark, tmp_path, text):
    write(tmp_path, NAME, plug(1, at=text))
    assert {r.timestamp for r in readings(spark, tmp_path)} == {datetime(2023, 8, 31, 21, 44)}


def test_door_defaults(spark, tmp_path):
    write(tmp_path, NAME, {"doorsWindows": {"Office": [{}, {"type": "WINDOW", "switch": None}], "Kitchen": []}})
    rows = sorted((r.sensor_type, r.field, r.value) for r in readings(spark, tmp_path))
    assert rows == [("door", "open", 0.0), ("window", "open", 0.0)]


def test_values_are_coerced_like_float(spark, tmp_path):
    cells = {"power": " 12.5 ", "total": True, "temperature": "1e2"}
    write(tmp_path, NAME, {"plugs": {"Office": cells}, "motions": {"Office": {"motion": False, "light": "inf"}}})
    assert {r.field: r.value for r in readings(spark, tmp_path) if r.sensor_type == "plug"} == {
        "power": 12.5, "total": 1.0, "temperature": 100.0,
    }
    assert {r.field: r.value for r in readings(spark, tmp_path) if r.sensor_type == "motion"} == {
        "motion": 0.0, "light": float("inf"),
    }


def test_nan_is_an_outlier_and_bounds_are_inclusive(spark, tmp_path):
    meteo = '{"meteos": {"meteo": {"A": {"Temperature": NaN, "Humidity": 100, "Noise": 140.001, "CO2": 300}}}}'
    write(tmp_path, NAME, meteo)
    flags = {r.field: r.is_outlier for r in readings(spark, tmp_path)}
    assert flags == {"temperature_c": True, "humidity_pct": False, "noise_db": True, "co2_ppm": False}


@pytest.mark.parametrize(
    "payload",
    [
        "{broken",
        "",
        "[]",
        '"text"',
        {"plugs": None},
        {"plugs": [1]},
        {"plugs": {"Office": None}},
        {"plugs": {"Office": 3}},
        {"plugs": {"Office": {"power": "n/a"}}},
        {"plugs": {"Office": {"power": ""}}},
        {"plugs": {"Office": {"power": [1]}}},
        {"plugs": {"Office": {"power": "12d"}}},
        {"meteos": None},
        {"meteos": {"meteo": None}},
        {"meteos": {"Office": 5}},
        {"doorsWindows": {"Office": None}},
        {"doorsWindows": {"Office": "on"}},
        {"doorsWindows": {"Office": [None]}},
        {"doorsWindows": {"Office": [{"type": None}]}},
        {"doorsWindows": {"Office": [{"battery": "low"}]}},
        {"consumptions": {"House": {"power1": {}}}},
    ],
    ids=str,
)
def test_any_bad_part_rejects_the_whole_file(spark, tmp_path, payload):
    write(tmp_path, NAME, payload)
    good = "31.08.2023 2145_Beta_received.json"
    write(tmp_path, good, plug(7, at="31.08.2023 21:45"))
    if isinstance(payload, dict):  # the rest of a bad file does not get through either
        write(tmp_path, NAME, {**plug(5), **{k: v for k, v in payload.items() if k != "plugs"}, **payload})
    parsed = parse(spark, tmp_path).cache()
    rejected = [r.name for r in flatten.quarantined(parsed).collect()]
    # an empty file yields no row in a whole-text scan, so there is nothing to quarantine
    assert rejected == ([NAME] if payload != "" else rejected)
    assert {r.apartment for r in flatten.readings_of(parsed).collect()} == {"apt_b"}
    parsed.unpersist()


def test_each_payload_is_parsed_once(spark, tmp_path):
    write(tmp_path, NAME, FULL)
    raw = sensors.with_file_keys(sensors.read_sensor_files(spark, str(tmp_path)), APARTMENTS)
    for df in (flatten.flatten_sensors(raw), flatten.quarantined(flatten.parse_payloads(raw))):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(StructField(datetime") == 1
        assert "Filter" not in plan


def test_same_key_in_two_files_keeps_the_latest(spark, tmp_path):
    from hearthlake.operators import dedupe
    from hearthlake.schemas import READING_KEY

    write(tmp_path, "31.08.2023 2144_Alpha_received.json", plug(1))
    write(tmp_path, "31.08.2023 2150_Alpha_received.json", plug(2))
    rows = flatten.readings_of(parse(spark, tmp_path))
    (kept,) = dedupe.one_per_key(rows, READING_KEY, flatten.last_reading_order()).collect()
    assert kept.value == 2.0


def test_file_name_keys(spark):
    names = [
        ("31.08.2023 2144_Alpha_received.json", "apt_a", datetime(2023, 8, 31, 21, 44)),
        ("1.9.2023 0705_BETA_received.json.gz", "apt_b", datetime(2023, 9, 1, 7, 5)),
        ("31.02.2023 0705_Alpha_received.json", "apt_a", None),
        ("something_else.json", None, None),
    ]
    df = spark.createDataFrame([(n,) for n, _, _ in names], "name string")
    rows = {r.name: (r.apartment, r.file_ts) for r in sensors.with_file_keys(df, APARTMENTS).collect()}
    assert rows == {n: (a, t) for n, a, t in names}


def test_names_with_blanks_and_signs_survive_the_scan(spark, tmp_path):
    write(tmp_path, "31.08.2023 2144_Alpha+100%_received.json", plug(1))
    (row,) = sensors.read_sensor_files(spark, str(tmp_path)).select("name").collect()
    assert row.name == "31.08.2023 2144_Alpha+100%_received.json"


def test_bronze_landing_keeps_every_payload(spark, tmp_path):
    for minute in range(10, 20):
        write(tmp_path / "in", f"31.08.2023 21{minute}_Alpha_received.json", plug(minute))
    raw = sensors.with_file_keys(sensors.read_sensor_files(spark, str(tmp_path / "in")), APARTMENTS)
    sensors.land_payloads(raw, str(tmp_path / "bronze"))
    landed = sensors.read_bronze(spark, str(tmp_path / "bronze"))
    assert landed.count() == 10
    assert [tuple(r) for r in landed.select("apartment", F.col("period").cast("string")).distinct().collect()] == [
        ("apt_a", "2023-08-31")
    ]

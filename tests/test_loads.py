"""Loads by lots, the manifest by days, and the counts that loads store."""

import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hearthlake import schemas
from hearthlake.operators import forecasts
from hearthlake.plans import lake as lakes
from hearthlake.sources import files, listing, sensors, tables, weather
from hearthlake.streaming import ingest
from tests.payloads import file_name, plug, write

NOW = datetime(2024, 3, 1, 12)
AT = datetime(2024, 1, 1, 10)


def put(root, at, value=1, name="Alpha"):
    return write(root, file_name(at, name), plug(value, at=f"{at:%d.%m.%Y %H:%M}"))


def spoil(folder):
    """Make every Parquet file below a folder unreadable."""
    spoilt = list(folder.glob("*.parquet"))
    for path in spoilt:
        path.write_bytes(b"no parquet")
        (path.parent / f".{path.name}.crc").unlink(missing_ok=True)
    return len(spoilt)


def test_a_tick_reads_the_touched_periods_of_the_manifest_only(lake, tmp_path):
    for day in range(3):
        put(tmp_path / "old", AT + timedelta(days=day))
    lakes.load_new_sensors(lake, str(tmp_path / "old"), NOW)
    stored = tmp_path / "lake" / lakes.SENSOR_MANIFEST
    assert sorted(p.name for p in stored.iterdir() if p.is_dir()) == [f"period=2024-01-0{d}" for d in (1, 2, 3)]
    assert spoil(stored / "period=2024-01-01") and spoil(stored / "period=2024-01-02")
    put(tmp_path / "new", AT + timedelta(days=2))
    put(tmp_path / "new", AT + timedelta(days=2, minutes=1))
    put(tmp_path / "new", AT + timedelta(days=3))
    lakes.load_new_sensors(lake, str(tmp_path / "new"), NOW)
    days = lake.manifest().filter(F.col("period") >= datetime(2024, 1, 3))
    assert sorted(r.filename for r in days.collect()) == sorted(
        file_name(AT + delta, "Alpha") for delta in (timedelta(days=2), timedelta(days=2, minutes=1), timedelta(days=3))
    )


def test_names_without_a_day_are_marked_once(lake, tmp_path):
    frame = lake.spark.createDataFrame([("x.json",), ("Pred_2024-13-01.csv",), ("x.json.gz",)], "name string")
    for _ in range(2):
        lakes._mark_done(lake, frame, lakes.SENSOR_MANIFEST, NOW)
    assert sorted((r.filename, r.period) for r in lake.manifest().collect()) == [("Pred_2024-13-01.csv", None), ("x.json", None)]
    lakes._mark_done(lake, frame.filter("false"), lakes.WEATHER_MANIFEST, NOW)
    assert lake.manifest(lakes.WEATHER_MANIFEST).count() == 0


def test_crowded_periods_are_packed(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "name string, period date"
    for n in range(9):
        rows = [(f"a{n}", AT.date()), (f"b{n}", None)] + ([("c", NOW.date())] if n == 0 else [])
        tables.append_by_period(spark.createDataFrame(rows, schema).coalesce(1), path, "period", most=3)
    files_of = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "t").iterdir() if p.is_dir()}
    assert set(files_of) == {"period=2024-01-01", "period=2024-03-01", "period=__HIVE_DEFAULT_PARTITION__"}
    assert max(files_of.values()) <= 4
    names = [r.name for r in spark.read.schema(schema).parquet(path).collect()]
    assert sorted(names) == sorted([f"{c}{n}" for c in "ab" for n in range(9)] + ["c"])


def test_lots_cover_every_file_once(spark, tmp_path):
    start = time.time() - 1000
    for n in range(20):
        path = put(tmp_path, AT + timedelta(minutes=n))
        stamp = start + (0 if n < 5 else n)  # five files of one time
        os.utime(path, (stamp, stamp))
    opened = files.open_files(spark, str(tmp_path), sensors.PAYLOAD_GLOB)
    listed = listing.described(opened)
    ranges = listing.lots(listed, 4)
    lots = [sorted(r.path for r in opened.filter(listing.within(m)).select("path").collect()) for m in ranges]
    assert sorted(p for lot in lots for p in lot) == sorted(r.path for r in listed.collect())
    assert len(lots) >= 4 and max(map(len, lots)) <= 6
    assert listing.lots(listed.filter("false"), 4) == []


def test_files_outside_a_lot_are_not_opened(spark, tmp_path):
    for n in range(4):
        path = put(tmp_path, AT + timedelta(minutes=n), n)
        os.utime(path, (1.7e9 + n, 1.7e9 + n))
    opened = files.open_files(spark, str(tmp_path), sensors.PAYLOAD_GLOB)
    first, second = listing.lots(listing.described(opened), 2)
    for n in (2, 3):  # listed, but gone: opening one would fail
        (tmp_path / file_name(AT + timedelta(minutes=n), "Alpha")).unlink()
    assert files.texts(opened.filter(listing.within(first))).filter("value IS NOT NULL").count() == 2
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        files.texts(opened.filter(listing.within(second))).collect()


def test_a_lot_beside_known_files(lake, tmp_path):
    root = tmp_path / "in"
    for n in range(0, 10, 2):
        put(root, AT + timedelta(minutes=n), n)
    assert lakes.load_new_sensors(lake, str(root), NOW)
    for n in range(1, 10, 2):
        put(root, AT + timedelta(minutes=n), n)
    for n in range(10):  # old and new files interleave
        stamp = 1.7e9 + n
        os.utime(root / file_name(AT + timedelta(minutes=n), "Alpha"), (stamp, stamp))
    assert lakes.load_new_sensors(lake, str(root), NOW, lot=2)
    assert sorted(r.value for r in lake.readings().collect()) == [float(n) for n in range(10)]
    counts = lake.load_counts().filter("stage = 'files'").collect()
    assert sum(r.rows for r in counts) == 10  # no known file was parsed again


def counted(lake, job):
    return [(r.stage, r.rows) for r in lake.load_counts().filter(F.col("job") == job).orderBy("loaded_at", "position").collect()]


def test_sensor_loads_store_their_counts(lake, tmp_path):
    root = tmp_path / "in"
    put(root, AT)
    put(root, AT + timedelta(minutes=1), "n/a")
    write(root, file_name(AT + timedelta(minutes=2), "Alpha"), {"datetime": "01.01.2024 10:02"})
    lakes.load_sensors(lake, sensors.read_sensor_files(lake.spark, str(root)), NOW)
    expected = [("files", 3), ("readable", 2), ("with_readings", 1), ("readings", 1)]
    assert counted(lake, "load_sensors") == expected
    stream = sensors.stream_sensor_files(lake.spark, str(root))
    ingest.ingest_sensors(lake, stream, every=None, refresh=False, clock=lambda: NOW + timedelta(hours=1)).awaitTermination()
    assert counted(lake, "load_sensors") == expected * 2


def test_weather_loads_store_the_stage_counts(lake, tmp_path):
    lines = ["Time,Value,Prediction,Site,Measurement,Unit"]
    for time_, value, kind in [
        ("2024-01-01 00:00:00", 1, "PRED_T_2M_ctrl"),
        ("2024-01-01 01:00:00", -99999.0, "PRED_T_2M_ctrl"),
        ("2024-01-01 02:00:00", 1, "PRED_OTHER"),
        ("2001-01-01 02:00:00", 1, "PRED_T_2M_ctrl"),
        ("never", 1, "PRED_T_2M_ctrl"),
    ]:
        lines.append(f"{time_},{value},00,Sion,{kind},C")
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "Pred_2024-01-01.csv").write_text("\n".join(lines))
    raw = weather.read_weather_files(lake.spark, str(tmp_path / "w"))
    lakes.load_weather(lake, raw, NOW)
    stages = counted(lake, "load_weather")
    assert stages == list(forecasts.stage_counts(raw).first().asDict().items())
    assert [rows for _, rows in stages] == [5, 4, 3, 2, 1]
    assert lake.load_counts().schema == schemas.LOAD_COUNTS


def test_a_load_of_nothing(lake, tmp_path):
    (tmp_path / "none").mkdir()
    lakes.load_sensors(lake, sensors.read_sensor_files(lake.spark, str(tmp_path / "none")), NOW)
    lakes.load_weather(lake, weather.read_weather_files(lake.spark, str(tmp_path / "none")), NOW)
    assert all(r.rows == 0 for r in lake.load_counts().collect())

import json
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hearthlake import schemas
from hearthlake.operators import flatten
from hearthlake.plans import lake as lakes
from hearthlake.sources import listing, sensors, tables, weather
from hearthlake.streaming import ingest
from tests.payloads import FULL, file_name, plug, write

NOW = datetime(2024, 1, 5, 12)
START = datetime(2024, 1, 1, 23, 58)


def put_files(root, n=6, apartments=("Alpha", "Beta"), start=START):
    """One file per apartment and minute, across midnight."""
    for i in range(n):
        at = start + timedelta(minutes=i)
        for a in apartments:
            payload = json.loads(json.dumps(FULL))
            payload["datetime"] = f"{at:%d.%m.%Y %H:%M}"
            payload["plugs"]["Office"]["power"] = 10.0 + i
            write(root, file_name(at, a), payload, compress=i % 2 == 1)


def raw(lake, root):
    return sensors.read_sensor_files(lake.spark, str(root))


def rows(df, *drop):
    return sorted(map(str, df.drop(*drop).collect()))


def natural_energy(lake):
    device = lake.gold("dim_device").select("device_key", "device_id")
    return rows(lake.gold("mv_energy_with_cost").join(device, "device_key"), "device_key", "room_key", "apartment_key")


def test_load_twice_changes_nothing(lake, tmp_path):
    put_files(tmp_path / "in")
    touched = lakes.as_list(lakes.load_sensors(lake, raw(lake, tmp_path / "in"), NOW))
    assert sorted(touched) == [date(2024, 1, 1), date(2024, 1, 2)]
    before, done = rows(lake.readings()), rows(lake.manifest())
    assert len(before) == 6 * 2 * 30 and len(done) == 12
    lakes.load_sensors(lake, raw(lake, tmp_path / "in"), NOW + timedelta(hours=1))
    assert (rows(lake.readings()), rows(lake.manifest())) == (before, done)


def test_bad_files_are_quarantined_and_tried_again(lake, tmp_path):
    put_files(tmp_path / "in", n=1)
    bad = write(tmp_path / "in", file_name(START + timedelta(minutes=9), "Alpha"), plug("n/a"))
    write(tmp_path / "in", "01.01.2024 2358_Nobody_received.json", plug(1))
    lakes.load_sensors(lake, raw(lake, tmp_path / "in"), NOW)
    listed = listing.list_files(lake.spark, str(tmp_path / "in"))
    names = [r.name for r in listing.new_files(listed, lake.manifest()).collect()]
    assert sorted(names) == sorted([bad.name, "01.01.2024 2358_Nobody_received.json"])
    assert [r.name for r in lake.spark.read.parquet(lake.path(lakes.QUARANTINE)).collect()] == [bad.name]


def test_refresh_of_touched_periods_equals_full_rebuild(lake, tmp_path):
    put_files(tmp_path / "a", n=3)
    put_files(tmp_path / "b", n=3, start=START + timedelta(minutes=1, days=1))
    for part in ("a", "b"):
        touched = lakes.as_list(lakes.load_sensors(lake, raw(lake, tmp_path / part), NOW))
        lakes.refresh_gold(lake, touched, weather=False)
    step_by_step = {n: rows(lake.gold(n)) for n in (*lakes.MINUTE_FACTS, "fact_device_health_day", "mv_energy_with_cost")}
    keys = rows(lake.gold("dim_device"))
    lakes.refresh_gold(lake, weather=False)
    assert {n: rows(lake.gold(n)) for n in step_by_step} == step_by_step
    assert rows(lake.gold("dim_device")) == keys
    assert lake.gold("dim_datetime").count() == 6
    assert lake.gold("fact_energy_minute").count() == 6 * 2 * 2


def test_stream_equals_batch(lake, spark, tmp_path):
    put_files(tmp_path / "in")
    batch = lakes.Lake(spark, str(tmp_path / "batch"), lake.apartment_map)
    lakes.load_sensors(batch, raw(batch, tmp_path / "in"), NOW)
    lakes.refresh_gold(batch, weather=False)

    def catch_up():
        stream = sensors.stream_sensor_files(spark, str(tmp_path / "in"), max_files=5)
        ingest.ingest_sensors(lake, stream, every=None, clock=lambda: NOW).awaitTermination()

    catch_up()
    assert rows(lake.readings()) == rows(batch.readings())
    assert natural_energy(lake) == natural_energy(batch)
    before = natural_energy(lake)
    put_files(tmp_path / "in", n=1, start=START - timedelta(days=3))  # late files
    catch_up()
    assert set(before) < set(natural_energy(lake))
    assert lake.readings().count() == 7 * 2 * 30


def test_backfill_keeps_the_oldest_and_verifies(lake, tmp_path):
    write(tmp_path / "old", file_name(START, "Alpha"), plug(1, at="01.01.2024 10:00"))
    write(tmp_path / "new", file_name(START, "Alpha"), plug(2, at="01.01.2024 10:00"))
    write(tmp_path / "new", file_name(START + timedelta(minutes=1), "Alpha"), plug(3, at="01.01.2024 11:00"))
    write(tmp_path / "new", file_name(START + timedelta(minutes=2), "Alpha"), plug(4, at="01.01.2024 11:00"))
    lakes.backfill(lake, raw(lake, tmp_path / "old"), NOW)
    for _ in range(2):
        lakes.backfill(lake, raw(lake, tmp_path / "new"), NOW)
        assert sorted(r.value for r in lake.readings().collect()) == [1.0, 3.0]
    assert lake.manifest().count() == 3


def test_duplicates_abort_with_samples(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    with pytest.raises(lakes.DuplicateKeysError, match="'k': 'a', 'n': 2"):
        lakes.verify_unique(df, ["k"])


def weather_file(root, name, values):
    lines = ["Time,Value,Prediction,Site,Measurement,Unit"]
    lines += [f"2024-01-0{d} 10:00:00+00:00,{v},{r:02d},Sion,PRED_T_2M_ctrl,C" for d, v, r in values]
    root.mkdir(parents=True, exist_ok=True)
    (root / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_weather_stream(lake, spark, tmp_path):
    weather_file(tmp_path / "w", "Pred_2024-01-01.csv", [(1, 5, 0), (1, 7, 1), (1, 7, 1), (2, 9, 0)])
    weather_file(tmp_path / "w", "Pred_2024-01-02.csv", [(2, 1, 0)])

    def catch_up():
        stream = weather.stream_weather_files(spark, str(tmp_path / "w"))
        ingest.ingest_weather(lake, stream, every=None, clock=lambda: NOW).awaitTermination()

    catch_up()
    hours = lake.gold("fact_weather_hour")
    got = {(r.date_key, r.prediction_date.day): (r.temperature_c, r.n_model_runs) for r in hours.collect()}
    assert got == {(20240101, 1): (6.0, 2), (20240102, 1): (9.0, 1), (20240102, 2): (1.0, 1)}
    assert sorted(r.filename for r in lake.manifest(lakes.WEATHER_MANIFEST).collect()) == [
        "Pred_2024-01-01.csv", "Pred_2024-01-02.csv",
    ]
    weather_file(tmp_path / "w", "Pred_2024-01-03.csv", [(3, 4, 0)])
    catch_up()
    assert lake.gold("fact_weather_hour").count() == 4
    assert lake.gold("dim_weather_site").count() == 2


def reading_files(spark, path, *batches):
    for rows_ in batches:
        df = spark.createDataFrame(
            [("a", "r", "plug", "power", v, "W", t, False) for v, t in rows_], schemas.READINGS
        )
        df.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schemas.READINGS).option("maxFilesPerTrigger", 1).parquet(path)


def drain(stream, out):
    query = stream.writeStream.option("checkpointLocation", out + "_c").trigger(availableNow=True)
    query.format("parquet").outputMode("append").start(out).awaitTermination()
    return stream.sparkSession.read.parquet(out)


def test_stream_drops_repeated_keys(spark, tmp_path):
    at = datetime(2024, 1, 1, 10)
    stream = reading_files(spark, str(tmp_path / "r"), [(1.0, at), (1.0, at)], [(1.0, at), (2.0, at + timedelta(minutes=1))])
    unique = drain(ingest.unique_readings(stream), str(tmp_path / "out"))
    assert sorted(r.value for r in unique.collect()) == [1.0, 2.0]


@pytest.mark.parametrize("kind", ["energy", "environment", "presence"])
def test_stream_minutes_are_the_batch_minutes(spark, tmp_path, kind):
    at = datetime(2024, 1, 1, 10)
    schema = schemas.READINGS
    cells = {"energy": ("plug", "power"), "environment": ("meteo", "noise_db"), "presence": ("motion", "motion")}[kind]
    data = [
        ("a", "r", *cells, float(i % 2), "u", at + timedelta(seconds=30 * i), False) for i in range(80)
    ]
    df = spark.createDataFrame(data, schema)
    df.coalesce(1).write.parquet(str(tmp_path / "r"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "r"))
    out = drain(ingest.minute_aggregate(stream, kind, "5 minutes"), str(tmp_path / "out"))
    batch = ingest.MINUTES[kind](df).filter(F.col("minute") < F.lit(at + timedelta(minutes=34)))
    assert rows(out.select(batch.columns)) == rows(batch)


@pytest.mark.parametrize("kind", ["energy", "environment", "presence"])
def test_published_minutes_take_readings_of_any_age(spark, tmp_path, kind):
    """Files an hour behind the newest reading, one per batch, give the minutes of all readings at once."""
    at = datetime(2024, 1, 1, 10)
    cells = {"energy": ("plug", "power"), "environment": ("meteo", "noise_db"), "presence": ("motion", "motion")}[kind]
    hours = [
        [("a", "r", *cells, float(i % 2), "u", at + timedelta(hours=h, seconds=20 * i + h), i == 4) for i in range(12)]
        for h in (2, 1, 0, 1)
    ]
    hours[3] = [(*r[:6], r[6] + timedelta(seconds=5), False) for r in hours[3]]
    path, seen = str(tmp_path / "r"), set()
    for k, data in enumerate(hours):
        spark.createDataFrame(data, schemas.READINGS).coalesce(1).write.mode("append").parquet(path)
        for f in set((tmp_path / "r").glob("part-*")) - seen:
            os.utime(f, (1_700_000_000 + 60 * k,) * 2)
            seen.add(f)
    stream = spark.readStream.schema(schemas.READINGS).option("maxFilesPerTrigger", 1).parquet(path)
    out = str(tmp_path / "out")
    ingest.publish_minutes(stream, kind, out).awaitTermination()
    assert len(list((tmp_path / "out" / "batches").glob("batch=*"))) == 4
    want = ingest.MINUTES[kind](spark.read.parquet(path))
    assert rows(ingest.published_minutes(spark, kind, out).select(want.columns)) == rows(want)
    for _ in range(2):
        ingest.compact_minutes(spark, kind, out)
        assert list((tmp_path / "out" / "batches").glob("batch=*")) == []
        assert rows(ingest.published_minutes(spark, kind, out).select(want.columns)) == rows(want)


def one_file_per_batch(spark, folder, *batches):
    """A stream that takes the batches in order, one file each."""
    seen = set()
    for k, data in enumerate(batches):
        spark.createDataFrame(data, schemas.READINGS).coalesce(1).write.mode("append").parquet(str(folder))
        for f in set(folder.glob("part-*")) - seen:
            os.utime(f, (1_700_000_000 + 60 * k,) * 2)
            seen.add(f)
    return spark.readStream.schema(schemas.READINGS).option("maxFilesPerTrigger", 1).parquet(str(folder))


def motion(value, at, room="r"):
    return ("a", room, "motion", "motion", float(value), "bool", at, False)


def test_published_minutes_stay_few_folders_and_count_a_key_once(spark, tmp_path):
    at = datetime(2024, 1, 1, 23, 59)
    batches = [[motion(1, at + timedelta(seconds=40 * k)), motion(k % 2, at)] for k in range(7)]
    out = str(tmp_path / "out")
    stream = one_file_per_batch(spark, tmp_path / "r", *batches)
    ingest.publish_minutes(stream, "presence", out, most=2).awaitTermination()
    assert len(list((tmp_path / "out" / "batches").glob("batch=*"))) <= 2
    # the later value of a key counts: batch 6 has 0 for the first one
    last = spark.createDataFrame([motion(1, at + timedelta(seconds=40 * k)) for k in range(1, 7)] + [motion(0, at)], schemas.READINGS)
    want = ingest.MINUTES["presence"](last)
    assert rows(ingest.published_minutes(spark, "presence", out).select(want.columns)) == rows(want)


def test_late_readings_are_kept_apart_and_counted(spark, tmp_path):
    at = datetime(2024, 1, 1, 10)
    hour = timedelta(hours=1)
    batches = [
        [motion(1, at), motion(1, at), motion(0, at + 2 * hour)],
        [motion(1, at + hour), motion(0, at + 2 * hour), motion(1, at), motion(1, at + hour, "s")],
        [motion(1, at + 5 * hour), motion(1, at + hour)],
        [motion(1, at + hour), motion(1, at + 5 * hour)],
    ]
    out = str(tmp_path / "out")
    ingest.split_readings(one_file_per_batch(spark, tmp_path / "r", *batches), out, "90 minutes").awaitTermination()
    got = {n: ingest.split_table(spark, out, n) for n in ("unique", "late", "counts")}
    assert sorted((r.room, r.timestamp - at) for r in got["unique"].collect()) == [
        ("r", 0 * hour), ("r", hour), ("r", 2 * hour), ("r", 5 * hour), ("s", hour),
    ]
    assert sorted((r.timestamp - at, r.batch) for r in got["late"].collect()) == [(0 * hour, 1), (hour, 3)]
    totals = [sum(r[n] for r in got["counts"].collect()) for n in ("rows", "unique", "late", "duplicates")]
    assert totals == [11, 5, 2, 4]


def test_readings_survive_any_batching(lake, spark, tmp_path):
    """The same files, loaded at once or one by one, give the same table."""
    put_files(tmp_path / "in", n=3, apartments=("Alpha",))
    one = lakes.Lake(spark, str(tmp_path / "one"), lake.apartment_map)
    lakes.load_sensors(one, raw(one, tmp_path / "in"), NOW)
    for path in sorted((tmp_path / "in").iterdir()):
        lakes.load_sensors(lake, sensors.read_sensor_files(spark, str(path)), NOW)
    assert rows(lake.readings()) == rows(one.readings())


def test_registry_errors_reach_the_health_fact(lake, spark, tmp_path):
    put_files(tmp_path / "in", n=1)
    lakes.load_sensors(lake, raw(lake, tmp_path / "in"), NOW)
    at = START
    named = spark.createDataFrame([(1, "apt_a_Bedroom_door", None, None, at, "x", "low")], schemas.DI_ERRORS)
    tables.truncate_and_load(named, lake.path(lakes.DI_ERRORS))
    gold = lakes.refresh_gold(lake, weather=False)
    devices = gold["dim_device"].select("device_key", "device_id")
    counts = gold["fact_device_health_day"].join(devices, "device_key").filter("error_count > 0")
    assert [(r.device_id, r.error_count) for r in counts.collect()] == [("apt_a_Bedroom_door", 1)]


def test_random_payloads_round_trip(spark):
    """Readings -> payload JSON -> readings, for generated values."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    number = st.floats(allow_nan=False, allow_infinity=False, width=64) | st.integers(-(10**6), 10**6)
    sections = st.fixed_dictionaries(
        {},
        optional={
            name: st.dictionaries(
                st.sampled_from(["Office", "Attic", "Kitchen"]),
                st.dictionaries(st.sampled_from([k for k, _, _ in fields]), st.none() | number),
            )
            for name, fields in schemas.SECTION_FIELDS.items()
            if name != "meteos"
        },
    )

    @settings(max_examples=3, deadline=None)
    @given(st.lists(sections, min_size=1, max_size=30))
    def check(payloads):
        expected = []
        for i, payload in enumerate(payloads):
            for section, rooms in payload.items():
                for room, cells in rooms.items():
                    for key, field, unit in schemas.SECTION_FIELDS[section]:
                        if cells.get(key) is not None:
                            kind = schemas.SECTION_TYPE[section]
                            expected.append((i, room, kind, field, unit, float(cells[key])))
        text = [(f"f{i}", f"f{i}", NOW, json.dumps(p), "a", NOW) for i, p in enumerate(payloads)]
        schema = "path string, name string, modified timestamp, value string, apartment string, file_ts timestamp"
        got = flatten.flatten_sensors(spark.createDataFrame(text, schema))
        found = [(int(r._path[1:]), r.room, r.sensor_type, r.field, r.unit, r.value) for r in got.collect()]
        assert sorted(found) == sorted(expected)

    check()

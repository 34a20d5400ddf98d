"""Files that cannot be read, files that come late, and refreshes under awkward conditions."""

import gzip
import os
import pathlib
import threading
import time
from datetime import datetime, timedelta

import pytest

from hearthlake import session
from hearthlake.plans import lake as lakes
from hearthlake.sources import files, locks, sensors, tables, weather
from hearthlake.streaming import ingest
from tests.payloads import file_name, plug, write
from tests.test_lake import weather_file

NOW = datetime(2024, 1, 5, 12)
AT = datetime(2024, 1, 1, 10)
DAY = 86400


def cut(path):
    path.write_bytes(path.read_bytes()[: path.stat().st_size // 2])


def test_decode():
    packed = gzip.compress(b"one") + gzip.compress(b" two")
    assert files.decode("a.json.gz", packed) == ("one two", None)
    assert files.decode("a.json.gz", packed[:-3])[0] is None
    assert files.decode("a.json.gz", b"plain")[0] is None
    assert files.decode("a.json", "\ufeffé".encode()) == ("é", None)
    assert files.decode("a.json", b"\xff")[0] is None
    assert files.decode("a.json", b"") == ("", None)


def test_late_files_are_loaded_by_the_stream(lake, spark, tmp_path):
    for n, days in enumerate((0, 5, 30)):
        path = write(tmp_path / "in", file_name(AT + timedelta(minutes=n), "Alpha"), plug(n, at=f"01.01.2024 10:0{n}"))
        old = time.time() - days * DAY
        os.utime(path, (old, old))
    stream = sensors.stream_sensor_files(spark, str(tmp_path / "in"), max_files=1)
    ingest.ingest_sensors(lake, stream, every=None, refresh=False, clock=lambda: NOW).awaitTermination()
    assert sorted(r.value for r in lake.readings().collect()) == [0.0, 1.0, 2.0]


def test_a_cut_payload_is_quarantined_beside_good_ones(lake, spark, tmp_path):
    write(tmp_path / "in", file_name(AT, "Alpha"), plug(1), compress=True)
    bad = write(tmp_path / "in", file_name(AT + timedelta(minutes=1), "Alpha"), plug(2), compress=True)
    cut(bad)
    for _ in range(2):
        lakes.load_sensors(lake, sensors.read_sensor_files(spark, str(tmp_path / "in")), NOW)
        assert lake.readings().count() == 1 and lake.manifest().count() == 1
        assert [(r.name, r.reason) for r in lake.quarantine().collect()] == [(bad.name, "truncated gzip file")]


def test_catching_up_takes_what_is_new_or_mended(lake, tmp_path):
    root = tmp_path / "in"
    write(root, file_name(AT, "Alpha"), plug(1, at="01.01.2024 10:00"))
    bad = write(root, file_name(AT + timedelta(minutes=1), "Alpha"), plug("n/a"))
    assert len(lakes.load_new_sensors(lake, str(root), NOW)) == 1
    assert lakes.load_new_sensors(lake, str(root), NOW) == []
    write(root, bad.name, plug(2, at="01.01.2024 10:01"))
    os.utime(bad, (time.time() + 60, time.time() + 60))
    write(root, file_name(AT + timedelta(days=3), "Alpha"), plug(3, at="04.01.2024 10:00"))
    assert len(lakes.load_new_sensors(lake, str(root), NOW, lot=1)) == 2
    assert sorted(r.value for r in lake.readings().collect()) == [1.0, 2.0, 3.0]


def test_forecast_files_are_taken_whole_or_not_at_all(lake, spark, tmp_path):
    root = tmp_path / "w"
    weather_file(root, "Pred_2024-01-01.csv", [(1, 5, 0)])
    weather_file(root, "Pred_2024-01-02.csv", [(d, v, 0) for d in (1, 2, 3) for v in range(300)])
    packed = root / "Pred_2024-01-02.csv.gz"
    packed.write_bytes(gzip.compress((root / "Pred_2024-01-02.csv").read_bytes()))
    (root / "Pred_2024-01-02.csv").unlink()
    cut(packed)
    (root / "Pred_2024-01-03.csv").write_text("Time,Value\n2024-01-01,1\n")
    weather_file(root, "Pred_2024-01-04.csv", [])
    assert len(lakes.load_new_weather(lake, str(root), NOW)) == 1
    assert [(r.prediction_date.day, r.value) for r in lake.forecasts().collect()] == [(1, 5.0)]
    assert sorted(r.filename for r in lake.manifest(lakes.WEATHER_MANIFEST).collect()) == ["Pred_2024-01-01.csv", "Pred_2024-01-04.csv"]
    assert {r.name: r.reason for r in lake.quarantine().collect()} == {
        "Pred_2024-01-02.csv.gz": "truncated gzip file", "Pred_2024-01-03.csv": "no column Prediction, Site, Measurement, Unit in header: Time,Value",
    }
    assert lakes.load_new_weather(lake, str(root), NOW) == []


def loaded(lake, root, *powers, start=AT):
    for n, power in enumerate(powers):
        at = start + timedelta(minutes=n)
        write(root, file_name(at, "Alpha"), plug(power, total=1000, at=f"{at:%d.%m.%Y %H:%M}"))
    lakes.load_sensors(lake, sensors.read_sensor_files(lake.spark, str(root)), NOW)


def test_a_home_with_plugs_only(lake, tmp_path):
    loaded(lake, tmp_path / "in", 1, 2)
    gold = lakes.refresh_gold(lake)
    empty = ["fact_environment_minute", "fact_presence_minute", "fact_device_health_day", "fact_weather_hour"]
    assert [gold[n].count() for n in empty] == [0, 0, 0, 0]
    assert gold["fact_energy_minute"].count() == lake.gold("mv_energy_with_cost").count() == 2
    assert lakes.refresh_gold(lake, [AT.date()])["fact_energy_minute"].count() == 2


def test_periods_gone_from_silver_go_from_gold(lake, tmp_path):
    loaded(lake, tmp_path / "in", 1)
    loaded(lake, tmp_path / "later", 2, start=AT + timedelta(days=2))
    lakes.refresh_gold(lake)
    left = session.materialise(lake.readings().filter("value < 2 OR field = 'total'").filter("timestamp < '2024-01-02'"), "left")
    left.write.mode("overwrite").partitionBy("period").parquet(lake.path(lakes.SENSOR_EVENTS))
    lakes.refresh_gold(lake)
    assert lake.gold("fact_energy_minute").count() == 1


def test_a_new_price_reaches_all_periods(lake, tmp_path):
    loaded(lake, tmp_path / "in", 1)
    loaded(lake, tmp_path / "later", 2, start=AT + timedelta(days=2))
    lakes.refresh_gold(lake, tariffs=[("OIKEN", 2024, "0.3000")])
    lakes.refresh_gold(lake, [AT.date()], tariffs=[("OIKEN", 2024, "0.5000")])
    assert {float(r.chf_per_kwh) for r in lake.gold("mv_energy_with_cost").collect()} == {0.5}


def test_two_refreshes_side_by_side(lake, spark, tmp_path):
    loaded(lake, tmp_path / "in", 1, 2)
    weather_file(tmp_path / "w", "Pred_2024-01-01.csv", [(1, 5, 0)])
    lakes.load_weather(lake, weather.read_weather_files(spark, str(tmp_path / "w")), NOW)
    failed = []

    def refresh(**what):
        try:
            for _ in range(2):
                lakes.refresh_gold(lake, **what)
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    jobs = [threading.Thread(target=refresh, kwargs=k) for k in ({"weather": False}, {"sensor": False})]
    for job in jobs:
        job.start()
    for job in jobs:
        job.join()
    assert not failed
    minutes = lake.gold("dim_datetime")
    assert minutes.count() == minutes.select("datetime_key").distinct().count()
    assert lake.gold("mv_energy_with_cost").count() == 2 and lake.gold("fact_weather_hour").count() == 1
    assert locks.Lock(spark, lake.path("_refreshing")).try_acquire()


def test_a_dead_refresh_does_not_block_for_ever(lake, spark, monkeypatch, tmp_path):
    loaded(lake, tmp_path / "in", 1)
    dead = locks.Lock(spark, lake.path("_refreshing"))
    assert dead.try_acquire()
    dead._stop.set()
    file = tmp_path / "lake" / "_refreshing" / f"{dead.number:012d}"
    os.utime(file, (time.time() - DAY, time.time() - DAY))
    assert lakes.refresh_gold(lake)["fact_energy_minute"].count() == 1


def test_jobs_leave_no_intermediate_tables(spark, tmp_path, lake):
    def stored():
        return {p for p in pathlib.Path(session.shared_dir(spark)).rglob("*") if p.is_file()}

    before = stored()
    loaded(lake, tmp_path / "in", 1, 2)
    lakes.refresh_gold(lake)
    loaded(lake, tmp_path / "in", 3)
    lakes.refresh_gold(lake, [AT.date()])
    assert stored() == before


@pytest.mark.parametrize("reader", [sensors.read_sensor_files, weather.read_weather_files])
def test_a_folder_without_files(spark, tmp_path, reader):
    assert reader(spark, str(tmp_path)).count() == 0


def test_one_file_per_row_is_written_by_many_tasks(spark, tmp_path):
    from hearthlake.workload import silver_queries

    rows = spark.createDataFrame([(i, f"n{i}") for i in range(40)], "k long, value string").coalesce(1)
    root = str(tmp_path / "landing")
    silver_queries.one_task_each(rows.select("value")).write.option("maxRecordsPerFile", 1).text(root)
    written = [p for p in os.listdir(root) if p.startswith("part-")]
    assert len(written) == 40
    assert len({p.split("-")[1] for p in written}) > 1
    assert sorted(r.value for r in spark.read.text(root).collect()) == sorted(f"n{i}" for i in range(40))

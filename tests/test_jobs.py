"""Registry, prediction and erasure jobs on a lake."""

import json
from datetime import datetime, timedelta

import pytest

from hearthlake.plans import jobs, lake as lakes
from hearthlake.sources import locks, sensors, tables
from tests.payloads import FULL, file_name, plug, write

NOW = datetime(2024, 1, 5, 12)
AT = datetime(2024, 1, 1, 10)


@pytest.fixture
def home(lake, tmp_path):
    for n in range(3):
        at = AT + timedelta(minutes=n)
        for name in ("Alpha", "Beta"):
            payload = json.loads(json.dumps(FULL)) | {"datetime": f"{at:%d.%m.%Y %H:%M}"}
            write(tmp_path / "in", file_name(at, name), payload)
    write(tmp_path / "in", file_name(AT + timedelta(hours=1), "Beta"), plug("n/a"))
    raw = sensors.read_sensor_files(lake.spark, str(tmp_path / "in"))
    sensors.land_payloads(sensors.with_file_keys(raw, lake.apartment_map), lake.path(jobs.BRONZE))
    lakes.load_sensors(lake, raw, NOW)
    return lake


def registry(spark):
    return {
        "buildings": spark.createDataFrame([(1, "Villa Alpha"), (2, "other")], "idBuilding int, houseName string"),
        "dierrors": spark.createDataFrame(
            [(5, 1, "sensor offline", "2024-01-01 10:00:00"), (6, 2, "ok", "2024-01-01 11:00:00"), (7, 1, "x", "")],
            "idError int, idBuilding int, errorMessage string, creationDate string",
        ),
    }


def test_registry_to_apartments_and_errors(home, spark):
    source = registry(spark)
    written = jobs.load_registry(home, source, source.__getitem__)
    assert "dim_buildings" in written and "di_errors_clean" in written
    errors = {r.error_id: (r.apartment, r.severity) for r in home.errors().collect()}
    assert errors == {5: ("apt_a", "high"), 6: (None, "low")}
    gold = lakes.refresh_gold(home, weather=False)
    names = {r.apartment_id: r.building_id for r in gold["dim_apartment"].collect()}
    assert names["apt_a"] == 1 and names["apt_b"] is None
    assert jobs.load_registry(home, {}, source.__getitem__) == []
    assert home.errors().count() == 2


def test_predictions_are_stored_and_completed(home, tmp_path):
    for n in range(8):
        at = AT + timedelta(hours=n // 4, minutes=15 * (n % 4))
        for day in (0, 1):
            then = at + timedelta(days=day)
            write(tmp_path / "more", file_name(then, "Alpha"), plug(10 + n, at=f"{then:%d.%m.%Y %H:%M}"))
    lakes.load_sensors(home, sensors.read_sensor_files(home.spark, str(tmp_path / "more")), NOW)
    lakes.refresh_gold(home)
    for _ in range(2):
        made = jobs.predict(home, NOW)
        rows = made["fact_prediction_consumption"]
        assert rows.count() == rows.select("apartment", "room", "timestamp_rounded", "model_name").distinct().count() > 0
        assert rows.filter("actual_power_w IS NOT NULL").count() >= 8
        assert rows.filter("predicted_power_w IS NULL").count() == 0


def test_erasure_rewrites_what_is_stored(home, spark):
    source = registry(spark)
    jobs.load_registry(home, source, source.__getitem__)
    lakes.refresh_gold(home, weather=False)
    before = {n: home.gold(n).count() for n in ("fact_energy_minute", "fact_environment_minute", "dim_device")}
    done = jobs.erase_apartments(home, ["apt_b"])
    assert jobs.BRONZE in done and "gold/dim_apartment" in done and lakes.QUARANTINE in done
    assert {r.apartment for r in home.readings().select("apartment").distinct().collect()} == {"apt_a"}
    assert {r.apartment_id for r in home.gold("dim_apartment").collect()} == {"apt_a"}
    assert {n: home.gold(n).count() * 2 for n in before} == before
    assert {r.apartment for r in sensors.read_bronze(spark, home.path(jobs.BRONZE)).collect()} == {"apt_a"}
    assert home.quarantine().count() == 0
    assert all("Alpha" in r.filename for r in home.manifest().collect())
    assert jobs.erase_apartments(home, ["apt_b"]) == done
    assert home.errors().count() == 2
    assert lakes.refresh_gold(home, weather=False)["fact_energy_minute"].count() * 2 == before["fact_energy_minute"]
    assert locks.Lock(spark, home.path("_refreshing")).try_acquire()

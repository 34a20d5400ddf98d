from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hearthlake import schemas
from hearthlake.functions import cleaning
from hearthlake.plans import dimensions, facts, measures

AT = datetime(2023, 1, 1, 10, 0, 30)  # a Sunday in ISO week 52 of 2022


def silver(spark, rows):
    df = spark.createDataFrame(rows, "apartment string, room string, sensor_type string, field string, value double, timestamp timestamp")
    flag = cleaning.is_outlier(F.col("field"), F.col("value"))
    return df.withColumns({"unit": F.lit("u"), "is_outlier": flag})


def dims_of(readings):
    found = dimensions.members(readings)
    apartments = dimensions.dim_apartment(found).cache()
    rooms = dimensions.dim_room(found, apartments).cache()
    return {
        "dim_apartment": apartments,
        "dim_room": rooms,
        "dim_device": dimensions.dim_device(found, apartments, rooms).cache(),
    }


def test_calendar(spark):
    readings = silver(spark, [("a", "r", "plug", "power", 1.0, AT)])
    (d,) = dimensions.dim_date(readings).collect()
    assert d.asDict() == {
        "date_key": 20230101, "date": date(2023, 1, 1), "day_of_week": "Sunday", "week": 52, "month": 1, "year": 2023,
        "is_weekend": True, "is_holiday": False,
    }
    (m,) = dimensions.dim_datetime(readings).collect()
    assert (m.datetime_key, m.timestamp_utc, m.hour, m.minute) == (202301011000, datetime(2023, 1, 1, 10), 10, 0)


def test_calendar_is_the_union_of_both_tables(spark):
    readings = silver(spark, [("a", "r", "plug", "power", 1.0, AT)])
    outlook = spark.createDataFrame([(AT,), (datetime(2024, 2, 29, 5),)], "timestamp timestamp")
    first = dimensions.dim_date(readings)
    grown = dimensions.dim_date(readings, outlook, existing=first)
    assert sorted(r.date_key for r in grown.collect()) == [20230101, 20240229]


def test_apartments_are_enriched_and_masked(spark):
    found = dimensions.members(silver(spark, [(a, "r", "plug", "power", 1.0, AT) for a in ("apt_a", "apt_b", "apt_c")]))
    buildings = spark.createDataFrame([("12", "Villa Alpha"), ("7", "BETA haus")], "idBuilding string, houseName string")
    rows = dimensions.dim_apartment(found, buildings, {"alpha": "apt_a", "beta": "apt_b"})
    by_id = {r.apartment_id: (r.building_id, r.building_name, r.owner_user_id, r.name) for r in rows.collect()}
    assert by_id == {
        "apt_a": (12, "Building 12", None, "apt_a"),
        "apt_b": (7, "Building 7", None, "apt_b"),
        "apt_c": (None, None, None, "apt_c"),
    }
    sites = dimensions.dim_weather_site(spark.createDataFrame([("X",), ("Y",)], "site_name string"))
    x_key = {r.site_name: r.site_key for r in sites.collect()}["X"]
    linked = dimensions.link_weather_site(rows, sites, "X")
    assert {r.weather_site_key for r in linked.collect()} == {x_key}
    relinked = dimensions.link_weather_site(linked, sites, "Y")
    assert {r.weather_site_key for r in relinked.collect()} == {x_key}


def test_devices_that_compose_the_same_id_share_a_row(spark):
    readings = silver(
        spark, [("a_b", "c", "plug", "power", 1.0, AT), ("a", "b_c", "plug", "power", 2.0, AT), ("a", "d", "door", "open", 1.0, AT)]
    )
    dims = dims_of(readings)
    assert dims["dim_device"].count() == 2
    rows = facts.fact_energy_minute(readings, dims).collect()
    assert len(rows) == 2 and len({r.device_key for r in rows}) == 1 and len({r.room_key for r in rows}) == 2


def test_tariff_update_keeps_keys(spark):
    first = dimensions.dim_tariff(spark).cache()
    assert {(r.provider, r.year, r.chf_per_kwh) for r in first.collect()} == {
        ("OIKEN", y, Decimal("0.3400")) for y in (2023, 2024, 2025)
    }
    second = dimensions.dim_tariff(spark, [("OIKEN", 2024, "0.3"), ("OIKEN", 2026, "0.4")], existing=first)
    before = {r.year: r.tariff_key for r in first.collect()}
    after = {r.year: (r.tariff_key, r.chf_per_kwh) for r in second.collect()}
    assert {y: after[y][0] for y in before} == before
    assert {y: str(p) for y, (_, p) in after.items()} == {2023: "0.3400", 2024: "0.3000", 2025: "0.3400", 2026: "0.4000"}


def test_energy_fact(spark):
    readings = silver(
        spark,
        [
            ("a", "r", "plug", "power", 5.0, AT),
            ("a", "r", "plug", "power", 20000.0, AT.replace(second=45)),
            ("a", "r", "plug", "total", 1500.0, AT),
            ("a", "r", "plug", "temperature", 30.0, AT.replace(minute=1)),
            ("a", "House", "consumption", "total_power", 700.0, AT),
            ("a", "r", "motion", "motion", 1.0, AT),
        ],
    )
    rows = facts.fact_energy_minute(readings, dims_of(readings)).collect()
    assert sorted((r.datetime_key, r.power_w, r.energy_kwh, r.is_valid) for r in rows if r.power_w) == [
        (202301011000, 700.0, None, True),
        (202301011000, 20000.0, 1.5, False),
    ]
    assert [(r.power_w, r.energy_kwh) for r in rows if r.datetime_key == 202301011001] == [(None, None)]


def test_environment_fact(spark):
    readings = silver(
        spark,
        [
            ("a", "r", "meteo", "temperature_c", 99.0, AT),
            ("a", "r", "humidity", "temperature", 21.0, AT),
            ("a", "r", "humidity", "humidity", 55.0, AT),
            ("a", "r", "window", "open", 0.0, AT),
            ("a", "r", "motion", "temperature", 120.0, AT),
            ("a", "only_motion", "motion", "temperature", 20.0, AT),
            ("a", "r", "humidity", "battery", 300.0, AT.replace(minute=7)),
        ],
    )
    (r,) = facts.fact_environment_minute(readings, dims_of(readings)).collect()
    assert (r.temperature_c, r.humidity_pct, r.co2_ppm) == (99.0, 55.0, None)
    assert (r.window_open_flag, r.door_open_flag, r.is_anomaly) == (False, None, True)


def test_presence_fact(spark):
    readings = silver(
        spark,
        [
            ("a", "hall", "door", "open", 1.0, AT),
            ("a", "office", "motion", "motion", 1.0, AT),
            ("a", "office", "motion", "motion", 1.0, AT.replace(second=50)),
            ("a", "office", "motion", "light", 1.0, AT),
            ("a", "attic", "motion", "motion", 0.0, AT),
        ],
    )
    dims = dims_of(readings)
    rooms = {r.room_key: r.room_name for r in dims["dim_room"].collect()}
    rows = {rooms[r.room_key]: r for r in facts.fact_presence_minute(readings, dims).collect()}
    assert {k: (r.motion_count, r.door_open_flag, r.presence_flag, r.presence_prob) for k, r in rows.items()} == {
        "hall": (0, True, False, None),
        "office": (2, None, True, None),
        "attic": (0, None, False, None),
    }


def test_device_health(spark):
    nine = [("a", "r", "humidity", "humidity", 50.0, AT.replace(minute=m)) for m in range(9)]
    readings = silver(
        spark,
        [
            *nine,
            ("a", "r", "humidity", "battery", 80.0, AT),
            ("a", "r", "humidity", "battery", 70.0, AT.replace(second=59)),
            ("a", "r", "plug", "power", 1.0, AT),
        ],
    )
    errors = spark.createDataFrame(
        [("a_r_humidity", AT), ("a_r_humidity", AT), ("unknown", AT), (None, AT)], "sensor_id string, timestamp timestamp"
    )
    (r,) = facts.fact_device_health_day(readings, errors, dims_of(readings)).collect()
    assert (r.date_key, r.error_count, r.missing_readings) == (20230101, 2, 1431)
    assert (r.uptime_pct, r.battery_min_pct, r.battery_avg_pct) == (0.63, 70.0, 75.0)


def test_health_without_error_ids_counts_none(spark):
    readings = silver(spark, [("a", "r", "door", "battery", 80.0, AT)])
    none = spark.createDataFrame([(None, AT)], "sensor_id string, timestamp timestamp")
    (r,) = facts.fact_device_health_day(readings, none, dims_of(readings)).collect()
    assert r.error_count == 0


def test_weather_fact(spark):
    rows = [
        (AT, "X", 0, date(2023, 1, 1), "PRED_T_2M_ctrl", 1.0, False),
        (AT, "X", 1, date(2023, 1, 1), "PRED_T_2M_ctrl", 2.0, False),
        (AT, "X", 2, date(2023, 1, 1), "PRED_T_2M_ctrl", 9.0, False),
        (AT, "X", 3, date(2023, 1, 1), "PRED_T_2M_ctrl", 99.0, True),
        (AT, "X", 1, date(2023, 1, 1), "PRED_GLOB_ctrl", 7.0, False),
        (AT, "X", 1, date(2023, 1, 2), "PRED_T_2M_ctrl", 5.0, False),
        (AT, "Y", 1, date(2023, 1, 1), "PRED_T_2M_ctrl", 5.0, False),
    ]
    names = "timestamp timestamp, site string, prediction int, prediction_date date, measurement string, value double, is_outlier boolean"
    outlook = spark.createDataFrame(rows, names)
    sites = dimensions.dim_weather_site(spark.createDataFrame([("X",)], "site_name string"))
    got = {r.prediction_date.day: r for r in facts.fact_weather_hour(outlook, sites).collect()}
    assert (got[1].temperature_c, got[1].radiation_wm2, got[1].humidity_pct, got[1].n_model_runs) == (4.0, 7.0, None, 3)
    assert (got[2].temperature_c, got[2].n_model_runs) == (5.0, 1)
    median = {r.prediction_date.day: r for r in facts.fact_weather_hour(outlook, sites, how="median").collect()}
    assert median[1].temperature_c == 2.0


@pytest.mark.parametrize(("year", "kwh", "cost"), [(2024, 1.5, "0.5100"), (2024, 0.0025, "0.0009"), (2026, 1.5, None)])
def test_cost(spark, year, kwh, cost):
    energy = spark.createDataFrame([(year * 10000 + 101, kwh)], "date_key int, energy_kwh double")
    dates = spark.createDataFrame([(year * 10000 + 101, year)], "date_key int, year int")
    (r,) = facts.energy_with_cost(energy, dates, dimensions.dim_tariff(spark)).collect()
    assert (None if r.cost_chf is None else str(r.cost_chf)) == cost


def test_daily_cost_counts_all_calendar_days(spark):
    tables = {
        "dim_date": spark.createDataFrame(
            [(20240101, date(2024, 1, 1), 1), (20240102, date(2024, 1, 2), 1), (20240201, date(2024, 2, 1), 2)],
            "date_key int, date date, month int",
        ),
        "dim_apartment": spark.createDataFrame([(1, "a"), (2, "b")], "apartment_key int, apartment_id string"),
        "mv_energy_with_cost": spark.createDataFrame(
            [(20240101, 1, Decimal("3.0")), (20240101, 2, Decimal("1.0"))],
            "date_key int, apartment_key int, cost_chf decimal(38,4)",
        ),
    }
    by_month = measures.measure("daily_cost_chf", tables, ["month"]).collect()
    assert [(r.month, r.daily_cost_chf) for r in by_month] == [(1, 2.0)]
    assert measures.measure("daily_cost_chf", tables).first().daily_cost_chf == pytest.approx(4 / 3)
    by_apartment = {r.apartment_id: r.daily_cost_chf for r in measures.measure("daily_cost_chf", tables, ["apartment_id"]).collect()}
    assert by_apartment == {"a": 1.0, "b": pytest.approx(1 / 3)}
    one = measures.measure("daily_cost_chf", tables, where={"month": [1], "apartment_id": ["a"]})
    assert one.first().daily_cost_chf == 1.5


def test_ratio_over_nothing_is_null(spark):
    empty = spark.createDataFrame([], "room_key bigint, presence_flag boolean")
    assert measures.measure("occupancy_rate_pct", {"fact_presence_minute": empty}).first()[0] is None


def test_measure_refuses_a_dimension_its_fact_lacks(spark):
    fact = spark.createDataFrame([], "room_key bigint, presence_flag boolean")
    with pytest.raises(ValueError, match="site_name"):
        measures.measure("occupancy_rate_pct", {"fact_presence_minute": fact}, ["site_name"])


def test_temperature_delta(spark):
    tables = {
        "fact_environment_minute": spark.createDataFrame([(1, 20.0), (1, 24.0), (2, 10.0)], "date_key int, temperature_c double"),
        "fact_weather_hour": spark.createDataFrame([(1, 2.0), (3, 5.0)], "date_key int, temperature_c double"),
        "dim_date": spark.createDataFrame([(k, date(2024, 1, k)) for k in (1, 2, 3)], "date_key int, date date"),
    }
    assert measures.measure("temp_delta_c", tables).first()[0] == pytest.approx(18.0 - 3.5)
    by_date = {r.date.day: r.temp_delta_c for r in measures.measure("temp_delta_c", tables, ["date"]).collect()}
    assert by_date == {1: 20.0, 2: None, 3: None}


def test_schemas_name_all_dimension_columns(spark):
    readings = silver(spark, [("a", "r", "plug", "power", 1.0, AT)])
    dims = dims_of(readings)
    for name, schema in {
        "dim_apartment": schemas.DIM_APARTMENT, "dim_room": schemas.DIM_ROOM, "dim_device": schemas.DIM_DEVICE,
    }.items():
        assert [(f.name, f.dataType) for f in dims[name].schema] == [(f.name, f.dataType) for f in schema]

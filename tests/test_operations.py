from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hearthlake import schemas
from hearthlake.operators import freshness, gaps, privacy, quality
from hearthlake.plans import ml
from hearthlake.sources import listing

T0 = datetime(2024, 1, 1, 23, 50)


def lit(t):
    return F.lit(t).cast("timestamp")


def arrivals(spark, offsets):
    data = [(a, T0 + timedelta(minutes=m, seconds=7)) for a, ms in offsets.items() for m in ms]
    return spark.createDataFrame(data, "apartment string, timestamp timestamp")


def test_gaps_against_brute_force(spark):
    present = {"a": [0, 1, 2, 5, 14, 15, 29, 29], "b": [3]}
    apartments = spark.createDataFrame([("a",), ("b",), ("c",)], "apartment string")
    start, end = T0, T0 + timedelta(minutes=30)
    expected = sorted(
        (a, T0 + timedelta(minutes=m)) for a in "abc" for m in range(31) if m not in present.get(a, [])
    )
    missing = gaps.missing_files(arrivals(spark, present), apartments, lit(start), lit(end))
    assert sorted((r.apartment, r.minute) for r in missing.collect()) == expected
    runs = gaps.file_gaps(arrivals(spark, present), apartments, lit(start), lit(end)).collect()
    assert sum(r.missing_minutes for r in runs) == len(expected)
    assert [(r.gap_start, r.gap_end, r.missing_minutes) for r in runs if r.apartment == "c"] == [(start, end, 31)]


def test_stops_need_ten_empty_minutes_of_all(spark):
    seen = {"a": [0, 10, 40], "b": [21, 31]}
    streaks = gaps.stops(arrivals(spark, seen), lit(T0), lit(T0 + timedelta(minutes=49)))
    got = sorted(((r.gap_start - T0).seconds // 60, r.missing_minutes) for r in streaks.collect())
    assert got == [(11, 10)]


def test_nothing_arrived_at_all(spark):
    none = arrivals(spark, {"a": [500]})
    (r,) = gaps.stops(none, lit(T0), lit(T0 + timedelta(minutes=19))).collect()
    assert (r.gap_start, r.missing_minutes) == (T0, 20)


@pytest.mark.parametrize(
    ("hours", "status"), [(25.9, "ok"), (26, "warn"), (7 * 24 - 0.1, "warn"), (7 * 24, "fail")]
)
def test_freshness_thresholds(spark, hours, status):
    now = datetime(2024, 3, 10)
    df = spark.createDataFrame([(now - timedelta(hours=hours),), (datetime(2020, 1, 1),)], "t timestamp")
    (r,) = freshness.freshness({"x": (df, "t", schemas.FRESHNESS_SENSORS)}, lit(now)).collect()
    assert (r.status, r.age_seconds) == (status, round(hours * 3600))


def test_freshness_decodes_keys_and_reports_no_data(spark):
    now = datetime(2024, 1, 2)
    sources = {
        "minute": (spark.createDataFrame([(202401012330,)], "datetime_key bigint"), "datetime_key", (3600, 7200)),
        "day": (spark.createDataFrame([(20240101,)], "date_key int"), "date_key", (3600, 7200)),
        "none": (spark.createDataFrame([], "date_key int"), "date_key", (3600, 7200)),
    }
    got = {r.source: (r.latest, r.status) for r in freshness.freshness(sources, lit(now)).collect()}
    assert got == {
        "minute": (datetime(2024, 1, 1, 23, 30), "ok"), "day": (datetime(2024, 1, 1), "fail"), "none": (None, "no data"),
    }


def manifest(spark):
    rows = [("a.json", datetime(2024, 1, 1)), ("b.json", datetime(2024, 1, 9)), ("c.json", datetime(2024, 1, 2))]
    return spark.createDataFrame(rows, schemas.MANIFEST)


def test_retention(spark):
    listed = spark.createDataFrame([("a.json.gz",), ("b.json",)], "name string")
    eligible = listing.retention_eligible(manifest(spark), listed, lit(datetime(2024, 1, 10)), 5)
    assert sorted((r.filename, r.exists) for r in eligible.collect()) == [("a.json", True), ("c.json", False)]
    assert listing.retention_summary(eligible).first().asDict() == {"eligible": 2, "would_delete": 1, "missing": 1}
    assert listing.retention_eligible(manifest(spark), listed, lit(datetime(2024, 1, 10)), -1).count() == 0


def test_new_files_ignore_compression(spark):
    listed = spark.createDataFrame([("a.json.gz",), ("b.json",), ("d.json.gz",)], "name string")
    assert [r.name for r in listing.new_files(listed, manifest(spark)).collect()] == ["d.json.gz"]


def test_newest_file_by_date_not_by_string(spark):
    names = ["31.01.2023 2359_A.json", "01.02.2023 0000_A.json", "zzz.json", "30.12.2022 1200_A.json"]
    listed = spark.createDataFrame([("s", n) for n in names], "source string, name string")
    (r,) = listing.newest_file(listed, ["source"]).collect()
    assert r.name == "01.02.2023 0000_A.json"


def test_footprint(spark, tmp_path):
    for folder, size in (("x", 3), ("x/deep", 4), ("y", 5)):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / "f.bin").write_bytes(b"0" * size)
    source = F.regexp_extract("path", f"{tmp_path.name}/([^/]+)/", 1)
    rows = listing.footprint(listing.list_files(spark, str(tmp_path)), source).collect()
    assert {r.source: (r.files, r.bytes) for r in rows} == {"x": (2, 7), "y": (1, 5)}


def test_violations(spark):
    df = spark.createDataFrame([("abc", None), (None, "x"), ("a", "y")], "k string, v string")
    rows = quality.violations(df, ["k", "v"], {"k": 2}).collect()
    assert {r.rule: r.violations for r in rows} == {"k_null": 1, "v_null": 1, "k_too_long": 1}


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "p int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert [tuple(r) for r in quality.orphans(child, "p", parent, "id").collect()] == [(2, 2)]


def test_table_status(spark):
    tables = {"full": spark.range(3), "none": spark.range(0)}
    assert {r.table_name: (r.rows, r.status) for r in quality.table_status(tables).collect()} == {
        "full": (3, "ready"), "none": (0, "empty"),
    }


@pytest.fixture(scope="module")
def star(spark):
    return {
        "dim_apartment": spark.createDataFrame([(1, "a"), (2, "b")], "apartment_key bigint, apartment_id string"),
        "dim_room": spark.createDataFrame([(10, 1), (20, 2)], "room_key bigint, apartment_key bigint"),
        "dim_device": spark.createDataFrame([(100, 10), (200, 20)], "device_key bigint, room_key bigint"),
        "dim_date": spark.createDataFrame([(20240101,)], "date_key int"),
        "fact": spark.createDataFrame([(1, 1.0), (2, 2.0), (2, 3.0)], "apartment_key bigint, v double"),
        "sensor_events": spark.createDataFrame([("a", 1), ("b", 2)], "apartment string, v int"),
    }


def counts(tables):
    return {name: df.count() for name, df in tables.items()}


def test_roles_see_their_apartment(spark, star):
    gold = {k: v for k, v in star.items() if k != "sensor_events"}
    grants = spark.createDataFrame([("B", 2), ("B", 2), ("A", 1)], "role string, apartment_key bigint")
    assert counts(privacy.visible(gold, grants, "B")) == {
        "dim_apartment": 1, "dim_room": 1, "dim_device": 1, "dim_date": 1, "fact": 2,
    }
    assert counts(privacy.visible(gold, grants, "nobody"))["fact"] == 0
    assert counts(privacy.visible(gold, grants, privacy.ADMIN)) == counts(gold)


def test_tables_by_apartment_name_and_by_room_follow_the_grants(spark, star):
    predictions = spark.createDataFrame([("a", 0.1), ("b", 0.2), ("b", 0.3)], "apartment string, predicted double")
    grants = spark.createDataFrame([("B", 2)], "role string, apartment_key bigint")
    private = {"fact_prediction_motion": predictions, "dim_device": star["dim_device"]}
    assert counts(privacy.visible(private, grants, "B", star)) == {"fact_prediction_motion": 2, "dim_device": 1}
    assert counts(privacy.visible(private, grants, "nobody", star)) == {"fact_prediction_motion": 0, "dim_device": 0}
    left = privacy.erase(private, spark.createDataFrame([("b",)], "apartment string"), star)
    assert counts(left) == {"fact_prediction_motion": 1, "dim_device": 1}


def test_unknown_tables_are_refused(spark, star):
    odd = {**star, "notes": spark.range(2)}
    with pytest.raises(ValueError, match="notes"):
        privacy.visible(odd, spark.createDataFrame([], "role string, apartment_key bigint"), "B")
    with pytest.raises(ValueError, match="notes"):
        privacy.erase(odd, spark.createDataFrame([("b",)], "apartment string"))


def test_erasure_reaches_every_table(spark, star):
    left = privacy.erase(star, spark.createDataFrame([("b",)], "apartment string"))
    assert counts(left) == {
        "dim_apartment": 1, "dim_room": 1, "dim_device": 1, "dim_date": 1, "fact": 1, "sensor_events": 1,
    }
    assert privacy.subject_access(star["sensor_events"], "a").count() == 1


def slots(spark):
    at = datetime(2024, 1, 1)
    data = []
    for i in range(4 * 24 * 3):
        t = at + timedelta(minutes=15 * i)
        busy = int(8 <= t.hour < 18)
        if i != 5:
            data.append((1, 10, "a", "r", t, 100.0 * busy + 5, busy, 3 * busy))
    schema = "apartment_key long, room_key long, apartment string, room string, slot timestamp, power_w double, occupied int, motion_count long"
    return spark.createDataFrame(data, schema)


def outlook(spark):
    rows = [
        (1, 202401011000, 20240101, date(2023, 12, 31), 1.0),
        (1, 202401011000, 20240101, date(2024, 1, 1), 2.0),
        (1, 202401011000, 20240101, date(2024, 1, 2), 3.0),
    ]
    df = spark.createDataFrame(rows, "site_key long, datetime_key long, date_key int, prediction_date date, temperature_c double")
    return df.withColumns({c: F.lit(None).cast("double") for c in ml.WEATHER[1:]})


def test_features_shift_by_time_and_use_the_forecast_known_then(spark):
    apartments = spark.createDataFrame([(1, 1)], "apartment_key long, weather_site_key long")
    rows = {r.slot: r for r in ml.features(slots(spark), outlook(spark), apartments).collect()}
    at = datetime(2024, 1, 1)
    assert len(rows) == 4 * 24 * 3 - 1
    assert rows[at + timedelta(hours=7, minutes=15)].label_occupied == 1
    assert rows[at + timedelta(minutes=15)].label_occupied is None  # its target slot is the missing one
    assert rows[at + timedelta(minutes=90)].power_w_lag_15m is None
    assert rows[at + timedelta(hours=8, minutes=30)].occupied_lag_15m == 1
    assert rows[at + timedelta(hours=8)].label_power_w == 105.0
    assert rows[at + timedelta(days=2, hours=1)].label_power_w is None
    assert rows[at + timedelta(hours=10, minutes=30)].outdoor_temperature_c == 2.0
    assert rows[at + timedelta(hours=11)].outdoor_temperature_c is None


def test_backtest_on_known_coefficients(spark):
    """Fitted before the cut, scored behind it: an exact linear law is found again."""
    at = datetime(2024, 1, 1)
    apartments = spark.createDataFrame([(1, 1)], "apartment_key long, weather_site_key long")
    rows = ml.features(slots(spark), outlook(spark), apartments)
    lawful = rows.withColumn("label_power_w", 3.0 * F.coalesce("power_w", F.lit(0.0)) + 2.0 * F.col("hour") + 7)
    cut = ml.split_time(lawful, 0.75)
    assert cut == at + timedelta(hours=53, minutes=45)  # 3/4 of 71:45 hours, rounded down to a slot
    past = ml.known_before(lawful, cut, ml.DAY)
    assert past.agg(F.max("slot")).first()[0] == cut - timedelta(days=1, minutes=15)
    held_out = lawful.filter(F.col("slot") >= F.lit(cut))
    made = ml.predict_consumption(ml.fit_consumption(past), held_out, F.lit(at))
    (errors,) = ml.backtest(made, "predicted_power_w", "actual_power_w").collect()
    assert errors.slots == held_out.count() == 73
    assert errors.mae < 5 and abs(errors.bias) <= errors.mae <= errors.rmse


def test_models_learn_and_predictions_are_upserted(spark, tmp_path):
    apartments = spark.createDataFrame([(1, 1)], "apartment_key long, weather_site_key long")
    rows = ml.features(slots(spark), outlook(spark), apartments).cache()
    made_at = lit(datetime(2024, 1, 4))
    motion = ml.predict_occupancy(ml.fit_occupancy(rows), rows, made_at)
    power = ml.predict_consumption(ml.fit_consumption(rows), rows, made_at)
    assert [(f.name, f.dataType) for f in motion.schema] == [(f.name, f.dataType) for f in schemas.PREDICTION_MOTION]
    assert [(f.name, f.dataType) for f in power.schema] == [(f.name, f.dataType) for f in schemas.PREDICTION_CONSUMPTION]
    assert motion.filter("predicted_occupied < 0 or predicted_occupied > 1").count() == 0
    (error,) = ml.backtest(motion, "predicted_occupied", "actual_occupied").collect()
    assert error.mae < 0.4 and error.model_name == "logistic_regression"
    (error,) = ml.backtest(power, "predicted_power_w", "actual_power_w").collect()
    assert error.slots == 4 * 24 * 2 - 1 and error.rmse < 40  # the slot missing on day 1 has no row
    path = str(tmp_path / "p")
    for _ in range(2):
        ml.store_predictions(motion, path)
    assert spark.read.parquet(path).count() == motion.count()

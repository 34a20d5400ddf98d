"""Landed payloads: compaction and retention; hash keys; prices of one year."""

import pathlib
from datetime import date, datetime, timedelta

import pytest

from hearthlake.operators import quality, surrogate
from hearthlake.plans import lake as lakes
from hearthlake.sources import sensors
from tests.payloads import file_name, plug, write
from tests.test_files import loaded

AT = datetime(2024, 1, 1, 10)


def landed(spark, path, n, apartment="apt_a", start=AT):
    at = [start + timedelta(minutes=k) for k in range(n)]
    rows = [(f"in/{t}", file_name(t, "Alpha"), t, "{}", t, apartment, None) for t in at]
    schema = "path string, name string, modified timestamp, value string, file_ts timestamp, apartment string, file_error string"
    for row in rows:
        sensors.land_payloads(spark.createDataFrame([row], schema), path)


def files(path):
    return list(pathlib.Path(path).rglob("*.parquet"))


def test_landed_partitions_are_packed(spark, tmp_path):
    path = str(tmp_path / "bronze")
    landed(spark, path, 12)
    landed(spark, path, 2, "apt_b")
    before = sorted(map(tuple, sensors.read_bronze(spark, path).collect()), key=str)
    assert sensors.compact_landed(spark, path, most=4) == ["apartment=apt_a/period=2024-01-01"]
    assert len(files(path)) <= 3
    assert sorted(map(tuple, sensors.read_bronze(spark, path).collect()), key=str) == before
    assert sensors.compact_landed(spark, path, most=4) == []


def test_only_processed_periods_go(spark, tmp_path):
    path = str(tmp_path / "bronze")
    for day in range(3):
        landed(spark, path, 2, start=AT + timedelta(days=day))
    names = [file_name(AT + timedelta(days=d, minutes=m), "Alpha") for d, m in ((0, 0), (0, 1), (1, 0), (2, 0), (2, 1))]
    manifest = spark.createDataFrame([(n,) for n in names], "filename string")
    report = {r.period.day: (r.files, r.unprocessed, r.dropped) for r in sensors.drop_landed(spark, path, manifest, date(2024, 1, 3)).collect()}
    assert report == {1: (2, 0, False), 2: (2, 1, False)} and sensors.read_bronze(spark, path).count() == 6
    report = {r.period.day: r.dropped for r in sensors.drop_landed(spark, path, manifest, date(2024, 1, 3), dry_run=False).collect()}
    assert report == {1: True, 2: False}
    assert sorted({r.period.day for r in sensors.read_bronze(spark, path).collect()}) == [2, 3]


def test_hash_keys_are_stable_and_collisions_abort(spark, monkeypatch):
    rows = [("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("a", None), ("a", "b")]
    df = spark.createDataFrame(rows, "x string, y string")
    keyed = {(r.x, r.y): r.key for r in surrogate.with_hash_keys(df, ["x", "y"], "key").collect()}
    assert len(keyed) == 5 == len(set(keyed.values()))
    again = surrogate.with_hash_keys(df.repartition(3).filter("x = 'a'"), ["x", "y"], "key").collect()
    assert all(keyed[r.x, r.y] == r.key for r in again)
    monkeypatch.setattr(surrogate, "hash_key", lambda *natural: surrogate.F.length(natural[0]).cast("bigint"))
    with pytest.raises(surrogate.KeyCollision):
        surrogate.with_hash_keys(df, ["x", "y"], "key")


def test_orphans_of_all_keys_in_one_join(spark):
    child = spark.createDataFrame([(1, 10), (2, 10), (2, None), (3, 11)], "apartment_key long, room_key long")
    parents = {"dim_apartment": spark.createDataFrame([(1,), (2,)], "apartment_key long"), "dim_room": spark.createDataFrame([(11, 1)], "room_key long, apartment_key long")}
    report = quality.orphan_report({"fact_presence_minute": child, **parents})
    assert {r.column_name: r.orphan_rows for r in report.collect() if r.table_name == "fact_presence_minute"} == {"apartment_key": 1, "room_key": 2}


def test_a_new_price_rewrites_its_year_only(lake, tmp_path):
    loaded(lake, tmp_path / "old", 1, start=AT - timedelta(days=300))
    loaded(lake, tmp_path / "new", 2)
    lakes.refresh_gold(lake, tariffs=[("OIKEN", 2023, "0.2000"), ("OIKEN", 2024, "0.3000")])
    costs = tmp_path / "lake" / "gold" / "mv_energy_with_cost"

    def by_year():
        return {y: {f.name for f in costs.rglob("part-*") if f"period={y}" in str(f)} for y in (2023, 2024)}

    before = by_year()
    lakes.refresh_gold(lake, [date(2025, 5, 5)], tariffs=[("OIKEN", 2024, "0.5000")])
    after = by_year()
    assert before[2023] and after[2023] == before[2023] and after[2024] and not after[2024] & before[2024]
    assert {(r.date_key // 10000, float(r.chf_per_kwh)) for r in lake.gold("mv_energy_with_cost").collect()} == {(2023, 0.2), (2024, 0.5)}

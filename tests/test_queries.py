"""Registered queries against their SQL in DuckDB.

Runs a selection that touches every module; set HEARTHLAKE_ALL_QUERIES=1 to run all of them.
"""

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("HEARTHLAKE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
SELECTION = [
    "flatten_sensors",
    "quarantined_files",
    "clean_weather",
    "cleaning_stage_counts",
    "clean_di_errors",
    "dedupe_readings",
    "silver_upsert",
    "retention",
    "expected_file_gaps",
    "fact_energy_minute",
    "fact_environment_minute",
    "fact_presence_minute",
    "fact_device_health_day",
    "fact_weather_hour",
    "energy_with_cost",
    "daily_cost",
    "drill_down",
    "row_level_security",
    "orphan_report",
    "ml_features",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        return None if math.isnan(value) else float(value) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value.isoformat() if isinstance(value, datetime.date) else value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain_rows = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain_rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["year", "month", "daily_cost_chf"]


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("HEARTHLAKE_ALL_QUERIES") else SELECTION)
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    cursor = duck.execute(entry.oracle_sql()[name])
    expected = canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == expected

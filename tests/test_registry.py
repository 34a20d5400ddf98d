from datetime import datetime

import pytest

from hearthlake.operators.errors import clean_di_errors
from hearthlake.sources import registry


def test_find_column_ignores_case(spark):
    df = spark.createDataFrame([(1, "x")], "ErrorMessage int, b string")
    assert registry.find_column(df, ["errormessage"]) == "ErrorMessage"
    assert registry.find_column(df, ["nothing", "B"]) == "b"
    assert registry.find_column(df, ["nothing"]) is None


def test_import_skips_missing_empty_and_denied(spark):
    source = {
        "buildings": spark.createDataFrame([(1, "Alpha", "secret")], "idBuilding int, houseName string, address string"),
        "rooms": spark.createDataFrame([], "id int"),
        "users": spark.createDataFrame([(1,)], "id int"),
        "badges": spark.createDataFrame([(1,)], "id int"),
    }
    out = {}
    written = registry.import_registry(
        source, source.__getitem__, out.__setitem__, allow={"buildings": ["idbuilding", "housename"]}
    )
    assert written == ["dim_buildings"]
    assert out["dim_buildings"].dtypes == [("idBuilding", "string"), ("houseName", "string")]
    assert out["dim_buildings"].collect()[0].asDict() == {"idBuilding": "1", "houseName": "Alpha"}


def errors(spark, rows, names="IdError string, idbuilding string, ErrorMessage string, CreationDate string"):
    return spark.createDataFrame(rows, names)


@pytest.mark.parametrize(
    ("message", "level"),
    [
        ("Sensor OFFLINE", "high"),
        ("server crashed: read failed", "high"),
        ("Null value", "medium"),
        ("unhandled EXCEPTION", "medium"),
        ("battery replaced", "low"),
        ("", "low"),
    ],
)
def test_severity_first_match_wins(spark, message, level):
    (r,) = clean_di_errors(errors(spark, [("1", "1", message, "2024-01-01 10:00:00")])).collect()
    assert (r.severity, r.apartment, r.sensor_id, r.room_id) == (level, None, None, None)


def test_blank_dates_go_blank_ids_become_null_buildings_match(spark):
    log = errors(
        spark,
        [
            ("", "1", "a", "2024-01-01 10:00:00"),
            ("5", "2", "b", "2024-01-01 10:01:00"),
            ("6", "9", "c", "2024-01-01 10:02:00"),
            ("7", "1", "d", ""),
            ("8", "1", "e", None),
        ],
    )
    buildings = spark.createDataFrame([("1", "Haus ALPHA"), ("2", "Other")], "IDBUILDING string, HouseName string")
    rows = clean_di_errors(log, buildings, {"alpha": "apt_a"}).orderBy("timestamp").collect()
    assert [(r.error_id, r.apartment, r.timestamp) for r in rows] == [
        (None, "apt_a", datetime(2024, 1, 1, 10, 0)),
        (5, None, datetime(2024, 1, 1, 10, 1)),
        (6, None, datetime(2024, 1, 1, 10, 2)),
    ]


def test_log_without_message_column_is_refused(spark):
    with pytest.raises(ValueError, match="message"):
        clean_di_errors(spark.createDataFrame([("1",)], "idError string"))

from datetime import date, datetime

import pytest

from hearthlake.operators import forecasts
from hearthlake.sources import weather

HEADER = "Time,Value,Prediction,Site,Measurement,Unit"
T, RH, PREC, GLOB = "PRED_T_2M_ctrl", "PRED_RELHUM_2M_ctrl", "PRED_TOT_PREC_ctrl", "PRED_GLOB_ctrl"


def row(time="2023-01-05 00:00:00+00:00", value="1.5", run="00", site="Aadorf / Tänikon", kind=GLOB, unit="Watt/m2"):
    return f"{time},{value},{run},{site},{kind},{unit}"


def put(root, rows, name="Pred_2023-01-01.csv", header=HEADER):
    (root / name).write_text("\n".join([header, *rows]) + "\n", encoding="utf-8")


def clean(spark, root):
    return forecasts.clean_forecasts(weather.read_weather_files(spark, str(root))).collect()


def test_row_is_typed(spark, tmp_path):
    put(tmp_path, [row(site='" Aadorf / Tänikon "', unit=" Watt/m2 ", run="07")])
    (r,) = clean(spark, tmp_path)
    assert r.timestamp == datetime(2023, 1, 5)
    assert (r.site, r.prediction, r.prediction_date) == ("Aadorf / Tänikon", 7, date(2023, 1, 1))
    assert (r.measurement, r.value, r.unit, r.is_outlier) == (GLOB, 1.5, "Watt/m2", False)


def test_columns_go_by_their_names(spark, tmp_path):
    """Swapped columns, one more column, quoted fields with commas and quotes; a missing name rejects the file."""
    put(tmp_path, [row()])
    put(tmp_path, ["Sion,1.5,2023-01-06 00:00:00+00:00,01," + GLOB + ",W"], "Pred_2023-01-02.csv", '"Site",Value, Time ,Prediction,Measurement,Unit')
    put(tmp_path, [f'x,2023-01-07 00:00:00+00:00,2.5,02,"A, ""b""",{GLOB},W,,'], "Pred_2023-01-03.csv", "Extra,Time,Value,Prediction,Site,Measurement,Unit,More")
    put(tmp_path, ["2023-01-07 00:00:00+00:00,2.5,02,Sion,W"], "Pred_2023-01-04.csv", "Time,Value,Prediction,Site,Unit")
    put(tmp_path, [",2.5,02,Sion," + GLOB + ",W", "2023-01-08 00:00:00+00:00,3.5"], "Pred_2023-01-05.csv")
    found = sorted((r.prediction_date.day, r.site, r.value, r.prediction) for r in clean(spark, tmp_path))
    assert found == [(1, "Aadorf / Tänikon", 1.5, 0), (2, "Sion", 1.5, 1), (3, "A, b", 2.5, 2)]
    errors = {r.name: r.file_error for r in weather.read_weather_files(spark, str(tmp_path)).filter("file_error IS NOT NULL").collect()}
    assert errors == {"Pred_2023-01-04.csv": "no column Measurement in header: Time,Value,Prediction,Site,Unit"}


def test_rows_are_dropped_in_order(spark, tmp_path):
    put(
        tmp_path,
        [
            row(),
            row(value="-99999.0"),
            row(value=""),
            row(value="abc"),
            row(value="nan"),
            row(time="soon"),
            row(time="2022-12-31 23:59:59+00:00"),
            row(kind="PRED_OTHER"),
            row(time="2023-01-01 00:30:00+01:00"),
        ],
    )
    assert len(clean(spark, tmp_path)) == 1
    (counts,) = forecasts.stage_counts(weather.read_weather_files(spark, str(tmp_path))).collect()
    assert counts.asDict() == {
        "raw": 9, "after_timestamp": 8, "after_year": 6, "after_measurement": 5, "after_sentinel": 1,
    }


@pytest.mark.parametrize(("kind", "low", "high"), [(T, -50, 60), (RH, 0, 100), (PREC, 0, 500), (GLOB, 0, 1500)])
def test_bounds_are_inclusive_and_outliers_kept(spark, tmp_path, kind, low, high):
    put(tmp_path, [row(value=str(v), kind=kind, run=str(i)) for i, v in enumerate([low, high, low - 1, high + 0.5])])
    assert {r.value: r.is_outlier for r in clean(spark, tmp_path)} == {
        low: False, high: False, low - 1: True, high + 0.5: True,
    }


def test_unreadable_run_is_null(spark, tmp_path):
    put(tmp_path, [row(run="control")])
    (r,) = clean(spark, tmp_path)
    assert r.prediction is None


def test_files_with_an_impossible_run_or_name_are_rejected(spark, tmp_path):
    put(tmp_path, [row()], "Pred_2023-01-01.csv")
    put(tmp_path, [row(), row(run="1.5")], "Pred_2023-01-02.csv")
    put(tmp_path, [row(), row(run="70000")], "Pred_2023-01-03.csv")
    put(tmp_path, [row(), row(run="70000", kind="PRED_OTHER")], "Pred_2023-01-04.csv")
    put(tmp_path, [row()], "Pred_2023-13-01.csv")
    raw = weather.read_weather_files(spark, str(tmp_path))
    rejected = {r.path.rsplit("/", 1)[1] for r in forecasts.rejected_files(raw).collect()}
    assert rejected == {"Pred_2023-01-02.csv", "Pred_2023-01-03.csv", "Pred_2023-13-01.csv"}
    usable = forecasts.clean_forecasts(forecasts.usable_files(raw)).collect()
    assert {r.prediction_date for r in usable} == {date(2023, 1, 1), date(2023, 1, 4)}


def test_file_without_a_required_column_is_left_out(spark, tmp_path):
    put(tmp_path, [row()], "Pred_2023-01-01.csv")
    put(tmp_path, ["2023-01-05 00:00:00+00:00,1,00,Sion,PRED_GLOB_ctrl"], "Pred_2023-01-02.csv", HEADER[:-5])
    put(tmp_path, [], "Pred_2023-01-03.csv")
    assert {r.prediction_date for r in clean(spark, tmp_path)} == {date(2023, 1, 1)}


def test_missing_columns_raise(spark):
    df = spark.createDataFrame([("x",)], "Time string")
    with pytest.raises(ValueError, match="Measurement"):
        forecasts.clean_forecasts(df)


def test_gzip_csv(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "Pred_2023-02-01.csv.gz", "wt", encoding="utf-8") as f:
        f.write(HEADER + "\n" + row() + "\n")
    (r,) = clean(spark, tmp_path)
    assert r.prediction_date == date(2023, 2, 1)


def test_year_filter_reaches_a_columnar_scan(spark, tmp_path):
    from pyspark.sql import functions as F

    spark.range(10).select(F.timestamp_seconds("id").alias("ts")).write.parquet(str(tmp_path / "t"))
    plan = spark.read.parquet(str(tmp_path / "t")).filter(forecasts.not_before(F.col("ts"), 2023))
    assert "GreaterThanOrEqual(ts" in plan._jdf.queryExecution().executedPlan().toString()

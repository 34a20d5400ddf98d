"""Forecast CSV files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.functions import calendar
from hearthlake.schemas import WEATHER_COLUMNS
from hearthlake.sources import files

FORECAST_GLOB = "*.csv{,.gz}"
# One field behind a comma, in quotes or up to the next comma.
_FIELD = ',("(?:[^"]|"")*"|[^,]*)'


def _fields(line: Column) -> Column:
    """The fields of a CSV line; quotes around a field go, and two of them inside stand for one."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1))
    return F.transform(raw, lambda f: F.when(f.startswith('"'), F.replace(f.substr(F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))).otherwise(f))


def rows_of(texts: DataFrame) -> DataFrame:
    """Rows of readable files; a file without rows, or one that cannot be used, is one row of nulls.

    Columns go by the names in the file's own header, in any order and with others between them. A header that lacks
    one of the expected names is an error of the whole file.
    """
    lines = texts.withColumn("lines", F.split("value", "\r?\n")).drop("value")
    header = F.transform(_fields(F.col("lines")[0]), lambda h: F.trim(h))
    lacking = F.array_except(F.array(*[F.lit(name) for name in WEATHER_COLUMNS]), "header")
    wrong = F.when(F.size(lacking) > 0, F.concat(F.lit("no column "), F.array_join(lacking, ", "), F.lit(" in header: "), F.col("lines")[0]))
    checked = lines.withColumn("header", header).withColumn("file_error", F.coalesce("file_error", wrong))
    body = F.filter(F.slice("lines", F.lit(2), F.size("lines")), lambda line: line != "")
    line = F.explode_outer(F.when(F.col("file_error").isNull(), body)).alias("line")
    rows = checked.select("path", "name", "modified", "file_error", "header", line).withColumn("fields", _fields(F.col("line")))
    columns = [F.nullif(F.get("fields", F.array_position("header", name).cast("int") - 1), F.lit("")).alias(name) for name in WEATHER_COLUMNS]
    date = calendar.prediction_date(F.col("name")).alias("prediction_date")
    return rows.select(*columns, "path", "name", date, "modified", "file_error")


def read_weather_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Rows of every ``.csv`` or ``.csv.gz`` below ``paths``, all columns text, with the issue date from the name."""
    return rows_of(files.read_text_files(spark, paths, FORECAST_GLOB))


def stream_weather_files(spark: SparkSession, root: str, max_files: int = 100) -> DataFrame:
    return rows_of(files.stream_text_files(spark, root, FORECAST_GLOB, max_files))

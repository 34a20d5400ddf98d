"""Age of the newest row per source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest(df: DataFrame, column: str) -> Column:
    """Timestamp of the newest row: decoded from a calendar key, so no dimension has to be joined."""
    top = F.max(column)
    if column == "datetime_key":
        return F.try_to_timestamp(top.cast("string"), F.lit("yyyyMMddHHmm"))
    if column == "date_key":
        return F.try_to_timestamp(top.cast("string"), F.lit("yyyyMMdd"))
    return top.cast("timestamp")


def freshness(sources: dict[str, tuple[DataFrame, str, tuple[int, int]]], now: Column) -> DataFrame:
    """Newest time, age and status per source.

    ``sources`` maps a name to (table, time or key column, (ok below seconds, warning below seconds)). An empty
    source has no age and the status ``no data``.
    """
    rows = [
        df.agg(newest(df, column).alias("latest")).select(
            F.lit(name).alias("source"), "latest", F.lit(ok).alias("ok_below"), F.lit(warn).alias("warn_below")
        )
        for name, (df, column, (ok, warn)) in sources.items()
    ]
    age = F.unix_timestamp(now) - F.unix_timestamp("latest")
    status = (
        F.when(F.col("age_seconds").isNull(), "no data")
        .when(F.col("age_seconds") < F.col("ok_below"), "ok")
        .when(F.col("age_seconds") < F.col("warn_below"), "warn")
        .otherwise("fail")
    )
    return (
        reduce(DataFrame.unionByName, rows)
        .withColumn("age_seconds", age)
        .select("source", "latest", "age_seconds", status.alias("status"))
    )

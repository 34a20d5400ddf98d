"""Missing sensor files: expected minutes that have no arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthlake.functions import calendar
from hearthlake.schemas import EMPTY_MINUTES_STOP


def _minutes(n: int) -> Column:
    return F.expr(f"INTERVAL {n} MINUTES")


def _runs(minutes: DataFrame, by: list[str]) -> DataFrame:
    """Runs of absent minutes between consecutive present ones, per ``by``.

    Consecutive minutes are found per day, so no task holds a source's whole history; a day's first minute is
    linked to the last minute of the previous day present through a table of one row per day.
    """
    daily = minutes.withColumn("day", F.to_date("minute"))
    in_day = Window.partitionBy(*by, "day").orderBy("minute")
    across = Window.partitionBy(*by).orderBy("day")
    last = daily.groupBy(*by, "day").agg(F.max("minute").alias("last"))
    carried = last.select(*by, "day", F.lag("last").over(across).alias("carried"))
    before = F.coalesce(F.lag("minute").over(in_day), F.col("carried"))
    linked = daily.join(carried, [*by, "day"]).withColumn("before", before)
    length = ((F.unix_timestamp("minute") - F.unix_timestamp("before")) / 60 - 1).cast("bigint")
    return (
        linked.withColumn("missing_minutes", length)
        .filter("missing_minutes > 0")
        .select(
            *by,
            (F.col("before") + _minutes(1)).alias("gap_start"),
            (F.col("minute") - _minutes(1)).alias("gap_end"),
            "missing_minutes",
        )
    )


def _bracketed(arrivals: DataFrame, sources: DataFrame, start: Column, end: Column, by: list[str]) -> DataFrame:
    """Distinct minutes present within the range, plus the minutes just outside it for every expected source."""
    minute = calendar.minute(F.col("timestamp"))
    present = arrivals.filter(minute.between(start, end)).select(*by, minute.alias("minute")).distinct()
    present = present.join(sources, by, "left_semi")  # after distinct, a busy source is no more than its minutes
    edges = F.explode(F.array(start - _minutes(1), end + _minutes(1)))
    return present.unionByName(sources.select(*by, edges.alias("minute")))


def file_gaps(arrivals: DataFrame, apartments: DataFrame, start: Column, end: Column) -> DataFrame:
    """Runs of minutes without a file, per expected apartment, between two minutes inclusive."""
    expected = apartments.select("apartment").distinct()
    return _runs(_bracketed(arrivals, expected, start, end, ["apartment"]), ["apartment"])


def missing_files(arrivals: DataFrame, apartments: DataFrame, start: Column, end: Column) -> DataFrame:
    """Every expected (apartment, minute) without a file. A gap is unfolded day by day, so no row holds more than a day of it."""
    day = F.col("day").cast("timestamp")
    days = F.explode(F.sequence(F.to_date("gap_start"), F.to_date("gap_end"))).alias("day")
    last = day + F.expr("INTERVAL 1439 MINUTES")
    every = F.sequence(F.greatest("gap_start", day), F.least("gap_end", last), _minutes(1))
    by_day = file_gaps(arrivals, apartments, start, end).select("apartment", "gap_start", "gap_end", days)
    return by_day.select("apartment", F.explode(every).alias("minute"))


def observed_range(arrivals: DataFrame, around: int = 0) -> tuple[Column, Column]:
    """First and last minute with an arrival, ``around`` minutes further out; null if there are none."""
    minute = calendar.minute(F.col("timestamp"))
    first, last = arrivals.agg(F.min(minute), F.max(minute)).first()
    low, high = (F.lit(value).cast("timestamp") for value in (first, last))
    return low - _minutes(around), high + _minutes(around)


def stops(arrivals: DataFrame, start: Column, end: Column, max_empty: int = EMPTY_MINUTES_STOP) -> DataFrame:
    """Streaks of at least ``max_empty`` minutes in which no apartment delivered anything."""
    source = F.lit("any").alias("source")
    present = arrivals.select("timestamp", source)
    edges = arrivals.sparkSession.range(1).select(source)
    streaks = _runs(_bracketed(present, edges, start, end, ["source"]), ["source"])
    return streaks.filter(F.col("missing_minutes") >= max_empty).drop("source")

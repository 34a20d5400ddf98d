"""Calendar keys and the parsing of timestamps and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(ts: Column) -> Column:
    """``YYYYMMDD`` as int."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def datetime_key(ts: Column) -> Column:
    """``YYYYMMDDHHMM`` as bigint."""
    return date_key(ts).cast("bigint") * 10000 + F.hour(ts) * 100 + F.minute(ts)


def minute(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def period(ts: Column, grain: str) -> Column:
    """First day of the storage period (``day``, ``month`` …) that holds ``ts``."""
    return F.to_date(F.date_trunc(grain, ts))


def day_of_key(key: Column) -> Column:
    """The day a ``date_key`` stands for."""
    return F.make_date(F.floor(key / 10000).cast("int"), F.floor(key / 100).cast("int") % 100, key % 100)


def slot(ts: Column, minutes: int = 15) -> Column:
    """Start of the fixed-width slot that holds ``ts``."""
    width = minutes * 60
    return F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / width) * width)


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5


def parse_sensor_ts(text: Column, fallback: Column) -> Column:
    """Payload ``datetime`` (day.month.year hour:minute, one-digit parts allowed); ``fallback`` when unreadable."""
    shaped = text.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}\s+\d{1,2}:\d{1,2}$")
    tidy = F.regexp_replace(text, r"\s+", " ")
    return F.coalesce(F.when(shaped, F.try_to_timestamp(tidy, F.lit("d.M.yyyy H:m"))), fallback)


def file_ts(name: Column) -> Column:
    """Time in a sensor file name, ``31.08.2023 2144_<Apartment>_received.json``; null if it holds none."""
    stamp = F.regexp_extract(name, r"^(\d{1,2}\.\d{1,2}\.\d{4} \d{4})\s*_", 1)
    return F.when(stamp != "", F.try_to_timestamp(stamp, F.lit("d.M.yyyy HHmm")))


def prediction_date(name: Column) -> Column:
    """Issue date in a forecast file name, ``Pred_2023-01-01.csv``; null if it holds none."""
    stamp = F.substring(name, 6, 10)
    return F.when(stamp.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.to_date(F.try_to_timestamp(stamp, F.lit("yyyy-M-d"))))


def canonical_name(name: Column) -> Column:
    """File name without a trailing ``.gz``: a file keeps its identity when it is compressed."""
    return F.regexp_replace(name, r"\.gz$", "")


def base_name(path: Column) -> Column:
    """Last path segment, percent-decoded as the file source reports paths as URIs."""
    return F.try_url_decode(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\+", "%2B"))

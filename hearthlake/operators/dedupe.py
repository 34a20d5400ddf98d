"""One row per key, and the search for keys that still occur twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: list[str], order_by: list[Column] | None = None) -> DataFrame:
    """The row that ``order_by`` puts first, for each key.

    ``row_number() = 1`` is limited to one row per key before the shuffle (WindowGroupLimit), so a key with a third
    of all rows sends one row per map task and no more. Without an order the remaining columns decide, which keeps
    the result the same on every run.
    """
    order = order_by or [F.col(c).asc_nulls_last() for c in df.columns if c not in keys] or [F.lit(1)]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__position", position).filter("__position = 1").drop("__position")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def duplicate_key_count(df: DataFrame, keys: list[str]) -> DataFrame:
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("duplicate_keys"))


def top_duplicate_keys(df: DataFrame, keys: list[str], limit: int = 5) -> DataFrame:
    """The keys with most rows; equal counts are listed in key order."""
    return duplicate_keys(df, keys).orderBy(F.desc("n"), *keys).limit(limit)

"""Registration of queries, each with its SQL counterpart where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run

    return register


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded and decimals as doubles, so that two engines can be compared."""

    def column(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return value.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DoubleType):
            return F.round(value, DIGITS).alias(field.name)
        return value

    return df.select([column(field) for field in df.schema])


def rounded_sql(*columns: str) -> str:
    """The same rounding for the listed columns of an oracle."""
    return ", ".join(f"round(CAST({c} AS DOUBLE), {DIGITS}) AS {c}" for c in columns)

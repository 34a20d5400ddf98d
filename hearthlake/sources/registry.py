"""Building registry: full snapshots of its tables, all columns as text."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.schemas import REGISTRY_DENIED, REGISTRY_TABLES


def jdbc_reader(
    spark: SparkSession, url: str, partitioning: dict[str, dict[str, str]] | None = None, **options: str
) -> Callable[[str], DataFrame]:
    """Reader of one registry table over JDBC.

    ``partitioning`` names, per table, the JDBC options ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions``, so that a large table is fetched by many tasks.
    """

    def read(table: str) -> DataFrame:
        extra = (partitioning or {}).get(table, {})
        return spark.read.format("jdbc").options(url=url, dbtable=table, **options, **extra).load()

    return read


def allowed_columns(df: DataFrame, allow: Iterable[str] | None) -> DataFrame:
    """Keep only the listed columns (any letter case); ``None`` keeps all."""
    if allow is None:
        return df
    wanted = {name.lower() for name in allow}
    return df.select([F.col(f"`{name}`") for name in df.columns if name.lower() in wanted])


def as_text(df: DataFrame) -> DataFrame:
    return df.select([F.col(f"`{name}`").cast("string").alias(name) for name in df.columns])


def find_column(df: DataFrame, candidates: Iterable[str]) -> str | None:
    """Actual name of the first candidate the table has, ignoring letter case."""
    actual = {name.lower(): name for name in df.columns}
    return next((actual[c.lower()] for c in candidates if c.lower() in actual), None)


def import_registry(
    available: Iterable[str],
    read: Callable[[str], DataFrame],
    write: Callable[[str, DataFrame], None],
    allow: dict[str, Iterable[str]] | None = None,
) -> list[str]:
    """Replace each silver copy with a text snapshot of its registry table; returns the silver tables written.

    Tables that are missing, empty or denied are skipped.
    """
    present = {name for name in available if name not in REGISTRY_DENIED}
    written = []
    for source, target in REGISTRY_TABLES.items():
        if source not in present:
            continue
        snapshot = as_text(allowed_columns(read(source), (allow or {}).get(source)))
        if snapshot.isEmpty():
            continue
        write(target, snapshot)
        written.append(target)
    return written

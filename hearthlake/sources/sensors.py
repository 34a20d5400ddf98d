"""Sensor payload files: scan, file-name keys, landing as partitioned Parquet."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake import session
from hearthlake.functions import calendar, cleaning
from hearthlake.sources import files, locks, publish

PAYLOAD_GLOB = "*.json{,.gz}"


def read_sensor_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row (path, name, modified, value, file_error) per ``.json`` or ``.json.gz`` file below ``paths``."""
    return files.read_text_files(spark, paths, PAYLOAD_GLOB)


def stream_sensor_files(spark: SparkSession, root: str, max_files: int = 10_000) -> DataFrame:
    """Streaming form of :func:`read_sensor_files`; each trigger takes at most ``max_files`` unseen files."""
    return files.stream_text_files(spark, root, PAYLOAD_GLOB, max_files)


def with_file_keys(df: DataFrame, apartment_map: dict[str, str], name_col: str = "name") -> DataFrame:
    """Add ``apartment`` and ``file_ts`` read from the file name.

    ``apartment_map`` maps a pattern found anywhere in the name, ignoring case, to the apartment id.
    """
    name = F.col(name_col)
    return df.withColumns(
        {"apartment": cleaning.by_pattern(name, apartment_map), "file_ts": calendar.file_ts(name)}
    )


def land_payloads(raw: DataFrame, path: str, grain: str = "day") -> None:
    """Append payloads to the bronze table, one Parquet partition per apartment and period.

    Replaces a tree of tiny compressed files. ``rebalance`` sizes the output files and splits a period or an
    apartment that holds far more than its share over several tasks.
    """
    period = calendar.period(F.coalesce("file_ts", "modified"), grain)
    readable = raw.filter(F.col("apartment").isNotNull() & F.col("value").isNotNull()).drop("file_error")
    landed = readable.withColumn("period", period)
    writer = landed.hint("rebalance", "apartment", "period").write.mode("append").partitionBy("apartment", "period")
    with locks.held(raw.sparkSession, f"{path}.lock"):  # compaction may not replace a partition meanwhile
        writer.option("compression", "zstd").parquet(path)


BRONZE_SCHEMA = (
    "path string, name string, modified timestamp, value string, file_ts timestamp, apartment string, period date"
)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BRONZE_SCHEMA).parquet(path)


def stream_bronze(spark: SparkSession, path: str, max_files: int = 10_000) -> DataFrame:
    """Landed payloads as a stream, with the columns of :func:`stream_sensor_files`."""
    reader = spark.readStream.schema(BRONZE_SCHEMA).option("maxFilesPerTrigger", max_files)
    reader = reader.option("maxFileAge", files.MAX_FILE_AGE)
    return reader.parquet(path).select("path", "name", "modified", "value")


def drop_landed(spark: SparkSession, path: str, manifest: DataFrame, before: date, dry_run: bool = True) -> DataFrame:
    """Remove landed partitions whose period ended before ``before`` and whose files are all processed.

    Returns (apartment, period, files, unprocessed, dropped). Only folders are deleted; payloads are not read, the names in
    them are. Nothing that the manifest lacks goes, and ``dry_run`` only reports.
    """
    landed = read_bronze(spark, path).filter(F.col("period") < F.lit(before)).select("apartment", "period", calendar.canonical_name(F.col("name")).alias("filename"))
    known = manifest.select("filename", F.lit(True).alias("known")).distinct()
    counted = landed.join(known, "filename", "left").groupBy("apartment", "period")
    report = counted.agg(F.count(F.lit(1)).alias("files"), F.count_if(F.col("known").isNull()).alias("unprocessed"))
    report = session.materialise(report.withColumn("dropped", (F.col("unprocessed") == 0) & F.lit(not dry_run)), "retention")
    if not dry_run:
        folder = publish.Folder(spark, path)
        with locks.held(spark, f"{path}.lock"):
            for row in report.filter("dropped").select("apartment", "period").toLocalIterator():
                folder.delete(f"{path}/apartment={row.apartment}/period={row.period}")
    return report


def compact_landed(spark: SparkSession, path: str, most: int = 8) -> list[str]:
    """Rewrite the landed partitions that have more than ``most`` files, sized by ``rebalance``; returns their folders.

    Their rows are staged once and renamed into place, so a reader sees the old files or the new ones.
    """
    folder = publish.Folder(spark, path)
    crowded = [p for p in folder.partitions(path, 2) if sum(n.endswith(".parquet") for n in folder.names(f"{path}/{p}")) > most]
    if crowded:
        with locks.held(spark, f"{path}.lock"):
            publish.recover(spark, path)
            rows = spark.read.schema(BRONZE_SCHEMA).option("basePath", path).parquet(*[f"{path}/{p}" for p in crowded])
            writer = publish.stage(rows.hint("rebalance", "apartment", "period"), path, ["apartment", "period"])
            publish.commit(spark, path, writer, ["apartment", "period"])
    return crowded

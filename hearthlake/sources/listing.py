"""File listings and the manifest of files already processed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.functions import calendar
from hearthlake.sources import files as text_files


def described(files: DataFrame) -> DataFrame:
    """One row (path, name, bytes, modified) per file of a frame of files; contents are not read."""
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """One row (path, name, bytes, modified) per file below ``root``; contents are not read."""
    return described(text_files.listed_files(spark, root, glob))


def named_day(name: Column) -> Column:
    """The day in the name of a sensor or forecast file; null if it holds none. Compressing a file keeps its day."""
    return F.coalesce(F.to_date(calendar.file_ts(name)), calendar.prediction_date(name))


def lots(files: DataFrame, size: int) -> list[tuple[int, int]]:
    """Ranges of modification times in microseconds, both ends included, that split ``files`` (column ``modified``) into lots of about ``size``.

    The cuts are quantiles, so only they come to the driver. Files of one modification time stay in one lot.
    """
    count = files.count()
    if not count:
        return []
    shares = [n / (-(-count // size)) for n in range(1, -(-count // size))]
    micros = F.unix_micros("modified")
    cuts = F.percentile_approx(micros, [*shares, 1.0], 20 * (len(shares) + 1))
    low, cuts = files.agg(F.min(micros), cuts).first()
    ranges = []
    for cut in sorted(set(cuts)):
        ranges.append((low, cut))
        low = cut + 1
    return ranges


def within(micros: tuple[int, int]) -> Column:
    """Whether a file was modified in a range of :func:`lots`.

    On the file source's own metadata, so files outside the range are left out when the scan is planned: no task gets them.
    """
    low, high = (F.timestamp_micros(F.lit(m).cast("bigint")) for m in micros)
    return F.col("_metadata.file_modification_time").between(low, high)


def new_files(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Listed files that the manifest does not hold, comparing names without ``.gz``."""
    known = manifest.select(calendar.canonical_name(F.col("filename")).alias("canonical"))
    return (
        listing.withColumn("canonical", calendar.canonical_name(F.col("name")))
        .join(known, "canonical", "left_anti")
        .select(*listing.columns)
    )


def newest_file(listing: DataFrame, by: list[str], name_col: str = "name") -> DataFrame:
    """Newest file per source by the time in its name, not by string order; ties go to the greater name."""
    stamped = listing.withColumn("file_ts", calendar.file_ts(F.col(name_col))).filter(F.col("file_ts").isNotNull())
    newest = F.max(F.struct("file_ts", name_col))
    return (
        stamped.groupBy(*by)
        .agg(newest.alias("newest"))
        .select(*by, F.col(f"newest.{name_col}").alias(name_col), F.col("newest.file_ts").alias("file_ts"))
    )


def footprint(listing: DataFrame, source: Column) -> DataFrame:
    """Files, bytes and newest modification per source."""
    return listing.groupBy(source.alias("source")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.max("modified").alias("newest")
    )


def retention_eligible(manifest: DataFrame, listing: DataFrame, now: Column, days: int) -> DataFrame:
    """Manifest entries processed more than ``days`` ago, and whether their file is still there.

    A negative ``days`` disables retention and yields no rows. Nothing is deleted here.
    """
    aged = manifest.filter(F.lit(days >= 0) & (F.col("processed_at") < now - F.make_dt_interval(F.lit(days))))
    present = listing.select(calendar.canonical_name(F.col("name")).alias("canonical")).distinct()
    return (
        aged.withColumn("canonical", calendar.canonical_name(F.col("filename")))
        .join(present.withColumn("exists", F.lit(True)), "canonical", "left")
        .select("filename", "processed_at", F.coalesce("exists", F.lit(False)).alias("exists"))
    )


def retention_summary(eligible: DataFrame) -> DataFrame:
    return eligible.agg(
        F.count(F.lit(1)).alias("eligible"),
        F.count_if("exists").alias("would_delete"),
        F.count_if(~F.col("exists")).alias("missing"),
    )

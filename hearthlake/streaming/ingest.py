"""Structured Streaming: files to silver and gold, bounded de-duplication, minute aggregates."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hearthlake import schemas, session
from hearthlake.functions import calendar
from hearthlake.operators import dedupe
from hearthlake.plans import facts, lake as lakes
from hearthlake.sources import publish, tables


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _start(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, every: str | None) -> StreamingQuery:
    """Run ``handle`` per micro-batch: every ``every``, or once over everything there is when it is None."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def ingest_sensors(
    lake: lakes.Lake,
    stream: DataFrame,
    every: str | None = "60 seconds",
    refresh: bool = True,
    clock: Callable[[], datetime] = utc_now,
) -> StreamingQuery:
    """A stream of payloads (from raw files or from landed ones) to silver, and gold for the periods touched.

    The checkpoint remembers which files were taken. A batch that is replayed after a failure upserts the same keys
    again, so the tables end up the same. Late files need no bound: their periods are simply recomputed.
    """

    def handle(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        touched = lakes.as_list(lakes.load_sensors(lake, batch, clock()))
        if refresh and touched:
            lakes.refresh_gold(lake, touched, weather=False)

    return _start(stream, handle, lake.path("_checkpoints/sensors"), every)


def ingest_weather(
    lake: lakes.Lake,
    stream: DataFrame,
    every: str | None = "1 hour",
    refresh: bool = True,
    clock: Callable[[], datetime] = utc_now,
) -> StreamingQuery:
    """A stream of forecast rows to silver, and the weather fact for the periods each batch touched."""

    def handle(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        touched = lakes.as_list(lakes.load_weather(lake, batch, clock()))
        if refresh and touched:
            lakes.refresh_gold(lake, touched, sensor=False)

    return _start(stream, handle, lake.path("_checkpoints/weather"), every)


def unique_readings(readings: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """First reading per key, with state kept only for ``lateness``; the bounded alternative to the keyed upsert."""
    return readings.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(schemas.READING_KEY)


MINUTES = {
    "energy": facts.energy_minutes,
    "environment": facts.environment_minutes,
    "presence": facts.presence_minutes,
}


# Micro-batches that stand beside the compacted tables before they are merged into them.
MOST_BATCHES = 32
_STORED = T.StructType([*schemas.READINGS.fields, T.StructField("period", T.DateType())])


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.split("=")[1]) for n in publish.Folder(spark, path).names(f"{path}/batches") if n.startswith("batch="))


def _waiting(spark: SparkSession, path: str, numbers: list[int]) -> DataFrame:
    """Readings of micro-batches that are not merged yet, with their number."""
    if not numbers:
        return spark.createDataFrame([], T.StructType([*_STORED.fields, T.StructField("_batch", T.LongType())]))
    parts = [spark.read.schema(_STORED).parquet(f"{path}/batches/batch={n}").withColumn("_batch", F.lit(n).cast("long")) for n in numbers]
    return reduce(DataFrame.unionByName, parts)


def publish_minutes(readings: DataFrame, kind: str, path: str, every: str | None = None, most: int = MOST_BATCHES, grain: str = "day") -> StreamingQuery:
    """Publish the minute table ``kind`` of a stream of readings, the newest minutes before they are final.

    There is no watermark: readings of any age count. A batch is a folder of its own, which a replay overwrites; when
    there are more than ``most``, they are merged by key into stored readings, and the minutes of the periods they
    touch are made anew. A key that comes twice counts once, with its later value. ``grain`` is the period of a partition.
    """

    def handle(batch: DataFrame, number: int) -> None:
        rows = batch.select(*[f.name for f in schemas.READINGS]).withColumn("period", calendar.period(F.col("timestamp"), grain))
        dedupe.one_per_key(rows, schemas.READING_KEY).write.mode("overwrite").parquet(f"{path}/batches/batch={number}")
        if len(_numbers(batch.sparkSession, path)) > most:
            compact_minutes(batch.sparkSession, kind, path, grain)

    return _start(readings, handle, f"{path}_checkpoint", every)


def compact_minutes(spark: SparkSession, kind: str, path: str, grain: str = "day") -> None:
    """Merge the waiting batches. Their folders go from the oldest on, so what an interruption leaves is the newest."""
    numbers = _numbers(spark, path)
    with session.scratch(spark):
        waiting = session.materialise(_waiting(spark, path, numbers), "waiting")
        periods = lakes.as_list(waiting.select("period"))
        tables.upsert(waiting, f"{path}/readings", schemas.READING_KEY, "period", order_by=[F.desc("_batch")])
        stored = _within(tables.read(spark, f"{path}/readings", _STORED), periods)
        minutes = _minutes(kind, stored).withColumn("period", calendar.period(F.col("minute"), grain))
        tables.replace_partitions(minutes.hint("rebalance", "period"), f"{path}/minutes", ["period"])
    folder = publish.Folder(spark, path)
    for number in numbers:
        folder.delete(f"{path}/batches/batch={number}")


def _within(df: DataFrame, periods: list) -> DataFrame:
    known = F.col("period").isin([p for p in periods if p is not None])
    return df.filter(known | F.col("period").isNull() if None in periods else known)


def _minutes(kind: str, readings: DataFrame) -> DataFrame:
    return MINUTES[kind](readings.drop("period"))


def published_minutes(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """One row per natural key and minute of what :func:`publish_minutes` has written.

    Periods that no waiting batch touches are read as they are stored; the others are made from their readings.
    """
    waiting = _waiting(spark, path, _numbers(spark, path))
    touched = lakes.as_list(waiting.select("period"))
    stored = _within(tables.read(spark, f"{path}/readings", _STORED), touched).withColumn("_batch", F.lit(-1).cast("long"))
    merged = dedupe.one_per_key(stored.unionByName(waiting), schemas.READING_KEY, [F.desc("_batch")]).drop("_batch")
    fresh = _minutes(kind, merged)
    schema = T.StructType([*fresh.schema.fields, T.StructField("period", T.DateType())])
    minutes = tables.read(spark, f"{path}/minutes", schema)
    known = F.coalesce(F.col("period").isin([p for p in touched if p is not None]), F.lit(None in touched))
    return minutes.filter(~known).drop("period").unionByName(fresh)


def split_readings(readings: DataFrame, path: str, lateness: str = "1 hour", every: str | None = None) -> StreamingQuery:
    """First reading per key with bounded state, and late readings kept apart and counted.

    A reading is late if it is older than the newest of earlier batches by more than ``lateness``. Timely ones are compared
    with the unique readings that are not older than that, so the state is what ``lateness`` holds. Of equal keys in one
    batch the least value, unit and flag come first. Tables: ``unique``, ``late`` and ``counts`` (rows, unique, late and
    duplicates per batch), each with a folder per batch that a replay overwrites.
    """

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        columns = [f.name for f in schemas.READINGS]
        earlier = split_table(spark, path, "counts").filter(F.col("batch") < number)
        horizon = earlier.agg((F.max("newest") - F.expr(f"INTERVAL {lateness}")).alias("h")).first()["h"]
        with session.scratch(spark):
            rows = session.materialise(batch.select(*columns), "split")
            late = F.lit(False) if horizon is None else F.coalesce(F.col("timestamp") < F.lit(horizon), F.lit(False))
            known = split_table(spark, path, "unique").filter(F.col("batch") < number)
            known = known if horizon is None else known.filter((F.col("timestamp") >= F.lit(horizon)) | F.col("timestamp").isNull())
            first = dedupe.one_per_key(rows.filter(~late), schemas.READING_KEY)
            unique = first.join(known, tables.same_key(first, known, schemas.READING_KEY), "left_anti")
            for name, df in (("unique", unique), ("late", rows.filter(late))):
                df.write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")
            written = {n: spark.read.schema(schemas.READINGS).parquet(f"{path}/{n}/batch={number}").count() for n in ("unique", "late")}
            counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.greatest(F.max("timestamp"), F.lit(horizon).cast("timestamp") + F.expr(f"INTERVAL {lateness}")).alias("newest"))
            counts = counts.select("newest", "rows", *[F.lit(v).cast("long").alias(n) for n, v in written.items()])
            counts.withColumn("duplicates", F.col("rows") - F.col("unique") - F.col("late")).write.mode("overwrite").parquet(f"{path}/counts/batch={number}")

    return _start(readings, handle, f"{path}_checkpoint", every)


_COUNTS = T.StructType([T.StructField("newest", T.TimestampType()), *[T.StructField(n, T.LongType()) for n in ("rows", "unique", "late", "duplicates")]])


def split_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """What :func:`split_readings` has written, with the number of the batch."""
    schema = _COUNTS if name == "counts" else schemas.READINGS
    return tables.read(spark, f"{path}/{name}", T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))


def minute_aggregate(readings: DataFrame, kind: str, lateness: str = "10 minutes") -> DataFrame:
    """The minute facts by natural key as readings arrive; a minute is final once ``lateness`` has passed."""
    window = F.window("timestamp", "1 minute").alias("window")
    grouped = MINUTES[kind](readings.withWatermark("timestamp", lateness), window)
    return grouped.select(F.col("window.start").alias("minute"), *[c for c in grouped.columns if c != "window"])

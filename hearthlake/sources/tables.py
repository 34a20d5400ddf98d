"""Stored tables: keyed upsert, insert-if-absent, truncate-and-load, CSV export."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthlake import session
from hearthlake.operators import dedupe
from hearthlake.sources import locks, publish


def _hadoop_path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was ever written at ``path``."""
    fs, hadoop = _hadoop_path(spark, path)
    return fs.exists(hadoop)


@contextlib.contextmanager
def writing(spark: SparkSession, path: str) -> Iterator[locks.Lock]:
    """One writer of a table at a time; whoever comes finishes what a dead one had decided."""
    with locks.held(spark, f"{path}.lock") as lock:
        publish.recover(spark, path)
        yield lock


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty one; the schema is always declared, never inferred."""
    if publish.pending(spark, path):
        with writing(spark, path):
            pass
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe key equality: two rows without a site or a model run are the same row."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def replace_partitions(df: DataFrame, path: str, partition_by: list[str], whole: bool = False, check: Callable[[], None] | None = None) -> None:
    """Replace exactly the partitions that occur in ``df``, or the ``whole`` table, which ``df`` may be derived from.

    Rows are written once and renamed into place. ``check`` is asked before, and may raise.
    """
    with writing(df.sparkSession, path) as lock:
        writer = publish.stage(df, path, partition_by)
        if check:
            check()
        lock.check()
        publish.commit(df.sparkSession, path, writer, partition_by, whole)


def touched_partitions(target: DataFrame, new: DataFrame, partition_by: str) -> DataFrame:
    """Rows of ``target`` in the partitions that ``new`` touches, that of the null value too; others are not read.

    The touched values are calendar periods, so there are no more of them than days.
    """
    values = [row[0] for row in new.select(partition_by).distinct().collect()]
    column = F.col(partition_by)
    known = column.isin([v for v in values if v is not None])
    return target.filter(known | column.isNull() if None in values else known)


def upsert(
    new: DataFrame,
    path: str,
    keys: list[str],
    partition_by: str,
    order_by: list[Column] | None = None,
    keep: str = "last",
    cluster_by: list[str] = (),
) -> None:
    """Merge ``new`` into the partitioned table at ``path``: one row per key, the new one winning.

    Within ``new`` the row that ``order_by`` puts first wins. ``order_by`` columns that are not stored belong in
    ``new`` as extra columns whose names start with ``_``. Re-running with the same input leaves the same table.
    Files are sorted by ``cluster_by``, so that filters on those columns skip row groups.

    Only the touched partitions are read and rewritten. ``new`` is written once to the shared folder, so the anti
    join against the stored rows broadcasts it when it is really small (a minute's worth of files) and sorts both
    sides when it is not (a backfill). Merged rows are written once, in a folder of this writer, and their partitions
    renamed into place with a journal (:mod:`publish`); writers of one table wait for each other.
    """
    spark = new.sparkSession
    stored = [name for name in new.columns if not name.startswith("_")]
    unique = dedupe.one_per_key(new, keys, order_by).select(*stored)

    def arranged(df: DataFrame) -> DataFrame:
        return df.sortWithinPartitions(partition_by, *cluster_by)

    with session.scratch(spark):
        batch = session.materialise(unique, "upsert_batch")
        with writing(spark, path) as lock:
            _merge(batch, path, keys, partition_by, keep, arranged, lock)


def _merge(
    batch: DataFrame, path: str, keys: list[str], partition_by: str, keep: str, arranged: Callable[[DataFrame], DataFrame], lock: locks.Lock
) -> None:
    spark, schema = batch.sparkSession, batch.schema
    existing = read(spark, path, schema)
    if keep == "first":
        fresh = batch.join(existing, same_key(batch, existing, keys), "left_anti")
        arranged(fresh.hint("rebalance", partition_by)).write.mode("append").partitionBy(partition_by).parquet(path)
        return
    old = touched_partitions(existing, batch, partition_by)
    kept = old.join(batch, same_key(old, batch, keys), "left_anti")
    merged = arranged(kept.unionByName(batch).hint("rebalance", partition_by))
    writer = publish.stage(merged, path, [partition_by])
    lock.check()
    publish.commit(spark, path, writer, [partition_by])


def insert_if_absent(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key ``existing`` does not hold, one per key."""
    distinct = dedupe.one_per_key(new, keys)
    return distinct.join(existing, same_key(distinct, existing, keys), "left_anti")


def recover_table(spark: SparkSession, path: str) -> bool:
    """Finish a change of the table that was decided by a writer who died."""
    if not publish.pending(spark, path):
        return False
    with writing(spark, path):
        return True


def truncate_and_load(df: DataFrame, path: str) -> None:
    """Replace a whole table, which ``df`` may be derived from. The new content is complete before the old goes."""
    replace_partitions(df, path, [], whole=True)


def _folder_name(column: str, value: date | None) -> str:
    return f"{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def append_by_period(df: DataFrame, path: str, period: str, most: int = 64) -> None:
    """Add rows to a table partitioned by the date column ``period``; a partition that has come to more than ``most`` files is packed.

    Only the partitions of ``df`` are looked at, and only the crowded ones among them are read. Their packed rows are staged
    and renamed into place. Writers of one table wait for each other.
    """
    spark = df.sparkSession
    periods = [row[0] for row in df.select(period).distinct().collect()]  # one value per calendar day at most
    if not periods:
        return
    with writing(spark, path) as lock:
        df.hint("rebalance", period).write.mode("append").partitionBy(period).parquet(path)
        folder = publish.Folder(spark, path)
        parts = [f"{path}/{_folder_name(period, value)}" for value in periods]
        crowded = [p for p in parts if sum(n.endswith(".parquet") for n in folder.names(p)) > most]
        if crowded:
            rows = spark.read.schema(df.schema).option("basePath", path).parquet(*crowded)
            writer = publish.stage(rows.hint("rebalance", period), path, [period])
            lock.check()
            publish.commit(spark, path, writer, [period])


def append(df: DataFrame, path: str, most: int = 64) -> None:
    """Add rows to a small unpartitioned table, and rewrite it whenever it has come to more than ``most`` files.

    Jobs that run every minute would otherwise leave a tiny file each time. Writers of one table wait for each other.
    """
    spark = df.sparkSession
    with writing(spark, path) as lock:
        df.write.mode("append").parquet(path)
        fs, hadoop = _hadoop_path(spark, path)
        if fs.getContentSummary(hadoop).getFileCount() > most:
            writer = publish.stage(spark.read.parquet(path).coalesce(max(1, most // 8)), path, [])
            lock.check()
            publish.commit(spark, path, writer, [], whole=True)


def rewrite(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace a whole table by rows derived from it; they are complete before the old ones go."""
    replace_partitions(df.hint("rebalance", *partition_by), path, partition_by, whole=True)


def export_csv(df: DataFrame, path: str, apartment: str | None = None) -> None:
    """Portable copy of a table, optionally of one apartment, as CSV with a header."""
    subset = df if apartment is None else df.filter(F.col("apartment") == apartment)
    subset.write.mode("overwrite").option("header", "true").csv(path)

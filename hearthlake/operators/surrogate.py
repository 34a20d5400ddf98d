"""Surrogate keys for dimension members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Members are numbered within hash buckets; the bucket table has at most 16 ** PREFIX rows whatever the data size.
PREFIX = 3


def bucket(*natural: str):
    """Fixed-size hash bucket of a natural key."""
    return F.substring(F.md5(F.concat_ws("|", *natural)), 1, PREFIX)


def number(members: DataFrame, natural: list[str], key: str, start: int = 0) -> DataFrame:
    """Add ``key`` = ``start`` + 1, 2, 3 … over distinct members, without sorting them all in one task.

    The number is the rank by (hash bucket, natural key). Buckets are ranked in parallel; only the at most 4096
    bucket sizes are added up in one place, and that many rows are safe to broadcast.
    """
    in_bucket = Window.partitionBy("__bucket").orderBy(*natural)
    ranked = members.withColumn("__bucket", bucket(*natural)).withColumn("__rank", F.row_number().over(in_bucket))
    sizes = ranked.groupBy("__bucket").agg(F.max("__rank").alias("__size"))
    running = F.sum("__size").over(Window.orderBy("__bucket"))
    offsets = sizes.select("__bucket", (running - F.col("__size")).alias("__offset"))
    numbered = ranked.join(F.broadcast(offsets), "__bucket")
    surrogate = (F.lit(start) + F.col("__offset") + F.col("__rank")).cast("bigint")
    return numbered.select(surrogate.alias(key), *members.columns)


def extend(members: DataFrame, existing: DataFrame | None, natural: list[str], key: str) -> DataFrame:
    """Existing dimension rows as they are, plus numbered rows for members not yet present."""
    if existing is None:
        return number(members, natural, key)
    new = members.join(existing.select(*natural), natural, "left_anti")
    highest = existing.agg(F.max(key)).first()[0] or 0
    return existing.unionByName(number(new, natural, key, start=highest), allowMissingColumns=True)


class KeyCollision(RuntimeError):
    """Two members of a dimension have one hash key."""


def hash_key(*natural: str) -> Column:
    """64 bits of a cryptographic hash of a natural key: the same on every run, without a look at other members.

    Parts are told apart by their lengths, and null from the empty string.
    """
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in natural]
    return F.conv(F.substring(F.sha2(F.concat(*parts), 256), 1, 15), 16, 10).cast("bigint")


def with_hash_keys(members: DataFrame, natural: list[str], key: str) -> DataFrame:
    """Distinct members with :func:`hash_key`, for dimensions too large to number densely; a collision aborts the load.

    The keys have 60 bits, so a billion members collide with a probability of about 0.4; the check costs one aggregation
    by key, and a dimension that fails it is numbered by :func:`number` instead.
    """
    keyed = members.dropDuplicates(natural).withColumn(key, hash_key(*natural))
    twice = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*natural)).alias("one"), F.max(F.struct(*natural)).alias("other")).filter("n > 1")
    found = twice.limit(1).collect()
    if found:
        raise KeyCollision(f"{key} {found[0][key]} stands for {found[0]['one'].asDict()} and {found[0]['other'].asDict()}")
    return keyed.select(key, *members.columns)

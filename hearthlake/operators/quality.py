"""Data-quality checks; each is one aggregate or one anti join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthlake.schemas import FOREIGN_KEYS, READING_LENGTHS, READING_REQUIRED


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def table_status(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, and whether it is ready or empty."""
    status = F.when(F.col("rows") > 0, "ready").otherwise("empty")
    return row_counts(tables).withColumn("status", status)


def violations(
    df: DataFrame, required: list[str] = READING_REQUIRED, lengths: dict[str, int] = READING_LENGTHS
) -> DataFrame:
    """Rows that break each not-null and length rule, in one pass; one output row per rule."""
    checks: list[tuple[str, Column]] = [(f"{c}_null", F.col(c).isNull()) for c in required]
    checks += [(f"{c}_too_long", F.length(c) > limit) for c, limit in lengths.items()]
    totals = df.agg(*[F.count_if(rule).alias(name) for name, rule in checks])
    return totals.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n, _ in checks]))
    )


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct non-null references of ``child`` without a row in ``parent``, and how many rows use each.

    References are counted before the join, so a value used by a third of the rows is one row there.
    """
    used = child.filter(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("reference"))
    parents = parent.select(F.col(parent_key).alias("reference"))
    return used.agg(F.count(F.lit(1)).alias("rows")).join(parents, "reference", "left_anti")


def orphan_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Orphan rows for every foreign key whose two tables are given.

    Each table is read once: its rows become (column, reference) pairs that are counted before anything moves, and all
    pairs of all tables meet the keys of all parents in one join.
    """
    checked = {
        table: [(column, parent, key) for column, parent, key in keys if parent in tables]
        for table, keys in FOREIGN_KEYS.items()
        if table in tables
    }
    used, known, names = [], [], []
    for table, keys in checked.items():
        if not keys:
            continue
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("reference"), F.lit(f"{p}.{k}").alias("parent")) for c, p, k in keys]))
        counted = tables[table].select(pairs.alias("r")).filter("r.reference IS NOT NULL").groupBy("r.column_name", "r.reference", "r.parent")
        used.append(counted.agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(table)))
        names += [(table, c) for c, _, _ in keys]
    for parent, key in sorted({(p, k) for keys in checked.values() for _, p, k in keys}):
        known.append(tables[parent].select(F.lit(f"{parent}.{key}").alias("parent"), F.col(key).cast("string").alias("reference")).distinct())
    orphaned = reduce(DataFrame.unionByName, used).join(reduce(DataFrame.unionByName, known), ["parent", "reference"], "left_anti")
    totals = orphaned.groupBy("table_name", "column_name").agg(F.sum("rows").alias("orphan_rows"))
    every = orphaned.sparkSession.createDataFrame(names, "table_name string, column_name string")
    return every.join(totals, ["table_name", "column_name"], "left").select(
        "table_name", "column_name", F.coalesce("orphan_rows", F.lit(0)).cast("bigint").alias("orphan_rows")
    )

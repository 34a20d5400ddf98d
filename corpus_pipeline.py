"""From raw documents to packed sequences: STAGES over the table documents, each stored and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hearthlake.llm import common, decontaminate, packing, similar, suffix, toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network does not call toxic."""
    scored = toxicity.score(docs, common.table(spark, sf_dir, "labels"))
    return scored.filter("predicted = 0").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar word shingles."""
    return similar.one_per_class(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that stand elsewhere too; a document that is nothing but such strings goes."""
    return suffix.cut_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, neighbours on the curve together."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

# The first stage is a trained network, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents; each works on what its predecessor stored."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The registered queries of these operators, and their SQL where it can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hearthlake.llm import blocks, chat, decontaminate, language, packing, quality, repair, rules, similar, suffix, toxicity, trie, wavelet
from hearthlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op2_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.classes(table(spark, sf_dir, "documents"))


@query
def op3_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_files(table(spark, sf_dir, "documents"))


@query
def op4_lyndon_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op5_fixed_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op6_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op7_edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


# A conversation made of control strings, which must come back unchanged.
MARKED = "</s>[INST] ok [/INST]"


@query
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = spark.range(2).selectExpr("-1L AS conv_id", "id AS turn", "IF(id = 0, 'user', 'assistant') AS role", f"'{MARKED}' AS text")
    return chat.digests(chat.format_chats(turns.unionByName(made)))


ORACLES["op9_chat_format"] = chat.sql(extra=f"UNION ALL SELECT -1, 0, 'user', '{MARKED}' UNION ALL SELECT -1, 1, 'assistant', '{MARKED}'")


@query
def op10_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op11_auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damaged(table(spark, sf_dir, "conversations")))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op13_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.score(table(spark, sf_dir, "documents"))

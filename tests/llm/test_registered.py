"""Registered queries on the smallest tables, and the pipeline's stages against plain versions of their decisions."""

import pathlib

import duckdb
import pytest

import corpus_pipeline
from hearthlake.llm import common, decontaminate, queries, suffix, toxicity
from tests.llm.helpers import byte_repeats, rows_of, similar

SF = pathlib.Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="needs the generated tables")


def test_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = db.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    found = queries.QUERIES[name](spark, str(SF))
    assert sorted(found.columns) == sorted(columns)
    assert rows_of(found, *columns) == sorted(map(tuple, want.fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op6_hilbert_packing", "op7_edit_decontamination", "op9_chat_format", "op11_auction_repair", "op12_prefix_trie"}))
def test_one_row_per_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows_of(queries.QUERIES[name](spark, str(SF)), "doc_id") == rows_of(docs, "doc_id")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = common.table(spark, str(SF), "labels")
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = common.materialise(stage(spark, docs, str(SF)), name)
        if name != "packing":
            assert out.columns == columns
            after = {r.doc_id: r.text for r in out.collect()}
        if name == "toxicity":
            assert set(after) == {r.doc_id for r in toxicity.score(docs, labels).collect() if not r.predicted}
        elif name == "near_copies":
            rows = sorted(before.items())
            want = similar(rows)
            assert set(after) == {d for n, (d, _) in enumerate(rows) if n not in want or n == min(want[n][0])}
        elif name == "suffix_dedup":
            removed = {d: n for d, _, n, _, _ in byte_repeats(list(before.items()), 200)}
            assert set(after) == {d for d, t in before.items() if removed[d] < len(t.encode())}
            assert all(after[d] == before[d] for d in after if not removed[d])
            assert all(len(after[d].encode()) <= len(before[d].encode()) - removed[d] for d in after)
        elif name == "decontamination":
            items = [decontaminate.normal(r.text) for r in common.table(spark, str(SF), "benchmark").collect()]
            leaked = {d for d, t in before.items() if any(i in decontaminate.normal(t) for i in items)}
            assert set(after) == set(before) - leaked
        else:
            assert {r.doc_id for r in out.collect()} == set(before)
        docs = out


def test_characters_cut_in_two_go(spark):
    docs = spark.createDataFrame([(1, "é" + "a" * 250 + "x"), (2, "è" + "a" * 250 + "y")], "doc_id long, text string")
    assert all("�" not in r.text for r in suffix.cut_repeats(docs).collect())

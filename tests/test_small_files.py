"""Folders of very many small files: one file per row, listed and read by few tasks, as Spark's own reader and writer would."""

import collections
import gzip
import os
import pathlib

import pytest

import __spark_entry__ as entry
from hearthlake import session
from hearthlake.sources import files, listing, sensors
from hearthlake.workload import silver_queries


def by_folder(root):
    """Lines of one file each, by the folder of the partition."""
    found = [p for p in pathlib.Path(root).rglob("*") if p.is_file() and p.suffix != ".crc" and not p.name.startswith("_")]
    return collections.Counter((p.parent.name, p.suffix, p.read_bytes()) for p in found)


ODD = [(1, "a", "x"), (2, "a", "x"), (3, None, "y/z=1%"), (4, "", None), (5, "ü\\", ""), (6, "b", "{[^]}'\"*?#:")]


@pytest.mark.parametrize("form", ["json", "text"])
def test_write_each_leaves_the_files_of_sparks_writer(spark, tmp_path, form):
    rows = spark.createDataFrame(ODD, "k long, value string, kind string").repartition(3)
    rows = rows.select("value", "kind") if form == "text" else rows
    getattr(rows.write.partitionBy("kind").option("maxRecordsPerFile", 1), form)(str(tmp_path / "spark"))
    files.write_each(rows, str(tmp_path / "own"), "kind", form)
    assert by_folder(tmp_path / "own") == by_folder(tmp_path / "spark")
    assert sum(by_folder(tmp_path / "own").values()) == len(ODD)
    assert all(name.startswith("part-") for name in os.listdir(tmp_path / "own"))
    with pytest.raises(FileExistsError):
        files.write_each(rows, str(tmp_path / "own"), "kind", form)


def test_write_each_without_rows(spark, tmp_path):
    files.write_each(spark.createDataFrame([], "value string, kind string"), str(tmp_path / "none"), "kind", "text")
    assert listing.list_files(spark, str(tmp_path / "none")).count() == 0


def test_write_each_cleans_up_after_a_failure(spark, tmp_path):
    rows = spark.range(10).selectExpr("if(id = 7, string(raise_error('no')), string(id)) AS value", "'k' AS kind")
    with pytest.raises(Exception, match="no"):
        files.write_each(rows, str(tmp_path / "out"), "kind", "text")
    assert not (tmp_path / "out").exists()


def odd_tree(root):
    names = "a.json b.json.gz c.JSON _h.json _k=1.json .d.json e.json._COPYING_ _metadata.json q.jsonx deep/er/ü.json"
    names = [*names.split(), "sp ace/x y%20z#.json", "_tmp/a.json", "_tmp=1/a.json", ".dot/a.json", "deep/e{r}/[1].json"]
    for name in names:
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(gzip.compress(b"packed") if name.endswith(".gz") else name.encode() + b"\n")
    (root / "empty.json").touch()
    (root / "bad.json").write_bytes(b"\xff\xfe\xff")
    (root / "cut.json.gz").write_bytes(gzip.compress(b"one two three")[:12])
    (root / "link.json").symlink_to(root / "a.json")
    (root / "dead.json").symlink_to(root / "nowhere")
    (root / "linked").symlink_to(root / "deep")
    os.utime(root / "a.json", ns=(10**18 + 123456789, 10**18 + 123456789))


@pytest.mark.parametrize("glob", [sensors.PAYLOAD_GLOB, "*", "[ab]*.json"])
@pytest.mark.parametrize("below", [["."], ["deep", "."], ["*"], ["a.json", "deep"], ["{a,q}.json*"]])
def test_listing_is_that_of_sparks_file_source(spark, tmp_path, glob, below):
    odd_tree(tmp_path)
    paths = [f"{tmp_path}/{b}" for b in below]
    own, theirs = files.listed_files(spark, paths, glob), files.open_files(spark, paths, glob).drop("content")
    assert own.schema == theirs.schema
    assert sorted(own.collect()) == sorted(theirs.collect())


def test_a_path_that_is_missing_and_another_file_system(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        listing.list_files(spark, str(tmp_path / "none"))
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.small.link./in", f"file://{tmp_path}")
    rows = spark.createDataFrame(ODD, "k long, value string, kind string").select("value", "kind")
    files.write_each(rows, "viewfs://small/in/text", "kind", "text")
    assert listing.list_files(spark, "viewfs://small/in/text", "*.txt").count() == len(ODD)


def test_a_listing_stays_as_it_was(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}")
    listed = listing.list_files(spark, str(tmp_path))
    (tmp_path / "b.json").write_text("{}")
    assert [r.name for r in listed.collect()] == ["a.json"] == [r.name for r in listed.collect()]


@pytest.fixture
def small_shares(spark):
    """So much in a task, for which Spark's file source would count one file as 4 MB more."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_small_files_share_a_task(spark, tmp_path, small_shares):
    for i in range(100):
        (tmp_path / f"{i}.json").write_text(f'{{"i": {i}}}')
    (tmp_path / "large.json").write_text("x" * 5 * 2**20)
    listed = listing.list_files(spark, str(tmp_path))
    assert listed.rdd.getNumPartitions() <= 16
    assert sorted(r.bytes for r in listed.collect())[-1] == 5 * 2**20
    assert listed.count() == 101


def customers(spark, folder):
    rows = [(i, f"Customer {i}" if i % 9 else None, i / 4 if i % 7 else None) for i in range(120)] * 2
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_acctbal double").write.parquet(f"{folder}/customer.parquet")
    return rows


def test_bronze_footprint_writes_one_file_per_customer(spark, tmp_path, monkeypatch):
    rows = customers(spark, tmp_path)
    monkeypatch.setattr(session, "new_path", lambda spark, name: str(tmp_path / name))
    found = {r.source: (r.files, r.bytes) for r in silver_queries.bronze_footprint(spark, str(tmp_path)).collect()}
    expected = {f"src{k}": [r for r in rows if r[0] % 3 == k] for k in range(3)}
    assert found == {k: (len(v), sum(len(r[1] or "") + 1 for r in v)) for k, v in expected.items()}
    written = by_folder(tmp_path / "landing")
    assert written == collections.Counter((f"source=src{r[0] % 3}", ".txt", f"{r[1] or ''}\n".encode()) for r in rows)
    assert not list((tmp_path / "landing").rglob("*.crc"))  # no process per file, which Hadoop's client would start
    assert "bronze_footprint" in entry.queries()


@pytest.mark.parametrize("glob", [sensors.PAYLOAD_GLOB, "*"])
@pytest.mark.parametrize("most", [(4 * 2**20, 1000), (8, 3)])
def test_texts_are_those_of_sparks_file_source(spark, tmp_path, glob, most, monkeypatch):
    monkeypatch.setattr(files, "BATCH_BYTES", most[0])
    monkeypatch.setattr(files, "BATCH_FILES", most[1])
    odd_tree(tmp_path)
    own, theirs = files.read_text_files(spark, str(tmp_path), glob), files.texts(files.open_files(spark, str(tmp_path), glob))
    assert own.schema == theirs.schema
    assert sorted(own.collect(), key=str) == sorted(theirs.collect(), key=str)
    assert {r.file_error for r in own.collect()} == {None, "not UTF-8 text", "truncated gzip file"}


def test_small_files_are_read_by_few_tasks(spark, tmp_path, small_shares):
    for i in range(100):
        (tmp_path / f"{i}.json").write_text(f'{{"i": {i}}}')
    read = sensors.read_sensor_files(spark, str(tmp_path))
    assert read.rdd.getNumPartitions() <= 16
    assert {(r.name, r.value) for r in read.collect()} == {(f"{i}.json", f'{{"i": {i}}}') for i in range(100)}


def test_another_file_system_is_read_by_spark(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}")
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.texts.link./in", f"file://{tmp_path}")
    assert [(r.path, r.value) for r in sensors.read_sensor_files(spark, "viewfs://texts/in").collect()] == [("viewfs://texts/in/a.json", "{}")]


def test_sensor_json_scan_writes_one_file_per_customer(spark, tmp_path, monkeypatch):
    rows = customers(spark, tmp_path)
    monkeypatch.setattr(session, "new_path", lambda spark, name: str(tmp_path / name))
    found = {r.apartment: (r.files, r.total) for r in silver_queries.sensor_json_scan(spark, str(tmp_path)).collect()}
    expected = {f"apt_{a}": [r for r in rows if r[0] % 2 == k] for k, a in enumerate("ab")}
    assert found == {k: (len(v), sum(int(r[2] * 100) for r in v if r[2] is not None)) for k, v in expected.items()}
    written = by_folder(tmp_path / "json_files")
    assert sum(written.values()) == len(rows)
    assert written[("apartment=apt_b", ".json", b'{"reading":{"c_custkey":1,"value":0.25}}\n')] == 2
    assert written[("apartment=apt_b", ".json", b'{"reading":{"c_custkey":7}}\n')] == 2
    assert not list((tmp_path / "json_files").rglob("*.crc"))

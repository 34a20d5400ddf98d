from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hearthlake import schemas
from hearthlake.operators import dedupe, surrogate
from hearthlake.sources import publish, tables

SCHEMA = "site string, run int, value double, period date"
DAY1, DAY2 = date(2024, 1, 1), date(2024, 1, 2)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def stored(spark, path):
    return sorted(map(tuple, tables.read(spark, path, frame(spark, []).schema).collect()), key=str)


def test_upsert_last_wins_and_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    first = frame(spark, [("a", 1, 1.0, DAY1), ("b", 1, 2.0, DAY1), ("c", 1, 3.0, DAY2)])
    second = frame(spark, [("a", 1, 9.0, DAY1), ("d", 1, 4.0, DAY1)])
    tables.upsert(first, path, ["site", "run"], "period")
    for _ in range(3):
        tables.upsert(second, path, ["site", "run"], "period")
        assert stored(spark, path) == [
            ("a", 1, 9.0, DAY1), ("b", 1, 2.0, DAY1), ("c", 1, 3.0, DAY2), ("d", 1, 4.0, DAY1),
        ]


def test_null_keys_are_one_row(spark, tmp_path):
    path = str(tmp_path / "t")
    for value in (1.0, 2.0):
        tables.upsert(frame(spark, [(None, None, value, DAY1), ("a", None, value, DAY1)]), path, ["site", "run"], "period")
    assert stored(spark, path) == [("a", None, 2.0, DAY1), (None, None, 2.0, DAY1)]


def test_keep_first_leaves_stored_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(frame(spark, [("a", 1, 1.0, DAY1)]), path, ["site", "run"], "period", keep="first")
    tables.upsert(frame(spark, [("a", 1, 2.0, DAY1), ("b", 1, 2.0, DAY1)]), path, ["site", "run"], "period", keep="first")
    assert stored(spark, path) == [("a", 1, 1.0, DAY1), ("b", 1, 2.0, DAY1)]


def test_batches_and_one_batch_agree(spark, tmp_path):
    rows = [(f"s{i % 7}", i % 3, float(i), date(2024, 1, 1 + (i % 7) % 3)) for i in range(60)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA + ", _n int")
    order = [F.desc("_n")]
    tables.upsert(df, str(tmp_path / "one"), ["site", "run"], "period", order)
    for low in range(0, 60, 20):
        part = df.filter(F.col("_n").between(low, low + 19))
        tables.upsert(part, str(tmp_path / "many"), ["site", "run"], "period", order)
    assert stored(spark, str(tmp_path / "one")) == stored(spark, str(tmp_path / "many"))


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    path = tmp_path / "t"
    tables.upsert(frame(spark, [("a", 1, 1.0, DAY1), ("c", 1, 3.0, DAY2)]), str(path), ["site", "run"], "period")
    before = {p: p.stat().st_mtime_ns for p in path.glob("period=2024-01-02/*.parquet")}
    tables.upsert(frame(spark, [("a", 1, 5.0, DAY1)]), str(path), ["site", "run"], "period")
    assert {p: p.stat().st_mtime_ns for p in path.glob("period=2024-01-02/*.parquet")} == before


def test_many_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("a", 1, 1.0, DAY1), ("c", 1, 3.0, DAY2)]
    tables.upsert(frame(spark, rows), path, ["site", "run"], "period")
    tables.upsert(frame(spark, [("a", 1, 7.0, DAY1), ("c", 1, 8.0, DAY2)]), path, ["site", "run"], "period")
    assert stored(spark, path) == [("a", 1, 7.0, DAY1), ("c", 1, 8.0, DAY2)]


def test_rows_of_a_null_period_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    for row in (("a", 1, 1.0, None), ("b", 1, 2.0, None), ("c", 1, 3.0, DAY1), ("a", 1, 4.0, None)):
        tables.upsert(frame(spark, [row]), path, ["site", "run"], "period")
    assert stored(spark, path) == [("a", 1, 4.0, None), ("b", 1, 2.0, None), ("c", 1, 3.0, DAY1)]


def test_interrupted_publication_is_finished(spark, monkeypatch, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(frame(spark, [("a", 1, 1.0, DAY1), ("b", 1, 2.0, DAY1)]), path, ["site", "run"], "period")
    # the merge was staged and decided, then the driver died after the old partition had been moved away
    staged = frame(spark, [("a", 1, 9.0, DAY1), ("b", 1, 2.0, DAY1)])
    writer = publish.stage(staged, path, ["period"])
    with pytest.raises(RuntimeError):
        with monkeypatch.context() as m:
            steps = iter([publish.Folder.rename] * 2)

            def rename(self, old, new):
                step = next(steps, None)
                if step is None:
                    raise RuntimeError("killed")
                step(self, old, new)

            m.setattr(publish.Folder, "rename", rename)
            publish.commit(spark, path, writer, ["period"])
    tables.upsert(frame(spark, [("z", 1, 0.0, DAY2)]), path, ["site", "run"], "period")
    assert stored(spark, path) == [("a", 1, 9.0, DAY1), ("b", 1, 2.0, DAY1), ("z", 1, 0.0, DAY2)]
    assert publish.Folder(spark, path).names(f"{path}.staged") == []


def test_truncate_and_load_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.truncate_and_load(spark.range(5).toDF("n"), path)
    tables.truncate_and_load(spark.read.parquet(path).filter("n > 2"), path)
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [3, 4]


def test_many_small_appends_stay_few_files(spark, tmp_path):
    path = tmp_path / "t"
    for n in range(20):
        tables.append(spark.range(n, n + 1).toDF("n").coalesce(1), str(path), most=6)
        assert len([f for f in path.iterdir() if not f.name.startswith(".")]) <= 7
    assert sorted(r.n for r in spark.read.parquet(str(path)).collect()) == list(range(20))


def test_insert_if_absent(spark):
    new = frame(spark, [("a", 1, 1.0, DAY1), ("a", 1, 2.0, DAY1), (None, 1, 1.0, DAY1), ("b", 1, 1.0, DAY1)])
    old = frame(spark, [("b", 1, 0.0, DAY1), (None, 1, 0.0, DAY1)])
    assert [r.site for r in tables.insert_if_absent(new, old, ["site", "run"]).collect()] == ["a"]


def test_export_of_one_apartment(spark, tmp_path):
    df = spark.createDataFrame([("apt_a", 1.5), ("apt_b", 2.5)], "apartment string, value double")
    tables.export_csv(df, str(tmp_path / "x"), "apt_b")
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "x")).collect()] == [("apt_b", "2.5")]


def test_missing_table_reads_as_empty(spark, tmp_path):
    assert tables.read(spark, str(tmp_path / "none"), schemas.READINGS).count() == 0


def test_one_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    kept = dedupe.one_per_key(df, ["k"], [F.desc("v")])
    assert sorted(tuple(r) for r in kept.collect()) == [(0, 999), (1, 997), (2, 998)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    shuffle, partial = plan.index("Exchange hashpartitioning"), plan.index("Partial", plan.index("WindowGroupLimit"))
    assert partial > shuffle  # printed below the exchange, so it runs before it


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(k, i) for i, k in enumerate("aaabbcdddd")], "k string, v int")
    assert dedupe.duplicate_key_count(df, ["k"]).first()[0] == 3
    assert [tuple(r) for r in dedupe.top_duplicate_keys(df, ["k"], 2).collect()] == [("d", 4), ("a", 3)]


def test_surrogates_are_dense_and_stable(spark):
    def members(names):
        return spark.createDataFrame([(n,) for n in names], "name string")

    names = [f"m{i}" for i in range(300)]
    first = surrogate.extend(members(names[:200]), None, ["name"], "key").cache()
    assert sorted(r.key for r in first.collect()) == list(range(1, 201))
    second = surrogate.extend(members(names), first, ["name"], "key")
    keys = {r.name: r.key for r in second.collect()}
    assert sorted(keys.values()) == list(range(1, 301))
    assert all(keys[r.name] == r.key for r in first.collect())
    again = {r.name: r.key for r in surrogate.number(members(names[:200]).repartition(7), ["name"], "key").collect()}
    assert again == {r.name: r.key for r in first.collect()}


def test_timestamps_are_utc(spark):
    (r,) = spark.sql("select timestamp'2024-01-01 00:00:00' t").collect()
    assert r.t == datetime(2024, 1, 1)

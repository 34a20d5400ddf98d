"""Locks under contention, and publication that is interrupted after any step."""

import os
import threading
import time
from datetime import date

import pytest

from hearthlake.sources import locks, publish, tables

SCHEMA = "site string, value double, period date"
DAYS = [date(2024, 1, d) for d in (1, 2, 3)]


def test_never_two_holders(spark, tmp_path):
    for pair in range(30):
        folder, inside, most, failed = str(tmp_path / f"lock{pair}"), [], [], []

        def work():
            try:
                with locks.held(spark, folder):
                    inside.append(1)
                    most.append(len(inside))
                    time.sleep(0.005)
                    inside.pop()
            except Exception as error:  # noqa: BLE001
                failed.append(error)

        jobs = [threading.Thread(target=work) for _ in range(2)]
        for job in jobs:
            job.start()
        for job in jobs:
            job.join()
        assert not failed and most == [1, 1]


def test_a_dead_holder_is_overtaken_once_and_notices(spark, tmp_path):
    folder = tmp_path / "lock"
    dead = locks.Lock(spark, str(folder), lease=2)
    assert dead.try_acquire()
    dead._stop.set()
    assert not locks.Lock(spark, str(folder), lease=2).try_acquire()
    os.utime(folder / f"{dead.number:012d}", (0, 0))
    others = [locks.Lock(spark, str(folder), lease=2) for _ in range(4)]
    taken = []
    jobs = [threading.Thread(target=lambda o=o: taken.append(o.try_acquire())) for o in others]
    for job in jobs:
        job.start()
    for job in jobs:
        job.join()
    assert sum(taken) == 1
    with pytest.raises(locks.LockLost):
        dead.check()
    dead.release()  # leaves the new holder alone
    assert not locks.Lock(spark, str(folder), lease=2).try_acquire()


def test_a_long_job_keeps_its_lock(spark, tmp_path):
    with locks.held(spark, str(tmp_path / "lock"), lease=1) as lock:
        time.sleep(2.5)
        assert not locks.Lock(spark, str(tmp_path / "lock"), lease=1).try_acquire()
        lock.check()


def rows(spark, path):
    return sorted(map(tuple, tables.read(spark, path, spark.createDataFrame([], SCHEMA).schema).collect()))


class Killed(RuntimeError):
    pass


@pytest.mark.parametrize("kind", ["upsert", "rewrite", "truncate_and_load"])
def test_a_kill_after_any_step_loses_nothing(spark, monkeypatch, tmp_path, kind):
    before = [("a", 1.0, DAYS[0]), ("b", 2.0, DAYS[1]), ("c", 3.0, DAYS[2])]
    after = {
        "upsert": [("a", 9.0, DAYS[0]), ("b", 8.0, DAYS[1]), ("c", 3.0, DAYS[2])],
        "rewrite": [("b", 2.0, DAYS[1])],
        "truncate_and_load": [("n", 0.0, DAYS[0])],
    }[kind]
    seen = set()
    for step in range(0, 60, 3):
        path = str(tmp_path / f"{kind}{step}")
        df = spark.createDataFrame(before, SCHEMA)
        if kind == "truncate_and_load":
            tables.truncate_and_load(df, path)
        else:
            tables.upsert(df, path, ["site"], "period")
        left = [step]
        with monkeypatch.context() as m:
            for name in ("rename", "delete", "write"):

                def counted(self, *args, do=getattr(publish.Folder, name)):
                    left[0] -= 1
                    if left[0] < 0:
                        raise Killed
                    return do(self, *args)

                m.setattr(publish.Folder, name, counted)
            try:
                if kind == "upsert":
                    tables.upsert(spark.createDataFrame(after[:2], SCHEMA), path, ["site"], "period")
                elif kind == "rewrite":
                    tables.rewrite(spark.read.schema(SCHEMA).parquet(path).filter("site = 'b'"), path, ["period"])
                else:
                    tables.truncate_and_load(spark.createDataFrame(after, SCHEMA), path)
                finished = True
            except Killed:
                finished = False
        found = rows(spark, path)  # reading finishes what was decided
        assert found in (before, after) and (found == after or not finished)
        seen.add(found == after)
        if finished:
            break
    assert finished and seen == {False, True}


def test_two_upserts_side_by_side(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert(spark.createDataFrame([("a", 0.0, DAYS[0])], SCHEMA), path, ["site"], "period")
    failed = []

    def work(k):
        try:
            for i in range(3):
                tables.upsert(spark.createDataFrame([(f"s{k}-{i}", 1.0, DAYS[0])], SCHEMA), path, ["site"], "period")
                tables.append(spark.createDataFrame([(f"s{k}-{i}", 1.0, DAYS[0])], SCHEMA), f"{path}_small", most=2)
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    jobs = [threading.Thread(target=work, args=(k,)) for k in range(2)]
    for job in jobs:
        job.start()
    for job in jobs:
        job.join()
    assert not failed
    assert len(rows(spark, path)) == 7 and len(rows(spark, f"{path}_small")) == 6

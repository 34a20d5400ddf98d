"""A lock on a folder of tables: one holder at a time, renewed while its job lives, with a number to check before publishing."""

from __future__ import annotations

import contextlib
import threading
import time
from collections.abc import Iterator

from pyspark.sql import SparkSession

# A holder that has not renewed its lock for so long is taken for dead; it renews five times as often.
LEASE_SECONDS = 120.0


class LockLost(RuntimeError):
    """The lock went to another job, because this one did not renew it in time."""


class Lock:
    """Numbered files in a folder; the highest number holds until its ``.done`` file is there.

    A number is taken by creating its file, which fails where it exists: file systems such as HDFS promise that, and the
    local one does so for plain files. A dead holder is overtaken by the next number, never by removing its file, so two
    jobs that find it dead cannot both succeed. Clocks may differ by less than the lease.
    """

    def __init__(self, spark: SparkSession, folder: str, lease: float = LEASE_SECONDS):
        self.spark, self.lease = spark, lease
        self.root = spark._jvm.org.apache.hadoop.fs.Path(folder)
        self.fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())
        self.number = 0
        self._stop = threading.Event()

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(self.root, name)

    def _entries(self) -> dict[str, float]:
        try:
            return {s.getPath().getName(): s.getModificationTime() / 1000 for s in self.fs.listStatus(self.root)}
        except Exception as error:
            if "FileNotFound" in str(error):
                return {}
            raise

    def _create(self, number: int) -> bool:
        path = self._path(f"{number:012d}")
        if self.fs.getUri().getScheme() == "file":
            return self.spark._jvm.java.io.File(path.toUri().getPath()).createNewFile()
        try:
            self.fs.create(path, False).close()
        except Exception as error:
            if "AlreadyExists" in str(error):
                return False
            raise
        return True

    def _top(self) -> int:
        return max((int(n) for n in self._entries() if n.isdigit()), default=0)

    def try_acquire(self) -> bool:
        self.fs.mkdirs(self.root)
        entries = self._entries()
        top = max((int(n) for n in entries if n.isdigit()), default=0)
        held = top and f"{top:012d}.done" not in entries
        if held and time.time() - entries[f"{top:012d}"] < self.lease:
            return False
        if not self._create(top + 1):
            return False
        # A number below one that exists by now was free only because old files are removed.
        if self._top() != top + 1:
            self.fs.delete(self._path(f"{top + 1:012d}"), False)
            return False
        self.number = top + 1
        for name in entries:
            if name.split(".")[0].isdigit() and int(name.split(".")[0]) < top:
                self.fs.delete(self._path(name), False)
        self._stop.clear()
        threading.Thread(target=self._renew, daemon=True).start()
        return True

    def _renew(self) -> None:
        while not self._stop.wait(self.lease / 5):
            with contextlib.suppress(Exception):  # the next round tries again; check() finds a lock that was lost
                if self._top() == self.number:
                    self.fs.setTimes(self._path(f"{self.number:012d}"), int(time.time() * 1000), -1)

    def acquire(self, pause: float = 0.2) -> None:
        while not self.try_acquire():
            time.sleep(pause)

    def check(self) -> None:
        """Raise if another job holds the lock by now."""
        if self._top() != self.number:
            raise LockLost(f"{self.root.toString()}: number {self.number} was overtaken")

    def release(self) -> None:
        self._stop.set()
        if self._top() == self.number:
            self.fs.create(self._path(f"{self.number:012d}.done"), True).close()


@contextlib.contextmanager
def held(spark: SparkSession, folder: str, lease: float = LEASE_SECONDS) -> Iterator[Lock]:
    """Wait for the lock, hold it inside the block."""
    lock = Lock(spark, folder, lease)
    lock.acquire()
    try:
        yield lock
    finally:
        lock.release()

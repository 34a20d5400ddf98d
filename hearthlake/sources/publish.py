"""Publication of staged tables by renaming, with a journal that a later run finishes.

A writer stages complete data in a folder of its own beside the table. One journal file, itself renamed into place, says
which partitions go and which come; from then on the change will happen, whoever finishes it. Every step can be
repeated: an old partition moves to the writer's trash, the staged one to its place.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class Folder:
    """File operations on one file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.fs = self.path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def names(self, path: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(path))) if self.exists(path) else []

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)

    def rename(self, old: str, new: str) -> None:
        self.fs.mkdirs(self.path(new).getParent())
        if not self.fs.rename(self.path(old), self.path(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def write(self, path: str, text: str) -> None:
        out = self.fs.create(self.path(path), True)
        try:
            out.write(text.encode())
        finally:
            out.close()

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def partitions(self, path: str, depth: int) -> list[str]:
        """Folders ``a=1/b=2`` below a table, ``depth`` levels deep."""
        found = [""]
        for _ in range(depth):
            found = [f"{p}/{n}".lstrip("/") for p in found for n in self.names(f"{path}/{p}") if "=" in n]
        return found


def _siblings(path: str) -> tuple[str, str, str]:
    return f"{path}.staged", f"{path}.journal", f"{path}.trash"


def stage(df: DataFrame, path: str, partition_by: list[str]) -> str:
    """Write ``df`` in a new folder beside the table; returns the writer's name for :func:`commit`."""
    writer = uuid.uuid4().hex
    out = df.write.partitionBy(*partition_by) if partition_by else df.write
    out.parquet(f"{_siblings(path)[0]}/{writer}")
    return writer


def commit(spark: SparkSession, path: str, writer: str, partition_by: list[str], whole: bool = False) -> None:
    """Make what ``writer`` staged part of the table: its partitions replace those of the same name, or ``whole`` the table."""
    folder = Folder(spark, path)
    staged, journal, _ = _siblings(path)
    come = folder.partitions(f"{staged}/{writer}", len(partition_by))
    go = [p for p in folder.partitions(path, len(partition_by)) if p not in come] if whole and partition_by else []
    folder.write(f"{journal}/_{writer}", json.dumps({"come": come, "go": go}))
    folder.rename(f"{journal}/_{writer}", f"{journal}/{writer}")
    _apply(folder, path, writer)


def _apply(folder: Folder, path: str, writer: str) -> None:
    staged, journal, trash = _siblings(path)
    plan = json.loads(folder.read(f"{journal}/{writer}"))

    def away(part: str) -> None:
        folder.rename(f"{path}/{part}".rstrip("/"), f"{trash}/{writer}/{uuid.uuid4().hex}/{part}".rstrip("/"))

    for part in plan["come"]:
        new, old = f"{staged}/{writer}/{part}".rstrip("/"), f"{path}/{part}".rstrip("/")
        if not folder.exists(new):
            continue  # it is in its place already
        if folder.exists(old):
            away(part)
        folder.rename(new, old)
    for part in plan["go"]:
        if folder.exists(f"{path}/{part}"):
            away(part)
    if not folder.exists(f"{path}/_SUCCESS"):
        folder.write(f"{path}/_SUCCESS", "")
    folder.delete(f"{staged}/{writer}")
    folder.delete(f"{trash}/{writer}")
    folder.delete(f"{journal}/{writer}")


def pending(spark: SparkSession, path: str) -> list[str]:
    """Writers whose change of the table was decided but not finished."""
    return [n for n in Folder(spark, path).names(_siblings(path)[1]) if not n.startswith(("_", "."))]


def recover(spark: SparkSession, path: str) -> bool:
    """Finish decided changes, and drop what was staged but never decided. Only for the holder of the table's lock."""
    folder, (staged, journal, trash) = Folder(spark, path), _siblings(path)
    writers = pending(spark, path)
    for writer in writers:
        _apply(folder, path, writer)
    for left in (staged, journal, trash):
        for name in folder.names(left):
            folder.delete(f"{left}/{name}")
    return bool(writers)

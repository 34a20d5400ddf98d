"""Text files as rows, where a file that cannot be read is a row with its reason."""

from __future__ import annotations

import contextlib
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.sources import publish

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
TEXT_SCHEMA = "path string, name string, modified timestamp, value string, file_error string"
# The file source forgets files that are older than the newest one by this much and would then skip them in silence.
# Copies keep their old modification times, so no age may be too old.
MAX_FILE_AGE = "36500d"
# What opening a small file takes, as bytes that could be read meanwhile.
OPEN_COST = 64 * 1024
# A batch of texts ends at so many bytes or files, so that no task holds more than that and one file.
BATCH_BYTES, BATCH_FILES = 4 * 2**20, 1000


def decode(name: str, content: bytes) -> tuple[str | None, str | None]:
    """Text of a file, unpacked if its name ends in ``.gz``; or None and why it cannot be read."""
    try:
        if name.endswith(".gz"):
            parts = []
            while content:
                unpacker = zlib.decompressobj(wbits=31)
                parts.append(unpacker.decompress(content))
                if not unpacker.eof:
                    return None, "truncated gzip file"
                content = unpacker.unused_data
            content = b"".join(parts)
        return content.decode("utf-8-sig"), None
    except zlib.error as error:
        return None, f"broken gzip file: {error}"
    except UnicodeDecodeError:
        return None, "not UTF-8 text"


def texts(files: DataFrame) -> DataFrame:
    """One row (path, name, modified, value, file_error) per file of a frame of :data:`FILE_SCHEMA`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            names = [p.rsplit("/", 1)[-1] for p in paths]
            for i, name in enumerate(names):
                value, error = decode(name, batch.column("content")[i].as_py() or b"")
                columns = [[paths[i]], [name], batch.column("modificationTime").slice(i, 1), [value], [error]]
                types = [pa.string(), pa.string(), None, pa.string(), pa.string()]
                arrays = [c if t is None else pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["path", "name", "modified", "value", "file_error"])

    return files.select("path", "modificationTime", "content").mapInArrow(run, TEXT_SCHEMA)


def open_files(spark: SparkSession, paths: str | list[str], glob: str) -> DataFrame:
    """Matching files below ``paths`` as :data:`FILE_SCHEMA`, listed once however often the frame is used."""
    reader = spark.read.schema(FILE_SCHEMA).format("binaryFile").option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", glob).load(paths)


def local_roots(spark: SparkSession, paths: str | list[str]) -> list[str] | None:
    """Folders and files that ``paths`` name on a local or mounted file system; None if Spark's own reader has to find them."""
    if any(spark.conf.get(f"spark.sql.files.{k}", "false") == "true" for k in ("ignoreMissingFiles", "ignoreCorruptFiles")):
        return None
    roots = []
    for path in [paths] if isinstance(paths, str) else paths:
        folder = publish.Folder(spark, path)
        found = folder.fs.getUri().getScheme() == "file" and folder.fs.globStatus(folder.path(path))
        if not found:
            return None
        roots += [status.getPath().toUri().getPath() for status in found]
    return roots or None


def _hidden(name: str) -> bool:
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def _found(name: str, path: str, wanted: re.Pattern) -> Iterator[tuple[str, int, int]]:
    if wanted.fullmatch(name) and (not name.startswith("_") or "=" in name):
        with contextlib.suppress(FileNotFoundError):  # gone meanwhile, or a link to nothing
            stat = os.stat(path)
            if stat.st_size:
                yield path, stat.st_mtime_ns // 10**6, stat.st_size


def local_files(roots: list[str], wanted: re.Pattern) -> Iterator[tuple[str, int, int]]:
    """(path, modification time in ms, length) of the files below ``roots`` that Spark's file source would find."""
    folders, seen = [r for r in roots if os.path.isdir(r)], set()
    for root in sorted(set(roots).difference(folders)):
        if not _hidden(name := os.path.basename(root)) and not any(root.startswith(f"{f.rstrip('/')}/") for f in folders):
            yield from _found(name, root, wanted)
    while folders:
        if (folder := folders.pop()) in seen:
            continue
        seen.add(folder)
        with os.scandir(folder) as entries:
            for entry in entries:
                if not _hidden(entry.name):
                    if entry.is_dir():
                        folders.append(entry.path)
                    else:
                        yield from _found(entry.name, entry.path, wanted)


def shares(spark: SparkSession, roots: list[str], glob: str) -> tuple[str, DataFrame]:
    """The files below ``roots``, listed once: a folder above them all, and a row per task with the files it has to do.

    Spark's file source keeps about a kilobyte per file in the driver and counts every file as 4 MB more, so that a task gets
    a handful. Here a file is its name below that folder and two numbers, and counts as :data:`OPEN_COST` bytes more.
    """
    wanted = re.compile(spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern(), re.DOTALL)
    base = os.path.join(os.path.commonpath([os.path.dirname(r) for r in roots]), "")
    names, held, modified, lengths = [], [], array("q"), array("q")
    for path, at, length in local_files(roots, wanted):
        held.append(path[len(base) :])
        modified.append(at)
        lengths.append(length)
        if len(held) == 100_000:  # Arrow holds them in less
            names.append(pa.array(held, pa.string()))
            held = []
    names.append(pa.array(held, pa.string()))
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    even = (sum(lengths) + OPEN_COST * len(lengths)) // spark.sparkContext.defaultParallelism
    starts, size, share = [], 0, min(most, max(even, 2**20))
    for i, length in enumerate(lengths):
        if not starts or size + length + OPEN_COST > share:
            starts.append(i)
            size = 0
        size += length + OPEN_COST
    offsets = pa.array([*starts, len(lengths)], pa.int32())
    columns = {"names": pa.concat_arrays(names), "modified": pa.array(modified, pa.int64()), "lengths": pa.array(lengths, pa.int64())}
    dealt = pa.table({k: pa.ListArray.from_arrays(offsets, v) for k, v in columns.items()})
    return base, spark.createDataFrame(dealt).repartition(max(1, len(starts)))


def listed_files(spark: SparkSession, paths: str | list[str], glob: str) -> DataFrame:
    """Matching files below ``paths`` as :data:`FILE_SCHEMA` without contents, listed once however often the frame is used."""
    roots = local_roots(spark, paths)
    if roots is None:
        return open_files(spark, paths, glob).drop("content")
    base, dealt = shares(spark, roots, glob)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            path = pc.binary_join_element_wise(f"file:{base}", batch.column("names").flatten(), "")
            modified = pc.multiply(batch.column("modified").flatten(), 1000).cast(pa.timestamp("us", "UTC"))
            yield pa.RecordBatch.from_arrays([path, modified, batch.column("lengths").flatten()], ["path", "modificationTime", "length"])

    return dealt.mapInArrow(run, "path string, modificationTime timestamp, length long")


def read_text_files(spark: SparkSession, paths: str | list[str], glob: str) -> DataFrame:
    """One row (path, name, modified, value, file_error) per matching file below ``paths``, listed once."""
    roots = local_roots(spark, paths)
    if roots is None:
        return texts(open_files(spark, paths, glob))
    base, dealt = shares(spark, roots, glob)
    types = [pa.string(), pa.string(), pa.timestamp("us", "UTC"), pa.string(), pa.string()]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["path", "name", "modified", "value", "file_error"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for path in batch.column("names").flatten().to_pylist():
                name = path.rsplit("/", 1)[-1]
                with open(base + path, "rb", buffering=0) as file:
                    modified, content = os.fstat(file.fileno()).st_mtime_ns // 10**6 * 1000, file.readall()
                rows.append((f"file:{base}{path}", name, modified, *decode(name, content)))
                size += len(rows[-1][3] or "")
                if size >= BATCH_BYTES or len(rows) == BATCH_FILES:
                    yield packed(rows)
                    rows, size = [], 0
            if rows:
                yield packed(rows)

    return dealt.mapInArrow(run, TEXT_SCHEMA)


def stream_text_files(spark: SparkSession, root: str, glob: str, max_files: int) -> DataFrame:
    """Streaming form of :func:`read_text_files`; each trigger takes at most ``max_files`` unseen files of any age."""
    reader = spark.readStream.schema(FILE_SCHEMA).format("binaryFile").option("recursiveFileLookup", "true")
    reader = reader.option("maxFileAge", MAX_FILE_AGE).option("maxFilesPerTrigger", max_files)
    return texts(reader.option("pathGlobFilter", glob).load(root))


def folder_name(column: str, value: str | None) -> str:
    """Folder of one value of a partition column, spelled as Spark's writers do."""
    if not value:
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    return f"{column}=" + re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", value)


def write_each(rows: DataFrame, root: str, by: str, form: str) -> None:
    """Write every row to a file of its own below ``root``, as ``json`` or ``text``, in folders of the column ``by``.

    Hadoop's client starts processes for every local file to set its mode, and the driver then moves file by file. So on a
    local or mounted file system the tasks write the lines of Spark's writer themselves, in a folder of their attempt that is
    renamed as a whole: a repeated or parallel attempt leaves one whole folder. Elsewhere Spark's writer does it.
    """
    folder = publish.Folder(rows.sparkSession, root)
    if folder.fs.getUri().getScheme() != "file":
        getattr(rows.write.partitionBy(by).option("maxRecordsPerFile", 1), form)(root)
        return
    top, suffix = folder.path(root).toUri().getPath(), {"json": ".json", "text": ".txt"}[form]
    others = [c for c in rows.columns if c != by]
    line = F.to_json(F.struct(*others)) if form == "json" else F.col(*others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, made, n = f"part-{task.partitionId():05d}", {}, 0
        attempt = f"{top}/_temporary/{part}.{task.taskAttemptId()}"
        for batch in batches:
            for value, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if value not in made:
                    made[value] = f"{attempt}/{folder_name(by, value)}"
                    os.makedirs(made[value])
                with open(f"{made[value]}/{n:010d}{suffix}", "xb") as out:
                    out.write((content or b"") + b"\n")
                n += 1
        if made:
            try:
                os.rename(attempt, f"{top}/{part}")
            except OSError:
                if not os.path.isdir(f"{top}/{part}"):  # else another attempt has published the same rows
                    raise
        yield pa.RecordBatch.from_arrays([pa.array([n])], ["files"])

    if folder.exists(root):
        raise FileExistsError(root)
    folder.fs.mkdirs(folder.path(f"{root}/_temporary"))
    lines = rows.select(F.col(by).cast("string"), line.cast("binary").alias("line"))
    try:
        lines.mapInArrow(run, "files long").agg(F.sum("files")).collect()
    except Exception:
        folder.delete(root)
        raise
    folder.delete(f"{root}/_temporary")

"""Token ids in one compressed file per shard: a wavelet matrix with rank and select support.

A shard holds the ids of consecutive documents. Bit-plane ``l`` keeps bit ``bits - 1 - l`` of every id, in the order
that stable partitioning by the planes above it leaves; blocks of a plane are compressed one by one and a directory
counts the ones before each block, so an access, a count or a search reads one block per plane.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthlake.llm import common, tokens

# Fixed values of the format: magic, block size in bits, and the header of ids, documents and planes.
MAGIC = b"HLWMTX01"
BLOCK_BITS = 1 << 18
HEADER = struct.Struct("<8sQQI")
SHARD_TOKENS = 1 << 20


def encode(ids: np.ndarray, lengths: np.ndarray, doc_ids: list[int | None]) -> bytes:
    """The file of one shard. ``lengths`` are ids per document; a null doc_id is kept as such."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    planes = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    level = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    zeros, ones_before, blocks = [], [], []
    for shift in reversed(range(planes)):
        bit = (level >> level.dtype.type(shift) & level.dtype.type(1)).astype(bool)
        zero = ~bit
        packed = np.packbits(bit)
        step = BLOCK_BITS // 8
        pieces = [packed[i : i + step] for i in range(0, len(packed), step)]
        counts = [int(np.bitwise_count(p).sum()) for p in pieces]
        ones_before.append(np.concatenate([[0], np.cumsum(counts)]).astype("<u8"))
        blocks.append([squeeze(p.tobytes()) for p in pieces])
        level = np.concatenate([level[zero], level[bit]])
        zeros.append(len(ids) - int(ones_before[-1][-1]))
    known = np.array([d is not None for d in doc_ids], bool)
    documents = squeeze(np.asarray(lengths, "<u8").tobytes() + np.array([d or 0 for d in doc_ids], "<i8").tobytes() + known.tobytes())
    directory = squeeze(
        np.array(zeros, "<u8").tobytes()
        + b"".join(o.tobytes() for o in ones_before)
        + np.array([len(b) for plane in blocks for b in plane], "<u8").tobytes()
    )
    head = HEADER.pack(MAGIC, len(ids), len(lengths), planes) + struct.pack("<QQ", len(documents), len(directory))
    return b"".join([head, documents, directory, *(b for plane in blocks for b in plane)])


class Shard:
    """Token access, counting and occurrence lookup on the bytes of one file; blocks are unpacked when touched."""

    def __init__(self, data: bytes):
        magic, self.n, docs, self.planes = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix file")
        documents, directory = struct.unpack_from("<QQ", data, HEADER.size)
        at = HEADER.size + 16
        unpack = zstandard.ZstdDecompressor().decompress
        raw = unpack(data[at : at + documents])
        self.lengths = np.frombuffer(raw, "<u8", docs).astype(np.int64)
        known = np.frombuffer(raw, bool, docs, 16 * docs)
        self.doc_ids = [int(d) if k else None for d, k in zip(np.frombuffer(raw, "<i8", docs, 8 * docs), known, strict=True)]
        raw = unpack(data[at + documents : at + documents + directory])
        per_plane = -(-self.n // BLOCK_BITS)
        numbers = np.frombuffer(raw, "<u8").astype(np.int64)
        self.zeros = numbers[: self.planes]
        self.ones = numbers[self.planes : self.planes * (per_plane + 2)].reshape(self.planes, per_plane + 1)
        sizes = numbers[self.planes * (per_plane + 2) :]
        self.block_at = (at + documents + directory + np.concatenate([[0], np.cumsum(sizes)])).tolist()
        self.per_plane, self.data, self.unpack = per_plane, data, unpack
        self.touched: dict[int, np.ndarray] = {}

    def block(self, plane: int, i: int) -> np.ndarray:
        key = plane * self.per_plane + i
        if key not in self.touched:
            if len(self.touched) >= 256:
                self.touched.clear()
            raw = self.unpack(self.data[self.block_at[key] : self.block_at[key + 1]])
            self.touched[key] = np.unpackbits(np.frombuffer(raw, np.uint8)).view(bool)
        return self.touched[key]

    def ones_to(self, plane: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        b, rest = divmod(i, BLOCK_BITS)
        return int(self.ones[plane, b]) + (int(np.count_nonzero(self.block(plane, b)[:rest])) if rest else 0)

    def find(self, plane: int, bit: int, k: int) -> int:
        """Position of the ``k``-th (from 0) such bit of a plane."""
        before = self.ones[plane] if bit else np.minimum(np.arange(self.per_plane + 1) * BLOCK_BITS, self.n) - self.ones[plane]
        b = int(np.searchsorted(before, k, side="right")) - 1
        inside = self.block(plane, b)[: self.n - b * BLOCK_BITS]
        return b * BLOCK_BITS + int(np.flatnonzero(inside == bool(bit))[k - int(before[b])])

    def access(self, i: int) -> int:
        """Token ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane in range(self.planes):
            bit = int(self.block(plane, i // BLOCK_BITS)[i % BLOCK_BITS])
            ones = self.ones_to(plane, i)
            i = int(self.zeros[plane]) + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, start: int, stop: int) -> tuple[int, int]:
        if token >> self.planes:
            return 0, 0
        for plane in range(self.planes):
            a, b = self.ones_to(plane, start), self.ones_to(plane, stop)
            zero = int(self.zeros[plane])
            start, stop = (zero + a, zero + b) if token >> (self.planes - 1 - plane) & 1 else (start - a, stop - b)
        return start, stop

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of a token in a range of positions."""
        a, b = self._range(token, start, self.n if stop is None else stop)
        return b - a

    def occurrence(self, token: int, k: int) -> int:
        """Position of the ``k``-th (from 0) occurrence of a token."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        at = a + k
        for plane in reversed(range(self.planes)):
            bit = token >> (self.planes - 1 - plane) & 1
            at = self.find(plane, bit, at - int(self.zeros[plane]) if bit else at)
        return at

    def ids(self) -> np.ndarray:
        """All tokens in order, by undoing the partitions from the last plane up."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        level = np.zeros(self.n, kind)
        for plane in reversed(range(self.planes)):
            bit = np.concatenate([self.block(plane, i) for i in range(self.per_plane)])[: self.n] if self.n else np.zeros(0, bool)
            out = np.empty(self.n, kind)
            zero = int(self.zeros[plane])
            out[~bit] = level[:zero]
            out[bit] = level[zero:] | kind(1 << (self.planes - 1 - plane))
            level = out
        return level


def write_file(folder: str, name: str, data: bytes) -> None:
    """Under a name of its own first, then renamed: a repeated or parallel attempt leaves one whole file."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("/") else f"file://{folder}")
    store.create_dir(root, recursive=True)
    attempt = f"{root}/_{name}.{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}"
    with store.open_output_stream(attempt) as out:
        out.write(data)
    store.move(attempt, f"{root}/{name}")


MANIFEST = "part int, seq int, shard string, n_docs long, shard_tokens long"


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order into files below ``folder``; returns their manifest.

    Null texts are empty documents, null ids come first, equal ids are ordered by their text. Rows are range
    partitioned by id, so a shard never holds more than its own documents and no task more than its range.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        held: list[bytes] = []
        owners: list[int | None] = []

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            name = f"shard-{part:07d}-{seq:07d}.wm"
            write_file(folder, name, encode(ids, np.array([len(h) // 4 for h in held]), owners))
            row = {"part": part, "seq": seq, "shard": name, "n_docs": len(held), "shard_tokens": len(ids)}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("shard", pa.string()), ("n_docs", pa.int64()), ("shard_tokens", pa.int64())]))

        size = 0
        for batch in batches:
            for step in common.steps(batch):
                for doc_id, ids in zip(step.column("doc_id").to_pylist(), tokens.encoder(tokenizer).encode(tokens.text_list(step.column("text"))), strict=True):
                    held.append(ids + end)
                    owners.append(doc_id)
                    size += len(ids) // 4 + 1
                    if size >= shard_tokens:
                        yield flush()
                        held, owners, size, seq = [], [], 0, seq + 1
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of(docs).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = rows.repartitionByRange(common.tasks_for(docs), *order).sortWithinPartitions(*order, "text")
    return common.materialise(ordered.mapInArrow(run, MANIFEST), "manifest")


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32.

    Starts are sums over the manifest: over range partitions first (as many rows as tasks), then inside each.
    """
    spark = manifest.sparkSession
    per_part = manifest.groupBy("part").agg(F.sum("shard_tokens").alias("n"))
    before = per_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    inside = F.sum("shard_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("shard_tokens")
    starts = manifest.select("part", "shard", inside.alias("inside")).join(before, "part")
    starts = starts.select("shard", (F.col("part_start") + F.col("inside")).alias("shard_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                shard = Shard(content.as_py())
                data = shard.ids().astype("<u4")
                cuts = np.concatenate([[0], np.cumsum(shard.lengths)])
                view = memoryview(data).cast("B")
                crc = [tokens.crc32(view[a * 4 : b * 4]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path.rsplit("/", 1)[1]] * len(crc)), pa.array(shard.doc_ids, pa.int64()), pa.array(cuts[:-1]), pa.array(shard.lengths), pa.array(crc, pa.int64())],
                    ["shard", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    files = spark.read.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile")
    files = files.option("pathGlobFilter", "shard-*.wm").load(folder).select("path", "content")
    rows = files.mapInArrow(run, "shard string, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return rows.join(starts, "shard").select("doc_id", (F.col("shard_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2, folder: str | None = None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write ``docs`` as shards and read them back; an empty table gives no file and no rows."""
    spark = docs.sparkSession
    folder = folder or common.new_path(spark, "wavelet")
    manifest = write_shards(docs, folder, tokenizer or tokens.default_path(), end_id, shard_tokens)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_documents(manifest, folder)

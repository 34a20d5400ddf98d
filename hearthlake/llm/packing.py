"""Packing along a space-filling curve: documents sorted by the Hilbert key of their vector share sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.llm import common, tokens

DIMENSIONS = 4
BITS = 12
# Keys that the cuts between tasks are taken from. They only balance the tasks: every row is sorted and packed.
BOUND_ROWS = 20_000
TIE_BITS = 14


def document_vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bags of hashed words projected to DIMENSIONS, as unit vectors; a text without words is the zero vector.

    A word adds the same pseudo-random value to each dimension wherever it occurs, which is the product of the hashed
    bag with a fixed random matrix.
    """
    starts, ends, owner = common.words_of(data, offsets)
    hashes = common.feature_hashes(data, starts, ends)
    out = np.empty((len(offsets) - 1, DIMENSIONS))
    for j in range(DIMENSIONS):
        values = (hashes >> np.uint64(16 * j) & np.uint64(0xFFFF)).astype(np.float64) - 32767.5
        out[:, j] = np.bincount(owner, values, len(out))
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(length > 0, length, 1)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Distance along the Hilbert curve for integer points (n, dimensions) below 2 ** bits.

    Axes are turned into the transposed index by exchanging or inverting low bits per level, then Gray-decoded.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(dims):
            high = (x[i] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        level >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        flip ^= np.where(x[-1] & level, level - 1, 0)
        level >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in reversed(range(bits)):
        for i in range(dims):
            key = key << 1 | (x[i] >> b & 1)
    return key


def with_keys(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``curve``: the Hilbert key, with bits of a row hash below it so that copies can be split."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors = document_vectors(*common.buffer_of(batch.column("text")))
        cells = np.minimum(((vectors + 1) / 2 * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
        tie = batch.column("tie").to_numpy() & ((1 << TIE_BITS) - 1)
        curve = hilbert_keys(cells) << TIE_BITS | tie
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(curve)], ["doc_id", "text", "curve"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of(docs).alias("text"), F.xxhash64("doc_id", "text").alias("tie"))
    return common.mapped(rows, run, "doc_id long, text string, curve long")


def cut_points(docs: DataFrame, n: int) -> list[int]:
    """Keys that split the curve into about equal shares of the text for ``n`` tasks."""
    rows = docs.count()
    if not rows or n < 2:
        return []
    some = docs if rows <= BOUND_ROWS else docs.sample(BOUND_ROWS / rows, 7)
    by_size = with_keys(some).withColumn("size", F.length("text") + 1)
    found = by_size.agg(F.percentile("curve", [i / n for i in range(1, n)], F.col("size")).alias("cuts")).first()["cuts"]
    return sorted({int(c) for c in found or []})


def lengths_of(total: int, most: int) -> list[int]:
    """Sequence lengths for ``total`` ids: full ones, then powers of two, which need no padding."""
    rest = total % most
    return [most] * (total // most) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, curve long"


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, length: int = 2048) -> DataFrame:
    """Pieces of all documents in sequences of at most ``length`` ids, neighbours on the curve together.

    Each task streams its stretch of the curve and cuts it at every ``length`` ids; what is left at its end becomes
    sequences of powers of two, so nothing is padded. Null or empty texts are their end id alone; rows with equal ids
    are packed each for itself. ``sequence_id`` has the task in its upper bits. No rows give no pieces.
    """
    tokenizer = tokenizer or tokens.default_path()
    tasks = common.tasks_for(docs)
    cuts = np.array(cut_points(docs, tasks), np.int64)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        held: list[tuple[int | None, int, bytes, int, int]] = []  # doc, start, ids, ids of the whole document, key
        waiting, sequence = 0, 0

        def emit(take: list[int]) -> pa.RecordBatch:
            nonlocal waiting, sequence
            out, row, used = [], 0, 0
            for size in take:
                offset = 0
                while offset < size:
                    doc, start, ids, whole, key = held[row]
                    n = min(size - offset, len(ids) // 4 - used)
                    piece = ids[used * 4 : (used + n) * 4]
                    out.append((doc, start + used, n, tokens.crc32(piece), whole, first + sequence, offset, key))
                    offset, used = offset + n, used + n
                    if used * 4 == len(ids):
                        row, used = row + 1, 0
                sequence += 1
            waiting -= sum(take)
            del held[:row]
            if used:
                doc, start, ids, whole, key = held[0]
                held[0] = (doc, start + used, ids[used * 4 :], whole, key)
            names = [c.split()[0] for c in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

        for batch in batches:
            for step in common.steps(batch):
                encoded = tokens.encoder(tokenizer).encode(tokens.text_list(step.column("text")))
                for doc, ids, key in zip(step.column("doc_id").to_pylist(), encoded, step.column("curve").to_pylist(), strict=True):
                    held.append((doc, 0, ids + end, len(ids) // 4 + 1, key))
                    waiting += len(ids) // 4 + 1
                if waiting >= length:
                    yield emit([length] * (waiting // length))
        if waiting:
            yield emit(lengths_of(waiting, length))

    keyed = with_keys(docs)
    task = F.lit(0)
    if len(cuts):
        task = F.array_size(F.filter(F.lit(cuts.tolist()), lambda c: c < F.col("curve")))
    return keyed.repartitionById(len(cuts) + 1, task).sortWithinPartitions("curve", "doc_id").mapInArrow(run, PIECES)

"""Where hashes occur at least twice: a packed exchange of (hash, place) between all texts.

A task packs the hashes of some texts into one value per bucket, so that a place costs about ten bytes instead of a
row. Of a hash that stands more than twice in these texts only two places are sent; the others wait where the answers
come home. The task of a bucket sorts the hashes and answers each sender with its repeated places; a second, small
exchange turns these into positions per text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthlake.llm import common

# What a slice of texts offers: position in all symbols of the slice, hash and mark of every place in ascending
# position, and where each text's symbols begin (one more entry than texts).
Places = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and key, a 64-bit name of the text: equal texts have equal results, whatever their ids."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of(docs).alias("text")).withColumn("key", name_of(F.col("text")))


def name_of(text: Column) -> Column:
    """64 bits that name a text in this run; the number in front is drawn per run, so no text can be written to collide."""
    return F.xxhash64(F.lit(common.run_base()), text)


def one_text(rows: DataFrame) -> DataFrame:
    """One row per key with its number of copies; they are merged before the shuffle too, so no text is a hot key.

    Two texts with one key differ in a second name; they end the job, whose next run draws other names.
    """
    second = F.xxhash64(F.lit(-common.run_base()), "text")
    merged = rows.groupBy("key").agg(F.min("text").alias("text"), F.count(F.lit(1)).alias("copies"), F.min(second).alias("low"), F.max(second).alias("high"))
    twice = F.raise_error(F.lit("two texts have one name; run again")).cast("string")
    return merged.select("key", F.when(F.col("low") == F.col("high"), F.col("text")).otherwise(twice).alias("text"), "copies")


def _pack(at: np.ndarray) -> bytes:
    """Ascending places as differences of two bytes, or four where one needs them."""
    steps = np.diff(at, prepend=0)
    return steps.astype("<u2" if not len(steps) or steps.max() < 65536 else "<u4").tobytes()


def _unpack(packed: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(packed, "<u2" if len(packed) == 2 * n else "<u4").astype(np.int64))


def _narrow(values: np.ndarray) -> bytes:
    """The low 40 bits of each value."""
    return values.astype("<u4").tobytes() + (values >> np.uint64(32)).astype(np.uint8).tobytes()


def _wide(packed: bytes, n: int) -> np.ndarray:
    if len(packed) == 8 * n:
        return np.frombuffer(packed, "<u8")
    return np.frombuffer(packed, "<u4", n).astype(np.uint64) | np.frombuffer(packed, np.uint8, n, 4 * n).astype(np.uint64) << np.uint64(32)


def _two(at: np.ndarray, hashes: np.ndarray, marks: np.ndarray, often: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The first two places of every hash with hash and mark (that of any of its places, or whether it has ``often``
    places), and for every further place the first one of its hash, as pairs.
    """
    order = np.argsort(hashes & ~np.uint64(1), kind="stable")
    ranked = hashes[order] & ~np.uint64(1)
    new = np.ones(len(order), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    begin = np.flatnonzero(new)
    if len(begin) == len(order):
        return at, hashes, marks, np.zeros((0, 2), "<u4")
    group = np.cumsum(new) - 1
    marks = marks.copy()
    marks[order[begin]] = np.diff(np.append(begin, len(order))) >= often if often else np.logical_or.reduceat(marks[order], begin)
    further = np.flatnonzero(np.arange(len(order)) - begin[group] >= 2)
    kept = np.ones(len(at), bool)
    kept[order[further]] = False
    pairs = np.stack([at[order[begin[group[further]]]], at[order[further]]], axis=1).astype("<u4")
    return at[kept], hashes[kept], marks[kept], pairs


def repeated(rows: DataFrame, offer: Callable[[pa.RecordBatch], Places], marked: bool, exact: bool = True, crowd: tuple[int, int] | None = None) -> DataFrame:
    """key and positions (binary, 32-bit) of all places of ``rows`` (key, text and more) whose hash occurs twice.

    With ``marked`` a hash also has to be marked in one of its places. Every key of ``rows`` should occur once. Unless
    ``exact``, 40 bits beside the bucket stand for a hash: all repeats are found, and a few places more.

    With ``crowd``, instead of marks, the column ``crowded`` has the places of hashes that stand that often in one slice
    of texts (first number) or are sent more than that often (second), and ``positions`` only those of the others.
    """
    buckets = common.tasks_for(rows)
    crowded_bit = np.uint32(1 << 31)
    names = ["bucket", "batch", "hashes", "at"]
    base = common.run_base()

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.use_base(base)
        batch_id = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in common.steps(batch):
                at, hashes, marks, begins = offer(part)
                batch_id += 1
                if not len(at):
                    continue
                at, hashes, marks, further = _two(at, hashes, marks, crowd[0] if crowd else None)
                bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                values = (hashes & ~np.uint64(1) | marks.astype(np.uint64))[order]
                place = at[order]
                filled = np.flatnonzero(np.diff(cuts))
                out_hashes = [values[cuts[b] : cuts[b + 1]].tobytes() if exact else _narrow(values[cuts[b] : cuts[b + 1]]) for b in filled]
                out_at = [_pack(place[cuts[b] : cuts[b + 1]]) for b in filled]
                # The sender's own list of texts and further places travels as a value without hashes.
                texts = np.int64(part.num_rows).tobytes() + part.column("key").to_numpy().tobytes() + begins.astype("<i8").tobytes() + further.tobytes()
                where = [*filled.tolist(), batch_id % buckets]
                yield pa.RecordBatch.from_arrays([pa.array(where, pa.int32()), pa.array([batch_id] * len(where), pa.int64()), pa.array([*out_hashes, None], pa.binary()), pa.array([*out_at, texts], pa.binary())], names)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        senders, hashes, at = [], [], []
        for batch in batches:
            for sender, h, a in zip(batch.column("batch").to_pylist(), batch.column("hashes").to_pylist(), batch.column("at").to_pylist(), strict=True):
                if h is None:
                    yield pa.RecordBatch.from_arrays([pa.array([sender], pa.int64()), pa.array([True]), pa.array([a], pa.binary())], ["batch", "texts", "value"])
                else:
                    senders.append(sender)
                    hashes.append(_wide(h, len(h) // (8 if exact else 5)))
                    at.append(a)
        if not hashes:
            return
        sizes = np.array([len(h) for h in hashes])
        everything = np.concatenate(hashes)
        hashes.clear()
        order = np.argsort(everything)
        ranked = everything[order]
        bare = ranked & ~np.uint64(1)
        begin = np.flatnonzero(np.concatenate([[True], bare[1:] != bare[:-1]]))
        size = np.diff(np.append(begin, len(bare)))
        found = size > 1
        if marked:
            found &= np.bitwise_or.reduceat(ranked & np.uint64(1), begin).astype(bool)
        hit = np.zeros(len(bare), bool)
        hit[order] = np.repeat(found, size)
        crowded = np.zeros(len(bare), bool)
        if crowd:
            crowded[order] = np.repeat((size > crowd[1]) | np.bitwise_or.reduceat(ranked & np.uint64(1), begin).astype(bool), size)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        for sender, a, b, packed in zip(senders, edges[:-1].tolist(), edges[1:].tolist(), at, strict=True):
            mine = hit[a:b]
            if mine.any():
                value = (_unpack(packed, b - a)[mine].astype("<u4") | np.where(crowded[a:b][mine], crowded_bit, np.uint32(0))).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([sender], pa.int64()), pa.array([False]), pa.array([value], pa.binary())], ["batch", "texts", "value"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in common.grouped(batches, ["batch"]):
            texts, found = b"", []
            for is_texts, value in zip(group.column("texts").to_pylist(), group.column("value").to_pylist(), strict=True):
                if is_texts:
                    texts = value
                else:
                    found.append(np.frombuffer(value, "<u4"))
            if not found:
                continue
            n = int(np.frombuffer(texts, "<i8", 1)[0])
            keys, begins = np.frombuffer(texts, "<i8", n, 8), np.frombuffer(texts, "<i8", n + 1, 8 + 8 * n)
            further = np.frombuffer(texts, "<u4", offset=16 + 16 * n).reshape(-1, 2)
            values = np.concatenate(found)
            bare = values & ~crowded_bit
            order = np.argsort(bare)
            values, bare = values[order], bare[order]
            first = np.minimum(np.searchsorted(bare, further[:, 0]), len(bare) - 1)
            also = bare[first] == further[:, 0]
            values = np.concatenate([values, further[also, 1] | values[first[also]] & crowded_bit])
            at = (values & ~crowded_bit).astype(np.int64)
            order = np.argsort(at)
            at, crowded = at[order], (values[order] & crowded_bit).astype(bool)
            owner = np.searchsorted(begins, at, side="right") - 1
            cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            ends = np.append(cuts[1:], len(at))
            inside = (at - begins[owner]).astype("<u4")
            kinds = [~crowded, crowded] if crowd else [~crowded]
            columns = [[inside[a:b][kind[a:b]].tobytes() or None for a, b in zip(cuts.tolist(), ends.tolist(), strict=True)] for kind in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(keys[owner[cuts]]), *[pa.array(c, pa.binary()) for c in columns]], ["key", "positions", "crowded"][: 1 + len(kinds)])

    sent = rows.mapInArrow(send, "bucket int, batch long, hashes binary, at binary")
    answered = sent.repartitionById(buckets, F.col("bucket")).select("batch", "hashes", "at").mapInArrow(answer, "batch long, texts boolean, value binary")
    home = answered.repartition(buckets, "batch").sortWithinPartitions("batch")
    return home.mapInArrow(place, "key long, positions binary" + (", crowded binary" if crowd else ""))


def flagged(batch: pa.RecordBatch, column: str, begins: np.ndarray, n: int) -> np.ndarray:
    """Positions of a binary column (null: none) as a mask over all symbols of the slice."""
    data, offsets = common.buffer_of(batch.column(column))
    at = np.frombuffer(data.tobytes(), "<u4").astype(np.int64) + np.repeat(begins[:-1], np.diff(offsets) // 4)
    out = np.zeros(n, bool)
    out[at] = True
    return out


def covered(starts: np.ndarray, width: int) -> np.ndarray:
    """Symbols that lie in a window of ``width`` beginning at a flagged symbol."""
    edge = np.zeros(len(starts) + width + 1, np.int32)
    edge[: len(starts)] += starts
    edge[width : width + len(starts)] -= starts
    return np.cumsum(edge)[: len(starts)] > 0

"""Arrow text buffers, vectorised words and hashes, and stored intermediate tables."""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake import session
from hearthlake.session import new_path  # noqa: F401

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
# Bytes of text that one vectorised step works on; a longer text is a step of its own.
STEP_BYTES = 2 << 20

# Bytes that separate words, 0x20 and 0x09 to 0x0D.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """The frame as a table in the shared folder; the shuffle files behind it are not needed any more and go."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return session.materialise(df, name, keep)
    finally:
        conf.set(key, before)


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def tasks_for(df: DataFrame) -> int:
    """Shuffle width: the session's setting, which the operator of a cluster sizes to the data."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def steps(batch: pa.RecordBatch, column: str = "text", most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``most`` bytes; every row is in one slice."""
    if not batch.num_rows:
        return
    total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, and where each begins (one more entry than texts). Null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit keys (the public splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


PRIME = (1 << 61) - 1
SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
_LOW32, _LOW29, _P = np.uint64((1 << 32) - 1), np.uint64((1 << 29) - 1), np.uint64(PRIME)
_POWERS: dict[int, np.ndarray] = {}
_RUN = {"base": 0}


def run_base() -> int:
    """The base of this driver's hashes: drawn anew for each run, so that no text can be written to collide."""
    if not _RUN["base"]:
        _RUN["base"] = secrets.randbelow(PRIME - (1 << 32)) + (1 << 31)
    return _RUN["base"]


def use_base(base: int) -> None:
    """Take over the driver's base in a task, before its first :class:`Hasher`."""
    _RUN["base"] = base


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> np.uint64(61))
    return np.where(x >= _P, x - _P, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo PRIME of numbers below it, from products of their halves."""
    a_high, a_low, b_high, b_low = a >> np.uint64(32), a & _LOW32, b >> np.uint64(32), b & _LOW32
    middle, low = a_high * b_low + a_low * b_high, a_low * b_low
    whole = (a_high * b_high << np.uint64(3)) + (middle >> np.uint64(29)) + ((middle & _LOW29) << np.uint64(32))
    return _reduced(whole + (low >> np.uint64(61)) + (low & _P))


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n - 1 modulo PRIME, doubling; kept for the next step unless it is unusually long."""
    known = _POWERS.get(base)
    if known is not None and len(known) >= n:
        return known[:n]
    made = np.ones(1, np.uint64)
    while len(made) < n:
        made = np.concatenate([made, _times(made, np.uint64(pow(base, len(made), PRIME)))])
    if n <= 4 * STEP_BYTES:
        if len(_POWERS) > 4:
            _POWERS.clear()
        _POWERS[base] = made
    return made[:n]


class Hasher:
    """64-bit hashes of any ranges of one sequence of symbols, by prefix sums of a polynomial modulo 2 ** 61 - 1.

    Two different ranges of n symbols agree for at most n of all bases.
    """

    def __init__(self, values: np.ndarray):
        n, base = len(values), _RUN["base"]
        if not base:
            raise RuntimeError("no base: call use_base with the driver's run_base first")
        terms = _times(_reduced(values), _powers(base, n))
        high, low = np.cumsum(terms >> np.uint64(32), dtype=np.uint64), np.cumsum(terms & _LOW32, dtype=np.uint64)
        self.sums = np.zeros(n + 1, np.uint64)
        self.sums[1:] = _reduced((high >> np.uint64(29)) + ((high & _LOW29) << np.uint64(32)) + _reduced(low))
        self.back = _powers(pow(base, -1, PRIME), n + 1)

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        between = _reduced(self.sums[ends] + (_P - self.sums[starts]))
        return mix(_times(between, self.back[starts]) + ((ends - starts).astype(np.uint64) << np.uint64(61)))


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text index of every word, a word being a run of bytes other than SEPARATORS."""
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    letter = ~SEPARATORS[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], after[-1] = False, False
    before[1:], after[:-1] = letter[:-1], letter[1:]
    starts = np.flatnonzero(letter & (~before | first[:n]))
    ends = np.flatnonzero(letter & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def _name(word: bytes) -> bytes:
    return hashlib.blake2b(word, digest_size=8).digest()


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits of a cryptographic hash of every word of :func:`words_of`; each different word is hashed once."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    letters = np.ascontiguousarray(data[~SEPARATORS[data]])
    cuts = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(letters)]).dictionary_encode()
    names = np.frombuffer(b"".join(map(_name, words.dictionary.to_pylist())), "<u8")
    return names[words.indices.to_numpy()]


FEATURE_BASE = 0x9E3779B97F4A7C15 | 1
_FEATURES: dict[int, np.ndarray] = {}


def _feature_powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n - 1 modulo 2 ** 64; kept for the next step unless it is unusually long."""
    known = _FEATURES.get(base)
    if known is not None and len(known) >= n:
        return known[:n]
    made = np.full(max(n, 1), base, np.uint64)
    made[0] = 1
    made = np.multiply.accumulate(made)
    if n <= 4 * STEP_BYTES:
        _FEATURES[base] = made
    return made[:n]


def feature_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Cheap hashes of words, the same in every run, for inputs of a model or a curve.

    Words can be written to collide, so nothing that has to be exact may rest on them.
    """
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(SYMBOLS[data] * _feature_powers(FEATURE_BASE, len(data)), out=sums[1:])
    back = _feature_powers(pow(FEATURE_BASE, -1, 1 << 64), len(data) + 1)
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def per_text(owner: np.ndarray, n: int) -> np.ndarray:
    """Where the entries of each text begin, for entries sorted by owner; one more entry than texts."""
    return np.searchsorted(owner, np.arange(n + 1))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def mapped(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``function`` over bounded slices of the column ``text``; a slice it has nothing for gives no rows."""
    base = run_base()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_base(base)
        for batch in batches:
            for part in steps(batch):
                out = function(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Complete groups of rows that agree in ``keys`` (64-bit or 32-bit integers), from rows sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy() for k in keys])
        cuts = [0, *(np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(values[:, a].tolist())
            if held and key != last:
                yield joined(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield joined(held)


def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


def matrix(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    """Binary values of equal size as the rows of an array."""
    return np.frombuffer(buffer_of(column)[0].tobytes(), dtype).reshape(len(column), width)


def components(edges: DataFrame, low: str = "a", high: str = "b") -> DataFrame:
    """node and label, the least node that it is connected with, for every node of ``edges`` (two columns, one type).

    Each round takes the least label among a node's neighbours and then the label of that label, so that labels move
    twice as far every time. Minima are combined before the shuffle, so a node with very many neighbours sends one
    row per task; each round is stored, so a lost executor repeats at most one round.
    """
    both = edges.select(F.col(low).alias("x"), F.col(high).alias("y"))
    both = materialise(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    labels = materialise(both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("node"), F.least("x", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("y"), "label"), "y").groupBy("x").agg(F.min("label").alias("near"))
        moved = labels.join(near.withColumnRenamed("x", "node"), "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = moved.join(jump, "label", "left").select("node", "was", F.least("label", F.coalesce("further", "label")).alias("label"))
        step = materialise(step, "labels")
        done = step.filter("was != label").isEmpty()
        labels = step.select("node", "label")
        if done:
            return labels

"""Benchmark decontamination by edit distance: pigeonhole pieces, exact hits, and bit-parallel verification.

Texts are compared as lower-cased words joined by one space. An item of n characters may occur with up to
``error_rate * n`` edits; cut into one piece more than that, at least one piece occurs unchanged. Pieces found in a
text name the stretch in which the item could lie, and only those stretches are verified. Items of fewer than
LEAST_CHARS characters have no budget and must stand there as whole words.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.llm import common

ERROR_RATE = 0.05
# Items whose normal form is shorter are looked for without edits, and only as whole words.
LEAST_CHARS = 30
# Characters of items that one automaton may hold; a larger benchmark is searched in several blocks.
BLOCK_CHARS = 4_000_000


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of about equal length that cover the item, with their offsets."""
    cuts = [round(i * len(item) / (errors + 1)) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def best_match(pattern: str, text: str, most: int) -> int | None:
    """Least edit distance of ``pattern`` to any substring of ``text`` if it is at most ``most`` (Myers' algorithm).

    One machine of len(pattern) bits: a column's vertical differences are two bit vectors, and a text character
    turns one column into the next by a constant number of operations on them.
    """
    m = len(pattern)
    if not m:
        return 0
    where: dict[str, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    plus, minus, distance, best = full, 0, m, m
    for c in text:
        equal = where.get(c, 0)
        x = equal | minus
        diagonal = ((((x & plus) + plus) ^ plus) | x) & full
        up, down = minus | (full & ~(diagonal | plus)), plus & diagonal
        if up & last:
            distance += 1
        elif down & last:
            distance -= 1
            if distance < best:
                best = distance
        up = up << 1 & full
        down = down << 1 & full
        plus, minus = down | (full & ~(x | up)), up & x
    return best if best <= most else None


class Index:
    """Pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        import ahocorasick

        self.items = items
        self.errors = [int(len(t) * error_rate) if len(t) >= LEAST_CHARS else 0 for _, t in items]
        found: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text) in enumerate(items):
            for at, piece in pieces(text, self.errors[i]):
                found.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def search(self, text: str) -> list[tuple[int, int]]:
        """(item index, distance) of the items in a normal text.

        Hits whose diagonals lie within the error budget of each other are verified together, so a piece that a text
        repeats costs one verification per place, and a found item is not looked for again unless it can get closer.
        """
        diagonals: dict[int, list[int]] = {}
        words: set[int] = set()
        for end, (size, places) in self.automaton.iter(text):
            for i, at in places:
                if len(self.items[i][1]) >= LEAST_CHARS:
                    diagonals.setdefault(i, []).append(end + 1 - size - at)
                elif text[end - size : end - size + 1] in ("", " ") and text[end + 1 : end + 2] in ("", " "):
                    words.add(i)
        out = [(i, 0) for i in sorted(words)]
        for i, starts in diagonals.items():
            pattern, errors = self.items[i][1], self.errors[i]
            best: int | None = None
            starts.sort()
            a = 0
            while a < len(starts) and best != 0:
                b = a
                while b + 1 < len(starts) and starts[b + 1] - starts[b] <= 2 * errors + 1:
                    b += 1
                window = text[max(0, starts[a] - errors) : max(0, starts[b] + len(pattern) + errors)]
                got = 0 if pattern in window else best_match(pattern, window, errors)
                best = got if best is None or (got is not None and got < best) else best
                a = b + 1
            if best is not None:
                out.append((i, best))
        return out


def blocks_of(benchmark: DataFrame, block_chars: int, with_id: bool) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of bounded size, streamed through the driver one block at a time; equal items once each."""
    held: list[tuple[int | None, str]] = []
    size = 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id") if with_id else F.lit(None).cast("long").alias("item_id"), common.text_of(benchmark).alias("text"))
    rows = rows.filter("item_id IS NOT NULL") if with_id else rows
    for row in rows.distinct().toLocalIterator():
        text = normal(row["text"])
        if not text:
            continue
        if held and size + len(text) > block_chars:
            yield held
            held, size = [], 0
        held.append((row["item_id"], text))
        size += len(text)
    if held:
        yield held


def find(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs`` and item that it contains: doc_id, item_id, distance (the least, in edits), short.

    Each block of items is broadcast, at most ``block_chars`` characters, and meets every text whole; texts are never
    shuffled. Null and empty texts contain nothing. ``short`` tells items of fewer than LEAST_CHARS characters in normal
    form, found as whole words without edits. Items without words stand in no text, items without id cannot be named
    here (:func:`clean` heeds them); an item that is listed twice is reported once per id. No rows give no rows.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, distance int, short boolean"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of(docs).alias("text"))
    found = [spark.createDataFrame([], schema)]
    for items in blocks_of(benchmark, block_chars, True):
        shared = spark.sparkContext.broadcast((items, error_rate))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = Index(*shared.value)
            for batch in batches:
                for part in common.steps(batch):
                    hits = [(d, own.items[i][0], n, len(own.items[i][1]) < LEAST_CHARS) for d, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True) for i, n in own.search(normal(t))]
                    if hits:
                        ids, named, distances, short = zip(*hits, strict=True)
                        columns = [pa.array(ids, pa.int64()), pa.array(named, pa.int64()), pa.array(distances, pa.int32()), pa.array(short, pa.bool_())]
                        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "distance", "short"])

        found.append(rows.mapInArrow(run, schema))
    return common.union_all(found)


def clean(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns; items need no id, short ones count as in :func:`find`.

    Rows are judged in place, so equal or null ids need no join and nothing is shuffled.
    """
    spark = docs.sparkSession
    out = docs
    for items in blocks_of(benchmark, block_chars, False):
        shared = spark.sparkContext.broadcast((items, error_rate))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = Index(*shared.value)
            for batch in batches:
                for part in common.steps(batch):
                    yield part.filter(pa.array([not own.search(normal(t)) for t in part.column("text").to_pylist()], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out

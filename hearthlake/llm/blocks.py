"""Substring dedup of words by fixed-block anchors.

Every text is cut into non-overlapping reference blocks of ``block`` words, which are indexed by hash, and each rolling
window of ``block`` words of every text probes the index. With 2 * block - 1 <= window, any repeated window holds a
whole reference block, so a repeat has a hit in each of its places. Windows around the hits are then compared, and
consecutive repeated windows form the maximal exact repeats.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake import session
from hearthlake.llm import common, places

WINDOW = 35
BLOCK = 18


def _words(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, owners, where each text's words begin, and the place of each word in its text."""
    data, offsets = common.buffer_of(part.column("text"))
    starts, ends, owner = common.words_of(data, offsets)
    begins = common.per_text(owner, len(offsets) - 1)
    return common.word_hashes(data, starts, ends), owner, begins, np.arange(len(owner)) - begins[owner]


def _whole(owner: np.ndarray, size: int) -> np.ndarray:
    """Words at which a window of ``size`` words of one text begins."""
    return np.flatnonzero(owner[size - 1 :] == owner[: len(owner) - size + 1]) if len(owner) >= size else np.zeros(0, np.int64)


def probes(block: int):
    """Every rolling window of ``block`` words; the text's own reference blocks are marked."""

    def offer(part: pa.RecordBatch) -> places.Places:
        words, owner, begins, inside = _words(part)
        at = _whole(owner, block)
        return at, common.Hasher(words).ranges(at, at + block), inside[at] % block == 0, begins

    return offer


def extensions(block: int, window: int):
    """Windows that hold a hit, from the hits in the column positions."""

    def offer(part: pa.RecordBatch) -> places.Places:
        words, owner, begins, _ = _words(part)
        hit = places.flagged(part, "positions", begins, len(words))
        # A window holds a hit if one begins among its first window - block + 1 words.
        count = np.concatenate([[0], np.cumsum(hit)])
        at = _whole(owner, window)
        at = at[count[at + window - block + 1] > count[at]]
        return at, common.Hasher(words).ranges(at, at + window), np.zeros(len(at), bool), begins

    return offer


def _kept(part: pa.RecordBatch, window: int) -> pa.RecordBatch:
    """key, copies, n_words, n_removed, n_spans and kept_sha256 of texts and their repeated windows."""
    data, offsets = common.buffer_of(part.column("text"))
    starts, ends, owner = common.words_of(data, offsets)
    begins = common.per_text(owner, len(offsets) - 1)
    gone = places.covered(places.flagged(part, "positions", begins, len(starts)), window)
    first = gone.copy()
    first[1:] &= ~gone[:-1] | (owner[1:] != owner[:-1])
    total, spans = np.concatenate([[0], np.cumsum(gone)]), np.concatenate([[0], np.cumsum(first)])
    raw = data.tobytes()
    digests = []
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
        here = np.flatnonzero(~gone[a:b]) + a
        kept = b" ".join([raw[s:e] for s, e in zip(starts[here].tolist(), ends[here].tolist(), strict=True)])
        digests.append(hashlib.sha256(kept).hexdigest())
    columns = [part.column("key"), part.column("copies"), pa.array(np.diff(begins)), pa.array(total[begins[1:]] - total[begins[:-1]]), pa.array(spans[begins[1:]] - spans[begins[:-1]]), pa.array(digests)]
    return pa.RecordBatch.from_arrays(columns, ["key", "copies", "n_words", "n_removed", "n_spans", "kept_sha256"])


RESULT = "key long, copies long, n_words long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_removed, n_spans and kept_sha256 for every row of ``docs``.

    Words covered by a window that also begins anywhere else, in the same text too, are removed; windows are judged
    on the input. Copies of a text repeat all its windows, so a copied text of ``window`` words or more goes whole.
    Null and empty texts have no words. Rows of equal ids or texts are rows of their own; no rows give no rows.
    """
    if 2 * block - 1 > window:
        raise ValueError("a window must hold a whole block")
    rows = places.keyed(docs)
    texts = common.materialise(places.one_text(rows), "texts", keep=True)
    with session.scratch(docs.sparkSession):
        hits = common.materialise(places.repeated(texts, probes(block), True, exact=False), "hits")
        near = texts.join(hits, "key")
        found = common.materialise(places.repeated(near, extensions(block, window), False), "repeats", keep=True)
    joined = texts.join(found, "key", "left")
    per_text = common.mapped(joined, lambda p: _kept(p, window), RESULT)
    whole = (F.col("copies") > 1) & (F.col("n_words") >= window)
    per_text = per_text.select(
        "key",
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
    return rows.select("doc_id", "key").join(per_text, "key").drop("key")

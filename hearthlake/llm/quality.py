"""Quality by nearest neighbours: labelled latent-semantic vectors are broadcast and vote by similarity.

Terms are letter triples (bytes) hashed to TERMS buckets, weighed by their document frequency over all documents, and
shares of repeated, plain and marked-up text. A truncated singular value decomposition of the labelled sample gives
the latent space. Every document is compared with
every labelled vector, in blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.llm import common
from hearthlake.llm.rules import measure_texts

TERMS = 4096
LATENT = 64
NEIGHBOURS = 15
SHARPNESS = 8
# Beside the hashed terms stand shares of the text, so much times as long as the unit vector of terms.
SHARES = (("n_repeat_words", "n_words"), ("n_dup_lines", "n_lines"), ("n_capitals", "word_chars"), ("n_symbols", "n_words"), ("n_plain", "n_words"))
SHARE_WEIGHT = 2.0
# Labelled documents that the space is fitted on and that vote: at most so many of quality 0, and 1.
SAMPLE = (1500, 2500)


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts (text, term) of byte triples inside each text."""
    n = len(offsets) - 1
    out = np.zeros((n, TERMS), np.float32)
    if len(data) < 3:
        return out
    code = data.astype(np.uint32)
    triple = code[:-2] << np.uint32(16) | code[1:-1] << np.uint32(8) | code[2:]
    bucket = (triple * np.uint32(2654435761) >> np.uint32(32 - 12)).astype(np.int32)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        if b - a >= 3:
            out[i] = np.bincount(bucket[a : b - 2], minlength=TERMS)
    return out


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Term counts, then the shares (0 to 1; 0 without anything to share)."""
    found = measure_texts(data, offsets)
    shares = np.stack([np.minimum(found[a] / np.maximum(found[b], 1), 1) for a, b in SHARES], axis=1)
    return np.concatenate([term_counts(data, offsets), shares.astype(np.float32)], axis=1)


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def weighted(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Damped counts by inverse document frequency, of length one (or zero), and the weighted shares."""
    return np.concatenate([unit(np.log1p(rows[:, :TERMS]) * idf), rows[:, TERMS:] * np.float32(SHARE_WEIGHT)], axis=1)


@dataclass
class Voters:
    idf: np.ndarray
    space: np.ndarray  # term, latent
    vectors: np.ndarray  # labelled document, latent; of length one
    labels: np.ndarray
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        return unit(weighted(counts, self.idf) @ self.space)

    def score(self, counts: np.ndarray, block: int = 512) -> np.ndarray:
        """Similarity-weighted share of label 1 among the NEIGHBOURS most similar; without any, the sample's share."""
        out = np.full(len(counts), self.prior)
        k = min(NEIGHBOURS, len(self.labels))
        for i in range(0, len(counts) if k else 0, block):
            similar = self.project(counts[i : i + block]) @ self.vectors.T
            best = np.argpartition(similar, -k, axis=1)[:, -k:]
            weight = np.maximum(np.take_along_axis(similar, best, 1), 0).astype(np.float64) ** SHARPNESS
            total = weight.sum(axis=1)
            share = (weight * self.labels[best]).sum(axis=1) / np.where(total > 0, total, 1)
            out[i : i + block] = np.where(total > 0, share, self.prior)
        return out


def latent_space(rows: np.ndarray, rounds: int = 6) -> np.ndarray:
    """The LATENT leading right singular vectors, by subspace iteration from a fixed random start."""
    rng = np.random.default_rng(5)
    space = np.linalg.qr(rng.standard_normal((rows.shape[1], LATENT + 16)).astype(np.float32))[0]
    for _ in range(rounds):
        space = np.linalg.qr(rows.T @ (rows @ space))[0]
    _, _, turn = np.linalg.svd(rows @ space, full_matrices=False)
    return np.ascontiguousarray((space @ turn.T)[:, :LATENT])


def fit(counts: np.ndarray, labels: np.ndarray, idf: np.ndarray) -> Voters:
    """The space of the labelled sample, and the sample's vectors in it."""
    idf = idf.astype(np.float32)
    if not len(labels):
        return Voters(idf, np.zeros((TERMS + len(SHARES), LATENT), np.float32), np.zeros((0, LATENT), np.float32), labels, 1.0)
    voters = Voters(idf, latent_space(weighted(counts, idf)), np.zeros((0, LATENT), np.float32), labels, float(labels.mean()))
    voters.vectors = voters.project(counts).astype(np.float32)
    return voters


def held_out() -> F.Column:
    """Rows whose labels are never learnt from; a null doc_id counts as held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(True))


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Rows, and rows holding each term, over all documents: each task sends one row per term it has seen."""

    def run(batches):
        rows, seen = 0, np.zeros(TERMS, np.int64)
        for batch in batches:
            for part in common.steps(batch):
                counts = term_counts(*common.buffer_of(part.column("text")))
                rows += len(counts)
                seen += np.count_nonzero(counts, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(TERMS), -1)), pa.array(np.append(seen, rows))], ["term", "n"])

    found = docs.select(common.text_of(docs).alias("text")).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    by_term = {r["term"]: r["n"] for r in found.collect()}
    return by_term.get(-1, 0), np.array([by_term.get(t, 0) for t in range(TERMS)], float)


def labelled_counts(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Term counts and labels of at most ``sample`` learnable documents per label, those with the least hash."""
    known = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"))
    picked = common.union_all([known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in enumerate(sample)])
    rows = docs.select("doc_id", common.text_of(docs).alias("text")).join(F.broadcast(picked), "doc_id")
    rows = rows.select("text", "y", F.xxhash64("doc_id", "text").alias("h")).orderBy("h").limit(2 * sum(sample))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = features(*common.buffer_of(batch.column("text"))).astype("<f4")
        return pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows], pa.binary()), batch.column("y")], ["counts", "y"])

    found = common.mapped(rows, run, "counts binary, y int").toArrow()
    counts = np.frombuffer(b"".join(found.column("counts").to_pylist()), "<f4").reshape(-1, TERMS + len(SHARES))
    return counts, found.column("y").to_numpy().astype(np.int64)


def score(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE) -> DataFrame:
    """Every row of ``docs`` with held_out, score and predicted; other columns stay.

    Texts of fewer than three bytes, null ones too, have no terms and score as the labelled sample's share of label
    1. Columns of these names are replaced. No labels mean score 1, no rows give no rows.
    """
    rows_in, seen = document_frequencies(docs)
    idf = np.log((1 + rows_in) / (1 + seen)) + 1
    shared = docs.sparkSession.sparkContext.broadcast(fit(*labelled_counts(docs, labels, sample), idf))
    keep = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    rows = docs.select(*keep, common.text_of(docs).alias("__text"))
    schema = rows.drop("__text").withColumn("score", F.lit(0.0)).schema
    base = common.run_base()

    def run(batches):
        common.use_base(base)
        for batch in batches:
            for part in common.steps(batch, "__text"):
                found = shared.value.score(features(*common.buffer_of(part.column("__text"))))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(found)], [*keep, "score"])

    out = rows.mapInArrow(run, schema)
    return out.select(*keep, held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs.

Trained in numpy on a bounded sample of labelled documents, then applied to all overlapping windows of every text.
A document scores as its worst window, which is also how it is trained.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.llm import common

WORD_ROWS, CHAR_ROWS = 1 << 14, 1 << 13
WORD_SIZE, CHAR_SIZE, HIDDEN = 8, 8, 8
WINDOW, STRIDE = 64, 48
# Labelled documents that the model is fitted on: at most so many clean and so many toxic ones.
SAMPLE = (2400, 800)
STEPS = 500
SEED = 11


@dataclass
class Inputs:
    """Words of some texts: bucket of each word, buckets of its letter triples, and the windows over them."""

    word: np.ndarray
    triple: np.ndarray
    triple_at: np.ndarray
    window: np.ndarray  # index of the first word
    size: np.ndarray  # words in the window
    owner: np.ndarray  # text of the window
    texts: int


def inputs_of(data: np.ndarray, offsets: np.ndarray) -> Inputs:
    """Lower-cased (ASCII) words; a text of up to WINDOW words, empty ones too, has one window."""
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    letter = (lower >= 128) | ((lower >= 97) & (lower <= 122)) | ((lower >= 48) & (lower <= 57))
    shown = np.where(letter, lower, 32).astype(np.uint8)
    starts, ends, owner = common.words_of(shown, offsets)
    word = (common.feature_hashes(shown, starts, ends) % np.uint64(WORD_ROWS)).astype(np.int32)
    # Letter triples with a mark on both sides of a word: one per letter, the word's own bytes around it.
    code = shown.astype(np.uint64)
    before, after = np.empty_like(code), np.empty_like(code)
    before[1:], after[:-1] = code[:-1], code[1:]
    if len(code):
        before[starts], after[ends - 1] = 1, 1
    triple = common.mix(before << np.uint64(16) | code << np.uint64(8) | after) % np.uint64(CHAR_ROWS)
    inside = shown != 32
    triple = triple[inside].astype(np.int32)
    size = ends - starts
    triple_at = np.concatenate([[0], np.cumsum(size)])
    texts = len(offsets) - 1
    at = common.per_text(owner, texts)
    count = np.diff(at)
    windows = np.maximum(1, -(-(count - WINDOW) // STRIDE) + 1)
    who = np.repeat(np.arange(texts), windows)
    nth = np.arange(len(who)) - np.repeat(np.cumsum(windows) - windows, windows)
    first = at[who] + nth * STRIDE
    return Inputs(word, triple, triple_at, first, np.clip(at[who + 1] - first, 0, WINDOW), who, texts)


def inputs_of_texts(texts: list[str], lot: int = 200) -> Inputs:
    """The inputs of a list of texts, made a few at a time."""
    parts = [inputs_of(*common.buffer_of(pa.array(texts[i : i + lot], pa.string()))) for i in range(0, max(1, len(texts)), lot)]
    words = np.cumsum([0, *(len(p.word) for p in parts)])
    letters = np.cumsum([0, *(len(p.triple) for p in parts)])
    before = np.cumsum([0, *(p.texts for p in parts)])
    return Inputs(
        np.concatenate([p.word for p in parts]),
        np.concatenate([p.triple for p in parts]),
        np.concatenate([np.zeros(1, np.int64), *(p.triple_at[1:] + n for p, n in zip(parts, letters, strict=False))]),
        np.concatenate([p.window + n for p, n in zip(parts, words, strict=False)]),
        np.concatenate([p.size for p in parts]),
        np.concatenate([p.owner + n for p, n in zip(parts, before, strict=False)]),
        int(before[-1]),
    )


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + np.float32(0.5)


class Model:
    """Parameters by name; ``forward`` keeps what ``backward`` needs."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        size, three = WORD_SIZE + CHAR_SIZE, 3 * HIDDEN

        def made(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {"words": made(WORD_ROWS, WORD_SIZE, scale=0.1), "chars": made(CHAR_ROWS, CHAR_SIZE, scale=0.3)}
        for side in ("f", "b"):
            self.p[f"in_{side}"] = made(size, three, scale=size**-0.5)
            self.p[f"rec_{side}"] = made(HIDDEN, three, scale=HIDDEN**-0.5)
            self.p[f"bias_{side}"] = np.zeros(three, np.float32)
        self.p["att"] = made(2 * HIDDEN, HIDDEN, scale=0.4)
        self.p["att_out"] = made(HIDDEN, scale=0.4)
        self.p["out"] = made(2 * HIDDEN, scale=0.4)
        self.p["out_bias"] = np.zeros(1, np.float32)

    def embed(self, x: Inputs, low: int = 0, high: int | None = None) -> np.ndarray:
        """A vector for each of the words low to high: its own, beside the mean of those of its letter triples."""
        at = x.triple_at[low : (len(x.word) if high is None else high) + 1]
        if len(at) < 2:
            return np.zeros((0, WORD_SIZE + CHAR_SIZE), np.float32)
        chars = np.add.reduceat(self.p["chars"][x.triple[at[0] : at[-1]]], at[:-1] - at[0], axis=0)
        chars /= np.diff(at)[:, None].astype(np.float32)
        return np.concatenate([self.p["words"][x.word[low : low + len(at) - 1]], chars], axis=1)

    def run(self, gates: np.ndarray, side: str, kept: list | None = None) -> np.ndarray:
        """States (step, hidden, window) of one direction; ``gates`` are the inputs' share of the three gates.

        Steps behind a window's end have no input: the backward state is still zero there, and attention leaves the
        forward states behind the end out, so neither direction needs a mask.
        """
        steps, _, n = gates.shape
        two = 2 * HIDDEN
        rec = self.p[f"rec_{side}"].T.copy()
        h, u = np.zeros((HIDDEN, n), np.float32), np.empty((3 * HIDDEN, n), np.float32)
        states = np.empty((steps, HIDDEN, n), np.float32)
        for t in range(steps) if side == "f" else reversed(range(steps)):
            np.matmul(rec, h, out=u)
            zr = gates[t, :two] + u[:two]
            zr *= np.float32(0.5)
            np.tanh(zr, out=zr)
            zr *= np.float32(0.5)
            zr += np.float32(0.5)
            z, r = zr[:HIDDEN], zr[HIDDEN:]
            new = r * u[two:]
            new += gates[t, two:]
            np.tanh(new, out=new)
            if kept is not None:
                kept.append((t, h, z, r, new, u[two:].copy()))
            h = np.subtract(h, new, out=states[t])
            h *= z
            h += new
        return states

    def forward(self, vectors: np.ndarray, index: np.ndarray, live: np.ndarray, keep: bool = False):
        """Logit of each window; ``index`` (step, window) says which word stands where."""
        kept: dict = {"f": [], "b": []}
        states = []
        for side in ("f", "b"):
            share = np.concatenate([vectors @ self.p[f"in_{side}"] + self.p[f"bias_{side}"], np.zeros((1, 3 * HIDDEN), np.float32)])
            gates = np.ascontiguousarray(share[index].transpose(0, 2, 1))
            states.append(self.run(gates, side, kept[side] if keep else None))
        h = np.concatenate(states, axis=1)
        hidden = np.matmul(self.p["att"].T, h)
        np.tanh(hidden, out=hidden)
        weight = np.matmul(self.p["att_out"], hidden)
        weight = np.where(live, weight, np.float32(-1e9))
        weight = np.exp(weight - weight.max(axis=0)) * live
        weight /= np.maximum(weight.sum(axis=0), np.float32(1e-9))
        pooled = np.einsum("tn,thn->hn", weight, h)
        logit = self.p["out"] @ pooled + self.p["out_bias"][0]
        return (logit, (kept, h, hidden, weight, pooled)) if keep else logit

    def backward(self, x: Inputs, vectors: np.ndarray, index: np.ndarray, cache, slope: np.ndarray, shown: np.ndarray | bool = True) -> dict:
        """Gradients of the loss whose derivative by each logit is ``slope``; every window has words of its own.

        ``shown`` says which words have their own vector in ``vectors``.
        """
        kept, h, hidden, weight, pooled = cache
        p, g = self.p, {}
        g["out"], g["out_bias"] = pooled @ slope, np.array([slope.sum()], np.float32)
        d_pooled = p["out"][:, None] * slope
        d_weight = np.einsum("thn,hn->tn", h, d_pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["att_out"] = np.einsum("tkn,tn->k", hidden, d_score)
        d_hidden = p["att_out"][:, None] * d_score[:, None, :] * (1 - hidden**2)
        g["att"] = np.einsum("thn,tkn->hk", h, d_hidden, optimize=True)
        d_h = weight[:, None, :] * d_pooled + np.matmul(p["att"], d_hidden)
        d_vectors = np.zeros((len(vectors), vectors.shape[1]), np.float32)
        for k, side in enumerate(("f", "b")):
            rec = p[f"rec_{side}"]
            d_share = np.zeros((len(vectors) + 1, 3 * HIDDEN), np.float32)
            g[f"rec_{side}"] = np.zeros_like(rec)
            carry = np.zeros((HIDDEN, index.shape[1]), np.float32)
            for t, old, z, r, new, u in reversed(kept[side]):
                d = carry + d_h[t, k * HIDDEN : (k + 1) * HIDDEN]
                d_new = d * (1 - z) * (1 - new**2)
                d_z = d * (old - new) * z * (1 - z)
                d_r = d_new * u * r * (1 - r)
                d_u = np.concatenate([d_z, d_r, d_new * r])
                d_share[index[t]] = np.concatenate([d_z, d_r, d_new]).T
                g[f"rec_{side}"] += old @ d_u.T
                carry = d * z + rec @ d_u
            d_share = d_share[:-1]
            g[f"in_{side}"] = vectors.T @ d_share
            g[f"bias_{side}"] = d_share.sum(axis=0)
            d_vectors += d_share @ p[f"in_{side}"].T
        size = np.diff(x.triple_at)
        own = d_vectors[:, :WORD_SIZE] * np.broadcast_to(shown, len(d_vectors))[:, None]
        g["words"] = summed(x.word, own, WORD_ROWS)
        g["chars"] = summed(x.triple, np.repeat(d_vectors[:, WORD_SIZE:] / size[:, None], size, axis=0), CHAR_ROWS)
        return g


def summed(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``values`` by their row."""
    return np.stack([np.bincount(rows, v, n) for v in values.T], axis=1).astype(np.float32)


def layout(x: Inputs, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word indices (step, window) and which of them are there; the others point behind the last word."""
    step = np.arange(max(1, int(x.size[chosen].max()) if len(chosen) else 1))[:, None]
    live = step < x.size[chosen]
    return np.where(live, x.window[chosen] + step, len(x.word)), live


def window_logits(model: Model, x: Inputs, lot: int = 1024) -> np.ndarray:
    out = np.empty(len(x.window), np.float32)
    for i in range(0, len(out), lot):
        chosen = np.arange(i, min(i + lot, len(out)))
        low, high = int(x.window[chosen[0]]), int((x.window + x.size)[chosen].max())
        index, live = layout(x, chosen)
        out[chosen] = model.forward(model.embed(x, low, high), np.where(live, index - low, high - low), live)
    return out


def subset(x: Inputs, chosen: np.ndarray) -> Inputs:
    """Only the chosen windows, with the words they hold."""
    size = x.size[chosen]
    first = np.cumsum(size) - size
    take = np.repeat(x.window[chosen] - first, size) + np.arange(size.sum())
    letters = np.diff(x.triple_at)[take]
    begin = np.cumsum(letters) - letters
    triples = np.repeat(x.triple_at[:-1][take] - begin, letters) + np.arange(letters.sum())
    return Inputs(x.word[take], x.triple[triples], np.concatenate([[0], np.cumsum(letters)]), first, size, np.arange(len(chosen)), len(chosen))


def hints(buckets: np.ndarray, owner: np.ndarray, toxic: np.ndarray, rows: int) -> np.ndarray:
    """How many standard errors more toxic texts than clean ones hold each bucket; 0 where chance could explain it."""
    holds = np.zeros((len(toxic), rows), bool)
    holds[owner, buckets] = True
    n1, n0 = (toxic == 1).sum(), (toxic == 0).sum()
    held1, held0 = (holds[toxic == y].sum(axis=0) for y in (1, 0))
    pooled = (held1 + held0) / (n1 + n0)
    error = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-9) * (1 / n1 + 1 / n0))
    z = (held1 / n1 - held0 / n0) / error
    return np.where(np.abs(z) > 3.5, z, 0)


def train(texts: list[str], toxic: np.ndarray, steps: int = STEPS, seed: int = SEED, lot: int = 64) -> Model:
    """Adam on the logistic loss of each document's worst window, the rarer class weighted up.

    A fifth of the sample only says which parameters to keep, those with the least loss on it. Some words go without
    their own vector at each step, so that letters have to carry the meaning of words not seen before.
    The first component of an input vector starts from the sample's hints on its word or letter triple, and so does
    the choice of worst windows, which a few hundred labelled texts could not settle by themselves.
    """
    model, rng = Model(seed), np.random.default_rng(seed)
    if not len(texts) or len(set(toxic.tolist())) < 2:
        model.p["out"][:] = 0
        model.p["out_bias"][:] = 4.0 if len(toxic) and toxic.all() else -4.0
        return model
    x = inputs_of_texts(texts)
    at = common.per_text(x.owner, x.texts)
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    rare = toxic == int(2 * toxic.sum() < len(toxic))
    share = np.where(rare, np.sqrt((~rare).sum() / rare.sum()), 1.0)
    share /= share.mean()
    judging = np.zeros(x.texts, bool)
    for y in (0, 1):
        judging[np.flatnonzero(toxic == y)[4::5]] = True
    kept, least, learning = None, np.inf, np.flatnonzero(~judging)
    owner = np.searchsorted(x.window[at[:-1]], np.arange(len(x.word)), side="right").astype(np.int32) - 1
    letters = np.repeat(owner, np.diff(x.triple_at))
    use, letters_use = ~judging[owner], ~judging[letters]
    model.p["words"][:, 0] = np.clip(hints(x.word[use], owner[use], toxic, WORD_ROWS) / 4, -2, 2)
    model.p["chars"][:, 0] = np.clip(hints(x.triple[letters_use], letters[letters_use], toxic, CHAR_ROWS) / 4, -2, 2)
    evidence = np.zeros(len(x.word) + 1, np.float32)
    if len(x.word):
        mean = np.add.reduceat(model.p["chars"][x.triple, 0], x.triple_at[:-1]) / np.diff(x.triple_at)
        evidence[:-1] = model.p["words"][x.word, 0] + mean
    best = np.array([evidence[a : a + n].max(initial=0) for a, n in zip(x.window.tolist(), x.size.tolist(), strict=True)])
    worst = np.array([a + int(np.argmax(best[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)])
    order = np.zeros(0, np.int64)
    per_look = max(10, -(-x.texts // lot))
    for step in range(1, steps + 1):
        if step % per_look == 0 or step == steps:
            logits = window_logits(model, x)
            worst = np.array([a + int(np.argmax(logits[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)])
            sign = np.where(toxic == 1, -1, 1)[judging]
            loss = float((np.logaddexp(0, sign * logits[worst][judging]) * share[judging]).sum())
            if loss < least or kept is None:
                least, kept = loss, {k: v.copy() for k, v in model.p.items()}
        if not len(order):
            order = rng.permutation(learning)
        docs, order = order[:lot], order[lot:]
        # Besides its worst window a toxic text learns from a random one at first; a clean text always does.
        other = rng.integers(at[docs], at[docs + 1])
        use = np.concatenate([np.ones(len(docs), bool), (toxic[docs] == 0) | (step < steps // 5)])
        chosen, label = np.concatenate([worst[docs], other])[use], np.tile(toxic[docs], 2)[use]
        weight = (np.tile(share[docs], 2) * 0.5)[use]
        part = subset(x, chosen)
        vectors = model.embed(part)
        hidden = rng.random(len(vectors)) < 0.3
        vectors[hidden, :WORD_SIZE] = 0
        index, live = layout(part, np.arange(len(chosen)))
        logit, cache = model.forward(vectors, index, live, keep=True)
        slope = ((sigmoid(logit) - label) * weight / len(docs)).astype(np.float32)
        for k, g in model.backward(part, vectors, index, cache, slope, ~hidden).items():
            first[k] += (g - first[k]) * 0.1
            second[k] += (g * g - second[k]) * 0.01
            model.p[k] -= 0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
    model.p = kept or model.p
    return model


def score_texts(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of each text's worst window."""
    x = inputs_of(data, offsets)
    logits = window_logits(model, x)
    worst = np.maximum.reduceat(logits, common.per_text(x.owner, x.texts)[:-1]) if x.texts else logits
    return sigmoid(worst.astype(np.float64))


def held_out() -> F.Column:
    """Rows whose labels are never learnt from; a null doc_id counts as held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE) -> DataFrame:
    """text and label y of at most ``sample`` learnable documents that are clean, and toxic, those with the least hash.

    Repeated labels count once.
    """
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    picked = common.union_all([known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in enumerate(sample)])
    rows = docs.select(F.col("doc_id"), common.text_of(docs).alias("text")).join(F.broadcast(picked), "doc_id")
    # The order by hash keeps the sample bounded when ids repeat among the documents.
    return rows.select("text", "y", F.xxhash64("doc_id", "text").alias("h")).orderBy("h").limit(2 * sum(sample)).select("text", "y")


def trained(rows: DataFrame, steps: int = STEPS) -> Model:
    """The model of a bounded sample; it is fitted by one task, so that the driver never holds the texts."""

    def run(batches):
        texts, toxic = [], []
        for batch in batches:
            texts += [t or "" for t in batch.column("text").to_pylist()]
            toxic += batch.column("y").to_pylist()
        out = io.BytesIO()
        np.savez(out, **train(texts, np.array(toxic, np.int64), steps).p)
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], ["model"])

    found = rows.coalesce(1).mapInArrow(run, "model binary").collect()
    if not found:
        return train([], np.zeros(0, np.int64))
    model = Model()
    with np.load(io.BytesIO(found[0]["model"])) as parameters:
        model.p = {k: parameters[k] for k in parameters.files}
    return model


def score(docs: DataFrame, labels: DataFrame, sample: tuple[int, int] = SAMPLE, steps: int = STEPS) -> DataFrame:
    """Every row of ``docs`` with held_out, score and predicted; other columns stay.

    Null and empty texts have the score of an empty window. Columns of these names are replaced. Without labels of
    both kinds the model says the one kind there is, or clean. No rows give no rows.
    """
    spark = docs.sparkSession
    model = trained(training_sample(docs, labels, sample), steps)
    shared = spark.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    rows = docs.select(*keep, common.text_of(docs).alias("__text"))
    schema = rows.drop("__text").withColumn("score", F.lit(0.0)).schema

    def run(batches):
        for batch in batches:
            for part in common.steps(batch, "__text"):
                found = score_texts(shared.value, *common.buffer_of(part.column("__text")))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(found)], [*keep, "score"])

    out = rows.mapInArrow(run, schema)
    return out.select(*keep, held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

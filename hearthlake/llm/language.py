"""Hierarchical Pitman-Yor language model: every word's restaurant of next words shares the root restaurant as parent.

Texts become slices: the different words of some documents as 64-bit names, and all tokens as numbers of these words. What
is global, counts of words and of pairs of a word and its predecessor, is gathered by a packed exchange (:func:`totals`):
a slice sends one entry per different key, the task of a bucket adds them up and answers each slice in its own order.

The seats of all customers of one dish in one restaurant are one Gibbs block: they are seated anew by the
Chinese-restaurant rule, given the parent's probability and the restaurant's other tables, with Metropolis-Hastings
steps that make up for the order of seating. The work of a block grows with its tables, not with its customers. Random
numbers are a function of the key and the sweep, so a lost task draws the same seats again. A pair's seats are drawn by
one slice that has it, its owner.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake import session
from hearthlake.llm import common

HELD_OUT = (7, 2)
# Sweeps whose probabilities are averaged, those before them, re-seatings of a block in a sweep, strength of each level.
SAMPLES, BURN_IN, MOVES, STRENGTH = 2, 1, 2, 1.0
END = np.uint64(0x5851F42D4C957F2D)
SUMMARY, DRAWN = -1, -2  # instead of a slice
MESSAGE = "slice long, bucket int, payload binary"

Keys = tuple[np.ndarray, list[np.ndarray]]


# ---- seats ----------------------------------------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function of positive numbers, by Stirling's series after a shift of eight."""
    shift = np.ones_like(x)
    for k in range(8):
        shift = shift * (x + k)
    y = x + 8
    series = (1 / 12 - (1 / 360 - 1 / (1260 * y * y)) / (y * y)) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def uniform(keys: np.ndarray, step: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on a 64-bit key and a step."""
    bits = common.mix(common.mix(keys + np.uint64(0x9E3779B97F4A7C15)) + np.uint64(step * 0xD1342543DE82EF95 & (1 << 64) - 1))
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


TABLED = 64


@cache
def _beyond(discount: float) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of more than 1, 2, ... customers at a table."""
    n, scale = np.arange(1, TABLED + 1), log_gamma(np.array([1 - discount]))
    return np.exp(log_gamma(n + 1 - discount) - log_gamma(n + 1.0) - scale), scale


def table_sizes(u: np.ndarray, discount: float) -> np.ndarray:
    """Sizes of single tables: n with probability discount * Gamma(n - discount) / (Gamma(1 - discount) * n!), by inversion.

    Beyond :data:`TABLED` the ratio of Gamma functions is taken for a power, which is right to a few millionths.
    """
    beyond, scale = _beyond(discount)
    sizes = 1 + np.searchsorted(-beyond, -u, side="right").astype(np.int64)
    tail = np.flatnonzero(sizes > TABLED)
    large = np.ceil(np.exp(-(np.log(u[tail]) + scale) / discount) - (1 - discount) / 2)
    sizes[tail] = np.clip(large, TABLED + 1, 1 << 60).astype(np.int64)
    return sizes


def tilted_sizes(tilt: np.ndarray, discount: float, keys: np.ndarray, step: int) -> np.ndarray:
    """Sizes as in :func:`table_sizes`, with the probability of n times ``tilt ** n``."""
    sizes = np.ones(len(tilt), np.int64)
    active = np.flatnonzero(tilt < 0.5)
    u, p = uniform(keys[active], step), discount * tilt[active] / -np.expm1(discount * np.log1p(-tilt[active]))
    while len(active):
        u = u - p
        go = (u > 0) & (sizes[active] < 1000)
        active, u, p = active[go], u[go], p[go]
        p = p * tilt[active] * (sizes[active] - discount) / (sizes[active] + 1)
        sizes[active] += 1
    active = np.flatnonzero(tilt >= 0.5)
    log_tilt = np.log(tilt)
    while len(active):
        sizes[active] = table_sizes(uniform(keys[active], step), discount)
        active = active[np.log(uniform(keys[active], step + 1)) > sizes[active] * log_tilt[active]]
        step += 2
    return sizes


def tilt_of(customers: np.ndarray, new: np.ndarray, discount: float) -> np.ndarray:
    """The tilt under which the expected sizes of all tables add up to the customers."""
    low, high = np.zeros(len(customers)), np.full(len(customers), 50.0)  # minus the logarithm of 1 - tilt
    for _ in range(18):
        rest = np.exp(-(low + high) / 2)
        z = 1 - rest
        less = new * z * rest ** (discount - 1) + 1 + (1 - discount) * z / rest < customers
        low, high = np.where(less, (low + high) / 2, low), np.where(less, high, (low + high) / 2)
    return np.maximum(1 - np.exp(-(low + high) / 2), 1e-300)


def seating(customers: np.ndarray, new: np.ndarray, discount: float, tilt: np.ndarray, keys: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """A proposed seating of ``customers``: its tables, and the logarithm of what it is worth beside how likely it is proposed.

    The tables other than the first customer's arrive one by one, each with a size; the first customer's table has the
    rest. A seating in which the others take everybody is worth nothing.
    """
    tables, left, clock = np.ones(len(customers), np.int64), customers.astype(np.int64), np.zeros(len(customers))
    rate = new / discount * -np.expm1(discount * np.log1p(-tilt))
    active = np.arange(len(customers))
    while len(active):
        clock[active] -= np.log(uniform(keys[active], step + 1))
        active = active[clock[active] < rate[active]]
        left[active] -= tilted_sizes(tilt[active], discount, keys[active], step + 2)
        tables[active] += 1
        active = active[left[active] > 0]
        step += 1 << 12
    return tables, _worth(left, discount, tilt)


def _worth(first: np.ndarray, discount: float, tilt: np.ndarray) -> np.ndarray:
    some = np.maximum(first, 1).astype(np.float64)
    return np.where(first > 0, log_gamma(some - discount) - log_gamma(some) + some * np.log(tilt), -np.inf)


def seats(customers: np.ndarray, new: np.ndarray, discount: float, keys: np.ndarray, sweep: int) -> np.ndarray:
    """Tables of each block after :data:`MOVES` re-seatings, from one table each.

    The steps leave the Chinese-restaurant distribution as it is: ``new`` to the number of tables, times (i - discount) for
    the customer that joins i others, over all seatings.
    """
    out = np.ones(len(customers), np.int64)
    several = np.flatnonzero(customers > 1)
    c, a, k = customers[several].astype(np.int64), new[several].astype(np.float64), keys[several]
    tilt = tilt_of(c, a, discount)
    tables, worth = np.ones(len(c), np.int64), _worth(c, discount, tilt)
    for move in range(MOVES):
        step = sweep << 48 | move << 40
        other, its = seating(c, a, discount, tilt, k, step + 1)
        take = np.log(uniform(k, step)) < its - worth
        tables, worth = np.where(take, other, tables), np.where(take, its, worth)
    out[several] = tables
    return out


def discount_of(once: int, twice: int) -> float:
    """The usual estimate from how many keys occur once and twice, kept off the ends of its range."""
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


# ---- slices and their exchange --------------------------------------------------------------------------------


def _packed(payload: object) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(payload, protocol=5))


def _unpacked(payload: bytes) -> object:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(payload))


def _row(slice_id: int, bucket: int, payload: object) -> tuple[int, int, bytes]:
    return slice_id, bucket, _packed(payload)


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.binary()))], ["slice", "bucket", "payload"])


def _narrow(values: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as hold them."""
    top = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _planes(values: np.ndarray) -> list[np.ndarray]:
    """Counts byte by byte, the lowest first: small ones pack well whatever the largest is."""
    top = int(values.max()) if len(values) else 0
    return [(values >> shift & 255).astype(np.uint8) for shift in range(0, max(1, top.bit_length()), 8)]


def _whole(planes: list[np.ndarray]) -> np.ndarray:
    out = planes[0].astype(np.int64)
    for k, plane in enumerate(planes[1:], 1):
        out |= plane.astype(np.int64) << 8 * k
    return out


def name(word: bytes) -> bytes:
    return hashlib.blake2b(word, digest_size=8).digest()


def word_names(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit names of the different lower-cased words, the last one END; number of each word among them; and its text."""
    data, offsets = common.buffer_of(texts)
    starts, ends, owner = common.words_of(data, offsets)
    letters = data[~common.SEPARATORS[data]]
    letters = np.where((letters >= 65) & (letters <= 90), letters + np.uint8(32), letters)
    cuts = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(letters)]).dictionary_encode()
    names = np.frombuffer(b"".join(map(name, words.dictionary.to_pylist())), "<u8")
    return np.append(names, END), words.indices.to_numpy(), owner


def slices(docs: DataFrame) -> DataFrame:
    """Stored slices of ``docs``: words; and in tokens doc_ids and held per document, starts of its tokens, and these."""
    n, left_out = HELD_OUT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in common.steps(batch):
                words, numbers, owner = word_names(part.column("text"))
                per_text = np.bincount(owner, minlength=part.num_rows)
                begins = np.concatenate([[0], np.cumsum(per_text + 1)])
                tokens = np.full(int(begins[-1]), len(words) - 1)
                tokens[np.arange(len(numbers)) + owner] = numbers
                times = np.bincount(tokens, minlength=len(words))
                # Frequent words get small numbers, whose bytes are stored apart and pack well.
                order = np.argsort(-times, kind="stable")
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                words, tokens = words[order], rank[tokens]
                payload = {"doc_ids": part.column("doc_id").to_pylist(), "held": part.column("held").to_numpy(zero_copy_only=False), "starts": begins, "planes": _planes(tokens)}
                columns = [pa.array([number], pa.int64()), pa.array([_packed(words)], pa.binary()), pa.array([_packed(payload)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["slice", "words", "tokens"])
                number += 1

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % n == left_out, F.lit(False)).alias("held")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of(docs).alias("text"), held)
    return common.materialise(rows.mapInArrow(run, "slice long, words binary, tokens binary"), "slices", keep=True)


def pair_names(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return common.mix(common.mix(context) + word)


class Slice:
    """What a stored slice says of its tokens: pairs of a word and its predecessor, the first one's being END."""

    def __init__(self, words: bytes, tokens: bytes):
        self.words = _unpacked(words)
        self.__dict__.update(_unpacked(tokens))
        tokens = _whole(self.planes)
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[self.starts[:-1]] = np.flatnonzero(self.words == END)[0]
        code, self.pair = np.unique(before * len(self.words) + tokens, return_inverse=True)
        self.context, self.word = np.divmod(code, len(self.words))
        self.learns = np.repeat(~self.held, np.diff(self.starts))
        self.pair_keys = pair_names(self.words[self.context], self.words[self.word])
        self.tokens = tokens

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.learns], minlength=len(self.words))

    def pair_counts(self) -> np.ndarray:
        return np.bincount(self.pair[self.learns], minlength=len(self.context))


def _offer(slice_id: int, keys: np.ndarray, values: list[np.ndarray], buckets: int, short: bool = False) -> list[tuple[int, int, bytes]]:
    """One message per bucket with its keys, in the slice's order, and their values.

    ``short`` sends 40 bits of a key beside its bucket: the counts of two pairs that agree in them are added up.
    """
    bucket = ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    out = []
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        mine = order[cuts[b] : cuts[b + 1]]
        sent = keys[mine]
        out.append(_row(slice_id, b, ([sent.astype(np.uint32), (sent >> np.uint64(32)).astype(np.uint8)] if short else [sent], [_planes(v[mine]) for v in values])))
    return out


def _keys(sent: list[np.ndarray]) -> np.ndarray:
    return sent[0] if len(sent) == 1 else sent[0].astype(np.uint64) | sent[1].astype(np.uint64) << np.uint64(32)


def _answers(keys: np.ndarray, got: list[tuple[int, list[list[np.ndarray]]]], buckets: int) -> list[np.ndarray]:
    """The buckets' answers put into the order of the slice's keys."""
    order = np.argsort(((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32), kind="stable")
    out = []
    for column in zip(*(values for _, values in sorted(got, key=lambda g: g[0])), strict=True):
        values = np.empty(len(keys), np.int64)
        values[order] = np.concatenate([_whole(c) for c in column])
        out.append(values)
    return out


def totals(messages: DataFrame, buckets: int, combine: Callable[[np.ndarray, list[np.ndarray]], tuple[list[np.ndarray], object]], name: str, owners: bool = False, drawn: bool = False, keep: bool = True) -> DataFrame:
    """Answers to ``messages``: ``combine`` makes them from the different keys of a bucket and the sums of their values.

    What it says of the bucket as a whole comes as the payload of a row of slice SUMMARY. With ``owners`` one more answer
    is 1 for one of the slices that sent a value of a key, which is as likely to be any of them. Messages of slice DRAWN are
    passed on as they are, for an exchange with ``drawn``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        senders, keys, values = [], [], []
        bucket = -1
        for batch in batches:
            for sender, at, payload in zip(*(batch.column(c).to_pylist() for c in ("slice", "bucket", "payload")), strict=True):
                bucket = at
                if sender == DRAWN and not drawn:
                    yield _as_it_is(sender, at, payload)
                    continue
                k, v = _unpacked(payload)
                senders.append(sender)
                keys.append(_keys(k))
                values.append(v)
        if not senders:
            return
        sizes = [len(k) for k in keys]
        unique, at = np.unique(np.concatenate(keys), return_inverse=True)
        columns = [np.concatenate([_whole(v[c]).astype(np.float64) for v in values]) for c in range(len(values[0]))]
        sums = [np.bincount(at, weights=c, minlength=len(unique)).astype(np.int64) for c in columns]
        answers, summary = combine(unique, sums)
        mine = [a[at] for a in answers]
        if owners:
            giving = np.flatnonzero(columns[0] > 0)
            sender = np.repeat(np.array(senders, np.uint64), sizes)[giving]
            order = np.lexsort((common.mix(common.mix(sender) + unique[at[giving]]), at[giving]))
            first = giving[order[np.unique(at[giving][order], return_index=True)[1]]]
            mine.append(np.zeros(len(at), np.uint8))
            mine[-1][first] = 1
        edges = np.concatenate([[0], np.cumsum(sizes)]).tolist()
        yield _rows([_row(SUMMARY, bucket, summary)])
        for i, a, b in zip(range(len(senders)), edges[:-1], edges[1:], strict=True):
            if senders[i] != DRAWN:
                yield _rows([_row(senders[i], bucket, [_planes(m[a:b]) for m in mine])])

    return common.materialise(messages.repartitionById(buckets, F.col("bucket")).mapInArrow(run, MESSAGE), name, keep)


def _as_it_is(*row: object) -> pa.RecordBatch:
    return _rows([row])


def summaries(answers: DataFrame) -> list:
    """What the buckets say of themselves: a few numbers each."""
    return [_unpacked(r.payload) for r in answers.filter(F.col("slice") == SUMMARY).select("payload").collect()]


def at_home(tables: list[DataFrame], work: Callable[[int, list[dict[int, bytes]]], pa.RecordBatch], schema: str, buckets: int) -> DataFrame:
    """``work`` over each slice and what each of ``tables`` has for it, by bucket."""
    width = len(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, [{} for _ in range(width)]
        for batch in batches:
            for i, slice_id in enumerate(batch.column("slice").to_pylist()):
                if slice_id != current:
                    if current is not None:
                        yield work(current, held)
                    current, held = slice_id, [{} for _ in range(width)]
                held[batch.column("table")[i].as_py()][batch.column("bucket")[i].as_py()] = batch.column("payload")[i].as_py()
        if current is not None:
            yield work(current, held)

    rows = common.union_all([t.filter("slice >= 0").withColumn("table", F.lit(k)) for k, t in enumerate(tables)])
    return rows.repartition(buckets, "slice").sortWithinPartitions("slice").mapInArrow(run, schema)


def _got(table: dict[int, bytes]) -> list[tuple[int, list[list[np.ndarray]]]]:
    return [(b, _unpacked(p)) for b, p in table.items()]


# ---- the model ------------------------------------------------------------------------------------------------


def _ask(stored: DataFrame, buckets: int, what: Callable[[Slice], Keys], short: bool = False) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slice_id, words, tokens in zip(batch.column("slice").to_pylist(), batch.column("words"), batch.column("tokens"), strict=True):
                yield _rows(_offer(slice_id, *what(Slice(words.as_py(), tokens.as_py())), buckets, short))

    return stored.mapInArrow(run, MESSAGE)


def _part(stored: DataFrame, column: str, number: int) -> DataFrame:
    return stored.select("slice", F.lit(number).alias("bucket"), F.col(column).alias("payload"))


def _counted(keys: np.ndarray, sums: list[np.ndarray]) -> tuple[list[np.ndarray], object]:
    n = sums[0]
    return [n], (int(n.sum()), int((n > 0).sum()), int((n == 1).sum()), int((n == 2).sum()))


def _owned(stored: DataFrame, pairs: DataFrame, buckets: int) -> DataFrame:
    """Per slice the pairs whose seats it draws, and how many single ones of them each of its words has on either side."""

    def work(slice_id: int, tables: list[dict[int, bytes]]) -> pa.RecordBatch:
        own = Slice(tables[0][-1], tables[1][-1])
        count, mine = _answers(own.pair_keys, _got(tables[2]), buckets)
        single, many = np.flatnonzero((mine > 0) & (count == 1)), np.flatnonzero((mine > 0) & (count > 1))
        payload = {
            "single": [_narrow(np.bincount(side[single], minlength=len(own.words))) for side in (own.context, own.word)],
            "context": _narrow(own.context[many]), "word": _narrow(own.word[many]), "count": _narrow(count[many]),
        }
        return _rows([_row(slice_id, -1, payload)])

    both = [_part(stored, "words", -1), _part(stored, "tokens", -1), pairs]
    return common.materialise(at_home(both, work, MESSAGE, buckets), "owned")


def _sums(words: np.ndarray, owned: dict, tables: np.ndarray) -> Keys:
    """Tables that a slice's own pairs add to each word's restaurant, and customers to its dish in the root."""
    n = len(words)
    return words, [s.astype(np.int64) + np.bincount(owned[side], weights=tables, minlength=n).astype(np.int64) for s, side in zip(owned["single"], ("context", "word"), strict=True)]


class Sample:
    """One sample of the root: its scalars, and what they make of a word's answers."""

    def __init__(self, answers: list, known: int, discount: float):
        self.customers, self.tables = sum(a[0] for a in answers), sum(a[1] for a in answers)
        self.known, self.discount = known, discount

    @property
    def new(self) -> float:
        """Weight of a new table of any one word in the root, whose parent is uniform over known words and one unknown."""
        return (STRENGTH + self.discount * self.tables) / (self.known + 1)

    def probability(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        return (customers - self.discount * tables + self.new) / (STRENGTH + self.customers)


def _swept(stored: DataFrame, owned: DataFrame, answers: DataFrame | None, sample: Sample | None, discount: float, sweep: int, buckets: int) -> DataFrame:
    """Messages with the sums of new seats, drawn given ``answers``; one table per pair where there are none yet.

    The tables of single pairs go along from the sweeps whose samples count.
    """

    def work(slice_id: int, tables: list[dict[int, bytes]]) -> pa.RecordBatch:
        words, own = _unpacked(tables[0][-1]), _unpacked(tables[1][-1])
        drawn, keys = np.ones(len(own["count"]), np.int64), pair_names(words[own["context"]], words[own["word"]])
        if sample is not None:
            seated, customers, root_tables = _answers(words, _got(tables[2]), buckets)
            weight = (STRENGTH + discount * seated[own["context"]]) * sample.probability(customers, root_tables)[own["word"]]
            drawn = seats(own["count"].astype(np.int64), weight, discount, keys, sweep)
        rows = _offer(slice_id, *_sums(words, own, drawn), buckets)
        if sweep >= BURN_IN:
            rows += [(DRAWN, bucket, payload) for _, bucket, payload in _offer(slice_id, keys, [drawn], buckets, short=True)]
        return _rows(rows)

    return at_home([_part(stored, "words", -1), owned, *([answers] if answers is not None else [])], work, MESSAGE, buckets)


def _root(discount: float, new: float, sweep: int) -> Callable[[np.ndarray, list[np.ndarray]], tuple[list[np.ndarray], object]]:
    def combine(keys: np.ndarray, sums: list[np.ndarray]) -> tuple[list[np.ndarray], object]:
        tables = np.where(sums[1] > 0, seats(sums[1], np.full(len(keys), new), discount, keys, sweep), 0)
        return [*sums, tables], (int(sums[1].sum()), int(tables.sum()), int((sums[1] == 1).sum()), int((sums[1] == 2).sum()))

    return combine


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame) -> DataFrame:
    """Per document of ``docs`` (doc_id, text; more columns are left alone) its log10 probability, and the base's.

    The model learns from documents whose crc32 of doc_id is not held out; a row without doc_id is learnt from. Null texts
    are empty: one end token. Repeated rows count each, a text of any length is one slice; no rows give no rows, and
    where nothing is learnt every word is the one unknown word.
    """
    buckets = common.tasks_for(docs)
    stored = slices(docs)
    words = totals(_ask(stored, buckets, lambda s: (s.words, [s.word_counts()])), buckets, _counted, "word_counts")
    n, known = (sum(c) for c in zip(*(s[:2] for s in summaries(words)), strict=True)) if not words.isEmpty() else (0, 0)
    pairs = totals(_ask(stored, buckets, lambda s: (s.pair_keys, [s.pair_counts()]), short=True), buckets, _counted, "pair_counts", owners=True)
    found = summaries(pairs)
    discount = discount_of(sum(f[2] for f in found), sum(f[3] for f in found))
    with session.scratch(docs.sparkSession):
        owned = _owned(stored, pairs, buckets)

        # Tables by sweep, each drawn given the one before, and what they make of the root.
        answers, sample, root_discount, new = None, None, 0.5, STRENGTH
        kept: list[tuple[DataFrame, Sample]] = []
        for sweep in range(BURN_IN + SAMPLES):
            messages = _swept(stored, owned, answers, sample, discount, sweep, buckets)
            answers = totals(messages, buckets, _root(root_discount, new, sweep), "tables", keep=sweep >= BURN_IN)
            found = summaries(answers)
            if sweep == 0:
                root_discount = discount_of(sum(f[2] for f in found), sum(f[3] for f in found))
            sample = Sample(found, known, root_discount)
            new = sample.new
            if sweep >= BURN_IN:
                kept.append((answers, sample))
        samples = [s for _, s in kept]
    questions = _ask(stored, buckets, lambda s: (s.pair_keys, [np.zeros(len(s.pair_keys), np.int64)]), short=True)
    drawn = [a.filter(F.col("slice") == DRAWN) for a, _ in kept]
    pair_tables = totals(common.union_all([questions, *drawn]), buckets, lambda _, sums: (sums, None), "pair_tables", drawn=True)

    def finish(_: int, tables: list[dict[int, bytes]]) -> pa.RecordBatch:
        own = Slice(tables[0][-1], tables[1][-1])
        count = _answers(own.words, _got(tables[2]), buckets)[0]
        pair_count = _answers(own.pair_keys, _got(tables[3]), buckets)[0]
        summed = _answers(own.pair_keys, _got(tables[4]), buckets)[0]
        mean_tables = np.where(pair_count > 1, summed / len(samples), pair_count)
        back_off = np.zeros(len(pair_count))
        for k, s in enumerate(samples):
            seated, customers, root_tables = _answers(own.words, _got(tables[5 + k]), buckets)
            back_off += (STRENGTH + discount * seated[own.context]) * s.probability(customers, root_tables)[own.word]
        probability = (pair_count - discount * mean_tables + back_off / len(samples)) / (STRENGTH + count[own.context])
        token_count = count[own.tokens]
        begins = own.starts[:-1]
        columns = [
            np.add.reduceat(token_count > 0, begins, dtype=np.int64),
            np.add.reduceat(np.log10((token_count + 1) / (n + known + 1)), begins),
            np.add.reduceat(np.log10(probability)[own.pair], begins),
        ]
        length = np.diff(own.starts)
        arrays = [pa.array(own.doc_ids, pa.int64()), pa.array(own.held), pa.array(length), pa.array(columns[0]), pa.array(np.full(len(length), n, np.int64)), pa.array(columns[1]), pa.array(columns[2])]
        return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in RESULT.split(", ")])

    both = [_part(stored, "words", -1), _part(stored, "tokens", -1)]
    return at_home([*both, words, pairs, pair_tables, *(a for a, _ in kept)], finish, RESULT, buckets)

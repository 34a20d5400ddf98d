"""Suffix arrays by linear grouping, and substring dedup of bytes on top of them.

The construction keeps suffixes in groups by their Lyndon prefix found so far. Groups are taken in descending order:
every member points to the nearest earlier suffix of a smaller group, and the suffixes pointed at gain the members'
prefix, which moves them to a group of their own right above the one they leave. When all groups are done they are
sorted by their Lyndon prefixes, and one ascending pass over the suffix array emits the order inside each group, along
the same pointers. No suffix is renamed and nothing recurses. (Baier, Linear-time Suffix Sorting, CPM 2016.)
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake import session
from hearthlake.llm import common, places

# Symbols of a table of texts that are sorted in step, and the longest text that is; longer ones are sorted alone.
TABLE_CELLS = 400_000
IN_STEP = 1024

# A core that stands so often in one slice of texts, or is sent more than so often by all (two places of a slice at
# most), is crowded. The others have at most half the product of fragments.
CROWD = (32, 1024)


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix array of one text whose last symbol is its only least one."""
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    sa = np.argsort(symbols, kind="stable")
    ranked = np.asarray(symbols)[sa]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    sizes = np.diff(np.append(first, n))
    place = np.empty(n, np.int64)
    place[sa] = np.arange(n)
    group = np.empty(n, np.int64)
    group[sa] = np.repeat(first, sizes)
    sa, place, group = sa.tolist(), place.tolist(), group.tolist()
    size = dict(zip(first.tolist(), sizes.tolist(), strict=True))
    before = [-1] * n
    end = n
    while end:
        start = group[sa[end - 1]]
        pointed: dict[int, int] = {}
        for i in sorted(sa[start:end]):
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = before[j]
            before[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        for times in sorted(set(pointed.values()), reverse=True):
            by_group: dict[int, list[int]] = {}
            for p, c in pointed.items():
                if c == times:
                    by_group.setdefault(group[p], []).append(p)
            for old, moved in by_group.items():
                tail = old + size[old]
                for p in moved:
                    tail -= 1
                    at, other = place[p], sa[tail]
                    sa[at], sa[tail], place[other], place[p] = other, p, at, tail
                size[old] -= len(moved)
                size[tail] = len(moved)
                for p in moved:
                    group[p] = tail
        end = start
    out, done, front = [-1] * n, [False] * n, list(range(n))
    out[0], done[n - 1] = n - 1, True
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not done[j]:
            out[front[group[j]]] = j
            front[group[j]] += 1
            done[j] = True
            j = before[j]
    return np.array(out)


def suffix_table(table: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Suffix arrays of many texts (the rows, each ``lengths`` long) by the same construction, all in step.

    Every step takes the highest open group of each text at once.
    """
    rows, n = table.shape
    index = np.arange(n, dtype=np.int32)
    real = index < lengths[:, None]
    order = np.argsort(np.where(real, table, np.iinfo(table.dtype).max), axis=1, kind="stable")
    ranked = np.take_along_axis(table, order, 1)
    new = np.ones((rows, n), bool)
    new[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
    new |= index >= lengths[:, None]
    first = np.maximum.accumulate(np.where(new, index, 0), axis=1).astype(np.int32)
    group = np.empty((rows, n), np.int32)
    np.put_along_axis(group, order, first, 1)
    group[~real] = n
    size = np.bincount((np.arange(rows)[:, None] * n + first)[real], minlength=rows * n)
    before = np.full((rows, n), -1, np.int32)

    live, last = np.arange(rows), np.full(rows, n, np.int32)
    groups = group
    while len(live):
        below = groups < last[:, None]
        current = np.where(below, groups, -1).max(axis=1)
        if (current < 0).any():
            group[live] = groups
            keep = current >= 0
            live, groups, last, current = live[keep], groups[keep], last[keep], current[keep]
            if not len(live):
                break
        smaller = groups < current[:, None]
        nearest = np.maximum.accumulate(np.where(smaller, index, -1), axis=1)
        t, i = np.nonzero(groups == current[:, None])
        p = nearest[t, i]
        before[live[t], i] = p
        t, p = t[p >= 0], p[p >= 0]
        pointed, times = np.unique(t * n + p, return_counts=True)
        for c in np.unique(times)[::-1]:
            t, p = np.divmod(pointed[times == c], n)
            slot = live[t] * n + groups[t, p]
            old, which, moved = np.unique(slot, return_inverse=True, return_counts=True)
            fresh = old + size[old] - moved
            size[old] -= moved
            size[fresh] = moved
            groups[t, p] = (fresh % n)[which]
        last = current

    out = np.full((rows, n), -1, np.int32)
    done = ~real
    every = np.arange(rows)
    out[every, 0] = lengths - 1
    done[every, lengths - 1] = True
    front = np.tile(index, (rows, 1))
    for i in range(n):
        at = every[lengths > i]
        j = out[at, i] - 1
        while len(at):
            go = j >= 0
            go[go] = ~done[at[go], j[go]]
            at, j = at[go], j[go]
            g = group[at, j]
            out[at, front[at, g]] = j
            front[at, g] += 1
            done[at, j] = True
            j = before[at, j]
    return out


def suffix_arrays(symbols: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Suffix arrays of consecutive texts, as positions in ``symbols``; each text ends in its only least symbol."""
    out = np.empty(len(symbols), np.int64)
    lengths = np.diff(begins)
    order = np.argsort(lengths, kind="stable")
    alone = order[lengths[order] > IN_STEP].tolist()
    for t in alone:
        out[begins[t] : begins[t + 1]] = begins[t] + suffix_array(symbols[begins[t] : begins[t + 1]])
    order = order[: len(order) - len(alone)]
    order = order[lengths[order] > 0]
    start = 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and (stop + 1 - start) * lengths[order[stop]] <= TABLE_CELLS:
            stop += 1
        lot = order[start:stop]
        inside = np.arange(lengths[lot].max()) < lengths[lot][:, None]
        table = np.full(inside.shape, np.iinfo(np.int32).max, np.int32)
        where = (begins[lot][:, None] + np.arange(inside.shape[1]))[inside]
        table[inside] = symbols[where]
        found = suffix_table(table, lengths[lot])
        out[where] = (found + begins[lot][:, None])[inside]
        start = stop
    return out


def common_prefixes(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length, up to ``most``, of the common prefix of the suffixes at ``a`` and ``b``; past the end nothing agrees."""
    padded = np.concatenate([symbols, np.arange(most + 1) + (1 << 20)])
    out = np.empty(len(a), np.int64)
    for i in range(0, len(a), 8192):
        x = padded[a[i : i + 8192, None] + np.arange(most)] == padded[b[i : i + 8192, None] + np.arange(most)]
        out[i : i + 8192] = np.where(x.all(axis=1), most, np.argmin(x, axis=1))
    return out


class Cutting:
    """How windows of ``length`` bytes are brought together.

    A window is known by its least hashed core among all its cores of ``core`` bytes. Equal windows have equal cores
    at the same distance, so windows only need to be compared among the fragments around one core: ``reach`` bytes on
    either side of it.
    """

    def __init__(self, length: int):
        self.length = length
        self.reach = min(31, length // 2)
        self.core = length - self.reach

    def anchors(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, common.Hasher]:
        """Positions of the cores that are least in some window."""
        n, span = len(data), self.reach + 1
        hasher = common.Hasher(common.SYMBOLS[data])
        if n < self.length:
            return np.zeros(0, np.int64), hasher
        end = np.repeat(offsets[1:], np.diff(offsets))
        at = np.arange(n)
        whole = at + self.core <= end
        hashes = np.full(n, common.MASK)
        hashes[whole] = hasher.ranges(at[whole], at[whole] + self.core)
        least = _sliding(hashes, span, np.minimum, common.MASK)
        least[at + self.length > end] = 0
        best = _sliding(least[::-1], span, np.maximum, np.uint64(0))[::-1]
        return np.flatnonzero((best == hashes) & whole), hasher


def _sliding(values: np.ndarray, span: int, merge, neutral: np.uint64) -> np.ndarray:
    """``merge`` of each value and the ``span - 1`` behind it."""
    out, width = values.copy(), 1
    while width < span:
        step = min(width, span - width)
        moved = np.full(len(out), neutral)
        moved[: len(out) - step] = out[step:]
        out = merge(out, moved)
        width += step
    return out


def offer_anchors(cutting: Cutting):
    def offer(part: pa.RecordBatch) -> places.Places:
        data, offsets = common.buffer_of(part.column("text"))
        at, hasher = cutting.anchors(data, offsets)
        return at, hasher.ranges(at, at + cutting.core), np.zeros(len(at), bool), offsets

    return offer


def offer_windows(cutting: Cutting):
    """All windows that hold a crowded core."""

    def offer(part: pa.RecordBatch) -> places.Places:
        data, offsets = common.buffer_of(part.column("text"))
        n = len(data)
        crowded = np.concatenate([[0], np.cumsum(places.flagged(part, "crowded", offsets, n))])
        at = np.arange(max(0, n - cutting.length + 1))
        at = at[crowded[at + cutting.reach + 1] > crowded[at]]
        at = at[at + cutting.length <= offsets[np.searchsorted(offsets, at, side="right")]]
        return at, common.Hasher(common.SYMBOLS[data]).ranges(at, at + cutting.length), np.zeros(len(at), bool), offsets

    return offer


def fragments(cutting: Cutting):
    """Fragments around shared cores: core hash, fragment (two lengths, left and right bytes), and all its places.

    Equal fragments of a slice are one row, so a passage with very many places is gathered before the shuffle.
    """
    reach = cutting.reach

    def cut(part: pa.RecordBatch) -> pa.RecordBatch | None:
        data, offsets = common.buffer_of(part.column("text"))
        at = np.flatnonzero(places.flagged(part, "positions", offsets, len(data)))
        if not len(at):
            return None
        owner = np.searchsorted(offsets, at, side="right") - 1
        core = common.Hasher(common.SYMBOLS[data]).ranges(at, at + cutting.core)
        padded = np.concatenate([np.zeros(reach, np.uint8), data, np.zeros(reach, np.uint8)])
        side = np.arange(reach)
        n_left = np.minimum(at - offsets[owner], reach)
        n_right = np.minimum(offsets[owner + 1] - at - cutting.core, reach)
        row = np.zeros((len(at), 2 + 2 * reach), np.uint8)
        row[:, 0], row[:, 1] = n_left, n_right
        row[:, 2 : 2 + reach] = np.where(side >= reach - n_left[:, None], padded[at[:, None] + side], 0)
        row[:, 2 + reach :] = np.where(side < n_right[:, None], padded[at[:, None] + reach + cutting.core + side], 0)
        where = np.stack([part.column("key").to_numpy()[owner], at - offsets[owner]], axis=1).astype("<i8")
        order, cuts = _same(core, row)
        data_out = [where[order[a:b]].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        chosen = order[cuts[:-1]]
        return pa.RecordBatch.from_arrays([pa.array(core[chosen].view(np.int64)), pa.array([r.tobytes() for r in row[chosen]], pa.binary()), pa.array(data_out, pa.binary())], ["core", "fragment", "places"])

    return cut


def _same(core: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal fragments of a core together, and where each kind begins."""
    kind = np.ascontiguousarray(row).view(np.dtype((np.void, row.shape[1]))).ravel()
    order = np.lexsort((np.unique(kind, return_inverse=True)[1], core))
    new = np.ones(len(order), bool)
    new[1:] = (core[order][1:] != core[order][:-1]) | (kind[order][1:] != kind[order][:-1])
    return order, np.append(np.flatnonzero(new), len(order))


def shared_starts(core: np.ndarray, row: np.ndarray, many: np.ndarray, cutting: Cutting) -> np.ndarray:
    """For each different fragment, sorted by core: bit ``j`` is set if the window that begins ``j`` bytes before the
    core also stands in another fragment of the core, or in another place of this one (``many``).

    The fragments of a core are one text over bytes, in which the core and all that they share next to it is a single
    symbol and each fragment ends in a symbol of its own. A window stands elsewhere if the suffix that begins with it
    agrees that far with a neighbour in the suffix array.
    """
    reach = cutting.reach
    n_left, n_right = row[:, 0].astype(np.int64), row[:, 1].astype(np.int64)
    one = np.uint64(1)

    def bits(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Bits low to high, none if high < low."""
        upper = np.where(high >= 63, common.MASK, (one << np.minimum(high + 1, 63).astype(np.uint64)) - one)
        return np.where(high >= low, upper & ~((one << low.astype(np.uint64)) - one), np.uint64(0))

    mask = np.where(many, bits(np.maximum(0, reach - n_right), n_left), np.uint64(0))
    # Fragments with a common window agree in more than half of ``reach`` on one side; the others need no sorting.
    half = reach // 2 + 1
    chosen = np.flatnonzero(_met(core, row[:, 2 + reach - half : 2 + reach], n_left >= half) | _met(core, row[:, 2 + reach : 2 + reach + half], n_right >= half))
    if not len(chosen):
        return mask
    core, row, n_left, n_right, place = core[chosen], row[chosen], n_left[chosen], n_right[chosen], chosen
    first = np.flatnonzero(np.concatenate([[True], core[1:] != core[:-1]]))
    kinds = np.diff(np.append(first, len(core)))
    group = np.repeat(np.arange(len(first)), kinds)
    # What all fragments of a core share to its left and right.
    left, right = row[:, 2 : 2 + reach], row[:, 2 + reach :]
    side = np.arange(reach)
    same_left = np.logical_and.reduceat((left == left[first[group]]) & (side >= reach - n_left[:, None]), first, axis=0)
    same_right = np.logical_and.reduceat((right == right[first[group]]) & (side < n_right[:, None]), first, axis=0)
    shared_left = np.cumprod(same_left[:, ::-1], axis=1).sum(axis=1)[group]
    shared_right = np.cumprod(same_right, axis=1).sum(axis=1)[group]

    left_in = (side >= reach - n_left[:, None]) & (side < reach - shared_left[:, None])
    right_in = (side >= shared_right[:, None]) & (side < n_right[:, None])
    always = np.ones((len(core), 1), bool)
    inside = np.concatenate([left_in, always, right_in, always], axis=1)
    rank = np.arange(len(core)) - first[group]
    cells = np.concatenate([left, np.full((len(core), 1), 256), right, -1 - rank[:, None]], axis=1, dtype=np.int32)
    symbols = cells[inside]
    owner, column = np.nonzero(inside)
    begins = np.append(np.flatnonzero(np.concatenate([[True], group[owner][1:] != group[owner][:-1]])), len(symbols))
    sa = suffix_arrays(symbols, begins)

    # Suffixes that begin in front of the core or at it, next to another such one of the same text.
    near = (column[sa[:-1]] <= reach) & (column[sa[1:]] <= reach) & (group[owner[sa[:-1]]] == group[owner[sa[1:]]])
    a, b = sa[:-1][near], sa[1:][near]
    agree = np.zeros(len(symbols), np.int64)
    got = common_prefixes(symbols, a, b, 2 * reach + 2)
    np.maximum.at(agree, a, got)
    np.maximum.at(agree, b, got)
    begin = np.flatnonzero((column <= reach) & (agree > 0))
    mine = owner[begin]
    ahead = np.where(column[begin] == reach, 0, reach - shared_left[mine] - column[begin])
    right_bytes = shared_right[mine] + agree[begin] - ahead - 1
    whole = agree[begin] > ahead
    at_core = whole & (ahead == 0)
    np.bitwise_or.at(mask, place[mine[at_core]], bits(np.maximum(0, reach - right_bytes[at_core]), shared_left[mine[at_core]]))
    bit = shared_left[mine] + ahead
    early = whole & (ahead > 0) & (right_bytes >= reach - bit)
    np.bitwise_or.at(mask, place[mine[early]], one << bit[early].astype(np.uint64))
    return mask


def _met(core: np.ndarray, side: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Fragments whose bytes on one side (all there if ``whole``) also stand beside the core in another fragment."""
    weights = common.mix(np.arange(1, side.shape[1] + 1, dtype=np.uint64)) | np.uint64(1)
    keys = common.mix((common.SYMBOLS[side] * weights).sum(axis=1, dtype=np.uint64) ^ core)
    _, which, times = np.unique(keys[whole], return_inverse=True, return_counts=True)
    out = np.zeros(len(core), bool)
    out[whole] = times[which] > 1
    return out


def repeated_starts(cutting: Cutting, lot: int = 60_000):
    """key, position and bits of shared_starts for every place, from fragments sorted by core."""

    def solve(batch: pa.RecordBatch) -> pa.RecordBatch:
        core = batch.column("core").to_numpy().view(np.uint64)
        row = common.matrix(batch.column("fragment"), np.uint8, 2 + 2 * cutting.reach)
        data, offsets = common.buffer_of(batch.column("places"))
        where = np.frombuffer(data.tobytes(), "<i8").reshape(-1, 2)
        order, cuts = _same(core, row)
        kind = np.empty(len(order), np.int64)
        kind[order] = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        of_place = np.repeat(kind, np.diff(offsets) // 16)
        many = np.bincount(of_place, minlength=len(cuts) - 1) > 1
        chosen = order[cuts[:-1]]
        mask = shared_starts(core[chosen], row[chosen], many, cutting)[of_place]
        some = mask != 0
        return pa.RecordBatch.from_arrays([pa.array(where[some, 0]), pa.array(where[some, 1]), pa.array(mask[some].view(np.int64))], ["key", "at", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lots of whole cores; what a core has in a task is never split."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            core = batch.column("core").to_numpy()
            if sum(h.num_rows for h in held) + len(core) >= lot:
                change = np.flatnonzero(core[1:] != core[:-1]) + 1
                if held and len(core) and held[-1].column("core")[-1].as_py() != core[0]:
                    change = np.insert(change, 0, 0)
                if len(change):
                    stop = int(change[-1])
                    whole = [*held, batch.slice(0, stop)] if stop else held
                    yield solve(common.joined(whole))
                    held, batch = [], batch.slice(stop)
            if batch.num_rows:
                held.append(batch)
        if held:
            yield solve(common.joined(held))

    return run


def starts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key and sorted window starts (binary, 32-bit), from rows sorted by key."""
    for group in common.grouped(batches, ["key"]):
        at, mask = group.column("at").to_numpy(), group.column("bits").to_numpy().view(np.uint64)
        spread = (mask[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)).astype(bool)
        starts = np.unique((at[:, None] - np.arange(64))[spread]).astype("<u4")
        yield pa.RecordBatch.from_arrays([group.column("key").slice(0, 1), pa.array([starts.tobytes()], pa.binary())], ["key", "positions"])


def kept_parts(part: pa.RecordBatch, length: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Remaining bytes, bytes, removed bytes and removed runs of each text."""
    data, offsets = common.buffer_of(part.column("text"))
    starts = places.flagged(part, "positions", offsets, len(data)) | places.flagged(part, "windows", offsets, len(data))
    gone = places.covered(starts, length)
    first = gone.copy()
    first[1:] &= ~gone[:-1]
    begin = offsets[:-1][offsets[:-1] < len(data)]
    first[begin] = gone[begin]
    total, spans = np.concatenate([[0], np.cumsum(gone)]), np.concatenate([[0], np.cumsum(first)])
    kept, kept_at = data[~gone].tobytes(), offsets - total[offsets]
    parts = [kept[a:b] for a, b in zip(kept_at[:-1].tolist(), kept_at[1:].tolist(), strict=True)]
    return parts, np.diff(offsets), np.diff(total[offsets]), np.diff(spans[offsets])


def _result(length: int, with_text: bool):
    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        kept, size, removed, spans = kept_parts(part, length)
        last = pa.array([k.decode("utf-8", "ignore") for k in kept]) if with_text else pa.array([hashlib.sha256(k).hexdigest() for k in kept])
        columns = [part.column("key"), part.column("copies"), pa.array(size), pa.array(removed), pa.array(spans), last]
        return pa.RecordBatch.from_arrays(columns, ["key", "copies", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


RESULT = "key long, copies long, n_bytes long, n_removed long, n_spans long, kept string"


def _per_text(rows: DataFrame, length: int, with_text: bool, crowd: tuple[int, int]) -> DataFrame:
    cutting = Cutting(length)
    texts = common.materialise(places.one_text(rows), "texts", keep=True)
    with session.scratch(rows.sparkSession):
        hits = common.materialise(places.repeated(texts, offer_anchors(cutting), False, exact=False, crowd=crowd), "cores")
        # The windows of a crowded core are told apart one by one, so that no task gets all its fragments.
        crowded, windows = hits.filter("crowded IS NOT NULL"), None
        if not crowded.isEmpty():
            windows = places.repeated(texts.join(crowded.select("key", "crowded"), "key"), offer_windows(cutting), False)
            windows = common.materialise(windows.withColumnRenamed("positions", "windows"), "windows", keep=True)
        cut = common.mapped(texts.join(hits.filter("positions IS NOT NULL").select("key", "positions"), "key"), fragments(cutting), "core long, fragment binary, places binary")
        cut = cut.repartition(common.tasks_for(rows), "core").sortWithinPartitions("core")
        found = common.materialise(cut.mapInArrow(repeated_starts(cutting), "key long, at long, bits long"), "starts")
        starts = found.repartition(common.tasks_for(rows), "key").sortWithinPartitions("key")
        spans = common.materialise(starts.mapInArrow(starts_of, "key long, positions binary"), "spans", keep=True)
    joined = texts.join(spans, "key", "left")
    joined = joined.join(windows, "key", "left") if windows else joined.withColumn("windows", F.lit(None).cast("binary"))
    judged = common.mapped(joined, _result(length, with_text), RESULT)
    nothing = F.lit("") if with_text else F.sha2(F.lit(""), 256)
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    return judged.select(
        "key",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(whole, nothing).otherwise(F.col("kept")).alias("kept"),
    )


def remove_repeats(docs: DataFrame, length: int = 200, crowd: tuple[int, int] = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row of ``docs``.

    Bytes (UTF-8) covered by a string of ``length`` bytes that also begins anywhere else, in the same text too, are
    removed; strings are judged on the input. Copies of a text repeat all of it, so a copied text of ``length`` bytes
    or more goes whole. Null and empty texts have no bytes. Rows of equal ids or texts are rows of their own, other
    columns are ignored; no rows give no rows.
    """
    rows = places.keyed(docs)
    found = _per_text(rows, length, False, crowd).withColumnRenamed("kept", "kept_sha256")
    return rows.select("doc_id", "key").join(found, "key").drop("key")


def cut_repeats(docs: DataFrame, length: int = 200, crowd: tuple[int, int] = CROWD) -> DataFrame:
    """``docs`` with the repeated bytes taken out of the texts; all columns stay, n_chars follows the new text.

    What is left of a character that is cut in two goes as well. Rows of which nothing is left go, rows that were null
    or empty stay. Rows that nothing is taken from are unchanged.
    Own columns may have any name but __key and __kept.
    """
    kept = _per_text(places.keyed(docs), length, True, crowd).filter("n_removed > 0").select(F.col("key").alias("__key"), F.col("kept").alias("__kept"))
    joined = docs.withColumn("__key", places.name_of(common.text_of(docs))).join(kept, "__key", "left").filter("__kept IS NULL OR __kept != ''")
    joined = joined.withColumn("text", F.coalesce("__kept", "text"))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(F.col("__kept").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return joined.select(*docs.columns)

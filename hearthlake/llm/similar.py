"""N-gram Jaccard join by chosen paths: exact links and classes of documents whose word shingles agree.

Sets are embedded as MinHash values, whose agreement per position has the Jaccard similarity as its probability. A
run starts all sets at one node; a node samples one or, now and then, two positions and sends every set to the child
named by its value there, 1 / similarity children per set on average. Children of one set are dropped, small ones are
searched by brute force, large ones split again, and runs are repeated until a pair at the threshold is missed with
at most ``1 - recall``. What the paths propose is verified exactly on whole shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake import session
from hearthlake.llm import common
from hearthlake.operators.dedupe import one_per_key

POSITIONS = 128
SEED = np.uint64(0x5851F42D4C957F2D)


@dataclass(frozen=True)
class Plan:
    """``small`` sets are searched by brute force at once, larger buckets after ``depth`` splits, in blocks."""

    shingle: int = 5
    numerator: int = 4  # similarity as a fraction, so that it is compared exactly
    denominator: int = 5
    recall: float = 0.9999
    depth: int = 3
    small: int = 256
    block: int = 2048
    block_shingles: int = 400_000

    @property
    def similarity(self) -> float:
        return self.numerator / self.denominator

    def lost_by_branch(self) -> float:
        """Chance that a pair at the threshold is parted on all paths of full depth that begin with one branch of a root."""
        alive, twice = 1.0, 1 / self.similarity - 1
        for _ in range(self.depth - 1):
            miss = 1 - self.similarity * alive
            alive = 1 - ((1 - twice) * miss + twice * miss * miss)
        return 1 - self.similarity * alive

    def lost(self, runs: int) -> float:
        """Chance that a pair at the threshold is missed: by every branch that the roots really have, or by the signatures."""
        branches = runs + int(_second(_here(np.arange(1, runs + 1, dtype=np.uint64)), self).sum())
        return self.lost_by_branch() ** branches + self.lost_by_sketch()

    def runs(self) -> int:
        runs = 1
        while self.lost(runs) > 1 - self.recall:
            runs += 1
        return runs

    def sketch_threshold(self) -> float:
        """Agreement below which a pair is not looked at: five deviations under the similarity."""
        return self.similarity - 5 * math.sqrt(self.similarity * (1 - self.similarity) / POSITIONS)

    def lost_by_sketch(self) -> float:
        """Chance that a pair at the threshold agrees in fewer positions."""
        s = self.similarity
        return sum(math.comb(POSITIONS, k) * s**k * (1 - s) ** (POSITIONS - k) for k in range(math.ceil(self.sketch_threshold() * POSITIONS)))


def _here(parent: np.ndarray) -> np.ndarray:
    """What a node draws its positions from."""
    return common.mix(parent ^ SEED)


def _second(here: np.ndarray, plan: Plan) -> np.ndarray:
    """Which nodes sample a second position."""
    return (common.mix(here) >> np.uint64(11)).astype(np.float64) / 2**53 < 1 / plan.similarity - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Different shingle hashes of each text, sorted, and where each text's begin.

    A text of fewer than ``size`` words has one shingle, all its words; one without words has none.
    """
    texts = len(offsets) - 1
    starts, ends, owner = common.words_of(data, offsets)
    words = common.word_hashes(data, starts, ends)
    at = common.per_text(owner, texts)
    count = np.diff(at)
    many = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    who = np.repeat(np.arange(texts), many)
    first = at[who] + np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many)
    hashes = common.Hasher(words).ranges(first, np.minimum(first + size, at[who + 1]))
    order = np.lexsort((hashes, who))
    hashes, who = hashes[order], who[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (who[1:] != who[:-1])
    hashes, who = hashes[new], who[new]
    return hashes, common.per_text(who, texts)


def signatures(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """POSITIONS MinHash values of 16 bits per set; an empty set has zeros."""
    out = np.zeros((len(at) - 1, POSITIONS), np.uint16)
    full = np.flatnonzero(np.diff(at))
    if not len(full):
        return out
    starts = at[full]
    keys = common.mix(np.arange(1, 2 * POSITIONS + 1, dtype=np.uint64) * SEED)
    for i in range(POSITIONS):
        # The high half of an odd multiple is the order; the value kept is a hash of the least.
        least = np.minimum.reduceat(((hashes ^ keys[i]) * (keys[POSITIONS + i] | np.uint64(1))) >> np.uint64(16), starts)
        out[full, i] = (common.mix(least) >> np.uint64(48)).astype(np.uint16)
    return out


def _digest(hashes: np.ndarray, at: np.ndarray) -> list[bytes]:
    """128 bits that name a set: its size and two sums of hashes over its members."""
    sums = []
    for k in (1, 2):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(common.mix(hashes ^ np.uint64(k) * SEED))])
        sums.append(common.mix(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(np.uint64) * np.uint64(k)))
    pair = np.stack(sums, axis=1)
    return [row.tobytes() for row in pair]


def embed(docs: DataFrame, plan: Plan) -> DataFrame:
    """doc_id, text_key, node (the name of the shingle set), size and signature of every row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, at = shingle_sets(*common.buffer_of(batch.column("text")), plan.shingle)
        signed = signatures(hashes, at)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(_digest(hashes, at), pa.binary()), pa.array(np.diff(at)), pa.array([s.tobytes() for s in signed], pa.binary())],
            ["doc_id", "text_key", "node", "size", "signature"],
        )

    rows = keyed(docs)
    return common.mapped(rows, run, "doc_id long, text_key string, node binary, size long, signature binary")


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of(docs).alias("text")).withColumn("text_key", F.md5(F.col("text").cast("binary")))


def _children(plan: Plan, rows: DataFrame, runs: int | None = None) -> DataFrame:
    """path and node of every child that a set is sent to; with ``runs``, from the root of each run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            signed = common.matrix(batch.column("signature"), "<u2", POSITIONS)
            parents = [np.full(batch.num_rows, r + 1, np.uint64) for r in range(runs)] if runs else [batch.column("path").to_numpy().view(np.uint64)]
            for parent in parents:
                here = _here(parent)
                picks = [(here % np.uint64(POSITIONS)).astype(np.int64)]
                picks.append((picks[0] + 1 + (here >> np.uint64(20)) % np.uint64(POSITIONS - 1)).astype(np.int64) % POSITIONS)
                for pick, use in zip(picks, (np.ones(len(here), bool), _second(here, plan)), strict=True):
                    rows_used = np.flatnonzero(use)
                    value = signed[rows_used, pick[use]].astype(np.uint64)
                    path = common.mix(here[use] ^ common.mix(value << np.uint64(8) | pick[use].astype(np.uint64)))
                    yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), batch.column("node").take(pa.array(rows_used))], ["path", "node"])

    return rows.mapInArrow(run, "path long, node binary")


def sketch_edges(signed: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Edges from the first member of each component of the graph of pairs that agree in ``least`` positions.

    A member that joins is compared with those that have not joined yet, so a tight group takes one comparison a row.
    """
    rest, edges = np.arange(len(signed)), []
    while len(rest) > 1:
        root, frontier, rest = rest[0], [rest[0]], rest[1:]
        while frontier and len(rest):
            one = frontier.pop()
            near = np.count_nonzero(signed[rest] == signed[one], axis=1) >= least
            frontier.extend(rest[near].tolist())
            edges.extend((int(root), int(m)) for m in rest[near])
            rest = rest[~near]
    return edges


def blocked(rows: DataFrame, group: str, blocks: F.Column) -> DataFrame:
    """Rows of each group dealt to ``blocks`` blocks, once per pair of blocks: columns i <= j name the pair.

    Any two rows of a group meet in some pair, and no pair holds more than two blocks.
    """
    rows = rows.withColumn("__g", blocks.cast("int")).withColumn("__own", F.pmod(F.xxhash64("node"), F.col("__g")).cast("int"))
    rows = rows.withColumn("__k", F.explode(F.sequence(F.lit(0), F.col("__g") - 1)))
    # A pair of one block with itself is only needed where there is no other block.
    rows = rows.filter((F.col("__g") == 1) | (F.col("__k") != F.col("__own")))
    rows = rows.withColumn("i", F.least("__own", "__k")).withColumn("j", F.greatest("__own", "__k")).drop("__k", "__g")
    return rows.repartition(common.tasks_for(rows), group, "i", "j").sortWithinPartitions(group, "i", "j")


def candidate_edges(sets: DataFrame, plan: Plan) -> DataFrame:
    """Pairs of nodes (a, b) that connect all sets which some run brings together and whose signatures agree."""
    signed = sets.select("node", "signature")
    leaves = []
    rows, runs = signed, plan.runs()
    for depth in range(1, plan.depth + 1):
        sent = common.materialise(_children(plan, rows, runs if depth == 1 else None), "paths")
        counts = sent.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        live = common.materialise(sent.join(counts, "path"), "buckets")
        large = (F.col("n") > plan.small) if depth < plan.depth else F.lit(False)
        leaves.append(live.filter(~large))
        rows = live.filter(large)
        if depth == plan.depth or rows.isEmpty():
            break
        rows = rows.select("path", "node").join(signed, "node")
    least = plan.sketch_threshold() * POSITIONS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in common.grouped(batches, ["path", "i", "j"]):
            edges = sketch_edges(common.matrix(group.column("signature"), "<u2", POSITIONS), least)
            if edges:
                a, b = (pa.array(x) for x in zip(*edges, strict=True))
                nodes = group.column("node")
                yield pa.RecordBatch.from_arrays([nodes.take(a), nodes.take(b)], ["a", "b"])

    dealt = blocked(common.union_all(leaves).join(signed, "node"), "path", F.ceil(F.col("n") / plan.block))
    found = dealt.select("path", "i", "j", "node", "signature").mapInArrow(run, "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def exact_links(values: np.ndarray, at: np.ndarray, plan: Plan) -> np.ndarray:
    """Which members of a group are linked (boolean matrix).

    Intersections are products of the incidence matrix with itself, over slices of the shared shingles.
    """
    n = len(at) - 1
    size = np.diff(at)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    which = np.cumsum(new) - 1
    shared = np.bincount(which) > 1
    use = shared[which]
    column = (np.cumsum(shared) - 1)[which[use]]
    member = owner[order][use]
    both = np.zeros((n, n), np.float32)
    width = max(1, (1 << 23) // max(n, 1))
    total = int(shared.sum())
    edges = np.searchsorted(column, np.arange(0, total + width, width))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        part = np.zeros((n, min(width, total - k * width)), np.float32)
        part[member[a:b], column[a:b] - k * width] = 1
        both += part @ part.T
    inter = both.astype(np.int64)
    union = size[:, None] + size[None, :] - inter
    linked = plan.denominator * inter >= plan.numerator * union
    np.fill_diagonal(linked, False)
    return linked


def verified(docs: DataFrame, sets: DataFrame, labels: DataFrame, plan: Plan) -> DataFrame:
    """Rows (node, links, root): links found in one pair of blocks, and the least node it is connected with there."""
    inside = sets.join(labels, "node").select("node", "label", "size", "copies", "row.text_key", "row.doc")
    total = inside.groupBy("label").agg(F.sum("size").alias("all"), F.count(F.lit(1)).alias("n"))
    blocks = F.greatest(F.ceil(F.col("all") / plan.block_shingles), F.ceil(F.col("n") / (plan.block // 4)))
    inside = inside.join(total, "label").withColumn("g", blocks).drop("all", "n", "size")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, at = shingle_sets(*common.buffer_of(batch.column("text")), plan.shingle)
        sets_out = [hashes[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
        keep = ["node", "label", "copies", "g"]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(sets_out, pa.binary())], [*keep, "shingles"])

    # A set names one row with its text, so copies have keys of their own; rows that agree in both are one again after it.
    rows = keyed(docs).select("text_key", F.coalesce("doc_id", F.lit(-1)).alias("doc"), "text")
    texts = one_per_key(rows.join(inside, ["text_key", "doc"]), ["node"], [F.col("text_key")])
    cut_sets = common.mapped(texts, cut, "node binary, label binary, copies long, g long, shingles binary")
    dealt = blocked(cut_sets.withColumn("group", F.xxhash64("label")), "group", F.col("g"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in common.grouped(batches, ["group", "i", "j"]):
            data, offsets = common.buffer_of(group.column("shingles"))
            own = group.column("own").to_numpy()
            linked = exact_links(np.frombuffer(data.tobytes(), "<u8"), offsets // 8, plan)
            # Pairs inside a block meet in each of its pairs of blocks: they count in the one with the next block.
            i, j, blocks = (group.column(c)[0].as_py() for c in ("i", "j", "g"))
            here = (own + 1) % blocks == np.where(own == i, j, i)
            counted = linked & ((own[:, None] != own[None, :]) | here[:, None])
            links = counted @ group.column("copies").to_numpy()
            nodes = group.column("node")
            root = np.arange(len(nodes))
            names = nodes.to_pylist()
            order = sorted(range(len(names)), key=names.__getitem__)
            seen = np.zeros(len(names), bool)
            for start in order:
                if not seen[start]:
                    seen[start] = True
                    front = [start]
                    while front:
                        near = np.flatnonzero(linked[front.pop()] & ~seen)
                        seen[near], root[near] = True, start
                        front.extend(near.tolist())
            yield pa.RecordBatch.from_arrays([nodes, pa.array(links.astype(np.int64)), nodes.take(pa.array(root))], ["node", "links", "root"])

    rows = dealt.withColumnRenamed("__own", "own").select("group", "i", "j", "own", "g", "node", "copies", "shingles")
    return rows.mapInArrow(run, "node binary, links long, root binary")


def _solved(docs: DataFrame, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """The embedded rows, and node, copies, least_doc, links and label of every set with shingles."""
    with session.scratch(docs.sparkSession):
        embedded = common.materialise(embed(docs, plan), "signatures")
        rows = common.materialise(embedded.select("doc_id", "text_key", "node", "size"), "nodes", keep=True)
        sets = embedded.filter("size > 0").groupBy("node").agg(
            F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least_doc"), F.min(F.struct("text_key", F.coalesce("doc_id", F.lit(-1)).alias("doc"))).alias("row"), F.first("size").alias("size"), F.first("signature").alias("signature")
        )
        sets = common.materialise(sets, "sets")
        labels = common.components(candidate_edges(sets, plan))
        checked = common.materialise(verified(docs, sets, labels, plan), "verified")
        links = checked.groupBy("node").agg(F.sum("links").alias("links"))
        final = common.components(checked.filter("node != root").select(F.col("root").alias("a"), F.col("node").alias("b")))
        known = sets.select("node", "copies", "least_doc").join(links, "node", "left").join(final, "node", "left")
        known = known.select("node", "copies", "least_doc", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("label", "node").alias("label"))
        known = common.materialise(known, "classes", keep=True)
    return rows, known


def classes(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """doc_id, class_id, n_links and class_size for every row of ``docs``.

    Two rows are linked if their sets of word shingles have the plan's similarity at least; a class is what links
    connect, and its id is the least doc_id in it. ``n_links`` counts the other rows that a row is linked with, copies
    included. Rows without words, null texts too, have no shingles: no links, and their own doc_id as class. A null
    doc_id sorts behind all others, other columns are ignored. No rows give no rows.
    """
    embedded, known = _solved(docs, plan)
    named = known.groupBy("label").agg(F.min("least_doc").alias("class_id"), F.sum("copies").alias("class_size"))
    per_node = known.join(named, "label").select("node", "class_id", "class_size", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    out = embedded.filter("size > 0").select("doc_id", "node").join(per_node, "node").select("doc_id", "class_id", "n_links", "class_size")
    empty = embedded.filter("size = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("class_size"))
    return out.unionByName(empty)


def one_per_class(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """One row of ``docs`` for each class, that with the least doc_id (null last); rows without words all stay."""
    embedded, known = _solved(docs, plan)
    texts = embedded.filter("size > 0").groupBy("node", "text_key").agg(F.min("doc_id").alias("d")).join(known.select("node", "label"), "node")
    first = F.min(F.struct(F.col("d").isNull().alias("none"), "d", "text_key")).alias("first")
    chosen = texts.groupBy("label").agg(first)
    others = texts.join(chosen, "label").filter("text_key != first.text_key").select(F.col("text_key").alias("__text_key"))
    text = common.text_of(docs)
    rows = docs.withColumn("__text_key", F.md5(text.cast("binary")))
    worded = F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]"))
    order = [F.col("doc_id").asc_nulls_last()] + [F.col(c).asc_nulls_last() for c in docs.columns if c not in ("doc_id", "text")]
    # The copies of a text come down to one per task before they are shuffled; only then other texts of a class go.
    one = one_per_key(rows.filter(worded), ["__text_key"], order).join(others, "__text_key", "left_anti")
    kept = one.unionByName(rows.filter(~worded))
    return kept.select(*docs.columns)

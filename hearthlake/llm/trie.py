"""Prefix trie of conversations: balanced parentheses per shard, searched by range min-max blocks.

A conversation is the sequence of names of its turns (16 bytes each). Conversations are range partitioned and sorted by
that sequence, so a shard's trie is written in one sweep: a turn that the last conversation did not share opens a
node, and a node that is not shared any more closes. Neighbouring shards share the nodes above the longest common
prefix of the conversations at their border: the spines, whose numbers are added up, with corrections for what both
counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlake.llm import common

NAME = 16
BLOCK = 256
# Turns after which a shard is closed; a longer conversation is a shard of its own. It changes no result.
SHARD_TURNS = 1 << 16
GROUP, HEADS = 100, 6


class Parentheses:
    """A tree as balanced parentheses with the excess (open minus closed) of blocks and ranges of blocks."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1)).astype(np.int64)
        self.rank = np.cumsum(opens)
        blocks = -(-len(opens) // BLOCK) or 1
        self.leaves = 1 << (blocks - 1).bit_length()
        padded = np.full(self.leaves * BLOCK, np.iinfo(np.int64).max)
        padded[: len(opens)] = self.excess
        # A node of the min tree has its range's least excess; steps are by one, so it says where a value is first reached.
        self.least = np.full(2 * self.leaves, np.iinfo(np.int64).max)
        self.least[self.leaves :] = padded.reshape(-1, BLOCK).min(axis=1)
        for i in range(self.leaves - 1, 0, -1):
            self.least[i] = min(self.least[2 * i], self.least[2 * i + 1])
        leaf = np.zeros(len(opens), bool)
        leaf[:-1] = opens[:-1] & ~opens[1:]
        self.pairs = np.concatenate([[0], np.cumsum(leaf)])

    def findclose(self, i: int) -> int:
        """Where the node that opens at ``i`` closes: the first later place with an excess below its own."""
        want = int(self.excess[i]) - 1
        block = i // BLOCK
        end = min((block + 1) * BLOCK, len(self.opens))
        inside = self.excess[i + 1 : end] <= want
        if inside.any():
            return i + 1 + int(inside.argmax())
        node = self.leaves + block
        while node & 1 or self.least[node + 1] > want:
            node >>= 1
        node += 1
        while node < self.leaves:
            node *= 2
            if self.least[node] > want:
                node += 1
        start = (node - self.leaves) * BLOCK
        return start + int((self.excess[start : start + BLOCK] <= want).argmax())


def shared(a: bytes, b: bytes) -> int:
    """Turns that two sequences begin with alike."""
    n = min(len(a), len(b)) // NAME
    if a[: n * NAME] == b[: n * NAME]:
        return n
    x, y = (np.frombuffer(v, np.uint8, n * NAME) for v in (a, b))
    return int((x != y).argmax()) // NAME


def spine(path: bytes) -> list[bytes]:
    """Names of the nodes on the way to the end of ``path``, the root first."""
    sha = hashlib.blake2b(digest_size=NAME)
    out = [sha.digest()]
    for i in range(0, len(path), NAME):
        sha.update(path[i : i + NAME])
        out.append(sha.digest())
    return out


def encode(paths: list[bytes], chars: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Parentheses of sorted ``paths``; per node in opening order the code points of its turn, and depth; per path its node."""
    kinds, ends, chars_of, depths = [np.ones(1, bool)], [], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    # Nodes of the last path, by depth.
    way, made, last = [0], 1, b""
    for path, own in zip(paths, chars, strict=True):
        keep, n = shared(last, path), len(path) // NAME
        kinds.append(np.zeros(len(way) - 1 - keep, bool))
        kinds.append(np.ones(n - keep, bool))
        del way[keep + 1 :]
        way.extend(range(made, made + n - keep))
        made += n - keep
        chars_of.append(own[keep:])
        depths.append(np.arange(keep + 1, n + 1))
        ends.append(way[n])
        last = path
    kinds.append(np.zeros(len(way), bool))
    return np.concatenate(kinds), np.concatenate(chars_of), np.concatenate(depths), np.array(ends, np.int64)


# ---- rebuilt conversations ------------------------------------------------------------------------------------


def name(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=NAME).digest()


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, path (names of the turns in order) and chars (code points of each) per conversation.

    Turns are ordered by turn (null first), role and text; null role or text is empty; rows without conv_id are left out.
    Texts move once, range partitioned by conversation and turn, so those of one conversation may lie in several tasks;
    24 bytes a turn then meet in one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no, current, names, sizes = TaskContext.get().partitionId(), 0, None, [], []
        out: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["conv_id", "place", "path", "chars"])

        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if names and conv_id != current:
                    out.append((current, part << 32 | no, b"".join(names), np.array(sizes, "<i8").tobytes()))
                    names, sizes, no = [], [], no + 1
                    if len(out) >= 1000:
                        yield flushed()
                        out = []
                current = conv_id
                names.append(name(role, text))
                sizes.append(len(text))
        if names:
            out.append((current, part << 32 | no, b"".join(names), np.array(sizes, "<i8").tobytes()))
        if out:
            yield flushed()

    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), common.text_of(conversations, "role").alias("role"), common.text_of(conversations).alias("text")
    ).withColumn("salt", F.monotonically_increasing_id())
    placed = turns.repartitionByRange(common.tasks_for(conversations), *order, "salt").sortWithinPartitions(*order)
    parts = placed.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, place long, path binary, chars binary")
    gathered = parts.repartition(common.tasks_for(conversations), "conv_id").sortWithinPartitions("conv_id", "place")
    return common.materialise(gathered.drop("place").mapInArrow(_joined, "conv_id long, path binary, chars binary"), "sequences")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from the parts that stand side by side."""
    current, held = None, ([], [])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], ["conv_id", "path", "chars"])

    for batch in batches:
        done = []
        for conv_id, path, chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "path", "chars")), strict=True):
            if held[0] and conv_id != current:
                done.append((current, b"".join(held[0]), b"".join(held[1])))
                held = ([], [])
            current = conv_id
            held[0].append(path)
            held[1].append(chars)
        if done:
            yield batch_of(done)
    if held[0]:
        yield batch_of([(current, b"".join(held[0]), b"".join(held[1]))])


def rebuilt(whole: DataFrame) -> DataFrame:
    """Each conversation with its first turns replaced by those of its group's first conversation, as many as its checksum says."""
    h = F.crc32(F.col("conv_id").cast("string")) % HEADS
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    own = whole.select("conv_id", base.alias("base"), h.cast("int").alias("h"), "path", "chars")
    most = (HEADS - 1) * NAME, (HEADS - 1) * 8
    heads = whole.filter(f"conv_id % {GROUP} = 0").select(
        F.col("conv_id").alias("base"), F.expr(f"substring(path, 1, {most[0]})").alias("head"), F.expr(f"substring(chars, 1, {most[1]})").alias("head_chars")
    )
    both = own.join(heads, "base", "left")

    def put(head: str, column: str, width: int):
        first = f"coalesce(substring({head}, 1, h * {width}), X'')"
        return F.expr(f"concat({first}, substring({column}, h * {width} + 1))").alias(column)

    return both.select("conv_id", put("head", "path", NAME), put("head_chars", "chars", 8))


# ---- shards ---------------------------------------------------------------------------------------------------

SHARD = (
    "shard long, part int, parentheses binary, nodes long, chars binary, depths binary, ends binary, ids binary, "
    "first binary, first_chars binary, last binary, before binary, known boolean"
)


def shards(conversations: DataFrame) -> DataFrame:
    """The trie of ``conversations`` (conv_id, path, chars) in shards.

    ``before`` is the last path of the shard before; in a task's first shard it is not ``known`` yet.
    """
    names = [c.split()[0] for c in SHARD.split(", ")]
    types = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), *[pa.binary()] * 8, pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no, before = TaskContext.get().partitionId(), 0, None
        ids: list[int] = []
        paths: list[bytes] = []
        chars: list[np.ndarray] = []
        held = 0

        def closed() -> pa.RecordBatch:
            kinds, chars_of, depths, ends = encode(paths, chars)
            row = [part << 32 | no, part, np.packbits(kinds).tobytes(), len(chars_of), chars_of.astype("<i8").tobytes(), depths.astype("<i4").tobytes()]
            row += [ends.astype("<i4").tobytes(), np.array(ids, "<i8").tobytes(), paths[0], chars[0].tobytes(), paths[-1], before, before is not None]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

        for batch in batches:
            for conv_id, path, own in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "path", "chars")), strict=True):
                if ids and held + len(path) // NAME + 1 > SHARD_TURNS:
                    yield closed()
                    before, no, held = paths[-1], no + 1, 0
                    ids, paths, chars = [], [], []
                ids.append(conv_id)
                paths.append(path)
                chars.append(np.frombuffer(own, "<i8"))
                held += len(path) // NAME + 1
        if ids:
            yield closed()

    order = ["path", "conv_id"]
    placed = conversations.repartitionByRange(common.tasks_for(conversations), *order).sortWithinPartitions(*order)
    made = common.materialise(placed.mapInArrow(run, SHARD), "shards")
    return _with_neighbours(made)


def _with_neighbours(made: DataFrame) -> DataFrame:
    """First shards of tasks get the last path of the task before; the driver sees only the numbers of tasks with rows."""
    parts = sorted(r.part for r in made.filter("NOT known").select("part").collect())
    spark = made.sparkSession
    pairs = spark.createDataFrame(list(zip(parts[1:], parts[:-1], strict=True)), "part int, previous int")
    final = made.groupBy("part").agg(F.max_by("last", "shard").alias("end")).select(F.col("part").alias("previous"), "end")
    ends = pairs.join(final, "previous").select("part", "end")
    joined = made.join(ends, "part", "left")
    return joined.withColumn("before", F.when(F.col("known"), F.col("before")).otherwise(F.col("end"))).drop("end", "known")


class Shard:
    """Numbers per node of one shard, in opening order."""

    def __init__(self, row: dict):
        n = row["nodes"]
        kinds = np.unpackbits(np.frombuffer(row["parentheses"], np.uint8), count=2 * n).astype(bool)
        tree = Parentheses(kinds)
        self.chars = np.frombuffer(row["chars"], "<i8")
        self.depth = np.frombuffer(row["depths"], "<i4").astype(np.int64)
        self.ids = np.frombuffer(row["ids"], "<i8")
        ends = np.frombuffer(row["ends"], "<i4").astype(np.int64)
        opens = np.flatnonzero(kinds)
        close = np.array([tree.findclose(i) for i in opens.tolist()], np.int64)
        # Nodes of a subtree are those that open between its parentheses.
        node, after = np.arange(n), tree.rank[close]
        self.n_leaves = tree.pairs[close] - tree.pairs[opens]
        # Conversations in order: those that end in a subtree stand side by side.
        self.lo, self.hi = np.searchsorted(ends, node), np.searchsorted(ends, after)
        self.members = self.hi - self.lo
        self.own = np.stack([self.lo, np.searchsorted(ends, node, side="right")], axis=1)
        total = np.concatenate([[0], np.cumsum(self.members * self.chars)])
        single = np.concatenate([[0], np.cumsum(self.chars)])
        self.spent = total[after] - total[node]
        self.distinct = single[after] - single[node]
        self.least = np.minimum.reduceat(np.append(self.ids, np.iinfo(np.int64).max), np.stack([self.lo, self.hi], axis=1).ravel())[::2]
        # The parent of a node is the last earlier one of the depth above.
        self.parent = np.full(n, -1)
        way: list[int] = []
        for i, d in enumerate(self.depth.tolist()):
            del way[d:]
            if way:
                self.parent[i] = way[-1]
            way.append(i)
        self.n_children = np.bincount(self.parent[1:], minlength=n) if n > 1 else np.zeros(n, np.int64)
        # Nodes that another shard may share: those above both ends of the shard.
        self.spines: dict[int, bytes] = {}
        self.first = self._way(int(ends[0]))
        border = -1 if row["before"] is None else shared(row["before"], row["first"])
        self.border, self.leaf_before = border, row["before"] is not None and len(row["before"]) // NAME == border
        for way, path in ((self.first[: border + 1], row["first"]), (self._way(int(ends[-1])), row["last"])):
            self.spines.update(zip(way, spine(path)[: len(way)], strict=True))

    def _way(self, node: int) -> list[int]:
        out = []
        while node >= 0:
            out.append(node)
            node = int(self.parent[node])
        return out[::-1]

    def ended(self, node: int) -> bytes:
        a, b = self.own[node]
        return ",".join(map(str, self.ids[a:b].tolist())).encode()


PART = "key binary, parent binary, shard long, depth long, conv_id long, n_convs long, n_children long, n_leaves long, spent long, ended binary"


def spine_parts(made: DataFrame) -> DataFrame:
    """What each shard adds to the nodes that it may share with others, less what the shard before counted too."""
    names = [c.split()[0] for c in PART.split(", ")]
    types = [pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                rows = []
                # Turns of shared nodes at or below each node of the common way.
                common_chars = [int(shard.chars[i]) for i in shard.first[: shard.border + 1]]
                below = np.cumsum(common_chars[::-1])[::-1].tolist() if common_chars else []
                for i, key in shard.spines.items():
                    d = int(shard.depth[i])
                    twice = d <= shard.border and i == shard.first[d]
                    children = int(shard.n_children[i]) - (twice and d < shard.border)
                    leaves = int(shard.n_leaves[i]) - (twice and shard.leaf_before)
                    saved = int(shard.spent[i] - shard.distinct[i]) + (below[d] if twice else 0)
                    parent = shard.spines[int(shard.parent[i])] if d else None
                    rows.append((key, parent, row["shard"], d, int(shard.least[i]), int(shard.members[i]), children, leaves, saved, shard.ended(i)))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return common.materialise(made.mapInArrow(run, PART), "spine_parts")


def _ends(parts: DataFrame) -> DataFrame:
    """Digest of the members that end at each shared node; their ids stream by in the order of the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, some = None, hashlib.sha256(), False
        for batch in batches:
            done = []
            for own, ended in zip(batch.column("key").to_pylist(), batch.column("ended").to_pylist(), strict=True):
                if own != key:
                    if key is not None:
                        done.append((key, sha.hexdigest()))
                    key, sha, some = own, hashlib.sha256(), False
                if ended:
                    sha.update((b"," if some else b"") + ended)
                    some = True
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done])], ["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([sha.hexdigest()])], ["key", "ends_sha256"])

    # A node with few ids in very many shards sends rows without ids for nothing, but for one.
    some = parts.filter(F.length("ended") > 0).select("key", "shard", "ended")
    return some.repartition(common.tasks_for(parts), "key").sortWithinPartitions("key", "shard").mapInArrow(run, "key binary, ends_sha256 string")


RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
EMPTY = hashlib.sha256(b"").hexdigest()


def _inner(made: DataFrame) -> DataFrame:
    """The nodes that only one shard has; ``known`` maps the names of the shared ones to their conversations."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    types = [*[pa.int64()] * 7, pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                known = {k["key"]: k["conv_id"] for k in row["known"]}
                least = shard.least.copy()
                for i, key in shard.spines.items():
                    least[i] = known[key]
                inner = np.setdiff1d(np.arange(len(least)), np.fromiter(shard.spines, np.int64, len(shard.spines)))
                if not len(inner):
                    continue
                saved = shard.spent - shard.distinct
                digests = [hashlib.sha256(shard.ended(i)).hexdigest() if shard.own[i, 1] > shard.own[i, 0] else EMPTY for i in inner.tolist()]
                columns = [least, shard.depth, least[shard.parent], shard.members, shard.n_children, shard.n_leaves, saved]
                yield pa.RecordBatch.from_arrays([*[pa.array(c[inner], t) for c, t in zip(columns, types[:-1], strict=True)], pa.array(digests)], names)

    return made.mapInArrow(run, RESULT)


def trie(conversations: DataFrame) -> DataFrame:
    """Per node of the prefix trie of ``conversations`` (conv_id, path, chars): its conversations, children, leaves, savings.

    A node's conv_id is its least member; n_leaves counts the childless nodes of its subtree; saved_tokens sums over it the
    code points of a turn for every member but one; ends_sha256 digests the members that end there, in ascending order.
    No conversations give no rows, not even a root.
    """
    made = shards(conversations)
    parts = spine_parts(made)
    merged = parts.groupBy("key").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "spent")]
    )
    merged = common.materialise(merged.join(_ends(parts), "key", "left").fillna(EMPTY, ["ends_sha256"]), "spines")
    above = merged.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    spines = merged.join(above, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("spent").alias("saved_tokens"), "ends_sha256"
    )
    known = parts.select("shard", "key").join(merged.select("key", "conv_id"), "key").groupBy("shard").agg(F.collect_list(F.struct("key", "conv_id")).alias("known"))
    return spines.unionByName(_inner(made.join(known, "shard")))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """:func:`trie` of the rebuilt ``conversations`` (conv_id, turn, role, text; more columns are left alone).

    Repeated rows are turns of their own; a text of any length is a name and a size; an empty table gives no rows.
    """
    return trie(common.materialise(rebuilt(sequences(conversations)), "rebuilt"))

"""Conversation structure repair: the cheapest edits that give legal role orders, by the auction algorithm.

Role initials have to read ``(s?(ua)+)?``. A conversation is a lattice of (row, state) nodes: state 0 has kept nothing,
1 a system turn, 2 ends in a user turn, 3 in an assistant turn. Edits are arcs with integer costs. The auction algorithm
for shortest paths raises node prices while a path from a start node grows along tight arcs or shrinks; prices stay dual
feasible, so once it has reached the sink every arc of every cheapest path is tight, and the path with the least letters
is read off the tight arcs from which the sink can be reached.

Rows are range partitioned by conversation and turn, so a conversation of any size lies in pieces of bounded size in
several tasks. Prices at the borders of pieces are all that their neighbours need of them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthlake.llm import common

# Fixed values of the rules: costs, word separators, ends of whole sentences, legal steps of role initials.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
LEGAL = {"su", "ua", "au"}
STATES = range(4)
# The state that an inserted or re-roled turn leads to, and its role.
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
# What is left to do after the last row, by state: cost and edits.
TAIL = ([0, 2 * INSERT, INSERT, 0], ["", "II", "I", ""])

# Rows that one auction works on, and the most rows and characters of one piece; neither changes a result.
CHUNK = 16
PIECE_ROWS, PIECE_CHARS = 4096, 4 << 20

Code = tuple[str, bool, bool]  # role initial, has to go, truncated
Arcs = list[tuple[str, int, int]]  # letter, cost, node


def auction(arcs: list[Arcs], sink: int, sources: list[int]) -> list[float]:
    """Dual prices: those of ``sources`` are their distances to ``sink``, infinite where it cannot be reached."""
    into: list[list[int]] = [[] for _ in arcs]
    for node, out in enumerate(arcs):
        for _, _, to in out:
            into[to].append(node)
    reach, open_nodes = {sink}, [sink]
    while open_nodes:
        for node in into[open_nodes.pop()]:
            if node not in reach:
                reach.add(node)
                open_nodes.append(node)
    prices = [0 if node in reach else math.inf for node in range(len(arcs))]
    usable = [[(cost, to) for _, cost, to in out if to in reach] for out in arcs]
    for source in sources:
        if source not in reach:
            continue
        path = [source]
        while path[-1] != sink:
            node = path[-1]
            best, to = min((cost + prices[to], to) for cost, to in usable[node])
            if prices[node] < best:
                prices[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
    return prices


def lattice(codes: list[Code], exits: list[float]) -> tuple[list[Arcs], int]:
    """Arcs of the nodes 4 * row + state, each node's by letter, and the sink behind the last rows' states."""
    sink = 4 * (len(codes) + 1)
    arcs: list[Arcs] = []
    for i, (initial, gone, truncated) in enumerate(codes):
        for state in STATES:
            at, to = 4 * i, 4 * i + 4
            out: Arcs = [("D", DELETE, to + state), ("I", INSERT, at + NEXT[state])]
            if not gone:
                if (state, initial) in STEP:
                    out.append(("K", TRUNCATED * truncated, to + STEP[state, initial]))
                out.append(("R", REROLE + TRUNCATED * truncated, to + NEXT[state]))
            arcs.append(out)
    arcs += [[("", exits[state], sink)] if exits[state] < math.inf else [] for state in STATES]
    arcs.append([])
    return arcs, sink


class Chunk:
    """One auction over some rows, given what the way on costs from each state behind them."""

    def __init__(self, codes: list[Code], exits: list[float]):
        self.arcs, self.sink = lattice(codes, exits)
        self.prices = auction(self.arcs, self.sink, list(STATES))
        self.entry = self.prices[:4]

    def trace(self, state: int) -> tuple[str, int]:
        """The least letters among the cheapest ways from ``state``, and the state that they end in."""
        tight = [[(letter, to) for letter, cost, to in out if cost + self.prices[to] == self.prices[node]] for node, out in enumerate(self.arcs)]
        into: list[list[int]] = [[] for _ in self.arcs]
        for node, out in enumerate(tight):
            for _, to in out:
                into[to].append(node)
        reach, open_nodes = {self.sink}, [self.sink]
        while open_nodes:
            for node in into[open_nodes.pop()]:
                if node not in reach:
                    reach.add(node)
                    open_nodes.append(node)
        node, letters, last = state, [], state
        while node != self.sink:
            last = node
            letter, node = min((letter, to) for letter, to in tight[node] if to in reach)
            letters.append(letter)
        return "".join(letters), last % 4


def backward(codes: list[Code], exits: list[float]) -> list[Chunk]:
    """The chunks of some rows, each with the prices behind it, in order."""
    out: list[Chunk] = []
    for start in reversed(range(0, len(codes), CHUNK)):
        out.append(Chunk(codes[start : start + CHUNK], exits))
        exits = out[-1].entry
    return out[::-1]


def forward(chunks: list[Chunk], state: int) -> tuple[str, int]:
    letters = []
    for chunk in chunks:
        piece, state = chunk.trace(state)
        letters.append(piece)
    return "".join(letters), state


def apply(roles: list[str], texts: list[str], letters: str, state: int = 0) -> tuple[list[str], list[str]]:
    """The repaired turns of rows that ``letters`` edit from ``state`` on."""
    new_roles, new_texts, i = [], [], 0
    for letter in letters:
        if letter == "I":
            state = NEXT[state]
            new_roles.append(ROLE[state])
            new_texts.append("")
            continue
        if letter != "D":
            state = STEP[state, roles[i][:1]] if letter == "K" else NEXT[state]
            new_roles.append(roles[i] if letter == "K" else ROLE[state])
            new_texts.append(texts[i])
        i += 1
    return new_roles, new_texts


def name(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def judged(roles: list[str], texts: list[str], seen: set[bytes]) -> tuple[list[Code], list[int]]:
    """Codes of rows and their numbers of blank, duplicate and truncated ones; ``seen`` names rows before them."""
    codes, counts = [], [0, 0, 0]
    for role, text in zip(roles, texts, strict=True):
        own, bare = name(role, text), text.strip(BLANKS)
        fault = 0 if not bare else 1 if own in seen else 2 if bare[-1] not in ENDS else 3
        seen.add(own)
        if fault < 3:
            counts[fault] += 1
        codes.append((role[:1], fault < 2, fault == 2))
    return codes, counts


def illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials[:-1], initials[1:], strict=True))


PIECE = (
    "conv_id long, part int, no long, whole boolean, roles array<string>, texts array<string>, turns array<long>, "
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)
_NAMES = [c.split()[0] for c in PIECE.split(", ")]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64()), *[pa.int64()] * 6, pa.string()]


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)


def _turn_gaps(turns: list[int | None]) -> int:
    known = [t for t in turns if t is not None]
    return known[-1] - known[0] + 1 - len(set(known)) if known else 0


def _solved(conv_id: int | None, part: int, rows: list[tuple]) -> tuple:
    """A conversation that lies in one piece."""
    turns, roles, texts = ([r[k] for r in rows] for k in range(3))
    codes, counts = judged(roles, texts, set())
    chunks = backward(codes, TAIL[0])
    letters, state = forward(chunks, 0)
    letters += TAIL[1][state]
    cost = chunks[0].entry[0] if chunks else 0
    return (conv_id, part, 0, True, *apply(roles, texts, letters), None, _turn_gaps(turns), *counts, illegal([r[:1] for r in roles]), int(cost), letters)


def pieces(turns: DataFrame) -> DataFrame:
    """Runs of rows of one conversation, in order; a conversation that lies inside one task is solved at once.

    ``turns`` has conv_id, turn, role, text and gone; a row that is gone only says that its conversation exists.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        made: list[tuple] = []
        rows: list[tuple] = []
        chars, no, first, current, begun = 0, 0, True, None, False

        def raw() -> tuple:
            return (current, part, no, False, [r[1] for r in rows], [r[2] for r in rows], [r[0] for r in rows], *[None] * 7)

        for batch in batches:
            for conv_id, turn, role, text, gone in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone")), strict=True):
                if not begun or conv_id != current:
                    if begun:
                        # The first conversation of a task may have begun in another one.
                        made.append(raw() if first or no else _solved(current, part, rows))
                        first = False
                    rows, chars, no, current, begun = [], 0, 0, conv_id, True
                if gone:
                    continue
                if len(rows) >= PIECE_ROWS or chars + len(text) > PIECE_CHARS and rows:
                    made.append(raw())
                    rows, chars, no = [], 0, no + 1
                rows.append((turn, role, text))
                chars += len(text)
                if len(made) >= 500 or made and not made[-1][3]:
                    yield _batch(made, _NAMES, _TYPES)
                    made = []
        if begun:
            made.append(raw())
        if made:
            yield _batch(made, _NAMES, _TYPES)

    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _spaced("role"), _spaced("text"), "gone"
    ).withColumn("salt", F.monotonically_increasing_id())
    placed = rows.repartitionByRange(common.tasks_for(turns), *order, "salt").sortWithinPartitions(*order)
    return common.materialise(placed.drop("salt").mapInArrow(run, PIECE), "pieces")


def _spaced(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" ")).alias(column)


PLACE = ["conv_id", "part", "no"]


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    out = a[columns[0]].eqNullSafe(b[columns[0]])
    for c in columns[1:]:
        out &= a[c] == b[c]
    return out


def _joined(left: DataFrame, right: DataFrame, columns: list[str], how: str = "left") -> DataFrame:
    """Left join that matches null conversation ids too."""
    return left.join(right, _same(left, right, columns), how).drop(*[right[c] for c in columns])


def seen_before(open_pieces: DataFrame) -> DataFrame:
    """Per piece the names of rows that an earlier piece of its conversation has, as many as it has rows at most."""

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = sorted({name(r, t) for r, t in zip(row["roles"], row["texts"], strict=True)})
                if own:
                    yield _batch([(row["conv_id"], row["part"], row["no"], n) for n in own], [*PLACE, "name"], [pa.int64(), pa.int32(), pa.int64(), pa.binary()])

    named = open_pieces.select(*PLACE, "roles", "texts").mapInArrow(names, "conv_id long, part int, no long, name binary")
    rank = F.row_number().over(Window.partitionBy("conv_id", "name").orderBy("part", "no"))
    return named.withColumn("rank", rank).filter("rank > 1").groupBy(*PLACE).agg(F.collect_list("name").alias("seen"))


SUMMARY = (
    "conv_id long, part int, no long, costs array<long>, n long, blank long, duplicate long, truncated long, illegal long, "
    "head string, end string, low long, high long, different long"
)


def summaries(with_seen: DataFrame) -> DataFrame:
    """Per piece what the rest of its conversation needs: the cost from each state to each (null: no way), and its ends."""
    names = [c.split()[0] for c in SUMMARY.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), *[pa.int64()] * 5, pa.string(), pa.string(), *[pa.int64()] * 3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, counts = judged(row["roles"], row["texts"], set(row["seen"] or []))
                costs = [[0 if s == t else math.inf for s in STATES] for t in STATES]
                if codes:
                    costs = [backward(codes, [0 if s == t else math.inf for s in STATES])[0].entry for t in STATES]
                flat = [None if costs[t][s] == math.inf else int(costs[t][s]) for s in STATES for t in STATES]
                known = [t for t in row["turns"] if t is not None] or [None]
                initials = [r[:1] for r in row["roles"]]
                ends = (initials[0], initials[-1]) if initials else (None, None)
                yield _batch([(row["conv_id"], row["part"], row["no"], flat, len(codes), *counts, illegal(initials), *ends, known[0], known[-1], len(set(known) - {None}))], names, types)

    return with_seen.select(*PLACE, "roles", "texts", "turns", "seen").mapInArrow(run, SUMMARY)


BORDER = "conv_id long, part int, no long, exits array<long>, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def borders(summary: DataFrame) -> DataFrame:
    """Per piece the price of each state behind it, and the conversation's numbers, from its pieces' summaries."""
    names = [c.split()[0] for c in BORDER.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), *[pa.int64()] * 6]

    def solve(rows: list[dict]) -> pa.RecordBatch:
        exits: list[list[float]] = [TAIL[0]]
        for row in reversed(rows):
            cost = [[("", row["costs"][4 * s + t], 4 + t) for t in STATES if row["costs"][4 * s + t] is not None] for s in STATES]
            way_on = [[("", exits[-1][t], 8)] if exits[-1][t] < math.inf else [] for t in STATES]
            exits.append(auction([*cost, *way_on, []], 8, list(STATES))[:4])
        full = [r for r in rows if r["n"]]
        known = [r for r in full if r["low"] is not None]
        gaps = known[-1]["high"] - known[0]["low"] + 1 - sum(r["different"] for r in known) + sum(a["high"] == b["low"] for a, b in zip(known[:-1], known[1:], strict=True)) if known else 0
        wrong = sum(r["illegal"] for r in full) + sum(a["end"] + b["head"] not in LEGAL for a, b in zip(full[:-1], full[1:], strict=True))
        total = (gaps, *(sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated")), wrong, int(exits[-1][0]) if full else 0)
        prices = [[None if p == math.inf else int(p) for p in e] for e in exits[-2::-1]]
        return _batch([(r["conv_id"], r["part"], r["no"], p, *total) for r, p in zip(rows, prices, strict=True)], names, types)

    return _per_conversation(summary, solve, BORDER)


def _per_conversation(rows: DataFrame, solve, schema: str) -> DataFrame:
    """``solve`` over the rows of each conversation in order; there is one row per piece, not per turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[-1]["conv_id"] != row["conv_id"]:
                    yield solve(held)
                    held = []
                held.append(row)
        if held:
            yield solve(held)

    return rows.repartition(common.tasks_for(rows), "conv_id").sortWithinPartitions(*PLACE).mapInArrow(run, schema)


CHOICE = "conv_id long, part int, no long, ends array<int>"


def choices(with_borders: DataFrame) -> DataFrame:
    """Per piece the state that each entry state leads to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunks = _chunks(row)
                ends = [(forward(chunks, s)[1] if chunks[0].entry[s] < math.inf else None) if chunks else s for s in STATES]
                yield _batch([(row["conv_id"], row["part"], row["no"], ends)], [*PLACE, "ends"], [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())])

    return with_borders.select(*PLACE, "roles", "texts", "seen", "exits").mapInArrow(run, CHOICE)


def _chunks(row: dict) -> list[Chunk]:
    codes, _ = judged(row["roles"], row["texts"], set(row["seen"] or []))
    return backward(codes, [math.inf if p is None else p for p in row["exits"]])


def entries(choice: DataFrame) -> DataFrame:
    """Per piece the state in which the cheapest edits enter it, and whether it is the last one."""

    def solve(rows: list[dict]) -> pa.RecordBatch:
        state, out = 0, []
        for i, row in enumerate(rows):
            out.append((row["conv_id"], row["part"], row["no"], state, i == len(rows) - 1))
            state = row["ends"][state]
        return _batch(out, [*PLACE, "entry", "final"], [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_()])

    return _per_conversation(choice, solve, "conv_id long, part int, no long, entry int, final boolean")


def _repaired(chosen: DataFrame) -> DataFrame:
    """Raw pieces with their borders and entries as repaired ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                letters, state = forward(_chunks(row), row["entry"])
                letters += TAIL[1][state] if row["final"] else ""
                numbers = [row[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                yield _batch([(row["conv_id"], row["part"], row["no"], True, *apply(row["roles"], row["texts"], letters, row["entry"]), None, *numbers, letters)], _NAMES, _TYPES)

    columns = [*PLACE, "roles", "texts", "seen", "exits", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "entry", "final"]
    return chosen.select(*columns).mapInArrow(run, PIECE)


def solved(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repaired pieces: those that are whole conversations, and those of conversations in several pieces."""
    made = pieces(turns)
    raw = made.filter("NOT whole")
    known = common.materialise(_joined(raw.select(*PLACE, "roles", "texts", "turns"), seen_before(raw), PLACE), "open_pieces")
    border = common.materialise(borders(summaries(known)), "borders")
    bordered = _joined(known, border, PLACE)
    entry = entries(choices(bordered))
    return made.filter("whole"), common.materialise(_repaired(_joined(bordered, entry, PLACE)), "repaired")


RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def _digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation from its pieces in order; texts are hashed as they stream by."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    types = [*[pa.int64()] * 7, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        held: dict | None = None
        sha, audit, empty = hashlib.sha256(), [], True

        def row() -> tuple:
            return (*(held[c] for c in names[:7]), "".join(audit), sha.hexdigest())

        for batch in batches:
            for piece in batch.to_pylist():
                if held is not None and held["conv_id"] != piece["conv_id"]:
                    done.append(row())
                    sha, audit, empty = hashlib.sha256(), [], True
                held = piece
                audit.append(piece["audit"])
                for role, text in zip(piece["roles"], piece["texts"], strict=True):
                    sha.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                    empty = False
            if done:
                yield _batch(done, names, types)
                done = []
        if held is not None:
            yield _batch([*done, row()], names, types)

    return repaired.select(*PLACE, "roles", "texts", *names[1:7], "audit").mapInArrow(run, RESULT)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, part, no and pos, which order the turns, and role and text."""
    whole, parts = solved(turns)
    both = whole.unionByName(parts)
    return both.select(*PLACE, F.posexplode(F.arrays_zip("roles", "texts")).alias("pos", "turn")).select(
        *PLACE, "pos", F.col("turn.roles").alias("role"), F.col("turn.texts").alias("text")
    )


def repair(turns: DataFrame) -> DataFrame:
    """Per conversation its faults, the cost and letters of the cheapest edits, and the digest of what they leave.

    ``turns`` has conv_id, turn, role, text and gone (true: a row that is not there but whose conversation counts); more
    columns, whatever their names, are left alone. Null role or text is one space. A null conv_id is a conversation of its
    own. Null turns come first; equal turns are ordered by role and text, so repeated rows stand side by side. A
    conversation without rows costs nothing and has an empty audit; no rows at all give no result. Texts of any length
    are one row of a piece.
    """
    whole, parts = solved(turns)
    in_order = parts.repartition(common.tasks_for(turns), "conv_id").sortWithinPartitions(*PLACE)
    return _digests(whole).unionByName(_digests(in_order))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by a checksum of their conversation and turn, for :func:`repair`; dropped ones are ``gone``."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1])) % 20
    rows = conversations.select(F.col("conv_id"), F.col("turn"), spaced[2].alias("role"), spaced[3].alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.col("kind") == 0, F.when(F.col("kind") == 3, 2).otherwise(1))).alias("gone")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times)

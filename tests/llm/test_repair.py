"""Conversation repair against exhaustive search and a plain table of cheapest edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from hearthlake.llm import repair
from tests.llm.helpers import rows_of

SCHEMA = "conv_id long, turn long, role string, text string, score string, part int, no int"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT = [2, 2, 3, 2]


def plain_damage(rows):
    out, ids = [], set()
    for c, t, role, text in rows:
        ids.add(c)
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(c, t, role, text)] * (2 if kind == 3 else 1)
    return ids, out


def plain_repair(rows):
    """rows: (turn, role, text) of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        letters = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not letters else "duplicate" if (role, text) in seen else "truncated" if letters[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {0: (0, "")}

    def better(table, state, value):
        if state not in table or value < table[state]:
            table[state] = value

    def inserted(table):
        for _ in range(3):
            for s, (cost, letters) in list(table.items()):
                better(table, NEXT[s], (cost + 2, letters + "I"))

    for (_, role, _), fault in zip(rows, faults, strict=True):
        inserted(best)
        after = {}
        for s, (cost, letters) in best.items():
            better(after, s, (cost + 3, letters + "D"))
            if fault in ("", "truncated"):
                extra = fault == "truncated"
                better(after, NEXT[s], (cost + 2 + extra, letters + "R"))
                if (s, role[:1]) in STEP:
                    better(after, STEP[s, role[:1]], (cost + extra, letters + "K"))
        best = after
    inserted(best)
    cost, audit = min(best[s] for s in (0, 3) if s in best)
    state, i, left = 0, 0, []
    for letter in audit:
        if letter == "D":
            i += 1
            continue
        state = STEP[state, rows[i][1][:1]] if letter == "K" else NEXT[state]
        left.append(f"{rows[i][1] if letter == 'K' else ['', '', 'user', 'assistant'][state]}:{'' if letter == 'I' else rows[i][2]}")
        i += letter != "I"
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    wrong = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows[:-1], rows[1:], strict=True))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), wrong, cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest())


def exhaustive(codes):
    """The cheapest letters, least first, among all edits with up to two inserts at each place."""
    found = []
    for edits in itertools.product("DKR", repeat=len(codes)):
        for inserts in itertools.product(range(3), repeat=len(codes) + 1):
            letters = "".join("I" * n + e for n, e in zip(inserts, [*edits, ""], strict=True))
            state, i, cost = 0, 0, 0
            for letter in letters:
                if letter == "I":
                    state, cost = NEXT[state], cost + 2
                    continue
                initial, gone, cut = codes[i]
                i += 1
                if letter == "D":
                    cost += 3
                elif gone or letter == "K" and (state, initial) not in STEP:
                    break
                else:
                    state = STEP[state, initial] if letter == "K" else NEXT[state]
                    cost += cut + 2 * (letter == "R")
            else:
                if state in (0, 3):
                    found.append((cost, letters))
    return min(found)


def test_auction_against_exhaustive_search():
    r = random.Random(3)
    for _ in range(120):
        codes = [(r.choice("suaat"), r.random() < 0.2, r.random() < 0.3) for _ in range(r.randint(0, 4))]
        chunks = repair.backward(codes, repair.TAIL[0])
        letters, state = repair.forward(chunks, 0)
        cost = chunks[0].entry[0] if chunks else 0
        assert (cost, letters + repair.TAIL[1][state]) == exhaustive(codes)


def table(seed=1):
    r = random.Random(seed)
    rows = []
    for c in range(60):
        for t in range(r.randint(1, 9)):
            text = r.choice(["a b.", "x", "é!", "", " \t", None, "q? ", "w. \n"]) if r.random() < 0.6 else f"text {r.randint(0, 99)}."
            rows.append((c, t + r.randint(0, 1), r.choice(["user", "assistant", "system", "tool", None, "", "user", "assistant"]), text))
    rows += [(None, 1, "user", "a."), (None, None, "assistant", "b"), (200, None, "user", "n."), (200, None, "user", "n."), (-5, -3, "user", "v" * 100_000 + ".")]
    rows += [(201, t, "user" if r.random() < 0.6 else "assistant", f"t{r.randint(0, 30)}" + r.choice([".", ""])) for t in range(150)]
    rows += [(c, t, "user", "one.") for c in (300, 301) for t in (0, 0)]
    return rows


@pytest.mark.parametrize("piece_rows", [4096, 3])
def test_repair_against_a_plain_table(spark, monkeypatch, piece_rows):
    monkeypatch.setattr(repair, "PIECE_ROWS", piece_rows)
    rows = table()
    ids, left = plain_damage(rows)
    found = repair.repair(repair.damaged(spark.createDataFrame([(*r, "s", 1, 2) for r in rows], SCHEMA)))
    assert found.columns == COLUMNS
    want = [(c, *plain_repair([r[1:] for r in left if r[0] == c])) for c in ids]
    assert rows_of(found, *COLUMNS) == sorted(want, key=str)


def test_repaired_turns_are_legal(spark):
    df = repair.damaged(spark.createDataFrame([(*r, "s", 1, 2) for r in table(7)], SCHEMA))
    turns = repair.repaired_turns(df).orderBy("conv_id", "part", "no", "pos").collect()
    by = {}
    for r in turns:
        by.setdefault(r.conv_id, []).append(r.role[:1])
    assert by and all(re.fullmatch("(s?(ua)+)?", "".join(v)) for v in by.values())


def test_no_conversations(spark):
    assert repair.repair(repair.damaged(spark.createDataFrame([], SCHEMA))).count() == 0


def test_nothing_left_after_damage(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    found = repair.repair(repair.damaged(spark.createDataFrame([(dropped, 0, "user", "a.", "s", 1, 2)], SCHEMA)))
    assert rows_of(found, *COLUMNS) == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]

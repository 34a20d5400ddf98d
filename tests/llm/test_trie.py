"""The prefix trie against plain dictionaries."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from hearthlake.llm import trie
from tests.llm.helpers import rows_of

SCHEMA = "conv_id long, turn long, role string, text string, path string, part int, shard int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    own = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [v[2:] for v in sorted(v, key=lambda x: (x[:2], x[2].encode(), x[3].encode()))] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, m in members.items():
        ended = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), parent, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=str)


def table(seed=1, convs=400):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        if c % 100 == 0 and c == 300:
            continue
        for t in range(r.choice([1, 1, 2, 3, 8])):
            rows.append((c, t, ["user", "assistant", None][t % 2 if r.random() < 0.95 else 2], r.choice(["a", "bé", "", None, "common text", "c" * r.randint(0, 3)])))
    rows += [(c, 0, "user", "hot") for c in range(1000, 1300)] + [(-150, 0, "user", "n"), (-100, 0, "user", "m"), (None, 1, "user", "x"), (None, None, None, None)]
    rows += [(500, None, "user", "n1"), (500, None, "user", "n2"), (500, 1, "user", "v" * 100_000), (500, 1, "user", "v" * 100_000)]
    rows += [(501, t, "user", f"t{t}") for t in range(700)]
    return rows


def test_findclose():
    r = random.Random(5)
    for n in (1, 3, 300, 2000):
        kinds, depth, left = [True], 1, n
        while depth:
            down = left and r.random() < (0.5 if depth > 1 else 1)
            kinds.append(bool(down))
            left -= bool(down)
            depth += 1 if down else -1
        tree, stack, want = trie.Parentheses(np.array(kinds)), [], {}
        for i, k in enumerate(kinds):
            if k:
                stack.append(i)
            else:
                want[stack.pop()] = i
        assert {i: tree.findclose(i) for i in want} == want


@pytest.mark.parametrize("turns", [1 << 16, 7, 1])
def test_trie_against_dictionaries(spark, monkeypatch, turns):
    monkeypatch.setattr(trie, "SHARD_TURNS", turns)
    rows = table()
    found = trie.prefix_trie(spark.createDataFrame([(*r, "p", 1, 2) for r in rows], SCHEMA))
    assert found.columns == COLUMNS
    assert rows_of(found, *COLUMNS) == plain(rows)


def test_copies_and_turnless_conversations(spark):
    turnless = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    for rows in ([(c, t, "user", "same") for c in range(50) for t in range(3)], [(turnless, 0, "user", "x")]):
        assert rows_of(trie.prefix_trie(spark.createDataFrame([(*r, "p", 1, 2) for r in rows], SCHEMA)), *COLUMNS) == plain(rows)


def test_no_conversations(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0

"""Small awkward tables, and plain versions of the operators to compare with."""

from __future__ import annotations

import collections
import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, score string, key int, label string, n int"


def awkward(seed: int = 1, texts: int = 60, words: int = 4, longest: int = 60) -> list[tuple[int | None, str | None]]:
    """Random texts over few words, copies, ties, null and empty texts, null ids, separators only, a long text."""
    r = random.Random(seed)
    rows: list[tuple[int | None, str | None]] = []
    for i in range(texts):
        text = " ".join("wé%d" % r.randint(0, words) for _ in range(r.randint(0, longest)))
        rows.append((i, rows[-1][1] if rows and r.random() < 0.2 else text))
    rows += [(100, None), (100, None), (101, ""), (102, " \t\n"), (103, "x"), (103, "x"), (None, "a b c d e f g"), (None, "a b c d e f g")]
    rows.append((104, "long word " * 3000 + "\n" + "z" * 5000))
    return rows


def frame(spark, rows):
    """With columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "s", 1, "l", 2) for i, t in rows], SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def word_repeats(rows, window: int):
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = collections.Counter(tuple(w[k : k + window]) for _, w in texts for k in range(len(w) - window + 1))
    out = []
    for i, w in texts:
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone |= set(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def byte_repeats(rows, length: int):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        edge = [0] * (len(b) + length + 1)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                edge[k] += 1
                edge[k + length] -= 1
        depth, gone = 0, []
        for k in range(len(b)):
            depth += edge[k]
            gone.append(depth > 0)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def similar(rows, size: int = 5):
    """(row number: class members, links) over rows with words."""
    sets = {}
    for n, (_, t) in enumerate(rows):
        w = WORD.findall(t or "")
        if w:
            sets[n] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))}
    parent, links = {n: n for n in sets}, collections.Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b:
                n = len(sets[a] & sets[b])
                if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n):
                    links[a] += 1
                    links[b] += 1
                    parent[root(b)] = root(a)
    members = collections.defaultdict(list)
    for n in sets:
        members[root(n)].append(n)
    return {n: (members[root(n)], links[n]) for n in sets}

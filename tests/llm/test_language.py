"""The language model against dictionaries, its sampler against the exact distribution, and its gain on held-out text."""

import collections
import itertools
import math
import pathlib
import re
import zlib

import numpy as np
import pytest

from hearthlake.llm import common, language
from tests.llm.helpers import awkward, frame

COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
SF = pathlib.Path("/root/testdata/sf0.001")


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def key_of(word):
    return int(language.END) if word is None else int.from_bytes(language.name(word.encode()), "little")


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def plain(rows):
    learnt = [words(t) for i, t in rows if not held(i)]
    count = collections.Counter(w for d in learnt for w in d)
    pair = collections.Counter(p for d in learnt for p in zip([None, *d[:-1]], d, strict=True))
    n, v = sum(count.values()), len(count)

    def estimate(counts):
        return language.discount_of(sum(c == 1 for c in counts), sum(c == 2 for c in counts))

    discount = estimate(pair.values())
    many = [p for p in pair if pair[p] > 1]
    keys = np.array([key_of(w) for p in many for w in p], np.uint64).reshape(-1, 2)
    pair_keys = common.mix(common.mix(keys[:, 0]) + keys[:, 1])
    known = sorted(count, key=str)
    word_keys = np.array([key_of(w) for w in known], np.uint64)
    tables, history = dict.fromkeys(pair, 1), []
    root_discount, new = 0.5, language.STRENGTH
    for sweep in range(language.BURN_IN + language.SAMPLES):
        if sweep:
            seated, root, _ = history[-1]
            weight = np.array([(language.STRENGTH + discount * seated[a]) * root[b] for a, b in many])
            drawn = language.seats(np.array([pair[p] for p in many]), weight, discount, pair_keys, sweep)
            tables |= dict(zip(many, drawn.tolist(), strict=True))
        seated, customers = collections.Counter(), collections.Counter()
        for (a, b), t in tables.items():
            seated[a] += t
            customers[b] += t
        root_tables = language.seats(np.array([customers[w] for w in known]), np.full(len(known), new), root_discount, word_keys, sweep)
        if not sweep:
            root_discount = estimate(customers.values())
        new = (language.STRENGTH + root_discount * root_tables.sum()) / (v + 1)
        total = language.STRENGTH + sum(customers.values())
        root = collections.defaultdict(lambda x=new / total: x)
        root |= {w: (customers[w] - root_discount * t + new) / total for w, t in zip(known, root_tables.tolist(), strict=True)}
        history.append((seated, root, dict(tables)))

    def probability(a, b):
        each = [(pair[a, b] - discount * t.get((a, b), 0) + (language.STRENGTH + discount * s[a]) * r[b]) / (language.STRENGTH + count[a]) for s, r, t in history[language.BURN_IN :]]
        return sum(each) / len(each)

    out = []
    for i, t in rows:
        d = words(t)
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in d)
        out.append((i, held(i), len(d), sum(count[w] > 0 for w in d), n, base, sum(math.log10(probability(a, b)) for a, b in zip([None, *d[:-1]], d, strict=True))))
    return out, probability, known


def same(found, want):
    def order(r):
        return (r[0] is not None, r[0] or 0, r[2], r[3])

    found, want = sorted((tuple(r) for r in found), key=order), sorted(want, key=order)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    for a, b in zip(found, want, strict=True):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("step", [common.STEP_BYTES, 500])
def test_score_against_dictionaries(spark, monkeypatch, step):
    monkeypatch.setattr(common.steps, "__defaults__", ("text", step))
    rows = awkward(4, texts=150) + [(500, "Ünïque ÄB Wé1 wé1"), (502, " x"), (503, "wé1 " * 3000)]
    found = language.score(frame(spark, rows))
    assert found.columns == COLUMNS
    want, probability, known = plain(rows)
    same(found.collect(), want)
    for context in (None, "wé1", "never seen"):
        assert sum(probability(context, w) for w in known) + probability(context, "unknown") == pytest.approx(1)


def test_no_documents_and_nothing_learnt(spark):
    assert language.score(frame(spark, [])).count() == 0
    only = next(i for i in range(100) if held(i))
    assert [tuple(r) for r in language.score(frame(spark, [(only, "a b")])).collect()] == [(only, True, 3, 0, 0, 0.0, 0.0)]


def test_log_gamma():
    x = np.array([1e-9, 0.01, 0.25, 1, 2.5, 30, 1e6])
    assert language.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-9, abs=1e-9)


def exact_tables(customers, new, discount):
    """Probability of each number of tables: new to their power times the sum over seatings."""
    weights = {1: 1.0}
    for i in range(1, customers):
        after = collections.Counter()
        for t, w in weights.items():
            after[t] += w * (i - discount * t)
            after[t + 1] += w * new
        top = max(after.values())
        weights = {t: w / top for t, w in after.items()}
    total = sum(weights.values())
    return {t: w / total for t, w in weights.items()}


@pytest.mark.parametrize(("customers", "new", "discount"), [(2, 0.5, 0.7), (6, 2.0, 0.8), (16, 0.3, 0.5), (17, 1.0, 0.5), (60, 3.0, 0.6), (400, 0.05, 0.75), (400, 30.0, 0.6), (3000, 1.0, 0.5), (5, 40.0, 0.7), (2, 1e4, 0.6)])
def test_seats_follow_the_exact_distribution(monkeypatch, customers, new, discount):
    monkeypatch.setattr(language, "MOVES", 60)
    n = 10_000
    drawn = language.seats(np.full(n, customers), np.full(n, new), discount, common.mix(np.arange(n, dtype=np.uint64)), 3)
    want = exact_tables(customers, new, discount)
    seen = collections.Counter(drawn.tolist())
    assert 0.5 * sum(abs(seen[t] / n - want.get(t, 0)) for t in set(seen) | set(want)) < 0.02 + 0.4 * math.sqrt(len([t for t in want if want[t] > 1e-4]) / n)


def test_all_short_texts_share_one_unit_of_probability(spark):
    ids = [i for i in range(40_000) if held(i)]
    texts = [" ".join(t) for n in range(6) for t in itertools.product(["a", "b", "other"], repeat=n)]
    learnt = [(i, t) for i, t in zip((i for i in range(200) if not held(i)), ["a b", "a", "", "b a a"] * 20, strict=False)]
    found = language.score(frame(spark, learnt + list(zip(ids, texts, strict=False)))).filter("held_out").collect()
    assert len(found) == len(texts)
    assert 0.9 < sum(10**r.score for r in found) < 1


@pytest.mark.skipif(not SF.exists(), reason="needs the generated tables")
def test_held_out_text_is_likelier_than_under_the_base(spark):
    rows = language.score(spark.read.parquet(str(SF / "documents.parquet"))).filter("held_out").collect()
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from hearthlake.llm import common, quality, rules, toxicity
from tests.llm.helpers import WORD, awkward, frame, rows_of


def labelled(n: int = 260, seed: int = 4):
    r = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(r.randint(20, 160))]
        bad = r.random() < 0.4
        if bad:
            for _ in range(4):
                words.insert(r.randrange(len(words)), "vile" + r.choice("mnopq") * r.randint(1, 3))
        docs.append((i, " ".join(words)))
        labels.append((i, int(not bad), int(bad)))
    return docs, labels


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_backward_is_the_slope_of_forward():
    model = toxicity.Model(3)
    x = toxicity.inputs_of(*common.buffer_of(pa.array(["some words to look at", "a", ""])))
    chosen = np.arange(len(x.window))
    index, live = toxicity.layout(x, chosen)
    slope = np.array([0.3, -0.7, 0.2], np.float32)

    def loss():
        return float(model.forward(model.embed(x), index, live) @ slope)

    _, cache = model.forward(model.embed(x), index, live, keep=True)
    gradients = model.backward(x, model.embed(x), index, cache, slope)
    for name, g in gradients.items():
        flat = np.argsort(-np.abs(g.ravel()))[:3]
        for i in flat:
            was = model.p[name].flat[i]
            model.p[name].flat[i] = was + 1e-2
            up = loss()
            model.p[name].flat[i] = was - 1e-2
            down = loss()
            model.p[name].flat[i] = was
            assert (up - down) / 2e-2 == pytest.approx(g.flat[i], rel=0.05, abs=2e-4), name


def test_windows_cover_all_words():
    x = toxicity.inputs_of(*common.buffer_of(pa.array(["w " * n for n in (0, 1, 64, 65, 200)])))
    at = common.per_text(x.owner, x.texts)
    sizes = np.bincount(np.repeat([0, 1, 2, 3, 4], [0, 1, 64, 65, 200]), minlength=5)
    begin = np.cumsum(sizes) - sizes
    for t in range(5):
        seen = set()
        for w in range(at[t], at[t + 1]):
            seen |= set(range(x.window[w], x.window[w] + x.size[w]))
        assert seen == set(range(begin[t], begin[t] + sizes[t]))


def test_toxicity_learns_and_handles_awkward_rows(spark):
    docs, labels = labelled()
    extra = [(None, "vilem words"), (900, None), (901, ""), (901, ""), (902, "calm " * 3000)]
    found = toxicity.score(frame(spark, docs + extra), label_frame(spark, labels), steps=150).collect()
    assert len(found) == len(docs) + len(extra) and found[0].label == "l"
    by = {r.doc_id: r for r in found}
    held = [(by[i].predicted, t) for i, _, t in labels if by[i].held_out]
    assert held and sum(p == t for p, t in held) / len(held) > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert by[900].score == by[901].score and by[None].held_out


def test_quality_learns_and_handles_awkward_rows(spark):
    r = random.Random(1)
    docs, labels = [], []
    for i in range(150):
        bad = r.random() < 0.4
        words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
        docs.append((i, " ".join(w.upper() + "!!" for w in words) if bad else " ".join(words)))
        labels.append((i, int(not bad), 0))
    extra = [(None, "abc"), (900, None), (901, ""), (902, "long text " * 5000), (0, docs[0][1])]
    found = quality.score(frame(spark, docs + extra), label_frame(spark, labels)).collect()
    assert len(found) == len(docs) + len(extra)
    by = {r.doc_id: r for r in found}
    held = [(by[i].predicted, q) for i, q, _ in labels if by[i].held_out]
    assert held and all(p == q for p, q in held)
    assert by[900].score == by[901].score


def test_cosine_votes_against_plain_loops():
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abc d"), 80)) for _ in range(60)]
    rows = quality.features(*common.buffer_of(pa.array(texts)))
    labels = rng.integers(0, 2, 40)
    voters = quality.fit(rows[:40], labels, np.ones(quality.TERMS))
    vectors = voters.project(rows)
    for row, score in zip(vectors, voters.score(rows, block=7), strict=True):
        near = sorted(range(40), key=lambda k: -float(row @ voters.vectors[k]))[: quality.NEIGHBOURS]
        weight = [max(float(row @ voters.vectors[k]), 0) ** quality.SHARPNESS for k in near]
        assert score == pytest.approx(sum(w * labels[k] for w, k in zip(weight, near, strict=True)) / sum(weight), abs=1e-4)


@pytest.mark.parametrize("score", [toxicity.score, quality.score])
def test_without_labels_or_rows(spark, score):
    none = label_frame(spark, [])
    assert score(frame(spark, []), none).count() == 0
    found = score(frame(spark, [(1, "a b c"), (2, None)]), none).collect()
    assert {r.predicted for r in found} == {0 if score is toxicity.score else 1}
    one_kind = label_frame(spark, [(1, 1, 0), (1, 1, 0), (None, 1, 1), (2, None, None)])
    assert score(frame(spark, [(1, "a b c"), (2, None)]), one_kind).count() == 2


def plain_measures(text):
    words = WORD.findall(text or "")
    threes = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered, seen, again = set(), set(), 0
    for i in range(len(words) - 2):
        if threes[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered)


def test_measures_and_base(spark):
    rows = awkward(6, words=3) + [(210, "a\na\r\na\n\na"), (211, "x|y #*$%&<> é\n" * 40), (212, "\n".join(["same line"] * 30))]
    found = rules.judge(frame(spark, rows))
    want = []
    for i, t in rows:
        m = plain_measures(t)
        want.append((i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    assert rows_of(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(want, key=str)
    assert all(not r.kept for r in found.collect() if r.base_failed)
    assert rules.judge(frame(spark, [])).count() == 0


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(1)
    table = np.array([[[0.6, 0.1, 0.3], [0.05, 0.7, 0.25]], [[0.5, 0.1, 0.4], [0.02, 0.6, 0.38]], [[0.7, 0, 0.3], [0.03, 0, 0.97]]])
    made = (rules.Rule("a", "1", 1, 0), rules.Rule("b", "1", 1, 0), rules.Rule("c", "1", 1))
    good = rng.random(40000) < 0.8
    votes = np.stack([[rng.choice(3, p=table[r, int(g)]) for g in good] for r in range(3)], axis=1)
    kinds, counts = np.unique(votes, axis=0, return_counts=True)
    found = rules.weigh(["".join(map(str, k)) for k in kinds], counts, made)
    assert found.prior == pytest.approx(0.8, abs=0.03)
    assert np.abs(found.table - table).max() < 0.06
    assert rules.weigh([], np.array([]), made).posterior == {}


def test_quality_scores_in_a_worker_without_the_base(spark, monkeypatch):
    """A fresh Python worker has no hash base until the task takes over the driver's."""
    docs, labels = labelled(60)
    docs_frame = frame(spark, docs)
    tasks = []
    real = type(docs_frame).mapInArrow

    def spy(self, function, schema, *args, **kwargs):
        tasks.append(function)
        return real(self, function, schema, *args, **kwargs)

    monkeypatch.setattr(type(docs_frame), "mapInArrow", spy)
    quality.score(docs_frame, label_frame(spark, labels))
    monkeypatch.setitem(common._RUN, "base", 0)
    row = {c: [v] for c, v in zip(docs_frame.columns, (7, "ab ab ab\nx\nx", "s", 1, "l", 2), strict=True)}
    batch = pa.RecordBatch.from_pydict({**row, "__text": row["text"]})
    out = list(tasks[-1](iter([batch])))
    assert out[0].num_rows == 1 and 0 <= out[0].column("score")[0].as_py() <= 1

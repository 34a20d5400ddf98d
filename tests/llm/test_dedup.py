import collections
import os
import random

import numpy as np
import pytest

from hearthlake.llm import blocks, common, places, similar, suffix
from tests.llm.helpers import WORD, awkward, byte_repeats, frame, rows_of, similar as plain_similar, word_repeats


def test_suffix_arrays_of_many_and_of_one():
    r = random.Random(2)
    texts = [[r.randint(0, r.choice([1, 2, 200])) for _ in range(r.randint(0, 60))] + [-1] for _ in range(200)]
    texts += [[1] * 50 + [-1], [1, 2] * 40 + [-1], list(range(50, 0, -1)) + [-1], [r.randint(0, 2) for _ in range(1500)] + [-1]]
    begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = suffix.suffix_arrays(np.array([x for t in texts for x in t], np.int32), begins)
    for t, a, b in zip(texts, begins[:-1], begins[1:], strict=True):
        want = sorted(range(len(t)), key=lambda i: t[i:])
        assert (found[a:b] - a).tolist() == want
        assert suffix.suffix_array(np.array(t)).tolist() == want
    assert len(suffix.suffix_array(np.array([], int))) == 0


@pytest.mark.parametrize("length", [7, 10, 24, 200])
def test_byte_repeats(spark, length):
    rows = awkward(length, words=1) + [(200, "a" * 300), (201, "ab" * 200), (202, "é" * 120)]
    found = suffix.remove_repeats(frame(spark, rows), length)
    assert rows_of(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == byte_repeats(rows, length)


def test_edited_copies(spark):
    """Repeats that end at every distance from a shared core."""
    r = random.Random(5)
    base = "".join(r.choice("abcdefgh ") for _ in range(900))
    rows = []
    for i in range(40):
        text = list(base)
        for _ in range(r.randint(0, 4)):
            text[r.randrange(len(text))] = r.choice("XYZ")
        rows.append((i, "".join(text)))
    found = suffix.remove_repeats(frame(spark, rows))
    assert rows_of(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == byte_repeats(rows, 200)


def _passage_rows(seed, n):
    """One passage between different surroundings, which share their nearest bytes now and then."""
    r = random.Random(seed)
    passage = "".join(r.choice("abcdefgh ") for _ in range(260))
    side = lambda: "".join(r.choice("xy") for _ in range(r.randint(0, 60)))
    return [(i, side() + passage + side() if i % 3 else side() + side()) for i in range(n)]


@pytest.mark.parametrize("crowd", [(2, 1), (4, 8), (10**9, 10**9)])
def test_crowded_cores(spark, crowd):
    rows = _passage_rows(3, 90)
    found = suffix.remove_repeats(frame(spark, rows), crowd=crowd)
    assert rows_of(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == byte_repeats(rows, 200)


def test_a_crowded_core_never_meets_in_one_group(spark):
    """No fragment around a passage that stands in two thirds of all rows is dealt by its core."""
    texts = places.one_text(places.keyed(frame(spark, _passage_rows(4, 300)))).coalesce(1)
    cutting = suffix.Cutting(200)
    hits = places.repeated(texts, suffix.offer_anchors(cutting), False, exact=False, crowd=suffix.CROWD)
    cut = common.mapped(texts.join(hits, "key"), suffix.fragments(cutting), "core long, fragment binary, places binary")
    assert hits.filter("crowded IS NOT NULL").count() == 200
    assert max([r["count"] for r in cut.groupBy("core").count().collect()], default=0) < suffix.CROWD[0]


@pytest.mark.parametrize("exact, marked", [(True, False), (False, False), (True, True)])
def test_a_slice_sends_two_places_of_a_hash(spark, exact, marked):
    def offer(part):
        data, offsets = common.buffer_of(part.column("text"))
        at = np.arange(len(data))
        hashes = common.mix(data.astype(np.uint64) + np.uint64(1))
        return at, hashes, (data == ord("a")) & (at % 7 == 3), offsets

    rows = frame(spark, [(1, "a" * 50 + "z"), (2, "bcab"), (3, "y" * 3)])
    rows = places.keyed(rows).coalesce(1)
    found = {r["key"]: np.frombuffer(r["positions"], "<u4").tolist() for r in places.repeated(rows, offer, marked, exact).collect()}
    key = {r["doc_id"]: r["key"] for r in rows.collect()}
    want = {key[1]: [*range(50)], key[2]: [2] if marked else [0, 2, 3]} | ({} if marked else {key[3]: [0, 1, 2]})
    assert found == want
    at, _, marks, further = places._two(np.arange(9), np.full(9, 8, np.uint64), np.arange(9) == 5, None)
    assert at.tolist() == [0, 1] and marks.tolist() == [True, False] and further.tolist() == [[0, i] for i in range(2, 9)]


@pytest.mark.parametrize("window, block", [(5, 3), (9, 5), (35, 18)])
def test_word_repeats(spark, window, block):
    rows = awkward(window, words=2) + [(200, "b " * 70), (201, "c " * 34)]
    found = blocks.remove_repeats(frame(spark, rows), window, block)
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept_sha256") == word_repeats(rows, window)


def test_a_window_must_hold_a_block(spark):
    with pytest.raises(ValueError):
        blocks.remove_repeats(frame(spark, []), 10, 6)


def test_cut_repeats_keeps_rows_and_columns(spark):
    shared = "This passage stands in two documents. " * 8
    rows = [(1, "one\n" + shared + "end"), (2, shared), (3, "clean"), (4, None), (5, "")]
    out = suffix.cut_repeats(frame(spark, rows))
    assert out.columns == frame(spark, rows).columns
    left = {r.doc_id: r.text for r in out.collect()}
    assert left == {1: "one\nend", 3: "clean", 4: None, 5: ""}
    assert {tuple(r)[2:] for r in out.collect()} == {tuple(r)[2:] for r in frame(spark, rows).collect()}


def test_texts_of_one_name_end_the_job(spark):
    rows = spark.createDataFrame([(1, "a", 7), (2, "b", 7), (3, "c", 8)], "doc_id long, text string, key long")
    with pytest.raises(Exception, match="two texts have one name"):
        places.one_text(rows).collect()
    assert places.one_text(rows.filter("doc_id > 1")).count() == 2


@pytest.mark.parametrize("plan", [similar.Plan(), similar.Plan(small=8, block=16, block_shingles=2000)])
def test_similar_classes(spark, plan):
    r = random.Random(3)
    base = [f"w{r.randint(0, 500)}" for _ in range(150)]
    rows = awkward(9, words=500)
    for i in range(90):
        words = list(base)
        for _ in range(r.randint(0, 6)):
            words[r.randrange(150)] = f"z{r.randint(0, 9)}"
        rows.append((300 + i, " ".join(words)))
    want = plain_similar(rows)
    expected = []
    for n, (i, _) in enumerate(rows):
        members, links = want.get(n, ([n], 0))
        ids = [rows[m][0] for m in members if rows[m][0] is not None]
        expected.append((i, min(ids) if ids else None, links, len(members)))
    assert rows_of(similar.classes(frame(spark, rows), plan), "doc_id", "class_id", "n_links", "class_size") == sorted(expected, key=str)


def test_one_per_class(spark):
    rows = [(5, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (7, "other words are here now"), (7, "same id but another text"), (8, ""), (8, ""), (9, None), (None, "a b c d e f"), (None, "no id has this row")]
    out = similar.one_per_class(frame(spark, rows))
    assert out.columns == frame(spark, rows).columns
    want = [(2, "a b c d e f"), (7, "other words are here now"), (7, "same id but another text"), (8, ""), (8, ""), (9, None), (None, "no id has this row")]
    assert rows_of(out, "doc_id", "text") == sorted(want, key=str)


def test_runs_reach_the_recall():
    plan = similar.Plan()
    assert plan.lost(plan.runs()) <= 1 - plan.recall < plan.lost(plan.runs() - 1)
    assert plan.lost_by_sketch() < 1e-5
    assert similar.Plan(recall=0.9).runs() < plan.runs()


def exact_similar_pairs(texts):
    """Different shingle sets with their copies, and pairs of them at 0.8 or more, by an index of the rarest of each set."""
    words = [WORD.findall(t or "") for t in texts]
    copies = collections.Counter(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) for w in words if w)
    often = collections.Counter(s for one in copies for s in one)
    sets, index, pairs = list(copies), collections.defaultdict(list), []
    for n, one in enumerate(sets):
        rarest = sorted(one, key=lambda s: (often[s], s))[: len(one) - -(-4 * len(one) // 5) + 1]
        for m in {m for s in rarest for m in index[s]}:
            both = len(one & sets[m])
            if 5 * both >= 4 * (len(one) + len(sets[m]) - both):
                pairs.append((n, m))
        for s in rarest:
            index[s].append(n)
    return copies, [(sets[a], sets[b]) for a, b in pairs]


def test_no_link_is_lost_on_the_given_table(spark):
    """Links of whole documents against an exact join: all of them but one in 10,000, and none that is not one."""
    folder = os.environ.get("HEARTHLAKE_SF_DIR", "/root/testdata/sf0.01")
    if not os.path.isdir(folder):
        pytest.skip("test data not present")
    docs = common.table(spark, folder, "documents")
    copies, pairs = exact_similar_pairs([r["text"] for r in docs.select("text").collect()])
    found = similar.classes(docs).agg({"n_links": "sum"}).first()[0]
    # A link counts at both its rows.
    want = sum(2 * copies[a] * copies[b] for a, b in pairs) + sum(n * (n - 1) for n in copies.values())
    print(f"{len(copies)} sets, {len(pairs)} links between them, {want} link ends, {found} found")
    assert want and want >= found >= want * similar.Plan().recall


def test_empty_tables(spark):
    empty = frame(spark, [])
    for found in (suffix.remove_repeats(empty), blocks.remove_repeats(empty), similar.classes(empty), suffix.cut_repeats(empty), similar.one_per_class(empty)):
        assert found.count() == 0

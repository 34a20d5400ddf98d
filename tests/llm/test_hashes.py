"""Hashes of ranges against plain arithmetic, and texts that collide under any polynomial modulo a power of two."""

import random

import numpy as np
import pytest

from hearthlake.llm import blocks, common, rules, similar, suffix
from tests.llm.helpers import byte_repeats, frame, rows_of, word_repeats
from tests.llm.helpers import similar as plain_similar


@pytest.fixture(autouse=True)
def base():
    common.use_base(common.run_base())


def test_products_and_powers():
    r = random.Random(1)
    a, b = ([r.randrange(common.PRIME) for _ in range(500)] + [0, 1, common.PRIME - 1] for _ in range(2))
    assert common._times(np.array(a, np.uint64), np.array(b, np.uint64)).tolist() == [x * y % common.PRIME for x, y in zip(a, b, strict=True)]
    assert common._powers(12345, 100).tolist() == [pow(12345, k, common.PRIME) for k in range(100)]


def test_equal_ranges_have_equal_hashes():
    data = np.frombuffer(b"abcXXabcabc" * 50, np.uint8)
    hasher = common.Hasher(common.SYMBOLS[data])
    at = np.arange(len(data) - 7)
    found = hasher.ranges(at, at + 7)
    names = {bytes(data[i : i + 7]) for i in at}
    assert len(set(found.tolist())) == len(names)
    assert all(len({int(found[i]) for i in at if bytes(data[i : i + 7]) == n}) == 1 for n in names)


def thue_morse(n, a, b):
    """A sequence over two symbols, and the one with both exchanged."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return [b if x else a for x in bits], [a if x else b for x in bits]


@pytest.mark.parametrize("n", [128, 1024, 4096])
def test_words_lines_and_passages_do_not_collide(spark, n):
    one, two = thue_morse(n, "a", "b")
    texts = [" ".join(["".join(x)] * 40) for x in (one, two)]  # long words
    texts += [" ".join(x) for x in thue_morse(64, "left", "right")]  # windows of words
    rows = list(enumerate(texts))
    found = rows_of(blocks.remove_repeats(frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert found == word_repeats(rows, 35)
    lines = [(1, "".join(one) + "\n" + "".join(two)), (2, "".join(one) + " x " + "".join(two) + " y z")]
    judged = rules.measure(frame(spark, lines)).collect()
    assert [(r.n_dup_lines, r.n_repeat_words) for r in sorted(judged)] == [(0, 0), (0, 0)]


def test_bytes_and_shingles_do_not_collide(spark):
    rows = [(i, "".join(x)) for i, x in enumerate(thue_morse(256, "a", "b"))] + [(5, "".join(thue_morse(256, "a", "b")[0]))]
    found = rows_of(suffix.remove_repeats(frame(spark, rows)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == byte_repeats(rows, 200)
    words = ["".join(x) for x in thue_morse(1024, "a", "b")]
    rows = [(0, " ".join([words[0], *"cdefghij"])), (1, " ".join([words[1], *"cdefghij"])), (2, " ".join([words[0], *"cdefghij"]))]
    classes = {r.doc_id: r for r in similar.classes(frame(spark, rows)).collect()}
    want = plain_similar(rows)
    assert len({classes[i].class_id for i in range(3)}) == len({tuple(v[0]) for v in want.values()})

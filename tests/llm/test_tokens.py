import collections
import zlib

import numpy as np
import pytest

from hearthlake.llm import packing, tokens, wavelet
from tests.llm.helpers import awkward, frame

ODD = ["", " ", "a  b", " a", "a ", "a \n b", "x's\n\n y\tz  ", "\0 a", "<|endoftext|> q", "a\t b \t c", "é ñ 漢字 ١٢", " x   y", "a" * 300]


@pytest.fixture(scope="module")
def encoder():
    return tokens.encoder(tokens.default_path())


def test_pieces_give_the_ids_of_whole_texts(encoder):
    assert encoder.encode(ODD) == encoder.whole(ODD)


def test_forgetting_changes_nothing(encoder, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 0)
    assert encoder.encode(ODD) + encoder.encode(ODD) == encoder.whole(ODD) * 2


@pytest.mark.parametrize("n, high", [(0, 1), (1, 1), (700, 3), (5000, 50257), (300_000, 40)])
def test_wavelet_matrix(n, high):
    ids = np.random.default_rng(n).integers(0, high, n)
    shard = wavelet.Shard(wavelet.encode(ids, np.array([n]), [None]))
    assert (shard.ids() == ids).all() and shard.doc_ids == [None]
    for i in range(0, n, max(1, n // 7)):
        assert shard.access(i) == ids[i]
    for token in {0, 1, high - 1, high + 70000}:
        at = np.flatnonzero(ids == token)
        assert shard.count(token) == len(at)
        assert shard.count(token, n // 3, n // 2) == ((at >= n // 3) & (at < n // 2)).sum()
        if len(at):
            assert [shard.occurrence(token, k) for k in (0, len(at) - 1)] == [at[0], at[-1]]
        with pytest.raises(IndexError):
            shard.occurrence(token, len(at))
    with pytest.raises(IndexError):
        shard.access(n)


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        wavelet.Shard(b"x" * 100)


@pytest.mark.parametrize("shard_tokens", [50, 1 << 20])
def test_token_files(spark, encoder, shard_tokens):
    rows = awkward()
    found = wavelet.token_files(frame(spark, rows), shard_tokens=shard_tokens).collect()
    assert len(found) == len(rows)
    found.sort(key=lambda r: r.start)
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    end = np.array([2], "<u4").tobytes()
    want = sorted((i is not None, i or 0, zlib.crc32(encoder.whole([t or ""])[0] + end)) for i, t in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids_crc32) for r in found) == want


def test_no_documents_no_files(spark):
    assert wavelet.token_files(frame(spark, [])).count() == 0
    assert packing.pack(frame(spark, [])).count() == 0


def test_hilbert_keys_are_a_walk_through_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = packing.hilbert_keys(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("length", [16, 2048])
def test_pack(spark, encoder, length):
    rows = [r for r in awkward() if r[0] is not None and r[0] not in (100, 103)]
    found = packing.pack(frame(spark, rows), length=length).collect()
    end = np.array([1], "<u4").tobytes()
    for i, t in rows:
        ids, at = encoder.whole([t or ""])[0] + end, 0
        for p in sorted((p for p in found if p.doc_id == i), key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids) // 4)
            assert p.ids_crc32 == zlib.crc32(ids[at * 4 : (at + p.length) * 4])
            at += p.length
        assert at * 4 == len(ids)
    filled = {}
    for p in sorted(found, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled.get(p.sequence_id, 0)
        filled[p.sequence_id] = p.offset + p.length
    assert all(n == length or n & (n - 1) == 0 for n in filled.values())


def test_repeated_rows_are_packed_each(spark):
    """Pieces of equal rows cannot be told apart; together they hold each id of the row once per copy."""
    rows = [(1, "a b"), (1, "a b"), (None, None), (None, None), (None, "c"), (2, None), (2, "")]
    found = packing.pack(frame(spark, rows)).collect()
    held = collections.Counter((p.doc_id, p.doc_tokens, k) for p in found for k in range(p.start, p.start + p.length))
    assert held == collections.Counter({(1, 3, 0): 2, (1, 3, 1): 2, (1, 3, 2): 2, (None, 1, 0): 2, (None, 2, 0): 1, (None, 2, 1): 1, (2, 1, 0): 2})

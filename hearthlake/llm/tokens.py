"""Token ids of whole texts by a public tokenizer file."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa

# Pieces that a Python worker remembers; beyond it the memory is emptied and filled again, which changes no id.
REMEMBERED = 600_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts, as little-endian unsigned 32-bit bytes, by the tokenizers library.

    A byte-level vocabulary always starts a new piece at a space before another character, so a text is cut there
    and each different piece is encoded once. New pieces go to the library joined into longer strings; a space opens
    each of them, and so do the ids, which cuts the ids again. Texts with two spaces in a row, a zero character or an
    added token of the vocabulary are given to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.odd = ["  ", "\0", *(t.content for t in self.tokenizer.get_added_tokens_decoder().values())]
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.known: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in encoded]

    def learn(self, pieces: list[str]) -> None:
        """Encode new pieces; those that start a text have a zero character in front, the others lost their space."""
        joined = [p for p in pieces if p and p[0] != "\0" and not p[0].isspace()]
        lots = [joined[i : i + 1000] for i in range(0, len(joined), 1000)]
        encoded = self.tokenizer.encode_batch_fast([" " + " ".join(lot) for lot in lots], add_special_tokens=False)
        for lot, e in zip(lots, encoded, strict=True):
            ids = np.asarray(e.ids, "<u4")
            cuts = (np.flatnonzero(self.opens[ids]) * 4).tolist()
            if len(cuts) != len(lot):
                self.known.update(zip(lot, self.whole([" " + p for p in lot]), strict=True))
                continue
            data = ids.tobytes()
            self.known.update(zip(lot, (data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)], strict=True)), strict=True))
        rest = [p for p in pieces if not p or p[0] == "\0" or p[0].isspace()]
        self.known.update(zip(rest, self.whole([p[1:] if p[:1] == "\0" else " " + p for p in rest]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [None if any(s in t for s in self.odd) else ("\0" + t).split(" ") for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        self.learn(list(set().union(*(p for p in cut if p)) - self.known.keys()))
        get = self.known.__getitem__
        odd = [i for i, p in enumerate(cut) if p is None]
        rest = dict(zip(odd, self.whole([texts[i] for i in odd]), strict=True))
        return [rest[i] if p is None else b"".join(map(get, p)) for i, p in enumerate(cut)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per Python worker, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def crc32(ids: bytes) -> int:
    return zlib.crc32(ids) & 0xFFFFFFFF


def text_list(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]

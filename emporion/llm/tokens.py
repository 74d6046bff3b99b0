"""Token ids of whole texts with the ``tokenizers`` library, on Arrow columns.

A text is cut at white space where both vocabularies always begin a new piece,
equal pieces of a block are encoded once, and their ids are put back in order.
The result equals encoding the whole text (tested); only repeated work goes.
Pieces are told apart by 64-bit keys (``blocks.Block.span_hash``): among two
million remembered ones the chance of one mistake is about 1e-7.

A text in which the vocabulary's special strings stand (``<|endoftext|>``) is
encoded in one piece, so it has the ids that the library gives it.  Ids are held
as unsigned 16-bit integers; a vocabulary of more than 65,536 ids is refused.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from .blocks import Block, blocks

#: pieces remembered between blocks of a worker; then the memory starts anew
MEMORY = 2_000_000
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x0A]] = True
_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[0x21:0x7F] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_SIGN = _PLAIN & ~_LETTER
_SIGN[[*range(0x30, 0x3A), 0x27]] = False  # digits; and the apostrophe, which may begin a contraction
_LETTER_LEAD = np.zeros(256, dtype=bool)
_LETTER_LEAD[0xC3:0xE0] = True  # two-byte characters that are never white space


@lru_cache(maxsize=4)
def encoder(path: str) -> "Encoder":
    return Encoder(path)


class Encoder:
    """One vocabulary file in a worker process."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError(f"{path}: ids of more than 16 bits")
        #: matched by the library before it cuts a text
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)  # sorted 64-bit keys of pieces, and where their ids are
        self.slot = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(1 << 16, dtype=np.uint16)
        self.at, self.used = np.zeros(1 << 14, dtype=np.int64), 0

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        lists = [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        end = self.at[self.used] + np.cumsum(np.fromiter(map(len, lists), dtype=np.int64, count=len(lists)))
        if end[-1] > len(self.ids):
            self.ids = np.resize(self.ids, max(int(end[-1]), 2 * len(self.ids)))
        self.ids[self.at[self.used]:end[-1]] = np.fromiter(chain.from_iterable(lists), dtype=np.uint16)
        if self.used + len(end) >= len(self.at):
            self.at = np.resize(self.at, 2 * (self.used + len(end) + 1))
        self.at[self.used + 1:self.used + 1 + len(end)] = end
        to = np.searchsorted(self.known, keys)
        self.known = np.insert(self.known, to, keys)
        self.slot = np.insert(self.slot, to, np.arange(self.used, self.used + len(end)))
        self.used += len(end)

    def block(self, b: Block) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, offsets of each document in them)."""
        if self.used > MEMORY:
            self._forget()
        raw = b.raw
        n = len(raw)
        cut = np.zeros(n + 1, dtype=bool)
        if n > 2:
            space = np.flatnonzero(_SPACE[raw[1:-1]]) + 1
            before, after = raw[space - 1], raw[space + 1]
            wide = (before >= 0x80) & _LETTER_LEAD[raw[np.maximum(space - 2, 0)]]
            cut[space[(_PLAIN[before] | wide) & (_PLAIN[after] | _LETTER_LEAD[after])]] = True
            sign, letter = _SIGN[raw], _LETTER[raw]
            cut[1:n] |= (letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:])
        data = raw.tobytes()
        for mark in self.special:
            at = data.find(mark)
            while at >= 0:
                d = int(np.searchsorted(b.offsets, at, side="right")) - 1
                cut[b.offsets[d]:b.offsets[d + 1]] = False
                at = data.find(mark, int(b.offsets[d + 1]))
        cut[b.offsets] = True
        start = np.flatnonzero(cut[:n])
        end = np.append(start[1:], n)
        first = np.searchsorted(start, b.offsets)
        keys = b.span_hash(start, end)
        key, one, which = np.unique(keys, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, key)
        new = np.flatnonzero(self.known[np.minimum(place, len(self.known) - 1)] != key) if len(self.known) else np.arange(len(key))
        if len(new):
            a, z = start[one[new]].tolist(), end[one[new]].tolist()
            self._learn(key[new], [data[x:y].decode() for x, y in zip(a, z)])
            place = np.searchsorted(self.known, key)
        slot = self.slot[place][which] if len(key) else np.zeros(0, dtype=np.int64)
        at = self.at
        length = at[slot + 1] - at[slot]
        to = np.zeros(len(slot) + 1, dtype=np.int64)
        np.cumsum(length, out=to[1:])
        source = np.repeat(at[slot] - to[:-1], length) + np.arange(to[-1])
        return self.ids[source], to[first]


def encode(column: pa.Array, path: str, end_id: int = 0) -> list[np.ndarray]:
    """uint16 ids of each text (null: empty) with ``end_id`` appended."""
    enc, out = encoder(path), []
    for b in blocks(column):
        ids, at = enc.block(b)
        at = at.tolist()
        out.extend(np.append(ids[i:j], np.uint16(end_id)) for i, j in zip(at, at[1:]))
    return out

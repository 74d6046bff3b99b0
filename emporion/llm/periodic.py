"""Periodic runs of words, found through longest common extensions.

A run is a stretch of consecutive words with smallest period q and a length of
at least ``max(least, times * q)`` that no neighbouring word extends with period q.

Runs are enumerated on a harmonic grid: a run of period q with three periods has
two neighbouring multiples of q in its comparable part, so only the places k * q
are looked at, n / q of them for each q.  Where two of them agree with the word q
further, the stretch is measured by two longest-common-extension queries, one on
the words and one on their reversal.

A query compares words until both places are in a difference cover (residues
modulo ``MODULUS`` whose differences are all residues; fewer than ``MODULUS``
words), and only pairs that still agree go on: the suffixes at covered places are
sorted by blocks of ``MODULUS`` words and doubling, and the minimum of their
neighbours' common prefixes (a sparse table) gives how many whole blocks agree;
the next block is compared word by word.

Texts are worked on in Arrow's buffers, a block of whole documents at a time
(``blocks.py``); a text is never split between tasks and nothing is shuffled.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; a null or empty text has no
words, no runs and an empty collapsed text; documents are looked at one by one, so
repeated rows, ids and other columns play no part; columns ``n_words``, ``runs`` and
``collapsed`` replace columns of these names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Block, blocks

#: a perfect difference set: every residue but 0 is one difference of two members
MODULUS = 31
COVER = np.array([1, 5, 11, 24, 25, 27])
#: for a distance modulo MODULUS, the member x of the cover with x + distance in it too
_MEMBER = np.array([next(x for x in COVER.tolist() if (x + d) % MODULUS in COVER) for d in range(MODULUS)])
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Extension:
    """Longest common extensions of a sequence of word numbers (1 and up)."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.words = np.concatenate([words, np.zeros(2 * MODULUS, dtype=words.dtype)])  # 0: past the end

    def _sort(self) -> None:
        """Order, neighbours' common blocks and sparse table of covered suffixes."""
        place = np.arange(-(-(self.n + 1) // MODULUS), dtype=np.int64)[:, None] * MODULUS + COVER[None, :]
        place = np.sort(place[place < self.n])
        self.index = np.full(self.n + 2 * MODULUS, -1, dtype=np.int64)
        m = len(place)
        self.index[place] = np.arange(m)
        # a block of words as one byte string; 0 past the end stands before all words
        width = np.lib.stride_tricks.sliding_window_view(self.words, MODULUS)[place].astype(">u4")
        _, rank = np.unique(np.ascontiguousarray(width).view(f"S{4 * MODULUS}").ravel(), return_inverse=True)
        levels, step = [rank.astype(np.int64)], 1
        while m and levels[-1].max() + 1 < m and step * MODULUS < self.n:
            after = place + step * MODULUS
            later = np.where(after < self.n, self.index[np.minimum(after, self.n)], -1)
            pair = levels[-1] * (m + 1) + np.where(later >= 0, levels[-1][later] + 1, 0)
            _, rank = np.unique(pair, return_inverse=True)
            levels.append(rank.astype(np.int64))
            step *= 2
        order = np.argsort(levels[-1], kind="stable")
        self.at = np.empty(m, dtype=np.int64)
        self.at[order] = np.arange(m)
        # common blocks of neighbours, from the coarsest doubling level down
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(max(m - 1, 0), dtype=np.int64)
        for k in range(len(levels) - 1, -1, -1):
            both = (a >= 0) & (b >= 0)
            same = both & (levels[k][a] == levels[k][b])
            for x in (a, b):
                after = place[x] + (MODULUS << k)
                x[same] = np.where(after < self.n, self.index[np.minimum(after, self.n)], -1)[same]
            common[same] += 1 << k
        self.table = [common]
        while 2 << (len(self.table) - 1) <= len(common):
            half, last = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from places i and j on (i < j)."""
        words, out = self.words, np.zeros(len(i), dtype=np.int64)
        ahead = (_MEMBER[(j - i) % MODULUS] - i) % MODULUS
        live = np.arange(len(i))
        for k in range(MODULUS):  # compare until the places are in the cover
            live = live[k < ahead[live]]
            if not len(live):
                break
            a, b = words[i[live] + k], words[j[live] + k]
            live = live[(a == b) & (a > 0)]
            out[live] += 1
        rest = np.flatnonzero((out == ahead) & (j + ahead < self.n))
        if not len(rest):
            return out
        if not hasattr(self, "table"):
            self._sort()
        a, b = self.at[self.index[i[rest] + ahead[rest]]], self.at[self.index[j[rest] + ahead[rest]]]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        blocks_ = np.empty(len(rest), dtype=np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            blocks_[at] = np.minimum(self.table[k][low[at]], self.table[k][high[at] - (1 << k)])
        out[rest] += blocks_ * MODULUS
        live = rest
        for _ in range(MODULUS):  # within the first block that differs
            a, b = np.minimum(i[live] + out[live], self.n), np.minimum(j[live] + out[live], self.n)
            live = live[(words[a] == words[b]) & (words[b] > 0)]
            if not len(live):
                break
            out[live] += 1
        return out


def find_runs(words: np.ndarray, sizes: np.ndarray, least: int = 24, times: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of some texts laid end to end, by start
    and period; ``sizes`` are the texts' numbers of words, equal words have equal
    keys.  ``times`` is 3 or more."""
    none = np.zeros(0, dtype=np.int64)
    by_size = np.argsort(-sizes, kind="stable")
    by_size = by_size[sizes[by_size] >= max(least, times)]
    if not len(by_size):
        return none, none, none
    first = np.concatenate([[0], np.cumsum(sizes)])
    # long texts first, with a word of its own after each: no stretch crosses it
    size = sizes[by_size]
    to = np.concatenate([[0], np.cumsum(size + 1)])
    _, number = np.unique(words, return_inverse=True)
    row = np.zeros(int(to[-1]), dtype=np.uint32)
    inside = np.ones(len(row), dtype=bool)
    inside[to[1:] - 1] = False
    source = np.repeat(first[by_size] - to[:-1], size + 1) + np.arange(len(row))
    row[inside] = number[source[inside]] + 1
    row[~inside] = len(words) + 1 + np.arange(len(size))
    places, periods = [], []
    for q in range(1, int(size[0]) // times + 1):
        end = int(to[np.searchsorted(-size, -max(least, times * q), side="right")])
        grid = row[:end:q]
        same = grid[:-1] == grid[1:]
        hit = np.flatnonzero(same[:-1] & same[1:])
        if len(hit):
            places.append(hit * q)
            periods.append(np.full(len(hit), q, dtype=np.int64))
    if not places:
        return none, none, none
    place, period = np.concatenate(places), np.concatenate(periods)
    ahead = Extension(row).common(place, place + period)
    long = ahead + 2 * period > np.maximum(least, times * period)  # the grid place is the first or a later one
    place, period, ahead = place[long], period[long], ahead[long]
    n = len(row)
    back = Extension(row[::-1].copy()).common(n - place - period, n - place)
    start, end = place - back, place + period + ahead
    good = end - start >= np.maximum(least, times * period)
    runs = np.unique(np.stack([start[good], end[good], period[good]], axis=1), axis=0)
    # a stretch of period q has every multiple of q as a period too; the smallest is its own
    own = np.ones(len(runs), dtype=bool)
    own[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    start, end, period = runs[own].T
    text = np.searchsorted(to, start, side="right") - 1
    shift = first[by_size][text] - to[text]
    start, end = start + shift, end + shift
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _joined(b: Block, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of every document's kept words, joined by one space."""
    kept = np.flatnonzero(keep)
    first = np.concatenate([[0], np.cumsum(keep)])[b.first]
    length = b.end[kept] - b.start[kept] + 1  # with a space after each
    to = np.concatenate([[0], np.cumsum(length)])
    out = b.raw[np.minimum(np.repeat(b.start[kept] - to[:-1], length) + np.arange(to[-1]), max(len(b.raw) - 1, 0))]
    out[to[1:] - 1] = 0x20
    whole = np.ones(len(out), dtype=bool)
    some = np.diff(first) > 0
    whole[to[first[1:][some]] - 1] = False  # not after the last
    sizes = np.diff(to[first]) - some
    return out[whole], np.concatenate([[0], np.cumsum(sizes)])


def _periodic(batches: Iterator[pa.RecordBatch], least: int, times: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        other = batch.drop_columns(["__text"])
        for b in blocks(batch.column("__text")):
            sizes = np.diff(b.first)
            start, end, period = find_runs(b.hash, sizes, least, times)
            open_ = np.zeros(len(b.start) + 1, dtype=np.int64)
            np.add.at(open_, np.minimum(start + period, end), 1)
            np.add.at(open_, end, -1)
            data, at = _joined(b, np.cumsum(open_)[:-1] == 0)
            doc = np.searchsorted(b.first, start, side="right") - 1
            runs = pa.StructArray.from_arrays([pa.array(x) for x in (start - b.first[doc], end - start, period)], ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(b.n_docs + 1)), pa.int32()), runs)
            text = pa.LargeStringArray.from_buffers(b.n_docs, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
            cols = [*other.slice(b.row, b.n_docs).columns, pa.array(sizes.astype(np.int64)), lists, text.cast(schema.field("collapsed").type)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, schema)], schema=schema)


def with_runs(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), least: int = 24, times: int = 3) -> DataFrame:
    """The columns ``keep`` and, of each row's text, ``n_words``, ``runs`` (start
    and length in words, smallest period; by start, then period) and ``collapsed``:
    the words that no run holds after its first period, joined by one space."""
    if least < 1 or times < 3:
        raise ValueError("least is 1 or more, times 3 or more")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StringType, StructField, StructType, _parse_datatype_string

    names = [c for c in keep if c not in ("n_words", "runs", "collapsed")]
    rows = docs.select(*names, F.col(text).alias("__text"))
    schema = StructType([*(rows.schema[c] for c in names), StructField("n_words", LongType()),
                         StructField("runs", _parse_datatype_string(RUNS)), StructField("collapsed", StringType())])
    arrow = to_arrow_schema(schema)
    return rows.mapInArrow(lambda batches: _periodic(batches, least, times, arrow), schema)

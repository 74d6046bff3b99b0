"""Benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment.

1. The words of every benchmark item (letters and digits, A-Z folded) give its
   n-grams; all of them are seeds, however frequent, so that a leak is found no
   matter how many documents hold it.
2. One pass finds the seeds in every whole text; hits of one item that lie
   within an item's length of each other make a passage.  A passage that shares
   too few words with the item for any alignment to count is dismissed; this
   bound is exact.
3. Local alignment of item and passage (match 2, other word -1, gap -1) gives
   the score: the alignment's value over that of a perfect copy.  Edited copies
   keep a high score, texts that share a seed by chance do not.
   A passage of a long item counts by its own length as well: an alignment
   worth ``EXCERPT_WORDS`` words of which ``EXCERPT_SAME`` are alike is a leak,
   whatever its share of the item.

Items are taken in blocks of bounded size (``block_words``); a block's n-grams
and words are broadcast, documents are never shuffled.

Defined results: a null or empty text, or an item without words, matches
nothing; an item shorter than n words is its own only seed; repeated documents
and items each give their rows; empty tables give none; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import Block, U64, blocks

#: words are runs of ASCII letters, digits and any non-ASCII characters
BREAKS = np.ones(256, dtype=bool)
BREAKS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_BITS = 22
#: a stretch so long, with so many of its words alike, is a leak of its own
EXCERPT_WORDS, EXCERPT_SAME = 20, 0.8
EXCERPT = round(EXCERPT_WORDS * (2 * EXCERPT_SAME - (1 - EXCERPT_SAME)))


@dataclass
class Grams:
    """n-grams of a block of items, sorted by (size, key)."""

    items: list[int]  # item_id
    words: list[np.ndarray]  # word keys of each item
    table: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # size: keys, owner, place (by key; repeats allowed)

    def __post_init__(self) -> None:
        self.seen = {}
        for size, (keys, _, _) in self.table.items():
            bits = np.zeros(1 << _BITS, dtype=bool)
            bits[(keys >> U64(64 - _BITS)).astype(np.int64)] = True
            self.seen[size] = np.packbits(bits)

    def hits(self, b: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(places in the block's shingles, first index in the table) of known n-grams."""
        g, first = b.shingles(size)
        keys = self.table[size][0]
        top = (g >> U64(64 - _BITS)).astype(np.int64)
        at = np.flatnonzero(np.unpackbits(self.seen[size]).view(bool)[top])
        i = np.searchsorted(keys, g[at])
        same = keys[np.minimum(i, len(keys) - 1)] == g[at]
        return at[same], i[same], first


def grams_of(items: list[tuple[int, str | None]], n: int) -> Grams:
    ids, words, rows = [], [], {}
    for b in blocks(pa.array([t or "" for _, t in items], pa.large_string()), fold=True, breaks=BREAKS):
        for k in range(b.n_docs):
            a, z = b.first[k], b.first[k + 1]
            if z == a:
                continue
            size = min(n, z - a)
            one = Block(b.raw, b.offsets[k:k + 2], 0, True, BREAKS)
            g, _ = one.shingles(size)
            owner = len(ids)
            ids.append(items[b.row + k][0])
            words.append(b.hash[a:z])
            rows.setdefault(int(size), []).append((g, np.full(len(g), owner), np.arange(len(g))))
    table = {}
    for size, parts in rows.items():
        keys, owner, place = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((place, owner, keys))
        table[size] = (keys[order], owner[order].astype(np.int64), place[order])
    return Grams(ids, words, table)


def most(item: np.ndarray, passage: np.ndarray, match: int = 2, other: int = -1) -> int:
    """No alignment has a greater value: on either side every word of its span
    counts ``match`` at most, and ``other`` where the other side lacks it."""
    def side(a: np.ndarray, b: np.ndarray) -> int:
        known = np.unique(b)
        there = known[np.minimum(np.searchsorted(known, a), len(known) - 1)] == a
        total = np.r_[0, np.cumsum(np.where(there, match, other))]
        return int((total - np.minimum.accumulate(total)).max())

    return min(side(passage, item), side(item, passage))


def align(item: np.ndarray, passage: np.ndarray, match: int = 2, other: int = -1, gap: int = 1) -> tuple[int, int, int]:
    """Smith-Waterman: (value, start, end) of the best local alignment in ``passage``.

    A row of the table is one vector step: what comes from the left is a running
    maximum of the row with the gap cost taken out.  Starts are carried along."""
    n = len(passage)
    slope = gap * np.arange(n + 1)
    row, start = np.zeros(n + 1, dtype=np.int64), np.arange(n + 1)
    best, span = 0, (0, 0)
    for word in item:
        diag = row[:-1] + np.where(passage == word, match, other)
        up = row[1:] - gap
        here, from_ = np.zeros(n + 1, dtype=np.int64), np.arange(n + 1)
        pick = diag >= up
        here[1:] = np.where(pick, diag, up)
        from_[1:] = np.where(pick, start[:-1], start[1:])
        none = here <= 0
        here[none] = 0
        from_[none] = np.flatnonzero(none)
        lifted = here + slope
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(n + 1), 0))
        row = top - slope
        start = from_[source]
        k = int(row.argmax())
        if row[k] > best:
            best, span = int(row[k]), (int(start[k]), k)
    return best, *span


def leaks_in(b: Block, seeds: Grams, least: float) -> Iterator[tuple[int, int, float, int, int, int]]:
    """(document, item index, score, first word, end word, seeds) in a block."""
    found: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for size, (keys, owner, place) in seeds.table.items():
        at, i, first = seeds.hits(b, size)
        if not len(at):
            continue
        doc = np.searchsorted(first, at, side="right") - 1
        last = np.searchsorted(keys, keys[i], side="right")
        for a, d, lo, hi in zip((at - first[doc]).tolist(), doc.tolist(), i.tolist(), last.tolist()):
            for k in range(lo, hi):
                found.setdefault((d, int(owner[k])), []).append((a, int(place[k])))
    for (d, k), hits in found.items():
        item, base, n = seeds.words[k], int(b.first[d]), int(b.first[d + 1] - b.first[d])
        m, best, groups = len(item), None, []
        enough = min(least * 2 * m, EXCERPT)
        for a, p in sorted(hits):
            if groups and a - groups[-1][-1][0] <= m:
                groups[-1].append((a, p))
            else:
                groups.append([(a, p)])
        for group in groups:
            slack = m // 2 + 4
            lo = max(0, min(a - p for a, p in group) - slack)
            hi = min(n, max(a - p for a, p in group) + m + slack)
            if most(item, b.hash[base + lo:base + hi]) < enough:
                continue
            value, s, e = align(item, b.hash[base + lo:base + hi])
            if best is None or value > best[0]:
                best = (value, lo + s, lo + e, len(group))
        if best and best[0] >= enough:
            yield d, k, best[0] / (2 * m), best[1], best[2], best[3]


def item_blocks(benchmark: DataFrame, block_words: int) -> list[list[tuple[int, str | None]]]:
    """Blocks of items whose texts fit a broadcast; fetched one at a time."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // (6 * block_words)))
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else rows
        yield sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def seed_blocks(benchmark: DataFrame, n: int = 3, block_words: int = 1_000_000):
    """Broadcast seeds of each block of items."""
    for items in item_blocks(benchmark, block_words):
        yield benchmark.sparkSession.sparkContext.broadcast(grams_of(items, n))


_SCHEMA = "doc_id long, item_id long, score double, start long, end long, n_seeds long"


def find(docs: DataFrame, benchmark: DataFrame, least: float = 0.4, **how) -> DataFrame:
    """Pairs (doc_id, item_id) with the alignment score (at least ``least``, or
    less where a passage counts by its length) and the passage's place in the text (code points, end exclusive)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = docs.sparkSession.createDataFrame([], _SCHEMA)
    for seeds in seed_blocks(benchmark, **how):
        def run(batches: Iterator[pa.RecordBatch], seeds=seeds) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for b in blocks(batch.column("text"), fold=True, breaks=BREAKS):
                    for d, k, score, s, e, n in leaks_in(b, seeds.value, least):
                        raw, base = b.raw[b.offsets[d]:b.offsets[d + 1]], b.first[d]
                        a, z = (int(x - b.offsets[d]) for x in (b.start[base + s], b.end[base + e - 1]))
                        points = np.cumsum((raw[:z] & 0xC0) != 0x80)
                        found.append((batch.column("doc_id")[b.row + d].as_py(), seeds.value.items[k], score,
                                      int(points[a]) - 1, int(points[z - 1]), n))
                if found:
                    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*found), kinds)],
                                                     names=[x.split()[0] for x in _SCHEMA.split(", ")])

        out = out.unionByName(rows.mapInArrow(run, _SCHEMA))
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, text: Column, least: float = 0.4, **how) -> Column:
    """A column that tells which texts hold a benchmark passage."""
    def test(seeds) -> Column:
        @F.arrow_udf("boolean")
        def has(column: pa.Array) -> pa.Array:
            out = np.zeros(len(column), dtype=bool)
            for b in blocks(column, fold=True, breaks=BREAKS):
                out[[b.row + d for d, *_ in leaks_in(b, seeds.value, least)]] = True
            return pa.array(out)

        return has(text.cast("string"))

    answer = F.lit(False)
    for seeds in seed_blocks(benchmark, **how):
        answer = answer | test(seeds)
    return answer

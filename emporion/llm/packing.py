"""Best-fit packing after dominance reduction.

Documents become pieces of at most ``capacity`` tokens (only longer documents
are cut).  Packing depends on lengths alone, and there are at most ``capacity``
different ones, so the instance is a histogram of that many counts: it is the
only thing the driver sees, whatever the corpus.  On it

1. dominance (Martello and Toth): a set of one to three lengths that provably
   does at least as well as every other set with its longest member is fixed
   for good, as often as it can be formed;
2. best-fit decreasing packs the rest, whole ranges of equal bins at a time.

The answer is a table of placements (length, rank range, bins, offset); each
piece finds its own by its rank among pieces of its length.  Ranks come from a
range shuffle on (length, doc_id, piece), which splits a frequent length over
many tasks.

Defined results: a null text is empty (one piece: the end id); rows with equal
``doc_id`` each get their pieces; an empty table gives none; other columns of
the documents are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .tokens import encode

_RANK_BITS = 44


def fix_dominating(count: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Remove dominating sets from ``count`` (by length) and return them with
    their numbers.  R is the room beside a piece of length s:

    * nothing fits beside it: {s};
    * the longest t that fits has s + t = capacity: {s, t};
    * no two others fit beside it: {s, t};
    * no three others fit and t is at least the longest fitting pair p + q: {s, t};
    * no three others fit, t = p, and every pair with a shorter member above q
      could take t's place whole: {s, t, q}.
    """
    fixed = []

    def fix(members: tuple[int, ...]) -> bool:
        need = Counter(members)
        times = min(int(count[x]) // n for x, n in need.items())
        for x, n in need.items():
            count[x] -= n * times
        if times:
            fixed.append((members, times))
        return times > 0

    for s in range(capacity, 0, -1):
        while count[s] > 0:
            room = capacity - s
            count[s] -= 1  # what is left beside one s
            there = np.flatnonzero(count[:room + 1]).tolist()
            small = [x for y in there[:3] for x in [y] * min(3, int(count[y]))][:3]
            twice = {x for x in there if count[x] > 1}
            count[s] += 1
            if not there:
                fix((s,))
                continue
            t = there[-1]
            if s + t == capacity or len(small) < 2 or small[0] + small[1] > room:
                if not fix((s, t)):
                    break
                continue
            if len(small) == 3 and sum(small) <= room:
                break
            p, q, lo, hi = 0, 0, 0, len(there) - 1
            while lo <= hi:
                if there[lo] + there[hi] > room or (lo == hi and there[lo] not in twice):
                    hi -= 1
                else:
                    if there[lo] + there[hi] > p + q:
                        p, q = there[hi], there[lo]
                    lo += 1
            if t >= p + q:
                if not fix((s, t)):
                    break
            elif t == p and not _other_pair(there, twice, room, t, q):
                if not fix((s, t, q)):
                    break
            else:
                break
    return fixed


def _other_pair(there: list[int], twice: set[int], room: int, t: int, q: int) -> bool:
    """Is there a fitting pair x >= y > q with x + y > t?"""
    hi = len(there) - 1
    for y in there:
        if y <= q:
            continue
        while hi >= 0 and there[hi] + y > room:
            hi -= 1
        if hi < 0 or there[hi] < y:
            return False
        x = there[hi] if there[hi] > y or y in twice else None
        if x is not None and x + y > t:
            return True
    return False


def plan(count: np.ndarray, capacity: int) -> dict[str, np.ndarray]:
    """Placements for ``count[length]`` pieces: pieces of ``length`` with rank
    ``rank .. rank + bins * each - 1`` go, ``each`` to a bin, into the bins from
    ``bin`` on, at ``offset``."""
    left, taken = count.copy(), np.zeros(capacity + 1, dtype=np.int64)
    rows, bins = [], 0

    def place(length: int, n_bins: int, each: int, first: int, offset: int) -> None:
        rows.append((length, int(taken[length]), n_bins, each, first, offset))
        taken[length] += n_bins * each

    for members, times in fix_dominating(left, capacity):
        offset = 0
        for length, n in sorted(Counter(members).items(), reverse=True):
            place(length, times, n, bins, offset)
            offset += length * n
        bins += times
    rooms: dict[int, list[tuple[int, int]]] = {}
    for s in range(capacity, 0, -1):
        todo = int(left[s])
        for room in sorted(r for r in rooms if r >= s):
            if not todo:
                break
            each = room // s
            ranges, kept = rooms.pop(room), []
            for first, n in ranges:
                full = min(n, todo // each)
                if full:
                    place(s, full, each, first, capacity - room)
                    rooms.setdefault(room - each * s, []).append((first, full))
                    todo -= full * each
                if full < n and todo:  # fewer than `each` are left: one more bin takes them
                    place(s, 1, todo, first + full, capacity - room)
                    rooms.setdefault(room - todo * s, []).append((first + full, 1))
                    todo, full = 0, full + 1
                if full < n:
                    kept.append((first + full, n - full))
            if kept:
                rooms.setdefault(room, []).extend(kept)
        if todo:
            each = capacity // s
            for n_bins, k in ((todo // each, each), (1, todo % each)):
                if n_bins and k:
                    place(s, n_bins, k, bins, 0)
                    rooms.setdefault(capacity - k * s, []).append((bins, n_bins))
                    bins += n_bins
    rooms.pop(0, None)
    rows.sort()
    out = np.array(rows, dtype=np.int64).reshape(-1, 6).T
    return dict(zip(("length", "rank", "bins", "each", "bin", "offset"), out))


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids): the token ids (little-endian
    unsigned 32-bit) of every document and the end id, cut at ``capacity``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                doc, piece, start, length, raw = [], [], [], [], []
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode(part.column("text"), tokenizer, end_id)):
                    for k, i in enumerate(range(0, len(ids), capacity)):
                        some = ids[i:i + capacity]
                        doc.append(doc_id)
                        piece.append(k)
                        start.append(i)
                        length.append(len(some))
                        raw.append(some.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(raw, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary")


def place(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (doc_id, piece, start, length
    and any columns to carry)."""
    spark = cut.sparkSession

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            length = batch.column("length").to_numpy()
            change = np.flatnonzero(np.diff(length)) + 1
            begin = np.concatenate([[0], change])
            place_ = np.arange(len(length)) - np.repeat(begin, np.diff(np.append(begin, len(length))))
            if len(length):
                same = length[0] == last
                place_[:change[0] if len(change) else len(length)] += seen if same else 0
                last, seen = length[-1], int(place_[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), part, np.int32)), pa.array(place_, pa.int64())],
                                             names=[*batch.schema.names, "_part", "_at"])

    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in cut.schema)}, _part int, _at long"
    order = ["length", "doc_id", "piece", "start"]
    rows = written(cut.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(ranked, schema), "ranked")
    # a sorted part holds few lengths: these rows number at most parts + capacity
    runs = rows.groupBy("length", "_part").agg((F.max("_at") + 1).alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for r in rows.groupBy("length").count().collect():  # at most `capacity` rows
        histogram[r["length"]] = r["count"]
    table = spark.sparkContext.broadcast(plan(histogram, capacity))

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        key = (t["length"] << _RANK_BITS) + t["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_at").to_numpy() + batch.column("_base").to_numpy()
            i = np.searchsorted(key, (length << _RANK_BITS) + rank, side="right") - 1
            k = rank - t["rank"][i]
            keep = [c for c in range(batch.num_columns) if batch.schema.names[c] not in ("_part", "_at", "_base")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(t["bin"][i] + k // t["each"][i]), pa.array(t["offset"][i] + k % t["each"][i] * length)],
                names=[*(batch.schema.names[c] for c in keep), "sequence_id", "offset"])

    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in cut.schema)}, sequence_id long, offset long"
    joined = rows.join(runs, ["length", "_part"]).select(*rows.columns, "_base")
    return joined.mapInArrow(assigned, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """Packed sequences (sequence_id, length, ids, documents) from placed pieces
    that carry ``ids``; a sequence has at most ``capacity`` pieces."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "length", "ids")))
    return (placed.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + x["length"]).alias("length"),
                    F.transform("parts", lambda x: x["ids"]).alias("ids"),
                    F.transform("parts", lambda x: F.struct(x["offset"], x["doc_id"], x["piece"], x["start"], x["length"])).alias("documents")))

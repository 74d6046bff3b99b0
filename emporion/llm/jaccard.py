"""N-gram Jaccard join with signature trees.

A document's set is its distinct k-word shingles (64-bit keys; expected
collisions inside one set are below 1e-9 up to 100,000 words).  Two documents
link when 100 * |A n B| >= percent * |A u B|.  Every step keeps every link:

1. Equal sets are one *node*; copies are never compared.
2. In one order of all shingles, common ones last, linked sets share one of
   their first ``n - ceil(percent * n / 100) + 1`` shingles.  Any order is right;
   which shingles are common is read from counts in a table of fixed size over
   all documents, so a passage or line in many documents makes no bucket.
3. Nodes that share such a shingle are a bucket.  In a small bucket pairs are
   counted: sets that link share many first shingles, by sizes alone at least a
   known number, and pairs below it are dropped (those that also meet in a large
   bucket are judged there).
4. In large buckets each node is tried with its neighbours in size.  Of the likely
   pairs those go whose bitmaps rule a link out; then each node's least partner is
   checked first, and after it the pairs that still lie in two provisional
   components: a class of near copies costs a few checks per node.
5. A large bucket is a signature tree: leaves are nodes with a token bitmap (the
   parity of shingles in each class; wider for larger sets, and folded where two
   widths meet), upper levels hold the OR and the AND of their bitmaps, the range
   of sizes and the component if it is one.  A dual traversal of the tree drops
   node pairs of one component and pairs whose greatest possible overlap, by
   sizes and by bits that must differ, is too small.  A bucket beyond
   ``TREE_ROWS`` is several trees, traversed pair by pair where their sizes allow
   a link.  Buckets of the same nodes (near copies make many) are one tree.  First traversals give each node's most similar open partners only,
   whose links join components; the last one gives every pair that is still open,
   so large groups of near copies cost a few checks per node and lose no link.
6. Of the pairs that stay, those are dropped whose first shingles rule a link
   out; the rest is checked on whole sets, and connected components of the links
   are taken.

A set is never cut; buckets, pairs and candidates have no cap.

Defined results: a null or empty text, or one without words, has an empty set,
links with nothing and is its own component; rows with equal ``doc_id`` are
nodes of their own and share the id; a null ``doc_id`` takes part, and a
component without any id has the id null; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import U64, blocks, mix
from .common import small, written
from .components import components

#: classes of shingle keys whose loads tell common shingles (fixed size: 128 KB of flags)
CLASS_BITS, SLICE_BITS = 20, 14
#: narrowest bitmap; a set of n shingles has the next power of two of n bits
LEAST_BITS = 512
#: nodes in a bucket whose pairs are counted one by one
SMALL = 16
#: nodes in one signature tree
TREE_ROWS = 4096
LEAF, FAN = 8, 8
#: bitmap words compared at a time (8 MB an array), whatever the width of the bitmaps
WORDS = 1 << 20
#: pairs held before those beyond a node's most similar ones are dropped
PAIRS = 1 << 18
#: partners of each node in the first traversals
NEAREST = (2,)


def first_count(n, percent: int):
    """Length of the prefix in which linked sets meet."""
    return n - (percent * n + 99) // 100 + 1


def least_overlap(total, percent: int):
    """Fewest common shingles of linked sets with ``total`` shingles together."""
    return -(-percent * total // (100 + percent))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def common_classes(docs: DataFrame, k: int) -> np.ndarray:
    """Flags of the shingle classes that hold a common shingle: those whose load
    stands out of their neighbours' mean."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = np.zeros(1 << CLASS_BITS, dtype=np.int32)
        for batch in batches:
            for b in blocks(batch.column("text"), fold=True):
                g, _ = b.shingles(k)
                at = (g >> U64(64 - CLASS_BITS)).astype(np.int64)
                load += np.bincount(at, minlength=len(load)).astype(np.int32) if len(at) > 1 << 17 else 0
                if len(at) <= 1 << 17:
                    np.add.at(load, at, 1)
        if load.any():
            parts = load.reshape(-1, 1 << SLICE_BITS)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())],
                                             names=["slice", "load"])

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, raw in zip(batch.column("slice").to_pylist(), batch.column("load").to_pylist()):
                total[s] = total.get(s, 0) + np.frombuffer(zlib.decompress(raw), dtype=np.int32).astype(np.int64)
        if total:
            bits = []
            for x in total.values():
                usual = float(np.median(x))
                bits.append(np.packbits(x > usual + 4 * np.sqrt(usual) + 8).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(bits, pa.binary())], names=["slice", "flags"])

    rows = (_texts(docs).select("text").mapInArrow(count, "slice int, load binary").repartition("slice")
            .mapInArrow(flag, "slice int, flags binary").collect())  # 64 rows of 2 KB
    flags = np.zeros(1 << CLASS_BITS, dtype=bool).reshape(-1, 1 << SLICE_BITS)
    for r in rows:
        flags[r["slice"]] = np.unpackbits(np.frombuffer(r["flags"], dtype=np.uint8)).astype(bool)
    return flags.reshape(-1)


def node_of(keys: np.ndarray) -> int:
    """64-bit key of a set (sorted distinct shingle keys)."""
    total = np.add.reduce(mix(keys ^ U64(0x5851F42D4C957F2D)))
    return int(mix(np.array([total + U64(len(keys))], dtype=np.uint64)).view(np.int64)[0])


def bitmap_of(keys: np.ndarray) -> bytes:
    """Parities of the shingles in each class of their low bits.  Folding the
    upper half onto the lower by XOR gives the bitmap of half the width."""
    width = max(LEAST_BITS, 1 << (len(keys) - 1).bit_length())
    bits = np.bincount((keys & U64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(bool)).tobytes()


def profiles(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, n, node, first, early, bitmap): the first shingles in order, how
    many of them are not common, and the bitmap; these are null for copies that
    the same task has seen, and node for an empty set."""
    flags = docs.sparkSession.sparkContext.broadcast(np.packbits(common_classes(docs, k)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, seen = np.unpackbits(flags.value).view(bool), set()
        for batch in batches:
            for b in blocks(batch.column("text"), fold=True):
                g, at = b.shingles(k)
                n, node, first, early, bitmap = [], [], [], [], []
                for i, j in zip(at.tolist(), at[1:].tolist()):
                    if i == j:
                        n.append(0), node.append(None), first.append(None), early.append(None), bitmap.append(None)
                        continue
                    keys = np.unique(g[i:j])
                    key = node_of(keys)
                    n.append(len(keys)), node.append(key)
                    if key in seen:
                        first.append(None), early.append(None), bitmap.append(None)
                        continue
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(key)
                    late = common[(keys >> U64(64 - CLASS_BITS)).astype(np.int64)]
                    p = first_count(len(keys), percent)
                    rare = keys[~late][:p]
                    early.append(len(rare))
                    first.append(np.concatenate([rare, keys[late][:p - len(rare)]]).view(np.int64))
                    bitmap.append(bitmap_of(keys))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(b.row, b.n_docs), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                     pa.array(first, pa.list_(pa.int64())), pa.array(early, pa.int64()), pa.array(bitmap, pa.binary())],
                    names=["doc_id", "n", "node", "first", "early", "bitmap"])

    return written(_texts(docs).mapInArrow(run, "doc_id long, n long, node long, first array<long>, early long, bitmap binary"), "profiles")


def meetings(base: DataFrame, percent: int) -> DataFrame:
    """What the buckets give, as rows (kind, a, b, na, nb, c, s, members): kind 0,
    pairs of small buckets and in how many they met; kind 1, pairs of a large one's
    neighbours in size and with the first of equal size; kind 2, the trees of large
    ones (a, b: keys of the set of members, na, nb: range of sizes, c: tree, s: the
    shingle if its bucket may have several trees)."""
    order = ["shingle", "n", "node"]
    posted = base.where("first is not null").select(F.explode("first").alias("shingle"), "n", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, trees, held, is_first = TaskContext.get().partitionId(), 0, None, True

        def rows(kind: int, a, b, na, nb, c, s=None, members=None) -> pa.RecordBatch:
            m = len(a)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, kind, np.int32)), *(pa.array(np.asarray(x, dtype=np.int64)) for x in (a, b, na, nb, c)),
                 pa.array(s if s is not None else [None] * m, pa.int64()), pa.array(members if members is not None else [None] * m, pa.list_(pa.int64()))],
                names=["kind", "a", "b", "na", "nb", "c", "s", "members"])

        def pairs(kind: int, i: np.ndarray, j: np.ndarray, n: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
            swap = node[i] > node[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            order = np.lexsort((node[j], node[i]))
            i, j = i[order], j[order]
            new = np.flatnonzero(np.r_[True, (node[i][1:] != node[i][:-1]) | (node[j][1:] != node[j][:-1])])
            return rows(kind, node[i[new]], node[j[new]], n[i[new]], n[j[new]], np.diff(np.r_[new, len(i)]))

        def judge(s: np.ndarray, n: np.ndarray, node: np.ndarray, open_first: bool, open_last: bool) -> Iterator[pa.RecordBatch]:
            """Whole buckets, but the first and last may go on in another task: they count as large."""
            nonlocal trees
            once = np.r_[True, (s[1:] != s[:-1]) | (node[1:] != node[:-1])]  # a node may be posted by several tasks
            s, n, node = s[once], n[once], node[once]
            begin = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
            size = np.diff(np.r_[begin, len(s)])
            large = size > SMALL
            if open_first:
                large[0] = True
            if open_last:
                large[-1] = True
            m = np.repeat(np.where(large, 0, size), size)
            left, right = [], []
            for d in range(1, SMALL):
                i = np.flatnonzero((m[:-d] > d) & (s[:-d] == s[d:]) & (100 * n[:-d] >= percent * n[d:]))
                if not len(i):
                    if not (m > d).any():
                        break
                    continue
                left.append(i)
                right.append(i + d)
            if left:
                yield pairs(0, np.concatenate(left), np.concatenate(right), n, node)
            left, right, tree = [], [], []
            for g in np.flatnonzero(large).tolist():
                a, z = int(begin[g]), int(begin[g] + size[g])
                here = np.arange(a, z)
                run = np.maximum.accumulate(np.where(np.r_[True, n[a + 1:z] != n[a:z - 1]], here, 0))
                for i, j in ((here[:-1], here[1:]), (here[:-2], here[2:]), (run, here)):
                    near = (j > i) & (100 * n[i] >= percent * n[j])
                    left.append(i[near])
                    right.append(j[near])
                one = z - a <= TREE_ROWS and not (open_first and a == 0) and not (open_last and z == len(s))
                for i in range(a, z, TREE_ROWS):
                    j, name = min(z, i + TREE_ROWS), (part << 40) + trees
                    key = node[i:j].view(np.uint64)
                    keys = (int(mix(key ^ U64(c)).sum().view(np.int64)) for c in (0x243F6A8885A308D3, 0x13198A2E03707344))
                    tree.append((*keys, n[i], n[j - 1], name, None, node[i:j]) if one else (name, int(s[a]), n[i], n[j - 1], name, int(s[a]), node[i:j]))
                    trees += 1
            if left and len(i := np.concatenate(left)):
                yield pairs(1, i, np.concatenate(right), n, node)
            for i in range(0, len(tree), 256):
                yield rows(2, *(list(x) for x in zip(*tree[i:i + 256])))

        for batch in batches:
            now = [batch.column(c).to_numpy() for c in order]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            s = now[0]
            if not len(s):
                continue
            cut = int(np.searchsorted(s, s[-1]))  # the last bucket may go on
            if cut == 0 and len(s) < 4 * TREE_ROWS:
                held = now
                continue
            if cut == 0:  # one bucket longer than its trees: pass on what is there
                yield from judge(*now, True, True)
                held, is_first = None, True
                continue
            yield from judge(*(x[:cut] for x in now), is_first, False)
            held, is_first = [x[cut:] for x in now], False
        if held is not None and len(held[0]):
            yield from judge(*held, is_first, True)

    return written(posted.repartitionByRange(*order).sortWithinPartitions(*order)
                   .mapInArrow(run, "kind int, a long, b long, na long, nb long, c long, s long, members array<long>"), "meetings")


def large_buckets(met: DataFrame) -> DataFrame:
    """(tree, lo, hi, s, members) of large buckets, one for all of the same members
    (their keys agree and then the members themselves).  Where a bucket may have
    several trees, all of them stay, as their members meet."""
    same = met.where("kind = 2").groupBy("a", "b", "members").agg(
        F.min("c").alias("tree"), F.first("na").alias("lo"), F.first("nb").alias("hi"), F.first("s").alias("s"))
    return written(same.select("tree", "lo", "hi", "s", "members"), "buckets")


def traverse(n: np.ndarray, bits: np.ndarray, comp: np.ndarray, side: np.ndarray | None, percent: int, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dual traversal of a signature tree with itself, or of the trees of two
    sides: index pairs whose sizes, bitmaps and components leave a link open,
    and how many bits differ; with ``most`` at least the pairs that ``nearest_of``
    keeps, which are then all that is held."""
    order = np.lexsort((n, comp, side if side is not None else np.zeros(len(n), np.int64)))
    n, bits, comp = n[order], bits[order], comp[order]
    split = int((side == 0).sum()) if side is not None else len(n)

    def levels(a: int, z: int) -> list[tuple]:
        out, starts = [], np.arange(a, z, LEAF)
        groups = (n[a:z], n[a:z], comp[a:z], comp[a:z], bits[a:z], bits[a:z])
        offsets = starts - a
        while True:
            lo = np.minimum.reduceat(groups[0], offsets)
            hi = np.maximum.reduceat(groups[1], offsets)
            c0, c1 = np.minimum.reduceat(groups[2], offsets), np.maximum.reduceat(groups[3], offsets)
            any_ = np.bitwise_or.reduceat(groups[4], offsets, axis=0)
            all_ = np.bitwise_and.reduceat(groups[5], offsets, axis=0)
            out.append((lo, hi, c0, c1, any_, all_))
            if len(lo) == 1:
                return out
            groups, offsets = out[-1], np.arange(0, len(lo), FAN)

    words = max(1, bits.shape[1])

    def open_(x: tuple, y: tuple, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        step = max(1, WORDS // words)
        parts = [some_open(x, y, i[a:a + step], j[a:a + step]) for a in range(0, len(i), step)]
        return np.concatenate(parts) if parts else np.zeros(0, bool)

    def some_open(x: tuple, y: tuple, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        lo, hi = x[0][i] + y[0][j], x[1][i] + y[1][j]
        differ = np.bitwise_count((x[5][i] & ~y[4][j]) | (y[5][j] & ~x[4][i])).sum(axis=1, dtype=np.int64)
        most = np.minimum((hi - differ) // 2, np.minimum(x[1][i], y[1][j]))
        one = (x[2][i] == x[3][i]) & (y[2][j] == y[3][j]) & (x[2][i] == y[2][j])
        return ~one & ((100 + percent) * most >= percent * lo)

    first = levels(0, split)
    second = levels(split, len(n)) if side is not None else first
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(first) < len(second):
        first.append(first[-1])
    while len(second) < len(first):
        second.append(second[-1])

    def children(count: int, parent: int, at: np.ndarray, fan: int) -> tuple[np.ndarray, np.ndarray]:
        if count == parent:  # a level repeated to even the heights
            return at, np.ones(len(at), np.int64)
        a = at * fan
        return a, np.minimum(a + fan, count) - a

    def expand(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = na * nb
        which = np.repeat(np.arange(len(a)), total)
        k = np.arange(int(total.sum())) - np.repeat(np.cumsum(total) - total, total)
        return a[which] + k // nb[which], b[which] + k % nb[which]

    for h in range(len(first) - 1, -1, -1):
        keep = open_(first[h], second[h], i, j)
        i, j = i[keep], j[keep]
        if not len(i):
            break
        if h:
            i, j = expand(*children(len(first[h - 1][0]), len(first[h][0]), i, FAN), *children(len(second[h - 1][0]), len(second[h][0]), j, FAN))
            if side is None:
                up = i <= j
                i, j = i[up], j[up]
    out, held = [], 0
    step = max(1, WORDS // (words * LEAF * LEAF))
    for a in range(0, len(i), step):  # leaf pairs to rows, some at a time
        x, y = i[a:a + step], j[a:a + step]
        x, y = expand(x * LEAF, np.minimum(x * LEAF + LEAF, split) - x * LEAF,
                      y * LEAF + (split if side is not None else 0),
                      np.minimum(y * LEAF + LEAF, len(n) - split if side is not None else len(n)) - y * LEAF)
        if side is None:
            up = x < y
            x, y = x[up], y[up]
        differ = np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1, dtype=np.int64)
        common = np.minimum((n[x] + n[y] - differ) // 2, np.minimum(n[x], n[y]))
        keep = (comp[x] != comp[y]) & ((100 + percent) * common >= percent * (n[x] + n[y]))
        out.append((order[x[keep]], order[y[keep]], differ[keep]))
        held += int(keep.sum())
        if most is not None and held > max(PAIRS, 4 * most * len(n)):  # at most ``most`` a node stay
            some = tuple(np.concatenate(z) for z in zip(*out))
            near = nearest_of(*some, most)
            out, held = [tuple(z[near] for z in some)], len(near)
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def open_pairs(n: np.ndarray, bitmaps: list[bytes], comp: np.ndarray, side: np.ndarray, percent: int, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``traverse`` for bitmaps of several widths.  Linked sets differ in width
    by a factor of two at most; there the wider is folded."""
    width, out = np.array([len(b) for b in bitmaps]), []
    at = {int(w): np.flatnonzero(width == w) for w in np.unique(width)}
    bits = {w: np.frombuffer(b"".join(bitmaps[i] for i in rows), dtype=np.uint64).reshape(len(rows), -1) for w, rows in at.items()}

    def add(rows: np.ndarray, b: np.ndarray, sides: np.ndarray | None) -> None:
        if len(rows) > 1 and (sides is None or 0 < sides.sum() < len(sides)):
            i, j, d = traverse(n[rows], b, comp[rows], sides, percent, most)
            out.append((rows[i], rows[j], d))

    for w, rows in at.items():
        two = bool(side.any()) or None
        add(rows, bits[w], side[rows] if two else None)
        if 2 * w in at:
            wide = at[2 * w]
            folded = bits[2 * w].reshape(len(wide), 2, -1)
            folded = folded[:, 0] ^ folded[:, 1]
            for x in (0, 1) if two else (None,):
                a = np.ones(len(rows), bool) if x is None else side[rows] == x
                b = np.ones(len(wide), bool) if x is None else side[wide] != x
                both = np.concatenate([rows[a], wide[b]])
                add(both, np.concatenate([bits[w][a], folded[b]]), np.repeat([0, 1], [int(a.sum()), int(b.sum())]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def nearest_of(i: np.ndarray, j: np.ndarray, differ: np.ndarray, most: int) -> np.ndarray:
    """Which pairs are among the ``most`` of least difference of either member."""
    pair = np.tile(np.arange(len(i)), 2)
    member = np.concatenate([i, j])
    order = np.lexsort((differ[pair], member))
    member, pair = member[order], pair[order]
    begin = np.maximum.accumulate(np.where(np.r_[True, member[1:] != member[:-1]], np.arange(len(member)), 0))
    return np.unique(pair[np.arange(len(member)) - begin < most])


def tree_pairs(buckets: DataFrame, base: DataFrame, found: DataFrame, percent: int, most: int | None = None) -> DataFrame:
    """Pairs (a, b) of large buckets that the signature trees leave open; with
    ``most`` only that many of each node in a tree, the most similar."""
    label = found.select("node", "label")
    named = buckets.select("tree", "s", F.explode("members").alias("node")).join(label, "node", "left").withColumn("comp", F.coalesce("label", "node"))
    span = written(named.groupBy("tree", "s").agg(F.min("comp").alias("x"), F.max("comp").alias("y")), "spans")
    # buckets of one component are done; trees of one bucket stay or go together
    whole = span.where("s is not null").groupBy("s").agg(F.min("x").alias("x"), F.max("y").alias("y")).where("x <> y").select("s")
    mixed = span.where("s is null and x <> y").select("tree").unionByName(span.join(whole, "s", "left_semi").select("tree"))
    trees = written(buckets.join(small(written(mixed, "open")), "tree", "left_semi"), "trees")
    several = trees.where("s is not null")
    x, y = (several.select("s", *(F.col(c).alias(f"{c}{k}") for c in ("tree", "lo", "hi"))) for k in (1, 2))
    duos = x.join(y, "s").where((F.col("tree1") < F.col("tree2")) & (100 * F.col("hi1") >= percent * F.col("lo2"))
                                & (100 * F.col("hi2") >= percent * F.col("lo1"))).select("tree1", "tree2")
    held = several.select("tree", "members")
    sides = trees.select(F.col("tree").alias("tree1"), F.col("tree").alias("tree2"), F.lit(0).alias("side"), "members")
    for k in (1, 2):
        sides = sides.unionByName(held.join(duos, held["tree"] == duos[f"tree{k}"]).select("tree1", "tree2", F.lit(k - 1).alias("side"), "members"))
    # bitmaps come last, and only those of nodes in open trees: they are what weighs
    nodes = small(written(trees.select(F.explode("members").alias("node")).distinct(), "nodes"))
    about = (base.where("bitmap is not null").join(nodes, "node", "left_semi").groupBy("node").agg(F.first("bitmap").alias("bitmap"), F.first("n").alias("n"))
             .join(label, "node", "left").withColumn("comp", F.coalesce("label", "node")).drop("label"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        node = pdf["node"].to_numpy()
        i, j, differ = open_pairs(pdf["n"].to_numpy(), pdf["bitmap"].tolist(), pdf["comp"].to_numpy(), pdf["side"].to_numpy(), percent, most)
        if most is not None and len(i):
            keep = nearest_of(i, j, differ, most)
            i, j = i[keep], j[keep]
        return pd.DataFrame({"a": np.minimum(node[i], node[j]), "b": np.maximum(node[i], node[j])})

    rows = sides.select("tree1", "tree2", "side", F.explode("members").alias("node"))
    return rows.join(about, "node").groupBy("tree1", "tree2").applyInPandas(run, "a long, b long").distinct()


def _groups(pairs: DataFrame) -> DataFrame:
    """(node, a, deal, b): the groups that a node's data goes to, for each a its own
    (b null) and those of its partners b.  A node with very many partners is dealt over
    several groups; every partner's data is sent once per pair, its own once per group."""
    many = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("_n"))
    dealt = pairs.join(many, "a").withColumn("deal", F.pmod(F.xxhash64("b"), 1 + F.expr("_n div 2048"))).select("a", "deal", "b")
    own = dealt.select("a", "deal").distinct().select(F.col("a").alias("node"), "a", "deal", F.lit(None).cast("long").alias("b"))
    return own.unionByName(dealt.select(F.col("b").alias("node"), "a", "deal", "b"))


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows (a, b, data) of whole groups in order: for each a its own data, then its partners'."""
    return (rows.select("a", "deal", "b", "data").repartition("a", "deal")
            .sortWithinPartitions("a", "deal", F.col("b").asc_nulls_first()).select("a", "b", "data"))


def _nodes(pairs: DataFrame) -> DataFrame:
    return written(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(), "nodes")


def _judge(passes):
    """A task over ``_dealt`` rows that keeps the pairs for which ``passes(own, other)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            out, data = [], batch.column("data")
            at = np.frombuffer(data.buffers()[1], dtype=np.int32)[data.offset:data.offset + len(data) + 1]
            flat = np.frombuffer(data.buffers()[2], dtype=np.uint8) if data.buffers()[2] is not None else np.zeros(0, np.uint8)
            for a, b, i, j in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), at.tolist(), at[1:].tolist()):
                keys = flat[i:j].copy().view(np.uint64)
                if b is None:
                    own = keys
                elif passes(own, keys):
                    out.append((a, b))
            if out:
                x, y = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["a", "b"])

    return run


def _common(own: np.ndarray, keys: np.ndarray) -> int:
    """Common elements of two sorted arrays without repeats."""
    if not len(own):
        return 0
    at = np.searchsorted(own, keys)
    return int((own[np.minimum(at, len(own) - 1)] == keys).sum())


def similar(pairs: DataFrame, base: DataFrame, percent: int) -> DataFrame:
    """``pairs(a, b)`` without those whose bitmaps rule a link out: each bit that
    differs is a shingle that only one of the two has."""

    def passes(own: np.ndarray, other: np.ndarray) -> bool:
        (n, x), (m, y) = ((int(z[0]), z[1:]) for z in ((own, other) if len(own) <= len(other) else (other, own)))
        if len(y) > 2 * len(x):  # linked sets differ in width by a factor of two at most
            return False
        if len(y) > len(x):
            y = y[:len(x)] ^ y[len(x):]
        most = min((n + m - int(np.bitwise_count(x ^ y).sum())) // 2, n, m)
        return (100 + percent) * most >= percent * (n + m)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [n.to_bytes(8, "little") + b for n, b in zip(batch.column("n").to_pylist(), batch.column("bitmap").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(raw, pa.binary())], names=["node", "data"])

    pairs = written(pairs.select("a", "b"), "pairs")
    shown = base.where("bitmap is not null").join(small(_nodes(pairs)), "node", "left_semi").select("node", "n", "bitmap")
    data = shown.mapInArrow(pack, "node long, data binary").groupBy("node").agg(F.first("data").alias("data"))
    return _dealt(data.join(_groups(pairs), "node")).mapInArrow(_judge(passes), "a long, b long")


def possible(pairs: DataFrame, base: DataFrame, percent: int) -> DataFrame:
    """``pairs(a, b)`` without those whose first shingles rule a link out: beyond
    the shingles that both show, at most the rest of the smaller can be common."""

    def passes(own: np.ndarray, other: np.ndarray) -> bool:
        sizes, shown, ends = [], [], []
        for x in (own, other):
            n, early, all_ = int(x[0]), int(x[1]), len(x) - 2
            sizes.append(n)
            shown.append(x[2:2 + early])
            ends.append(int(x[1 + early]) if early == all_ and early < n else (1 << 64) - 1)
        end = U64(min(ends))
        a, b = (x[:int(np.searchsorted(x, end, side="right"))] for x in shown)
        most = _common(a, b) + min(sizes[0] - len(a), sizes[1] - len(b))
        return (100 + percent) * most >= percent * sum(sizes)

    pairs = written(pairs.select("a", "b"), "pairs")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.column("first")
            at, flat = first.offsets.to_numpy(), first.values.to_numpy()
            raw = [np.concatenate([[n, e], flat[i:j]]).astype(np.int64).tobytes()
                   for n, e, i, j in zip(batch.column("n").to_pylist(), batch.column("early").to_pylist(), at.tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(raw, pa.binary())], names=["node", "data"])

    shown = base.where("first is not null").join(small(_nodes(pairs)), "node", "left_semi").select("node", "n", "early", "first")
    data = shown.mapInArrow(pack, "node long, data binary").groupBy("node").agg(F.first("data").alias("data"))
    return _dealt(data.join(_groups(pairs), "node")).mapInArrow(_judge(passes), "a long, b long")


def checked(pairs: DataFrame, docs: DataFrame, base: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` whose whole sets link."""
    pairs = written(pairs.select("a", "b"), "pairs")
    nodes = small(_nodes(pairs))
    some = base.where("node is not null").join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    ids = written(some.select("doc_id").distinct(), "ids")
    groups = _groups(pairs)
    texts = _texts(docs).join(small(ids), "doc_id", "left_semi").select("text")
    if ids.where("doc_id is null").count():  # nodes of rows without any id
        texts = texts.unionByName(_texts(docs).where("doc_id is null").select("text"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch.column("text"), fold=True):
                g, at = b.shingles(k)
                keys = [np.unique(g[i:j]) for i, j in zip(at.tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array([node_of(x) for x in keys], pa.int64()), pa.array([x.tobytes() for x in keys], pa.binary())],
                                                 names=["node", "data"])

    # whole sets weigh most: they go straight to the groups they are compared in
    dealt = _dealt(texts.mapInArrow(sets, "node long, data binary").join(groups, "node"))

    def passes(own: np.ndarray, other: np.ndarray) -> bool:
        both = _common(own, other)
        return 100 * both >= percent * (len(own) + len(other) - both)

    # rows of one text and doc_id give a pair more than once
    return written(dealt.mapInArrow(_judge(passes), "a long, b long").distinct(), "links")


def least_partners(pairs: DataFrame) -> DataFrame:
    """Of ``pairs(a, b)``, a < b, each b's with its least a: in a class of near copies
    stars around few nodes, so that a set is sent about once."""
    return pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")


def apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` whose nodes are of different components so far."""
    a, b = (found.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in ("a", "b"))
    return (pairs.join(a, "a", "left").join(b, "b", "left")
            .where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b"))


def join(docs: DataFrame, k: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(documents, links): per row of ``docs`` doc_id, n_shingles, node and
    component_id; and links (a, b) between nodes that span each component."""
    base = profiles(docs, k, percent)
    met = meetings(base, percent)
    pairs = met.where("kind < 2").groupBy("a", "b").agg(
        F.max("na").alias("na"), F.max("nb").alias("nb"),
        F.sum(F.when(F.col("kind") == 0, F.col("c")).otherwise(0)).alias("small"),
        F.sum(F.when(F.col("kind") == 1, F.col("c")).otherwise(0)).alias("large"))
    total = F.col("na") + F.col("nb")
    overlap = F.expr(f"({percent} * (na + nb) + {100 + percent - 1}) div {100 + percent}")

    def must(n: str) -> F.Column:
        return F.expr(f"{n} - ({percent} * {n} + 99) div 100 + 1 - {n}") + overlap

    need = F.greatest(F.least(must("na"), must("nb")), F.lit(1))
    # pairs of small buckets: exact bound; pairs of large ones: likely links first
    likely = pairs.where((F.col("small") >= need) | (2 * (F.col("small") + F.col("large")) >= need) & (F.col("large") > 0)).where(total > 0)
    likely = written(similar(likely, base, percent), "likely")
    links = checked(least_partners(likely), docs, base, k, percent)
    found = written(components(links), "found")
    buckets = large_buckets(met)

    def from_trees(most: int | None) -> DataFrame:
        return possible(tree_pairs(buckets, base, found, percent, most), base, percent)

    for most in (0, *NEAREST, None):  # the other likely pairs; then from trees, where the last round takes every open pair
        more = checked(apart(likely, found) if most == 0 else from_trees(most), docs, base, k, percent)
        if more.isEmpty():
            continue
        # components of components: their labels are smallest nodes already
        a, b = (found.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")) for c in ("a", "b"))
        joined = more.join(a, "a", "left").join(b, "b", "left").select(
            F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
        up = components(joined)
        named = found.unionByName(more.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                                  .join(found, "node", "left_anti").select("node", F.col("node").alias("label")))
        found = written(named.join(up.withColumnRenamed("label", "top").withColumnRenamed("node", "label"), "label", "left")
                        .select("node", F.coalesce("top", "label").alias("label")), "found")
        links = links.unionByName(more)
    label = found
    return assigned(base, label), links


def assigned(base: DataFrame, label: DataFrame) -> DataFrame:
    """Component ids of all rows: the smallest ``doc_id`` of the component."""
    own = base.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    own = own.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    comp = own.groupBy("label").agg(F.min("least").alias("component_id"))
    named = own.join(comp, "label").select("node", "component_id")
    rows = base.select("doc_id", F.col("n").alias("n_shingles"), "node")
    full = rows.where("node is not null").join(named, "node").select("doc_id", "n_shingles", "node", "component_id")
    return full.unionByName(rows.where("node is null").select("doc_id", "n_shingles", "node", F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` (all columns) with one document of each component: the
    one with its smallest ``doc_id``.  Rows without ``doc_id`` stay; of rows
    that repeat both ``doc_id`` and text one stays."""
    classes = written(join(docs, k, percent)[0].where("doc_id is not null").select("doc_id", "component_id"), "classes")
    ids = classes.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count(F.lit(1)).alias("rows"))
    gone = written(ids.where("not stays or rows > 1"), "gone")
    drop = gone.where("not stays").select(F.col("doc_id").alias("_gone"))
    kept = docs.join(drop, docs["doc_id"].cast("long") == drop["_gone"], "left_anti")
    again = gone.where("stays").select(F.col("doc_id").alias("_again"))
    if again.isEmpty():
        return kept
    same = kept["doc_id"].cast("long") == again["_again"]
    return kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))

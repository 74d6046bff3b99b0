"""Toxicity by nearest labelled examples.

Labelled documents are examples; a text's toxicity is the distance-weighted vote
of its nearest ones by exact TF-IDF cosine, found with a block-max inverted
index, and calibrated to a probability.

*Features* are words and the beginnings of words (``PREFIXES`` bytes long), so
that inflected and compound words share some.  The labels choose all
whose share of toxic examples is surely above or below the usual share (lower
bound of the log odds, from ``SUPPORT`` examples on), however many there are.  Document frequencies of the
chosen terms are counted over all documents and give the IDF weights.

*Index.*  Per term, postings (example, weight) in order of example, in blocks
of ``BLOCK`` examples with each block's largest weight.  A query adds up its
terms' block maxima; a block whose bound is below the k-th best cosine of the blocks with the
greatest bounds can hold no neighbour and is not opened.  Many queries are worked
on at once.  The result is exact.

*Score.*  Votes of the k nearest, weighted by 1 / (0.02 + distance), are turned
into a probability by a step function fitted on examples that vote without
themselves.  A text with no chosen term has no neighbour and gets the share of
toxic among such examples.

Examples are a bounded sample of the labelled rows (``examples``, at most that
many by smallest hash of the id); everything else reads all rows.

Defined results: a null or empty text is scored like any text without terms;
repeated labels of a document agree on the largest, of rows with its id the least
text is the example; labels without a document or
without a value count for nothing; with no labels at all every score is 0;
repeated rows each get their row; an empty table gives none; other columns are
never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import Block, U64, blocks, mix

#: words: runs of ASCII letters, digits and non-ASCII characters
BREAKS = np.ones(256, dtype=bool)
BREAKS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
PREFIXES = (4, 5, 6, 7)
BLOCK = 64
#: examples that hold a term, at least: with fewer the bound on its log odds says nothing (chance words would reject clean texts)
SUPPORT = 5
#: blocks that a query opens before its bound counts
FIRST = 16
#: cosines held at a time (queries x examples), and votes remembered by a worker
TABLE, KNOWN = 1 << 18, 200_000
_BITS = 22
_TOP = U64(64 - _BITS)


def features(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """(keys, document) of all features of a block, repeats included."""
    doc = b.word_doc()
    keys, owner = [b.hash], [doc]
    length = b.end - b.start
    for p in PREFIXES:
        long = np.flatnonzero(length > p)
        keys.append(mix(b.span_hash(b.start[long], b.start[long] + p) + U64(p)))
        owner.append(doc[long])
    return np.concatenate(keys), np.concatenate(owner)


@dataclass
class Terms:
    """Chosen terms: sorted keys, weights, and flags of their leading bits."""

    keys: np.ndarray
    idf: np.ndarray

    def __post_init__(self) -> None:
        flags = np.zeros(1 << _BITS, dtype=bool)
        flags[(self.keys >> _TOP).astype(np.int64)] = True
        self.flags = np.packbits(flags)

    def counts(self, b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, term, count) of the chosen terms in a block, in order."""
        if not len(self.keys):
            return (np.zeros(0, np.int64),) * 3
        if not hasattr(self, "_flags"):
            self._flags = np.unpackbits(self.flags).view(bool)
        keys, owner = features(b)
        at = np.flatnonzero(self._flags[(keys >> _TOP).astype(np.int64)])
        i = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
        same = self.keys[i] == keys[at]
        both, n = np.unique(owner[at][same] * len(self.keys) + i[same], return_counts=True)
        return both // len(self.keys), both % len(self.keys), n

    def vectors(self, b: Block) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(document, terms, unit TF-IDF weights) of documents with any term."""
        doc, term, n = self.counts(b)
        weight = (1 + np.log(n)) * self.idf[term] if len(n) else np.zeros(0)
        begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
        out = []
        for i, j in zip(begin.tolist(), np.r_[begin[1:], len(doc)].tolist()):
            w = weight[i:j]
            out.append((int(doc[i]), term[i:j], w / np.sqrt((w * w).sum())))
        return out

    def __getstate__(self):
        return {"keys": self.keys, "idf": self.idf, "flags": self.flags}


class BlockMax:
    """Block-max inverted index of unit vectors."""

    def __init__(self, n_terms: int, vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray):
        self.n, self.labels = len(vectors), labels
        self.n_blocks = -(-self.n // BLOCK)
        term = np.concatenate([t for t, _ in vectors]) if vectors else np.zeros(0, np.int64)
        weight = np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0)
        doc = np.repeat(np.arange(self.n), [len(t) for t, _ in vectors])
        order = np.lexsort((doc, term))
        self.doc, self.weight, term = doc[order], weight[order], term[order]
        # one chunk per (term, block): where it begins, and its largest weight
        chunk = term * max(1, self.n_blocks) + self.doc // BLOCK
        self.begin = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]]) if len(chunk) else np.zeros(0, np.int64)
        self.stop = np.r_[self.begin[1:], len(chunk)]
        self.top = np.maximum.reduceat(self.weight, self.begin) if len(chunk) else np.zeros(0)
        self.block = self.doc[self.begin] // BLOCK if len(chunk) else np.zeros(0, np.int64)
        self.first = np.searchsorted(term[self.begin] if len(chunk) else term, np.arange(n_terms + 1))

    def nearest(self, at: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query i has the terms ``at[i]:at[i + 1]``.  (query, example, cosine) of
        each query's k examples of greatest cosine above 0 (ties: lowest number),
        best first; ``skip[i]`` is an example that query i leaves out."""
        n, no = len(at) - 1, (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if not n or not self.n:
            return no
        many = self.first[terms + 1] - self.first[terms]
        chunk = np.repeat(self.first[terms] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        query = np.repeat(np.repeat(np.arange(n), np.diff(at)), many)
        q, cell = np.repeat(weights, many), query * self.n_blocks + self.block[chunk]
        bound = np.bincount(cell, weights=self.top[chunk] * q, minlength=n * self.n_blocks).reshape(n, self.n_blocks)
        cosine = np.zeros(n * self.n)

        def open_blocks(which: np.ndarray) -> None:
            some = np.flatnonzero(which.ravel()[cell])
            size = self.stop[chunk[some]] - self.begin[chunk[some]]
            p = np.repeat(self.begin[chunk[some]] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            cosine[:] += np.bincount(np.repeat(query[some], size) * self.n + self.doc[p], weights=self.weight[p] * np.repeat(q[some], size), minlength=len(cosine))
            if skip is not None:
                cosine[np.flatnonzero(skip >= 0) * self.n + skip[skip >= 0]] = 0

        # the blocks of greatest bounds give each query's k-th best so far; of the
        # others only those that can beat it are opened
        best = np.argpartition(-bound, min(FIRST, self.n_blocks) - 1, axis=1)[:, :FIRST]
        first = np.zeros(bound.shape, dtype=bool)
        np.put_along_axis(first, best, True, axis=1)
        first &= bound > 0
        open_blocks(first)
        table = cosine.reshape(n, self.n)
        kth, width = np.zeros(n), best.shape[1] * BLOCK
        if k < width:
            seen = np.minimum((best[:, :, None] * BLOCK + np.arange(BLOCK)).reshape(n, width), self.n)
            seen = np.take_along_axis(np.concatenate([table, np.zeros((n, 1))], axis=1), seen, axis=1)
            kth = np.partition(seen, width - k, axis=1)[:, width - k]
        rest = ~first & (bound > 0) & (bound >= kth[:, None] - 1e-12)
        if rest.any():
            open_blocks(rest)
        # no neighbour is below what the first blocks gave; ties by twelve digits
        who, what = np.nonzero((table >= kth[:, None] - 1e-11) & (table > 0))
        near = table[who, what].round(12)
        order = np.lexsort((what, -near, who))
        who, what = who[order], what[order]
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        who, what = who[rank < k], what[rank < k]
        return who, what, table[who, what]


@dataclass
class Model:
    terms: Terms
    index: BlockMax
    k: int
    edges: np.ndarray  # upper ends of the vote's steps
    steps: np.ndarray  # probability of each step
    none: float  # probability of a text without chosen terms
    names: np.ndarray  # example numbers to doc_id

    def votes(self, vectors: list[tuple[np.ndarray, np.ndarray]], skip: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Some vectors at a time: number of the first, raw votes (NaN without
        neighbours), and (vector, example, cosine) of the neighbours."""
        step = max(1, TABLE // max(1, self.index.n))
        for a in range(0, len(vectors), step):
            some = vectors[a:a + step]
            at = np.r_[0, np.cumsum([len(t) for t, _ in some])]
            who, near, cosine = self.index.nearest(at, np.concatenate([t for t, _ in some]), np.concatenate([w for _, w in some]), self.k,
                                                   None if skip is None else skip[a:a + step])
            pull = 1 / (0.02 + 1 - np.minimum(cosine, 1))
            total = np.bincount(who, weights=pull, minlength=len(some))
            toxic = np.bincount(who, weights=pull * self.index.labels[near], minlength=len(some))
            yield a, np.where(total > 0, toxic / np.where(total > 0, total, 1), np.nan), who, near, cosine

    def calibrated(self, vote: float) -> float:
        if vote != vote:
            return self.none
        # steps tell apart; a small part of the vote itself keeps the order inside a step
        p = float(self.steps[min(int(np.searchsorted(self.edges, vote)), len(self.steps) - 1)])
        return min(1.0, max(0.0, 0.98 * p + 0.02 * vote))

    def scores(self, column: pa.Array, evidence: bool = False) -> tuple[np.ndarray, list]:
        out, why = np.full(len(column), self.none), [None] * len(column)
        if not self.index.n:
            return out, why
        if not hasattr(self, "_known"):
            self._known: dict[bytes, float] = {}  # votes of this worker's earlier vectors
        for b in blocks(column, fold=True, breaks=BREAKS):
            new: dict[bytes, int] = {}
            vectors, where, keys = [], [], []
            for d, t, w in self.terms.vectors(b):
                key = t.tobytes() + w.tobytes()
                if not evidence and key in self._known:
                    out[b.row + d] = self._known[key]
                    continue
                if key not in new:
                    new[key] = len(vectors)
                    vectors.append((t, w))
                    keys.append(key)
                where.append((b.row + d, new[key]))
            score, reasons = np.zeros(len(vectors)), [[] for _ in vectors]
            for a, votes, who, near, cosine in self.votes(vectors):
                score[a:a + len(votes)] = [self.calibrated(v) for v in votes.tolist()]
                if evidence:
                    for i, e, c in zip((a + who).tolist(), near.tolist(), cosine.tolist()):
                        reasons[i].append({"doc_id": int(self.names[e]), "cosine": c, "toxic": int(self.index.labels[e])})
            for row, i in where:
                out[row] = score[i]
                why[row] = reasons[i] if evidence else None
            if len(self._known) < KNOWN:
                self._known.update(zip(keys, score.tolist()))
        return out, why

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_known"}


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, examples: int = 12_000, k: int = 15) -> Model:
    """Learn from ``labels(doc_id, toxic)`` and the texts of ``docs``.

    At most ``examples`` labelled documents are used; their features and this
    model are what the driver holds, whatever the corpus."""
    spark = docs.sparkSession
    given = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    chosen = given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # one text of each example, however often its row is repeated
    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # features that the examples of a batch hold, by label
            toxic, seen = batch.column("toxic").to_numpy(), []
            for b in blocks(batch.column("text"), fold=True, breaks=BREAKS):
                keys, owner = features(b)
                order = np.lexsort((keys, owner))
                keys, owner = keys[order], owner[order]
                new = np.r_[True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])] if len(keys) else np.zeros(0, bool)
                seen.append((keys[new], toxic[b.row + owner[new]]))
            if seen:
                keys, y = (np.concatenate(x) for x in zip(*seen))
                u, inverse = np.unique(keys, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(np.bincount(inverse, minlength=len(u))),
                                                  pa.array(np.bincount(inverse, weights=y, minlength=len(u)).astype(np.int64))], names=["term", "n", "bad"])

    size = chosen.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    total, bad = int(size[0]), int(size[1] or 0)
    if not total or not bad or bad == total:
        return Model(Terms(np.zeros(0, np.uint64), np.zeros(0)), BlockMax(0, [], np.zeros(0)), k, np.ones(1), np.zeros(1),
                     bad / total if total else 0.0, np.zeros(0, np.int64))
    # sure terms: the lower bound of |log odds| against the usual share
    usual = float(np.log(bad / (total - bad)))
    tally = sample.select("text", "toxic").mapInArrow(count, "term long, n long, bad long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where(f"n >= {SUPPORT}")
    odds = F.log((F.col("bad") + 0.5 * bad / total) / (F.col("n") - F.col("bad") + 0.5 * (total - bad) / total)) - usual
    sure = F.abs(odds) - 2.6 * F.sqrt(1 / (F.col("bad") + 0.5 * bad / total) + 1 / (F.col("n") - F.col("bad") + 0.5 * (total - bad) / total))
    picked = tally.withColumn("sure", sure).where("sure > 0").select("term").collect()  # bounded by the examples' features
    keys = np.sort(np.array([r["term"] for r in picked], dtype=np.int64).view(np.uint64))

    plain = Terms(keys, np.ones(len(keys)))
    shared = spark.sparkContext.broadcast(plain)

    def frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, n, df = shared.value, 0, np.zeros(len(shared.value.keys) + 1, dtype=np.int64)
        for batch in batches:
            n += batch.num_rows
            for b in blocks(batch.column("text"), fold=True, breaks=BREAKS):
                df[:-1] += np.bincount(t.counts(b)[1], minlength=len(t.keys))
        df[-1] = n
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(df))), pa.array(df)], names=["term", "n"])

    df = np.zeros(len(keys) + 1)
    for r in texts.select("text").mapInArrow(frequency, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():  # a row per term
        df[r["term"]] = r["n"]
    weighted = Terms(keys, np.log1p(df[-1] / np.maximum(1, df[:-1])))
    shared_terms = spark.sparkContext.broadcast(weighted)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared_terms.value
        for batch in batches:
            names, toxic = batch.column("doc_id").to_pylist(), batch.column("toxic").to_pylist()
            for b in blocks(batch.column("text"), fold=True, breaks=BREAKS):
                # numbers as bytes: the driver holds no object a number
                got = {d: (x.astype(np.int64).tobytes(), w.astype(np.float64).tobytes()) for d, x, w in t.vectors(b)}
                rows = [(names[b.row + d], toxic[b.row + d], *got.get(d, (b"", b""))) for d in range(b.n_docs)]
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "toxic", "terms", "weights"])

    rows = [(r["doc_id"], int(r["toxic"]), np.frombuffer(r["terms"], np.int64), np.frombuffer(r["weights"]))
            for r in sample.mapInArrow(vectors, "doc_id long, toxic int, terms binary, weights binary").collect()]  # at most `examples` documents
    blank = [toxic for _, toxic, terms, _ in rows if not len(terms)]
    # similar examples next to each other make block maxima tight; as big-endian bytes terms sort like lists
    rows = sorted((r for r in rows if len(r[2])), key=lambda r: (r[2].astype(">i8").tobytes(), r[0]))
    y = np.array([r[1] for r in rows], dtype=float)
    vecs = [(r[2], r[3]) for r in rows]
    none = (sum(blank) + bad / total) / (len(blank) + 1)
    model = Model(weighted, BlockMax(len(keys), vecs, y), k, np.ones(1), np.zeros(1), none, np.array([r[0] for r in rows], dtype=np.int64))
    asked = spark.sparkContext.broadcast((model, vecs))

    def without_itself(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, every = asked.value
        for batch in batches:
            i = batch.column("id").to_numpy()
            found = [v for _, v, *_ in own.votes([every[x] for x in i.tolist()], i)]
            if found:
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.concatenate(found))], names=["id", "vote"])

    votes = np.full(len(vecs), np.nan)
    for r in spark.range(0, len(vecs), 1, -(-len(vecs) // 500) or 1).mapInArrow(without_itself, "id long, vote double").collect():  # a row an example
        votes[r["id"]] = r["vote"]
    model.edges, model.steps = rising_steps(votes[~np.isnan(votes)], y[~np.isnan(votes)])
    return model


def rising_steps(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing step function of least squares (pool adjacent violators)."""
    if not len(x):
        return np.ones(1), np.zeros(1)
    values, inverse = np.unique(x, return_inverse=True)
    pools = []
    for v, total, n in zip(values.tolist(), np.bincount(inverse, weights=y).tolist(), np.bincount(inverse).tolist()):
        pools.append([v, total, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            v, total, n = pools.pop()
            pools[-1] = [v, pools[-1][1] + total, pools[-1][2] + n]
    return np.array([p[0] for p in pools]), np.array([p[1] / p[2] for p in pools])


def toxicity(model: Model, docs: DataFrame, text: Column) -> Column:
    """Score column of any text column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(column)[0])

    return score(text.cast("string"))


def evidence(model: Model, docs: DataFrame, text: Column) -> Column:
    """The neighbours that voted: array of (doc_id, cosine, toxic)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    @F.arrow_udf("array<struct<doc_id: long, cosine: double, toxic: int>>")
    def why(column: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(column, evidence=True)[1], kind)

    return why(text.cast("string"))

import random
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from emporion.llm import blocks, packing, token_file, tokens
from emporion.llm.common import scratch, ship

from llm_cases import ODD, frame, no_docs, odd_docs, prose, words_of  # noqa: F401

BYTE, WORD = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ALPHABET = st.text(st.sampled_from(list("abZ '.,\n\t é日 <|>09́")), max_size=40)


@lru_cache
def library(path):
    return Tokenizer.from_file(path)


def whole(path, text):
    return library(path).encode(text or "", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_give_the_ids_of_the_whole_text(path):
    rng = random.Random(1)
    texts = ODD + [prose(rng, 300), "A b. C\nd, e; f!  g\n\nh 'll we'll.x 3.5% don't"]
    assert [x.tolist() for x in tokens.encode(pa.array(texts), path)] == [whole(path, t) for t in texts]


def thue_morse(n, a="a", b="b"):
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_words_alike_modulo_a_power_of_two_have_keys_of_their_own(n):
    one, two = thue_morse(n), thue_morse(n, "b", "a")
    for path in (BYTE, WORD):
        assert [x.tolist() for x in tokens.encode(pa.array([one, two, one + " " + two]), path)] == [whole(path, t) for t in (one, two, one + " " + two)]
    b = next(blocks.blocks(pa.array([f"{one} x y z", f"{two} x y z"]), fold=True))
    assert len(set(b.hash.tolist())) == 5 and len(set(b.shingles(4)[0].tolist())) == 2


def test_special_strings_as_the_library_reads_them():
    texts = ["hello<|endoftext|>world", "<|endoftext|>", "a <|endoftext|> b c, d", "</s> <unk> [INST]", "no mark", "<|endoftext|", "x " * 50 + "<|endoftext|><|endoftext|> y"]
    for path in (BYTE, WORD):
        assert [x.tolist() for x in tokens.encode(pa.array(texts), path)] == [whole(path, t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(ALPHABET, max_size=6))
def test_pieces_property(texts):
    for path in (BYTE, WORD):
        assert [x.tolist() for x in tokens.encode(pa.array(texts, pa.string()), path)] == [whole(path, t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(ALPHABET, max_size=5), st.integers(1, 5))
def test_words_and_shingles(texts, k):
    col, got, keys = pa.array(texts, pa.string()), [], []
    for b in blocks.blocks(col, fold=True, limit=16):
        data = b.raw.tobytes()
        g, at = b.shingles(k)
        for d in range(b.n_docs):
            got.append([data[i:j].decode() for i, j in zip(b.start[b.first[d]:b.first[d + 1]], b.end[b.first[d]:b.first[d + 1]])])
            keys.append(g[at[d]:at[d + 1]].tolist())
    assert got == [words_of(t) for t in texts]
    seen = {}
    for words, ks in zip(got, keys):
        fold = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
        want = [tuple(fold[i:i + k]) for i in range(len(fold) - k + 1)] if len(fold) >= k else [tuple(fold)] if fold else []
        assert len(want) == len(ks)
        for w, x in zip(want, ks):  # equal shingles have equal keys, others differ
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("plane", ["byte", "bit"])
def test_planes_round_trip(plane):
    rng = np.random.default_rng(3)
    for n in (1, 7, 8, 9, 1000):
        ids = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        assert (token_file.from_planes(token_file.to_planes(ids, plane), n) == ids).all()
        sizes, payload = token_file.pack_segment(ids, 64, plane, 3)
        assert len(sizes) == -(-n // 64) * (4 if plane == "byte" else 32) and sum(sizes) == len(payload)
        assert (token_file.unpack_segment(n, 64, sizes, payload) == ids).all()


@pytest.mark.parametrize("plane", ["byte", "bit"])
def test_token_file(spark, odd_docs, plane):
    ship(spark)
    path = scratch(spark, "test-file")
    token_file.write_token_file(odd_docs, path, BYTE, block_ids=100, segment_ids=700, plane=plane)
    got = token_file.read_token_file(spark, path).withColumn("crc", F.crc32("ids")).collect()
    rows = sorted(((r["doc_id"], r["text"]) for r in odd_docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in got) == [(r[0] is not None, r[0] or 0) for r in rows]
    want = sorted((zlib.crc32(np.array(whole(BYTE, t), "<u4").tobytes()), len(whole(BYTE, t))) for _, t in rows)
    assert sorted((r["crc"], r["n_tokens"]) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    segments = spark.read.parquet(path)
    assert segments.count() > 2 and "plane_sizes" in segments.columns


def test_token_file_of_nothing(spark, no_docs):
    ship(spark)
    path = scratch(spark, "test-file")
    token_file.write_token_file(no_docs, path, BYTE)
    assert token_file.read_token_file(spark, path).count() == 0


def best_bins(sizes, capacity):
    """Fewest bins by exhaustive search."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms)}.values():
            if rooms[j] >= sizes[i]:
                go(i + 1, rooms[:j] + [rooms[j] - sizes[i]] + rooms[j + 1:])
        go(i + 1, [*rooms, capacity - sizes[i]])

    go(0, [])
    return best


def test_fixed_sets_keep_the_optimum():
    rng = random.Random(5)
    reduced = 0
    for _ in range(300):
        capacity = rng.randint(6, 24)
        low = rng.choice([1, capacity // 6 + 1, capacity // 4 + 1])
        sizes = [rng.randint(low, capacity) for _ in range(rng.randint(1, 9))]
        count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
        fixed = packing.fix_dominating(count, capacity)
        rest = np.repeat(np.arange(capacity + 1), count).tolist()
        assert all(sum(m) <= capacity for m, _ in fixed)
        assert sorted(rest + [x for m, n in fixed for x in m * n]) == sorted(sizes)
        assert sum(n for _, n in fixed) + best_bins(rest, capacity) == best_bins(sizes, capacity)
        reduced += bool(fixed)
    assert reduced > 200


def martello_toth_bound(sizes, capacity):
    """L2: for each limit, large sizes have bins of their own, and what middle
    ones leave open bounds how many bins the rest adds."""
    best = -(-int(sizes.sum()) // capacity)
    for limit in range(capacity // 2 + 1):
        large, middle = sizes[sizes > capacity - limit], sizes[(sizes > capacity / 2) & (sizes <= capacity - limit)]
        rest = sizes[(sizes >= limit) & (sizes <= capacity / 2)]
        over = int(rest.sum()) - (len(middle) * capacity - int(middle.sum()))
        best = max(best, len(large) + len(middle) + max(0, -(-over // capacity)))
    return best


def test_plan_fills_bins_without_gaps():
    rng = random.Random(6)
    for _ in range(100):
        capacity = rng.randint(3, 60)
        count = np.zeros(capacity + 1, dtype=np.int64)
        for _ in range(rng.randint(0, 12)):
            count[rng.randint(1, capacity)] += rng.choice([1, 2, 5, 1000])
        t = packing.plan(count, capacity)
        bins, taken = {}, np.zeros_like(count)
        for length, rank, n, each, first, offset in zip(*(t[c].tolist() for c in ("length", "rank", "bins", "each", "bin", "offset"))):
            assert rank == taken[length]
            taken[length] += n * each
            for b in range(first, first + n):
                bins.setdefault(b, []).extend((offset + i * length, length) for i in range(each))
        assert (taken == count).all()
        for parts in bins.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
        least = martello_toth_bound(np.repeat(np.arange(capacity + 1), count), capacity)
        assert least <= len(bins) <= least * 11 / 6 + 1 and sorted(bins) == list(range(len(bins)))


def test_packing_of_odd_documents(spark, odd_docs, no_docs):
    ship(spark)
    cut = packing.pieces(odd_docs, WORD, capacity=64)
    placed = packing.place(cut, capacity=64)
    rows = placed.collect()
    want = []
    for r in odd_docs.collect():
        ids = np.array(whole(WORD, r["text"]), "<u4")
        want += [(r["doc_id"], i // 64, i, len(ids[i:i + 64]), ids[i:i + 64].tobytes()) for i in range(0, len(ids), 64)]
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in rows), key=key) == sorted(want, key=key)
    full = packing.sequences(placed).collect()
    assert sum(s["length"] for s in full) == sum(w[3] for w in want)
    assert all(s["length"] <= 64 and [d["offset"] for d in s["documents"]] == np.cumsum([0, *(d["length"] for d in s["documents"])])[:-1].tolist() for s in full)
    assert packing.place(packing.pieces(no_docs, WORD)).count() == 0


def test_one_length_holds_most_rows(spark):
    """A hot length is ranked over several tasks without gaps."""
    ship(spark)
    docs = frame(spark, ["same words here"] * 3000 + ["a few more words in this one"] * 40).repartition(7)
    rows = packing.place(packing.pieces(docs, WORD, capacity=50).drop("ids"), capacity=50).collect()
    seen = {(r["sequence_id"], r["offset"]) for r in rows}
    total = sum(r["length"] for r in rows)
    assert len(seen) == len(rows) == 3040 and len({s for s, _ in seen}) <= -(-total // 48) + 1

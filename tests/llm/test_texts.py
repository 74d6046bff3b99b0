"""Licences, decontamination, toxicity, secrets and outliers."""

import hashlib
import math
import random
import re
import statistics
import string
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from emporion.llm import decontaminate, licences, outliers, secrets, toxicity
from emporion.llm.blocks import blocks
from emporion.llm.common import ship
from llm_cases import DOCS, frame, no_docs, odd_docs, prose, words_of  # noqa: F401

APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://example.org.
Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES.
See the License for the specific language governing permissions and
limitations under the License."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software.
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED."""


@pytest.mark.parametrize("text,names,status", [
    ("Words.\nLicensed under the Apache License, Version 2.0.\nMore words.", ["Apache-2.0"], "known"),
    (MIT, ["MIT"], "known"),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0-only"], "known"),
    ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"], "known"),
    ("x\n// SPDX-License-Identifier: MIT\ny", ["MIT"], "known"),
    ("Released under the MIT License. Licensed under CC BY-SA 4.0. Released under the MIT License.", ["MIT", "CC-BY-SA-4.0", "MIT"], "known"),
    ("You may not use this file except in compliance with the License.", [], "partial"),
    ("Released under the MIT License.\nThis comes with a licence of our own making", ["MIT"], "partial"),
    ("All rights under a licence of our own making", [], "unknown"),
    ("He has a driving skill.", [], "none"), ("", [], "none"),
])
def test_licences(text, names, status):
    found = licences.sentence_ids(text)
    got, left = licences.match_rules(found)
    assert got == names
    known = [x for x in found if x[0] != "?"]
    assert status == ("none" if not found else "unknown" if not known else "partial" if left or len(known) < len(found) else "known")
    for _, _, a, z in found:
        assert 0 <= a < z <= len(text)


def test_longest_rule_first():
    names, left = licences.match_rules(licences.sentence_ids(APACHE))
    assert names == ["Apache-2.0"] and [x[0] for x in licences.sentence_ids(APACHE)][:3] == ["ApacheLic", "ApacheUse", "ApacheCopy"]
    assert left == 0


def test_licence_scan(spark, odd_docs, no_docs):
    ship(spark)
    texts = ["Long. " * 30_000 + "\nReleased under the MIT License.", "no mark", None, "é\nLICENSED UNDER THE APACHE LICENSE, VERSION 2.0!"]
    got = {r["doc_id"]: r for r in licences.scan(frame(spark, texts)).collect()}
    assert [got[i]["licences"] for i in range(4)] == ["MIT", "", "", "Apache-2.0"]
    a, z = map(int, got[3]["spans"].split(":")[1:])
    assert texts[3][a:z].strip() == "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0"
    assert licences.scan(odd_docs).count() == odd_docs.count() and licences.scan(no_docs).count() == 0


# ---------------------------------------------------------------- decontamination

def plain_alignment(a, b):
    best, rows = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            rows[i][j] = max(0, rows[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), rows[i - 1][j] - 1, rows[i][j - 1] - 1)
            best = max(best, rows[i][j])
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=14), st.lists(st.integers(0, 4), max_size=20))
def test_alignment(a, b):
    value, start, end = decontaminate.align(np.array(a, np.uint64), np.array(b, np.uint64))
    assert value == plain_alignment(a, b)
    if value:  # the span alone gives the same value
        assert plain_alignment(a, b[start:end]) == value


def edited(rng, text, share):
    out = []
    for w in text.split():
        x = rng.random()
        if x < share / 3:
            continue
        out.append(f"changed{rng.randrange(99)}" if x < 2 * share / 3 else w)
        if x > 1 - share / 3:
            out.append("added")
    return " ".join(out)


def test_leaks(spark, odd_docs, no_docs):
    ship(spark)
    rng = random.Random(7)
    items = [prose(rng, rng.randint(25, 60), 3000) for _ in range(30)] + ["tiny item", "", None]
    texts, truth = [], set()
    for i in range(300):
        body = prose(rng, rng.randint(30, 300), 3000)
        if i < 120:
            k = 0 if i < 60 else i % 30  # one item leaked very often
            text = items[k] if i % 3 else edited(rng, items[k], 0.25)
            body = f"{body} {text.upper() if i % 5 == 0 else text}, {prose(rng, 20, 3000)}"
            truth.add((i, k))
        texts.append(body)
    texts.append("a tiny, item inside")
    truth.add((300, 30))
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, score string")
    docs = frame(spark, texts).repartition(3)
    got = decontaminate.find(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == truth
    for r in got:
        assert 0.4 <= r["score"] <= 1 and texts[r["doc_id"]][r["start"]:r["end"]].strip()
    whole = [r for r in got if r["doc_id"] < 120 and r["doc_id"] % 3]
    assert all(r["score"] == 1 and texts[r["doc_id"]][r["start"]:r["end"]].lower() == items[r["item_id"]].lower() for r in whole)
    # items in several blocks: the same leaks
    some = decontaminate.find(docs, bench, block_words=300).collect()
    assert {(r["doc_id"], r["item_id"]) for r in some} == truth
    left = docs.where(~decontaminate.leaks(docs, bench, F.col("text")))
    assert {r["doc_id"] for r in left.collect()} == set(range(301)) - {d for d, _ in truth}
    assert decontaminate.find(odd_docs, bench).count() == 0 and decontaminate.find(no_docs, bench).count() == 0
    assert decontaminate.find(docs, bench.limit(0)).count() == 0
    assert odd_docs.where(~decontaminate.leaks(odd_docs, bench, F.col("text"))).count() == odd_docs.count()


# ---------------------------------------------------------------- toxicity

def test_nearest_is_exact():
    rng = np.random.default_rng(5)
    for _ in range(20):
        n, terms = int(rng.integers(1, 400)), 30
        vecs = []
        for _ in range(n):
            t = np.sort(rng.choice(terms, rng.integers(1, 6), replace=False))
            w = rng.integers(1, 4, len(t)).astype(float)
            vecs.append((t, w / np.sqrt((w * w).sum())))
        index = toxicity.BlockMax(terms, vecs, np.zeros(n))
        asked = [np.sort(rng.choice(terms, rng.integers(1, 5), replace=False)) for _ in range(20)]
        at, skip = np.r_[0, np.cumsum([len(t) for t in asked])], rng.integers(-1, n, 20)
        who, near, cosine = index.nearest(at, np.concatenate(asked), np.full(at[-1], 0.5), 7, skip)
        for q, t in enumerate(asked):
            full = np.zeros(n)
            for i, (x, y) in enumerate(vecs):
                full[i] = sum(0.5 * b for a, b in zip(x, y) if a in t)
            if skip[q] >= 0:
                full[skip[q]] = 0
            order = [i for i in np.lexsort((np.arange(n), -full.round(12))) if full[i] > 0][:7]
            assert near[who == q].tolist() == order
            assert np.allclose(cosine[who == q], full[order])
    assert not len(toxicity.BlockMax(3, [], np.zeros(0)).nearest(np.array([0, 1]), np.array([1]), np.ones(1), 3)[0])


def test_scores_equal_brute_force(spark):
    """Terms, IDF over all documents, cosines, votes and steps without index, keys or blocks of texts."""
    ship(spark)
    texts, y = toxic_corpus(11, 400)
    docs = frame(spark, texts).repartition(3)
    labels = spark.createDataFrame([(i, v) for i, v in enumerate(y) if i % 2], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, k=5)

    def strings(text):
        words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())
        return [("word", w) for w in words] + [("start", w[:p]) for w in words for p in toxicity.PREFIXES if len(w) > p]

    def key(kind, string):
        b = next(toxicity.blocks(pa.array([string + ("x" if kind == "start" else "")]), fold=True, breaks=toxicity.BREAKS))
        return int(toxicity.features(b)[0][0] if kind == "word" else toxicity.features(b)[0][1 + toxicity.PREFIXES.index(len(string))])

    every = [strings(t) for t in texts]
    chosen = {f for fs in every for f in fs if key(*f) in set(model.terms.keys.tolist())}
    assert len(chosen) == len(model.terms.keys) > 10
    idf = {f: math.log1p(len(texts) / sum(f in fs for fs in every)) for f in chosen}

    def vector(fs):
        w = {f: (1 + math.log(fs.count(f))) * idf[f] for f in set(fs) & chosen}
        size = math.sqrt(sum(x * x for x in w.values()))
        return {f: x / size for f, x in w.items()}

    vectors, learnt = [vector(fs) for fs in every], set(model.names.tolist())
    got = {r["doc_id"]: r["score"] for r in docs.select("doc_id", toxicity.toxicity(model, docs, F.col("text")).alias("score")).collect()}
    rank = {int(d): i for i, d in enumerate(model.names)}
    for d, v in enumerate(vectors):
        cosines = [(round(c, 12), -rank[e], c, e) for e in learnt if (c := sum(x * vectors[e].get(f, 0) for f, x in v.items())) > 0]
        best = sorted(cosines, reverse=True)[:5]
        pull = [(1 / (0.02 + 1 - min(c, 1)), y[e]) for *_, c, e in best]
        want = model.calibrated(sum(p * t for p, t in pull) / sum(p for p, _ in pull)) if pull else model.none
        assert math.isclose(got[d], want, abs_tol=1e-9)


def test_steps_rise_and_average():
    x = np.array([0.1, 0.1, 0.2, 0.3, 0.4, 0.9])
    y = np.array([0, 1, 0, 1, 0, 1.0])
    edges, steps = toxicity.rising_steps(x, y)
    assert (np.diff(steps) >= 0).all()
    fitted = steps[np.searchsorted(edges, x)]
    assert math.isclose(fitted.mean(), y.mean())


def toxic_corpus(seed, n=900):
    rng = random.Random(seed)
    bad = ["vile", "scumbag", "rotten", "idiotic"]
    texts, labels = [], []
    for i in range(n):
        w = prose(rng, rng.randint(20, 120)).split()
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(rng.randint(1, 5)):  # inflected forms share their beginning
                w.insert(rng.randrange(len(w)), rng.choice(bad) + rng.choice(["", "s", "ness", "ly", "!"]))
        texts.append(" ".join(w))
        labels.append(int(toxic))
    return texts, labels


def test_toxicity(spark, odd_docs, no_docs):
    ship(spark)
    texts, y = toxic_corpus(3)
    docs = frame(spark, texts).repartition(3)
    rows = [(i, v) for i, v in enumerate(y) if i % 5 < 3] + [(0, y[0]), (10**6, 1), (None, 1), (4, None)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    scored = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held"), toxicity.toxicity(model, docs, F.col("text")).alias("score"),
                         toxicity.evidence(model, docs, F.col("text")).alias("why")).collect()
    unseen = [r for r in scored if r["held"] or r["doc_id"] % 5 >= 3]
    hits = [(r["score"] >= 0.3) == bool(y[r["doc_id"]]) for r in unseen]
    assert len(hits) > 300 and sum(hits) / len(hits) > 0.97
    assert all(0 <= r["score"] <= 1 for r in scored)
    learnt = {i for i, _ in rows if i is not None and i < 900}
    for r in scored:
        for e in r["why"] or []:
            assert e["doc_id"] in learnt and 0 < e["cosine"] <= 1 + 1e-9 and e["toxic"] == y[e["doc_id"]]
    # labels that may not be learnt from change nothing
    import zlib
    flipped = [(i, 1 - v if i is not None and v is not None and zlib.crc32(str(i).encode()) % 4 == 2 else v) for i, v in rows]
    again = toxicity.fit(docs, spark.createDataFrame(flipped, "doc_id long, toxic int"))
    assert (again.terms.keys == model.terms.keys).all() and (again.steps == model.steps).all()
    assert odd_docs.select(toxicity.toxicity(model, odd_docs, F.col("text")).alias("s")).where("s between 0 and 1").count() == odd_docs.count()
    assert no_docs.select(toxicity.toxicity(model, no_docs, F.col("text"))).count() == 0
    blank = toxicity.fit(docs, labels.limit(0))
    assert blank.scores(pa.array(["x", None]))[0].tolist() == [0, 0]
    assert toxicity.fit(no_docs, labels).scores(pa.array(["x"]))[0].shape == (1,)


def test_term_counts():
    keys = np.unique(np.concatenate([toxicity.features(b)[0] for b in blocks(pa.array(["Alpha alphabet beta"]), fold=True, breaks=toxicity.BREAKS)]))
    terms = toxicity.Terms(keys, np.ones(len(keys)))
    got = [terms.counts(b) for b in blocks(pa.array(["alpha ALPHA, zz", None, "alphabets"]), fold=True, breaks=toxicity.BREAKS)][0]
    by_doc = Counter()
    for d, _, n in zip(*got):
        by_doc[int(d)] += int(n)
    # alpha twice: the word and its beginning of four; alphabets: beginnings of 4, 5, 6 and 7
    assert by_doc[0] == 4 and by_doc[2] == 4 and 1 not in by_doc


# ---------------------------------------------------------------- secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_of(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{z}" for a, k, z in sorted(out))


def test_base_spans(spark, odd_docs):
    rng = random.Random(1)
    bits = ["password", "Secret", "api_key", "APIKEY", "token", "=", ":", " ", '"', "'", "abc", "abcdef", "0123456789abcdef" * 2, "AKIA", "ABCDEFGH01234567",
            "é", "\n", "日", "secret=token: ", "x.y-z+/=", "passwd", "K", "\U0001f600"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(400)] + ["token=abcdef " * 3000, "a" * 100_000]
    texts += [r["text"] for r in odd_docs.collect()]
    docs = frame(spark, texts)
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", secrets.joined(secrets.base_spans(F.col("text"))).alias("s")).collect()}
    assert [got[i] for i in range(len(texts))] == [base_of(t or "") for t in texts]


def test_random_strings_and_masks(spark, odd_docs, no_docs):
    rng = random.Random(2)
    prng = random.Random(9)
    alphabets = [string.ascii_letters + string.digits, string.ascii_lowercase + string.digits, string.ascii_uppercase + "234567"]
    texts, planted, plain = [], [], []
    for i in range(400):
        secret = "".join(rng.choice(alphabets[i % 3]) for _ in range(rng.choice([32, 40, 44, 64])))
        name = "-".join(prng.choice(["user", "order", "value", "name", "list", "item"]) for _ in range(8)) + f"-{i % 10}"
        same = prng.choice("xyzw") * 30 + "0000000000"
        texts.append(f"{prose(rng, 12)} {secret} tail {name} {same}é")
        planted.append(secret)
        plain.append((name, same))
    docs = frame(spark, texts).withColumn("spans", F.lit("clash"))
    clean = secrets.without_secrets(docs)
    assert clean.columns == docs.columns
    rows = {r["doc_id"]: r for r in clean.collect()}
    caught = sum(planted[i] not in rows[i]["text"] for i in rows)
    wrong = sum(x not in rows[i]["text"] for i in rows for x in plain[i])
    masked = sum(rows[i]["text"].count(secrets.MASK) for i in rows)
    assert caught >= 0.85 * len(texts) and wrong <= 0.06 * max(1, masked)
    assert all(r["n_chars"] == len(r["text"]) and r["text"].endswith("é") for r in rows.values())
    odd = secrets.without_secrets(odd_docs)
    assert odd.count() == odd_docs.count() and odd.where("text is null").count() == 1 and odd.columns == odd_docs.columns
    assert secrets.without_secrets(no_docs).count() == 0
    over = frame(spark, ["x token=0123456789abcdef0123456789abcdef y", "password: abcdefgh, secret=ijklmnop"])
    assert [r["text"] for r in secrets.without_secrets(over).orderBy("doc_id").collect()] == [f"x {secrets.MASK} y", f"{secrets.MASK}, {secrets.MASK}"]


def test_battery_is_uniform_on_random_strings(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice(string.ascii_letters + string.digits) for _ in range(60)) + "aB1" for _ in range(600)]
    p = [r["p"] for r in frame(spark, texts).select(F.explode(secrets.candidates(F.col("text"))).alias("c")).select("c.p").collect()]
    assert len(p) == 600 and 0.4 < statistics.mean(p) < 0.6 and sum(x < 0.05 for x in p) < 60


# ---------------------------------------------------------------- outliers

def brute_statistics(text):
    t = text or ""
    w = words_of(t)
    lines = [x for x in t.split("\n") if words_of(x)]
    count = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if count[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))


def test_statistics(spark, odd_docs):
    rng = random.Random(6)
    texts = ["".join(rng.choice(["a ", "b ", "#x ", "é\t", "\n", "a b c d e f g h ", "\n\n", "$%", "\x0c"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    docs = frame(spark, texts + [r["text"] for r in odd_docs.collect()])
    rows = outliers.statistics(docs).withColumn("failed", outliers.base_failed()).collect()
    want = {r["doc_id"]: brute_statistics(r["text"]) for r in docs.collect()}
    assert {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["failed"]) for r in rows} == want


def test_outliers(spark, odd_docs, no_docs):
    rng = random.Random(11)
    rows = []
    for i in range(1300):
        lang, source = ("en", "hot") if i % 3 else (None, "small") if i % 30 == 0 else ("de", "other")
        text = prose(rng, int(math.exp(rng.gauss(5, 0.5))) + 30)
        if i % 25 == 1:
            text = " ".join(w + "#$%" for w in text.split())
        rows.append((i, text, lang, source, 0))
    got = {r["doc_id"]: r for r in outliers.judged(spark.createDataFrame(rows, DOCS).withColumn("g", F.lit("clash"))).collect()}
    assert len(got) == 1300
    junk = [i for i in got if i % 25 == 1]
    assert not any(got[i]["kept"] for i in junk)
    clean = [i for i in got if i % 25 != 1]
    assert sum(got[i]["kept"] for i in clean) > 0.995 * len(clean)
    few = outliers.judged(odd_docs).collect()
    assert len(few) == odd_docs.count() and all(r["distance"] is None and r["kept"] == (not r["base_failed"]) for r in few)
    assert outliers.judged(no_docs).count() == 0


def test_single_faults_are_outliers(spark):
    """Half of the lines repeated, or a quarter of symbols, in a clean group; very long clean texts stay."""
    rng = random.Random(12)
    rows = [(i, "\n".join(prose(rng, 12) for _ in range(rng.randint(8, 40))), "en", "clean", 0) for i in range(600)]
    rows[3] = (3, "\n".join(prose(rng, 12) for _ in range(400)), "en", "clean", 0)
    for i in (10, 11, 12):
        short = prose(rng, 3)   # between long lines: no window of eight words occurs twice
        rows[i] = (i, "\n".join(f"{short}\n{short}\n{prose(rng, 30)}" for _ in range(6)), "en", "clean", 0)
    for i in (20, 21, 22):
        words = prose(rng, 200).split()
        rows[i] = (i, " ".join("#" * round(len(w) * 0.35) + w for w in words), "en", "clean", 0)
    found = outliers.judged(spark.createDataFrame(rows, DOCS)).collect()
    gone = {r["doc_id"] for r in found if not r["kept"]}
    planted = {10, 11, 12, 20, 21, 22}
    assert not any(r["base_failed"] for r in found if r["doc_id"] in planted)
    assert planted <= gone and 3 not in gone and len(gone) <= 6 + 3


def test_least_determinant(spark):
    """A start that a far cluster of a fifth has bent is not the one that is kept."""
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (1000, outliers.D)) * [2000, 300, 900, 1500, 1300, 900]
    x[:200] = rng.normal(0, 1, (200, outliers.D)) * 50 + [9000, 3000, 9000, 9000, 9000, 9000]
    rows = spark.createDataFrame([("g", *map(int, r)) for r in np.round(x)], "g string, " + ", ".join(f"x{i} long" for i in range(outliers.D)))
    starts = outliers._starts(rows).collect()
    assert sorted(r["start"] for r in starts) == [0, 1, 2]
    got = outliers.least_determinant(rows)
    assert got.count() == 1
    far = rows.join(got, "g").withColumn("d", outliers._distance())
    bound = outliers.chi2_quantile(outliers.QUANTILE, outliers.D)
    assert far.where(F.col("d") > bound).count() >= 200
    assert far.where((F.col("d") > bound) & (F.col("x0") < 6000)).count() < 20


def test_concentration_against_numpy(spark):
    """Mean and covariance of one step equal those of numpy on the same rows."""
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(0, 1, (500, outliers.D)) * [1500, 900, 2000, 1200, 1100, 1000] + 7000).astype(int)
    rows = spark.createDataFrame([("g", *map(int, r)) for r in x], "g string, " + ", ".join(f"x{i} long" for i in range(outliers.D)))
    first = outliers._first(rows)
    near = rows.join(first, "g").withColumn("d", outliers._distance()).collect()
    d = np.array([r["d"] for r in near])
    bins = np.floor(np.log(d + 1e-6) * 50)
    cut = np.sort(bins)[int(np.ceil(outliers.SHARE * len(d))) - 1]
    y = np.array([[r[f"x{i}"] for i in range(outliers.D)] for r in near])[bins <= cut]
    cov = np.cov(y.T, bias=True)
    floors = np.array([(f * outliers.UNIT) ** 2 for _, f in outliers.VECTOR])
    np.fill_diagonal(cov, np.maximum(np.diag(cov), floors))
    got = outliers._concentrated(rows, first, 1.0).first()
    assert np.allclose([got[f"m{i}"] for i in range(outliers.D)], y.mean(axis=0))
    w = np.array([[got[f"w{i}_{j}"] if j <= i else 0 for j in range(outliers.D)] for i in range(outliers.D)])
    assert np.allclose(w @ cov @ w.T, np.eye(outliers.D), atol=1e-6)
    assert math.isclose(outliers.chi2_cdf(outliers.chi2_quantile(0.75, 6), 6), 0.75, rel_tol=1e-9)


def test_digest_of_no_span():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c4")


def test_a_block_holds_a_bounded_part_of_a_batch():
    """Whatever the batch, the arrays of the block in hand are what a worker holds beside it."""
    import tracemalloc

    import pyarrow as pa

    from emporion.llm import blocks

    texts = pa.array(["some words of a text that goes on and on " * 40] * 2500)  # 4 MB
    tracemalloc.start()
    n = 0
    for b in blocks.blocks(texts, fold=True):
        n += len(b.shingles(5)[0])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 2500 * (400 - 4) and peak < 80 << 20, peak >> 20

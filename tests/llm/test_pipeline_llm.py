import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from emporion.llm.common import scratch
from emporion.llm.queries import ORACLE, QUERIES
from llm_cases import DOCS, prose


@pytest.fixture(scope="module")
def tables(spark):
    """A small corpus with every kind of row that a stage acts on."""
    rng = random.Random(21)
    rows, kind = [], {}

    def add(text, what):
        kind[len(rows)] = what
        rows.append((len(rows), text, "en", "s", len(text or ""), "x"))

    items = [prose(rng, 40, 3000) for _ in range(8)]
    for i in range(300):
        add(prose(rng, rng.randint(40, 200), 2000), "clean")
        if i % 6 == 0:
            add(f"{prose(rng, 60, 2000)} vile rotten scumbag {prose(rng, 30, 2000)} vile", "toxic")
    for i in range(12):
        add(f"{prose(rng, 30, 2000)} {items[i % 8]} {prose(rng, 30, 2000)}", "leak")
    for _ in range(10):
        text = prose(rng, 150, 2000)
        add(text, "first")
        add(text + " one more", "copy")
        add(text.replace(" ", "  "), "copy")
    for i in range(10):
        add(f"{prose(rng, 50, 2000)} password = hunter{i:06d}x and more", "secret")
    add(None, "clean")
    add("", "clean")
    path = scratch(spark, "test-tables")
    docs = spark.createDataFrame(rows, f"{DOCS}, score string")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(d, int(k == "toxic")) for d, k in kind.items() if d % 2], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, kind, docs


def test_stages(spark, tables):
    path, kind, docs = tables
    now, kept = corpus_pipeline.table(spark, path, "documents"), {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = scratch(spark, "test-stage")
        stage(spark, now, path).write.parquet(out)
        now = spark.read.parquet(out)
        if name != "best_fit_packing":
            assert now.columns == docs.columns
        kept[name] = {r["doc_id"] for r in now.select("doc_id").collect()}
        if name == "secret_scans":
            texts = {r["doc_id"]: r for r in now.collect()}
    after = lambda what, name: {d for d, k in kind.items() if k == what and d in kept[name]}
    assert not after("toxic", "toxicity") and len(after("clean", "toxicity")) >= 300
    assert not after("copy", "ngram_jaccard_join") and len(after("first", "ngram_jaccard_join")) == 10
    assert after("clean", "ngram_jaccard_join") >= after("clean", "toxicity") - {max(kind)}
    assert not after("leak", "benchmark_decontamination") and after("clean", "benchmark_decontamination") == after("clean", "ngram_jaccard_join")
    assert kept["secret_scans"] == kept["benchmark_decontamination"] == kept["best_fit_packing"]
    for d in after("secret", "secret_scans"):
        assert "hunter" not in texts[d]["text"] and "[SECRET]" in texts[d]["text"] and texts[d]["n_chars"] == len(texts[d]["text"])
    for d in after("clean", "secret_scans"):
        assert texts[d]["text"] == docs.where(F.col("doc_id") == d).first()["text"] if d % 40 == 0 else True
    rows = now.collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)


def test_run_equals_the_stages_and_takes_an_empty_table(spark, tables):
    path, _, docs = tables
    whole = corpus_pipeline.run(spark, path)
    assert whole.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and whole.count() > 250
    none = scratch(spark, "test-none")
    docs.limit(0).write.parquet(f"{none}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{path}/{t}.parquet").write.parquet(f"{none}/{t}.parquet")
    assert corpus_pipeline.run(spark, none).count() == 0


def test_registry():
    import __spark_entry__

    names = __spark_entry__.queries()
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(QUERIES) <= set(names) and set(ORACLE) <= set(QUERIES)

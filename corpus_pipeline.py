"""The corpus pipeline: stages over ``documents``, each one operator of ``emporion.llm``.

Each stage takes all that the one before it kept, and its decisions hold: toxic
texts go, one document of each class of near copies stays, texts that hold a
benchmark passage go, secrets are masked, and the rest is packed.

Defined results: null and empty texts pass every filter (they are clean); rows
without ``doc_id`` are kept; an empty table gives an empty result; columns that
the stages do not know are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporion.llm import decontaminate, jaccard, packing, secrets, toxicity
from emporion.llm.common import scratch, ship, table, written
from emporion.llm.queries import vocabulary

#: a text goes when its label 1 is likelier than not
TOXIC = 0.5


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    blank = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return docs.where(blank | (toxicity.toxicity(model, docs, F.col("text")) < TOXIC))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return jaccard.one_of_each(docs, k=5, percent=80)


def no_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return docs.where(~decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"), F.col("text")))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.without_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens, with the crc of their ids."""
    ship(spark)
    cut = written(packing.pieces(docs, vocabulary("word_bpe_49k.json")), "pieces")
    return packing.place(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("toxicity", not_toxic),
    ("ngram_jaccard_join", one_of_near_copies),
    ("benchmark_decontamination", no_benchmark_passages),
    ("secret_scans", secrets_masked),
    ("best_fit_packing", packed),
]
#: none of trained votes, tokenizers and packing is SQL; tested against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

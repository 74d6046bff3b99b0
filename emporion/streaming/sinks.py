"""Streaming sinks.

* ``raw_fanout_writer``: a foreachBatch function that writes the lake
  (partitioned by ``event_date``, then ``batch_id``), the landing copy and the
  quarantine of one parsed micro-batch.  Every output of batch n lives under
  ``batch_id=<n>`` and is overwritten, so a replayed batch (after a crash
  between write and commit) replaces itself.
* ``idempotent_batch_writer``: the same for a single output.
* ``keyed_upsert_writer`` + ``current_rows``: update-mode rows are written per
  batch with the batch id; readers take, per key, the row of the newest batch.
* relational targets are in ``relational.py``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BatchFn = Callable[[DataFrame, int], None]


def idempotent_batch_writer(path: str, drop: Sequence[str] = (), fmt: str = "parquet", jdbc: BatchFn | None = None) -> BatchFn:
    def write(batch_df: DataFrame, batch_id: int) -> None:
        out = batch_df.drop(*drop) if drop else batch_df
        if jdbc is not None:
            out.persist()
        try:
            out.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}")
            if jdbc is not None:
                jdbc(out, batch_id)
        finally:
            if jdbc is not None:
                out.unpersist()
    return write


def keyed_upsert_writer(path: str, then: BatchFn | None = None) -> BatchFn:
    """``then`` gets the batch after it is written, so it can read its keys' current rows."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        if then is not None:
            batch_df.persist()
        try:
            (batch_df.withColumn("_batch_id", F.lit(batch_id).cast("bigint"))
                     .write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}"))
            if then is not None:
                then(batch_df, batch_id)
        finally:
            if then is not None:
                batch_df.unpersist()
    return write


def raw_fanout_writer(lake: str, landing: str, rejected: str, valid_fn: Callable[[DataFrame], DataFrame],
                      rejected_fn: Callable[[DataFrame], DataFrame], jdbc: BatchFn | None = None) -> BatchFn:
    """One pass over a parsed micro-batch (persisted, as three outputs read it)."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.persist()
        try:
            bid = F.lit(batch_id).cast("bigint")
            ok = valid_fn(batch_df).withColumn("batch_id", bid)
            (ok.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("event_date", "batch_id").parquet(lake))
            landed = ok.drop("event_date", "batch_id")
            landed.write.mode("overwrite").parquet(f"{landing.rstrip('/')}/batch_id={batch_id}")
            rejected_fn(batch_df).write.mode("overwrite").parquet(f"{rejected.rstrip('/')}/batch_id={batch_id}")
            if jdbc is not None:
                jdbc(landed, batch_id)
        finally:
            batch_df.unpersist()
    return write


def current_rows(spark: SparkSession, path: str, keys: Sequence[str], only: Column | None = None) -> DataFrame:
    """Newest version of every key; ``only`` is a condition on keys."""
    rows = spark.read.parquet(path).drop("batch_id")
    if only is not None:
        rows = rows.where(only)
    value_cols = [c for c in rows.columns if c not in (*keys, "_batch_id")]
    return rows.groupBy(*keys).agg(*[F.max_by(c, F.col("_batch_id")).alias(c) for c in value_cols])


def make_folder(spark: SparkSession, path: str) -> None:
    """So that a file stream can start on a folder that another query will fill."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(where)


def batch_sink(df: DataFrame, fn: BatchFn, checkpoint: str, output_mode: str = "append",
               trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).outputMode(output_mode)
    if name:
        w = w.queryName(name)
    return w.trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def await_any(spark: SparkSession, queries: Sequence[StreamingQuery], timeout: float | None = None) -> None:
    """Block until any of the queries terminates (re-raises its error)."""
    spark.streams.resetTerminated()
    if timeout is None:
        spark.streams.awaitAnyTermination()
    else:
        spark.streams.awaitAnyTermination(timeout)
    for q in queries:
        if q.exception():
            raise q.exception()

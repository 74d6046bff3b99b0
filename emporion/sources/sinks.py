"""Batch sinks.

``write_partitions`` is the rerun-safe form of an hourly append: it replaces
only the partitions present in the DataFrame (dynamic partition overwrite),
so re-running an hour rewrites that hour instead of appending it twice.
Relational targets are in ``emporion.streaming.relational``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    (df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).save(path))

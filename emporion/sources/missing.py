"""Reading a path that may not be there yet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

#: the path does not exist, or holds no file; anything else is an error
NOT_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_parquet_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in NOT_THERE:
            return None
        raise

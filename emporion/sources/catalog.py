"""Product catalogue source (CSV with header, fixed schema, no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import PRODUCT_CATALOG


def read_catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=PRODUCT_CATALOG, mode="PERMISSIVE")

"""Small shared pieces of the operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python once per application, so that
    it need not be installed on them (Spark's own ``addPyFile``)."""
    sc = spark.sparkContext
    if not any(name.startswith("emporion-") for name in sc._python_includes or ()):
        package = Path(__file__).resolve().parent.parent
        to = Path(tempfile.mkdtemp(prefix="emporion-py-")) / f"emporion-{uuid.uuid4().hex[:8]}.zip"
        with zipfile.ZipFile(to, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f"{package.name}/{f.relative_to(package)}")
        sc.addPyFile(str(to))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    return scratch_path(spark, "llm", f"{what}-{uuid.uuid4().hex}")


def written(df: DataFrame, what: str, compression: str = "zstd") -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage is cut and
    it survives lost executors."""
    path = scratch(df.sparkSession, what)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """``df``, a written table of ids, marked for broadcast where its counted
    size allows (8 bytes a row); beyond that Spark joins it by a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df

"""Session helpers.

Library code never changes a running session's configuration; it only reads
it.  ``local_session`` is for tests, the bench and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "emporion") -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions",
                str(shuffle_partitions or os.environ.get("EMPORION_SHUFFLE_PARTITIONS") or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # local runs: tiny but CPU-heavy shuffles should still use every core
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.driver.memory", os.environ.get("EMPORION_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="emporion-warehouse-", dir="/tmp"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder
    and is used as is.  Only when it is unset and Spark runs in local mode
    (tests) a scratch folder is created and registered with
    ``SparkContext.setCheckpointDir``; on a cluster without the setting this
    raises instead of falling back to a machine-local folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster; "
                           "a machine-local scratch folder is only used in local mode")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="emporion-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never a machine-local tmp
    folder when the cluster names one)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python once per application, so that
    it need not be installed on them (Spark's own ``addPyFile``)."""
    sc = spark.sparkContext
    if not any(name.startswith("emporion-") for name in sc._python_includes or ()):
        package = Path(__file__).resolve().parent
        to = Path(tempfile.mkdtemp(prefix="emporion-py-")) / f"emporion-{uuid.uuid4().hex[:8]}.zip"
        with zipfile.ZipFile(to, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f"{package.name}/{f.relative_to(package)}")
        sc.addPyFile(str(to))

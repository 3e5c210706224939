"""Session settings used by tests and the benchmark, and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: str | int = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and local timing; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rillmark")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _unshared_dir() -> str:
    """One temporary folder per process, for sessions that name no shared one (tests on one machine)."""
    return tempfile.mkdtemp(prefix="rillmark-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, the shared folder the cluster names.

    Only a local session may go without that setting; on a cluster a machine's own temporary folder would not be seen by the
    other executors, so the missing setting is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _unshared_dir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def checkpointed(df, name: str):
    """Write ``df`` once to the shared folder and read it back.

    Used where a result feeds an iterative fit or several outputs: it cuts the lineage and survives the loss of
    executors, unlike cached blocks.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

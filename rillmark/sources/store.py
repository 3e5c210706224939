"""Feature store and datasets as partitioned Parquet: scans, retry-safe writes and dataset versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_events(
    spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
    schema: T.StructType | None = None, ts: str = "timestamp",
) -> DataFrame:
    """Event history in [start, end); the bounds are pushed to the Parquet footer statistics.

    Where the history is partitioned by ``date`` the same bounds also prune folders.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    kind = df.schema[ts].dataType.simpleString()
    for bound, after in ((start, True), (end, False)):
        if bound is None:
            continue
        limit = F.lit(bound).cast(kind)
        df = df.where(F.col(ts) >= limit) if after else df.where(F.col(ts) < limit)
        if "date" in df.columns:
            day = F.to_date(F.lit(bound))
            df = df.where(F.col("date") >= day) if after else df.where(F.col("date") <= day)
    return df


def scan_features(spark: SparkSession, root: str, kind: str, schema: T.StructType | None = None) -> DataFrame:
    """One feature table (``user_features``, ``item_features``, ``interaction_features``)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{root.rstrip('/')}/{kind}")


def write_features(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a table, or only the partitions present in ``df`` when it is partitioned."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def append_batch(df: DataFrame, batch_id: int, path: str, ts: str = "timestamp") -> None:
    """Store one micro-batch under its date and batch number; a retried batch replaces itself."""
    dated = df.withColumn("date", F.to_date(ts)).withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
    write_features(dated, path, ["batch_id", "date"])


def write_versioned(df: DataFrame, root: str, version: str) -> str:
    """Write one dataset version; every version is its own folder below ``root``."""
    path = f"{root.rstrip('/')}/version={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def list_values(spark: SparkSession, root: str, column: str) -> list[str]:
    """Values of a partition column, from folder names only; no data file is read."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{column}=*")
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(fs_path)
    return [s.getPath().getName().split("=", 1)[1] for s in (found or [])]


def is_directory(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).isDirectory()


def latest_version(spark: SparkSession, root: str) -> str | None:
    """Newest dataset version by name."""
    return max(list_values(spark, root, "version"), default=None)


def read_version(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    version = version or latest_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no dataset version below {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/version={version}")


def write_factors(model, path: str) -> None:
    """Latent factors of a fitted factorisation model, one table per side."""
    model.userFactors.write.mode("overwrite").parquet(f"{path}/user_factors")
    model.itemFactors.write.mode("overwrite").parquet(f"{path}/item_factors")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)

"""Tables behind a pointer: readers go by the newest manifest, writers add folders and then move the pointer by one rename.

A manifest is a small JSON file ``_manifest/v<number>.json`` below the table's root. It names the folders that make up the table, so
nothing a crashed writer left behind is ever read, and folders in use are never changed. Two writers that start from the
same version cannot both publish: the second one's rename fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.operators.profiles import upsert
from rillmark.sources.store import list_values

KEPT = 2  # versions whose folders stay readable after the pointer has moved on


class Conflict(RuntimeError):
    """Another writer has published the version this one wanted to."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions, oldest first."""
    return [int(n[1:-5]) for n in _names(spark, f"{root}/_manifest") if n.startswith("v") and n.endswith(".json")]


def read_manifest(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """The newest manifest, or that of a version; one of version 0 that names nothing if none is published."""
    if version is None:
        version = max(versions(spark, root), default=0)
    if not version:
        return {"version": 0, "folders": [], "upto": -1}
    fs, p = _fs(spark, f"{root}/_manifest/v{version:012d}.json")
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def publish(spark: SparkSession, root: str, manifest: dict) -> dict:
    """Make ``manifest`` (which holds the version it was made from) the newest one: written aside, then renamed."""
    new = manifest | {"version": manifest["version"] + 1}
    fs, target = _fs(spark, f"{root}/_manifest/v{new['version']:012d}.json")
    _, aside = _fs(spark, f"{root}/_manifest/_{uuid.uuid4().hex}.tmp")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(json.dumps(new, sort_keys=True).encode()))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise Conflict(f"version {new['version']} of {root} is already there")
    return new


def drop_unused(spark: SparkSession, root: str, kept: int = KEPT) -> list[str]:
    """Delete data folders that none of the last ``kept`` versions names, and the stream batches that they have all taken in.

    It runs after the pointer has moved. Folders of a writer that has not published yet are told by their names: each begins with the
    version it is to become, and only those of published versions go.
    """
    known = versions(spark, root)
    held = [read_manifest(spark, root, v) for v in known[-kept:]]
    used = {f for m in held for f in [*m["folders"], *m.get("of", {}).values()]}
    gone = [n for n in _names(spark, root) if n.startswith("data-") and n not in used and int(n.split("-")[1]) <= max(known, default=0)]
    done = min((m["upto"] for m in held), default=-1)
    gone += [f"batch_id={v}" for v in list_values(spark, root, "batch_id") if int(v) <= done]
    for name in gone:
        fs, p = _fs(spark, f"{root}/{name}")
        fs.delete(p, True)
    return sorted(gone)


def _new_folder(manifest: dict) -> str:
    return f"data-{manifest['version'] + 1:012d}-{uuid.uuid4().hex[:12]}"


def _read(spark: SparkSession, root: str, folders: Sequence[str]) -> DataFrame | None:
    return spark.read.parquet(*[f"{root}/{f}" for f in folders]) if folders else None


def read_batches(spark: SparkSession, root: str, merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A stream's table: what has been compacted and the newer batches, merged.

    ``merge`` maps rows of base and batches (with batch_id) to the table's rows, and must give the same for a table already merged:
    a sum of sums, or the newest row per key. A table that has never been compacted is read from its batches.
    """
    manifest = read_manifest(spark, root)
    base = _read(spark, root, manifest["folders"])
    newer = sorted(int(v) for v in list_values(spark, root, "batch_id") if int(v) > manifest["upto"])
    if not newer and base is None:
        raise FileNotFoundError(f"no batch and no snapshot below {root}")
    if not newer:
        return base.drop("batch_id")
    rows = spark.read.option("basePath", root).parquet(*[f"{root}/batch_id={v}" for v in newer])
    rows = rows if base is None else base.unionByName(rows, allowMissingColumns=True)
    return merge(rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))).drop("batch_id")


def compact(spark: SparkSession, root: str, merge: Callable[[DataFrame], DataFrame]) -> dict:
    """Merge base and newer batches into a new base and move the pointer. A retry after a crash starts from what is published.

    Batches stay until :func:`drop_unused`; the last one is left out, since a stream that restarts may write it again.
    """
    manifest = read_manifest(spark, root)
    newer = sorted(int(v) for v in list_values(spark, root, "batch_id") if int(v) > manifest["upto"])[:-1]
    if not newer:
        return manifest
    rows = spark.read.option("basePath", root).parquet(*[f"{root}/batch_id={v}" for v in newer])
    base = _read(spark, root, manifest["folders"])
    rows = rows if base is None else base.unionByName(rows, allowMissingColumns=True)
    folder = _new_folder(manifest)
    merge(rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))).write.parquet(f"{root}/{folder}")
    return publish(spark, root, manifest | {"folders": [folder], "upto": newer[-1]})


def create_table(df: DataFrame, root: str, key: str, buckets: int = 64) -> dict:
    """A table dealt into buckets by the hash of its key, one folder each."""
    spark = df.sparkSession
    manifest = read_manifest(spark, root) | {"key": key, "buckets": buckets}
    return publish(spark, root, manifest | {"folders": [], "of": _write_buckets(df, root, manifest)})


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _write_buckets(df: DataFrame, root: str, manifest: dict) -> dict[str, str]:
    """Write rows under a new folder by bucket; bucket → folder of those that have rows."""
    folder = _new_folder(manifest)
    df.withColumn("bucket", _bucket(manifest["key"], manifest["buckets"])).repartition("bucket").write.partitionBy(
        "bucket").parquet(f"{root}/{folder}")
    return {v: folder for v in list_values(df.sparkSession, f"{root}/{folder}", "bucket")}


def _schema_of(spark: SparkSession, root: str, manifest: dict):
    return spark.read.parquet(f"{root}/{next(iter(sorted(manifest['of'].items())))[1]}").drop("bucket").schema


def read_table(spark: SparkSession, root: str, version: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
    """Rows of a table made by :func:`create_table`, of some buckets if ``only`` names them."""
    manifest = read_manifest(spark, root, version)
    paths = [f"{root}/{f}/bucket={b}" for b, f in sorted(manifest["of"].items()) if only is None or int(b) in only]
    schema = _schema_of(spark, root, manifest)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def upsert_table(updates: DataFrame, root: str, order: Sequence[str]) -> dict:
    """Apply partial updates (see ``profiles.upsert``) to a table, reading and writing only the buckets that have any.

    The buckets' numbers are what reaches the driver. Untouched buckets keep their files; the new folders take their place when the
    pointer moves, so readers see all of an update or nothing. A second writer at the same time gets a Conflict and may try again.
    """
    spark = updates.sparkSession
    manifest = read_manifest(spark, root)
    touched = [r[0] for r in updates.select(_bucket(manifest["key"], manifest["buckets"])).distinct().collect()]
    if not touched:
        return manifest
    merged = upsert(read_table(spark, root, manifest["version"], touched), updates, manifest["key"], order)
    new = _write_buckets(merged, root, manifest)
    return publish(spark, root, manifest | {"of": manifest["of"] | new})


def drop_days(spark: SparkSession, root: str, before: str, column: str = "date") -> list[str]:
    """Retention of a table partitioned by day: delete the folders of the days before ``before`` (YYYY-MM-DD)."""
    gone = sorted(v for v in list_values(spark, root, column) if v < before)
    for v in gone:
        fs, p = _fs(spark, f"{root}/{column}={v}")
        fs.delete(p, True)
    return gone

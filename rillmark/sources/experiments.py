"""Experiment, assignment and metric tables: fixed schemas, checks on what is written, readers by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.operators.experiments import sticky
from rillmark.schemas import ASSIGNMENT, EXPERIMENT, METRIC
from rillmark.sources.store import write_features

TABLES = {"experiments": EXPERIMENT, "assignments": ASSIGNMENT, "metrics": METRIC}

# Values a column may have. Fixed values of the contract.
STATUSES = ("active", "paused", "completed")
GROUPS = ("control", "treatment")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` by name, in its order and types; one that is missing is null."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def _reasons(kind: str) -> list[tuple[Column, str]]:
    missing = {"experiments": ("experiment_id", "name", "control_version", "treatment_version"),
               "assignments": ("user_id", "experiment_id", "group"),
               "metrics": ("experiment_id", "group", "metric_name", "metric_value")}[kind]
    out = [(F.col(c).isNull(), f"{c}_missing") for c in missing]
    if kind == "experiments":
        out += [(~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False)), "status_unknown"),
                (~F.coalesce(F.col("traffic_percentage").between(0, 100), F.lit(False)), "traffic_out_of_range")]
    else:
        out.append((~F.coalesce(F.col("group").isin(*GROUPS), F.lit(True)), "group_unknown"))
    return out


def checked(df: DataFrame, kind: str) -> DataFrame:
    """Rows in the table's schema with ``reasons``: what keeps a row out of the table, an empty list if nothing does.

    A name that several experiments have counts for the oldest of them (ties: the smaller id).
    """
    rows = conform(df, TABLES[kind]).withColumn("reasons", F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, r in _reasons(kind)])))
    if kind != "experiments":
        return rows
    place = F.struct(F.coalesce("created_at", F.lit("9999-12-31").cast("timestamp")).alias("t"), "experiment_id")
    first = rows.where("name IS NOT NULL").groupBy(F.col("name").alias("_name")).agg(F.min(place).alias("_first"))
    joined = rows.join(first, F.col("name") == F.col("_name"), "left")
    taken = F.col("_first").isNotNull() & (place != F.col("_first"))
    return joined.withColumn("reasons", F.when(taken, F.array_append("reasons", F.lit("name_taken"))).otherwise(F.col("reasons"))).drop(
        "_name", "_first")


def write_table(df: DataFrame, root: str, kind: str) -> None:
    """Replace a table by the rows of ``df`` that pass the checks; of assignments the first per user and experiment.

    Metrics are partitioned by day, of which only those in ``df`` are replaced.
    """
    rows = checked(df, kind).where(F.size("reasons") == 0).drop("reasons")
    if kind == "assignments":
        rows = conform(sticky(rows, rows.where(F.lit(False))), ASSIGNMENT)
    if kind == "metrics":
        write_features(rows.withColumn("date", F.to_date("timestamp")), f"{root}/{kind}", ["date"])
    else:
        write_features(rows, f"{root}/{kind}")


def read_table(spark: SparkSession, root: str, kind: str, since: str | None = None) -> DataFrame:
    """A table in its schema; of metrics those from the day ``since`` on, by folder."""
    schema = TABLES[kind]
    if kind != "metrics":
        return spark.read.schema(schema).parquet(f"{root}/{kind}")
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("date", T.DateType())])).parquet(f"{root}/{kind}")
    return (rows if since is None else rows.where(F.col("date") >= F.lit(since).cast("date"))).drop("date")

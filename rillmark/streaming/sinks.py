"""Stream sinks. Every micro-batch is written under its batch number, so a retried batch replaces itself."""

from __future__ import annotations

import dataclasses
import time
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillmark.functions.columns import safe_ratio
from rillmark.operators import driftcounts as dc
from rillmark.operators import features as ft
from rillmark.operators import models as ml
from rillmark.operators import sketches as sk
from rillmark.operators.monitor import RetrainRule, advance_retrain_state
from rillmark.sources.snapshots import read_batches
from rillmark.sources.store import write_features

EVERY = "30 seconds"


def _start(df: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str, mode: str, every: str,
           once: bool) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(handler).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start()


def batch_writer(path: str, partitions: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """Handler that stores a micro-batch in one write; nothing is collected, counted or written twice."""
    def write(df: DataFrame, batch_id: int) -> None:
        tagged = df.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
        write_features(tagged, path, ["batch_id", *partitions])
    return write


def start_feature_query(
    df: DataFrame, path: str, checkpoint: str, mode: str = "update", every: str = EVERY, once: bool = False,
    partitions: Sequence[str] = (),
) -> StreamingQuery:
    """Write a feature stream. Update mode shows a window while it is open; append waits for the watermark."""
    return _start(df, batch_writer(path, partitions), checkpoint, mode, every, once)


def read_latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current rows of an update-mode table: the newest batch of every key, from the last snapshot on."""
    return read_batches(spark, path, newest_rows(keys))


def newest_rows(keys: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """How an update-mode table is merged: the row of the newest batch of every key."""
    def merge(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(F.desc("batch_id"))
        return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    return merge


def summed_state(key: str) -> Callable[[DataFrame], DataFrame]:
    """How a table of state deltas is merged: sums and the latest time per key."""
    sums = ("interaction_count", "rating_sum", "rating_n", "views", "clicks")

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(key).agg(*[F.sum(c).alias(c) for c in sums],
                                     F.max("last_active_timestamp").alias("last_active_timestamp"))
    return merge


def start_ingest(df: DataFrame, path: str, checkpoint: str, every: str = EVERY, once: bool = False) -> StreamingQuery:
    """Store checked events; valid ones and dead letters go to folders ``valid=true`` and ``valid=false`` in one write."""
    return _start(df, batch_writer(path, ["valid"]), checkpoint, "append", every, once)


def start_report(df: DataFrame, path: str, checkpoint: str, every: str = EVERY, once: bool = False) -> StreamingQuery:
    """Store the report parts of every micro-batch of checked events by day; ``sketches.report_of`` puts them together on read."""
    def write(batch: DataFrame, batch_id: int) -> None:
        parts = sk.report_parts(batch.withColumn("day", F.to_date("timestamp").cast("string")), ["day"])
        batch_writer(path)(parts, batch_id)
    return _start(df, write, checkpoint, "append", every, once)


def start_drift(df: DataFrame, path: str, checkpoint: str, monitor: DriftMonitor, every: str = EVERY, once: bool = False) -> StreamingQuery:
    """Count every micro-batch in the bins of a drift reference, and store the trailing index per column below ``path``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        monitor.add(batch, batch_id)
        batch_writer(path)(monitor.index(batch.sparkSession, batch_id), batch_id)
    return _start(df, write, checkpoint, "append", every, once)


def merged_report(rows: DataFrame) -> DataFrame:
    """How a table of report parts is compacted."""
    return sk.merged_parts(rows, ["day"])


def land_raw(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Topic events to the raw store by date and hour, with the exactly-once file sink."""
    dated = df.withColumn("date", F.to_date("timestamp")).withColumn("hour", F.hour("timestamp"))
    writer = dated.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.partitionBy("date", "hour").outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 hour")).start()


def _previous(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """Rows of the newest batch before this one, or None at the start."""
    from rillmark.sources.store import list_values
    earlier = [int(v) for v in list_values(spark, path, "batch_id") if int(v) < batch_id]
    return spark.read.parquet(f"{path}/batch_id={max(earlier)}") if earlier else None


@dataclasses.dataclass(frozen=True)
class DriftMonitor:
    """Drift of a stream against a stored reference (``driftcounts.drift_reference``), over the last ``batches`` micro-batches.

    Each batch is counted once, in its bins; windows are read from the counts below ``path``.
    """

    reference: DataFrame
    columns: tuple[str, ...]
    path: str
    batches: int = 24

    def add(self, df: DataFrame, batch_id: int) -> None:
        batch_writer(self.path)(dc.drift_counts(df, self.reference, self.columns), batch_id)

    def index(self, spark: SparkSession, upto: int) -> DataFrame:
        """The index per column of the window that ends with a batch."""
        return dc.psi(dc.trailing(spark.read.parquet(self.path), upto, self.batches), self.reference)

    def score(self, df: DataFrame, batch_id: int) -> Column:
        self.add(df, batch_id)
        return dc.drift_score(self.index(df.sparkSession, batch_id)).scalar()


def online_update(
    root: str, factors: DataFrame, started_at: str, model: str = "als", reg: float = 0.1, rule: RetrainRule = RetrainRule(),
    drift: Callable[[DataFrame], float] | None = None, monitor: DriftMonitor | None = None,
) -> Callable[[DataFrame, int], None]:
    """Handler for raw events: batch features per user and item, folded-in user factors, and the retrain state.

    The k x k inverse of the item factors is computed once. The tables below ``root`` are user_delta, item_delta, user_factors,
    retrain and metrics (rows, seconds and whether a retrain fired); each holds one folder per batch, so a retry after a
    failure repeats a batch without doubling it. A batch is read once: it is held while its tables are written. The drift that the
    retrain rule looks at comes from ``monitor``, by the counts of a trailing window of batches, or from a function of the batch.
    """
    inverse = ml.gram_inverse(factors, reg)

    def handle(df: DataFrame, batch_id: int) -> None:
        spark, began = df.sparkSession, time.monotonic()
        events = df.persist(StorageLevel.MEMORY_AND_DISK).select("user_id", "item_id", "event_type", "rating", "timestamp")
        for key, name in (("user_id", "user_delta"), ("item_id", "item_delta")):
            batch_writer(f"{root}/{name}")(ft.entity_state(events, key), batch_id)
        weighted = events.select("user_id", "item_id", F.coalesce("rating", F.lit(1.0)).alias("rating"), "timestamp")
        batch_writer(f"{root}/user_factors")(ml.fold_in(weighted, factors, reg, inverse), batch_id)
        score = monitor.score(df, batch_id) if monitor else F.lit(drift(df) if drift else 0.0)
        stats = events.groupBy().agg(F.count("*").alias("events"), F.max("timestamp").alias("at")).select(
            F.lit(model).alias("model"), "events", score.alias("drift_score"), "at")
        before = _previous(spark, f"{root}/retrain", batch_id)
        if before is None:
            before = spark.range(1).select(
                F.lit(model).alias("model"), F.lit(0).cast("bigint").alias("events_since"),
                F.lit(started_at).cast("timestamp").alias("last_retrain"))
        batch_writer(f"{root}/retrain")(
            advance_retrain_state(before.select("model", "events_since", "last_retrain"), stats, rule), batch_id)
        fired = spark.read.parquet(f"{root}/retrain/batch_id={batch_id}").agg(F.coalesce(F.bool_or("retrain"), F.lit(False))).scalar()
        batch_writer(f"{root}/metrics")(events.groupBy().agg(F.count("*").alias("rows")).select(
            F.lit(model).alias("model"), "rows", F.lit(time.monotonic() - began).alias("seconds"), fired.alias("retrain")), batch_id)
        df.unpersist()
    return handle


def start_online_learning(df: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str, every: str = EVERY,
                          once: bool = False) -> StreamingQuery:
    return _start(df, handler, checkpoint, "append", every, once)


def current_state(spark: SparkSession, path: str, key: str) -> DataFrame:
    """State per key summed over the last snapshot and the newer batch deltas (``snapshots.compact`` with :func:`summed_state`)."""
    total = read_batches(spark, path, summed_state(key))
    return total.withColumn("running_avg_rating", F.col("rating_sum") / F.nullif(F.col("rating_n"), F.lit(0))).withColumn(
        "click_through_rate", safe_ratio("clicks", "views"))

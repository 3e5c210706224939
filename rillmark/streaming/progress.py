"""Stream progress as data: one row per micro-batch, written by a listener, read like any table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from rillmark.operators.monitor import window_start
from rillmark.operators.windows import alert_runs

SCHEMA = ("query string, run_id string, batch_id bigint, timestamp timestamp, input_rows bigint, late_rows bigint, state_rows bigint, "
          "seconds double, watermark timestamp, source string, offsets_behind bigint, observed map<string, double>")

# Consumer lag that raises an alert, and for how many minutes it must last. Fixed values of the contract.
LAG, LAG_MINUTES = 10_000, 10


def _number(v) -> float | None:
    try:
        return float(v)
    except (TypeError, ValueError):
        return None


def progress_rows(progress: dict) -> list[dict]:
    """Rows of one progress report, one per source: what came in, what was dropped as late, what the state holds, how long it
    took, how far the source is behind, and the metrics that the query observes."""
    operators = progress.get("stateOperators") or []
    observed = {f"{name}.{c}": _number(v) for name, row in (progress.get("observedMetrics") or {}).items() for c, v in row.items()}
    base = {"query": progress.get("name") or progress["id"], "run_id": progress["runId"], "batch_id": progress["batchId"],
            "timestamp": progress["timestamp"], "late_rows": sum(o.get("numRowsDroppedByWatermark", 0) for o in operators),
            "state_rows": sum(o.get("numRowsTotal", 0) for o in operators),
            "seconds": (progress.get("durationMs") or {}).get("triggerExecution", 0) / 1000,
            "watermark": (progress.get("eventTime") or {}).get("watermark"),
            "observed": {k: v for k, v in observed.items() if v is not None}}
    out = []
    for s in progress.get("sources") or [{}]:
        behind = [_number(v) for k, v in (s.get("metrics") or {}).items() if k == "maxOffsetsBehindLatest"]
        out.append(base | {"input_rows": s.get("numInputRows", 0), "source": s.get("description"),
                           "offsets_behind": int(behind[0]) if behind and behind[0] is not None else None})
    return out


class ProgressTable(StreamingQueryListener):
    """Writes each progress report of the queries of a session as one small file ``<run>-<batch>.json`` below ``root``.

    A batch that is reported again after a restart has another run; a report is written once, under its own name.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = json.loads(event.progress.json)
        rows = "\n".join(json.dumps(r) for r in progress_rows(report))
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{report['runId']}-{report['batchId']:012d}-{report['timestamp'].replace(':', '')}.json")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        stream = fs.create(path, True)
        try:
            stream.write(bytearray(rows.encode()))
        finally:
            stream.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_progress(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(root)


def query_totals(progress: DataFrame) -> DataFrame:
    """Per query: batches, rows in, late rows, seconds, rows per second, and the state rows of the last report."""
    last = F.max_by("state_rows", F.struct("timestamp", "batch_id"))
    # late rows and time belong to the batch, whatever its number of sources
    batches = progress.groupBy("query", "run_id", "batch_id", "timestamp").agg(
        F.sum("input_rows").alias("rows"), F.max("late_rows").alias("late"), F.max("seconds").alias("seconds"),
        F.max("state_rows").alias("state_rows"))
    return batches.groupBy("query").agg(
        F.count_distinct("batch_id").alias("batches"), F.sum("rows").alias("input_rows"), F.sum("late").alias("late_rows"),
        F.sum("seconds").alias("seconds"), last.alias("state_rows")).withColumn(
        "rows_per_second", F.try_divide("input_rows", "seconds"))


def lag_by_window(progress: DataFrame, seconds: int = 60) -> DataFrame:
    """Largest number of offsets behind per query and window."""
    return progress.where(F.col("offsets_behind").isNotNull()).groupBy("query", window_start("timestamp", seconds).alias("window_start")).agg(
        F.max("offsets_behind").alias("offsets_behind"))


def lag_alerts(lag: DataFrame, limit: int = LAG, minutes: int = LAG_MINUTES, seconds: int = 60, series: str = "query") -> DataFrame:
    """Runs of windows in which a consumer was more than ``limit`` offsets behind for at least ``minutes``."""
    return alert_runs(lag, series, "window_start", F.col("offsets_behind") > limit, seconds, -(-minutes * 60 // seconds))

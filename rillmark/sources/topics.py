"""Event topics: a keyed message log on a cluster, or files of the same rows where no broker is at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rillmark.operators.events import encode

# Reading starts at new messages and goes on when old ones have expired. Fixed values of the contract.
TOPIC_OPTIONS = {"startingOffsets": "latest", "failOnDataLoss": "false"}
MESSAGE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


def read_event_stream(
    spark: SparkSession, source: str, fmt: str = "kafka", servers: str | None = None,
    schema: T.StructType | None = None, **opts,
) -> DataFrame:
    """A stream of messages. With ``kafka``, ``source`` is the topic; otherwise it is a path of files."""
    if fmt == "kafka":
        reader = spark.readStream.format("kafka").option("subscribe", source)
        if servers:
            reader = reader.option("kafka.bootstrap.servers", servers)
        return reader.options(**{**TOPIC_OPTIONS, **opts}).load()
    return spark.readStream.format(fmt).schema(schema or MESSAGE).options(**opts).load(source)


def publish(
    df: DataFrame, target: str, checkpoint: str, fmt: str = "kafka", key: str = "user_id", servers: str | None = None,
    once: bool = False, **opts,
) -> StreamingQuery:
    """Write a stream of events as keyed messages; one user's messages share a partition and keep their order."""
    writer = encode(df, key).writeStream.option("checkpointLocation", checkpoint).outputMode("append").options(**opts)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")
    if fmt == "kafka":
        writer = writer.format("kafka").option("topic", target)
        return (writer.option("kafka.bootstrap.servers", servers) if servers else writer).start()
    return writer.format(fmt).option("path", target).start()

"""Queue options (the Kafka connector has to be on the class path)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

# ---------------------------------------------------------------- fixed values
BATCH_MESSAGES = 50_000
# -----------------------------------------------------------------------------


def kafka_options(servers: str, topic: str, group: str | None = None,
                  per_batch: int | None = None,
                  starting: str = "earliest") -> dict[str, str]:
    """Reader options; a drain passes ``per_batch=BATCH_MESSAGES`` to bound a batch, a
    running stream takes what has arrived."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic,
               "startingOffsets": starting}
    if group:
        options["kafka.group.id"] = group
    if per_batch:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    return options


def read_topic(spark: SparkSession, servers: str, topic: str,
               **options: object) -> DataFrame:
    """``value`` text of a topic as a stream."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options))
    return stream.load().selectExpr("CAST(value AS STRING) AS value", "timestamp")


def write_topic(stream: DataFrame, servers: str, topic: str,
                checkpoint: str) -> DataStreamWriter:
    """A stream with a ``value`` column to a topic."""
    return (stream.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint))

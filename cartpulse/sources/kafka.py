"""Kafka topics as stream sources and sinks.

The Kafka connector jar is not bundled; these helpers only assemble the
reader/writer options. Without the jar Spark fails at ``load()``/``start()``
with a clear "data source not found" error; tests feed the same parsers from
file streams instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_topic(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
               max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Stream of one topic's messages as a string ``value`` column.

    ``maxOffsetsPerTrigger`` bounds each micro-batch, which is what lets the
    per-batch operators treat a batch as small.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load().select(F.col("value").cast("string").alias("value"), "timestamp")


def write_topic(messages: DataFrame, servers: str, topic: str, checkpoint: str):
    """Publish a ``value`` string column to a topic (no key), checkpointed."""
    return (messages.select("value").writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())

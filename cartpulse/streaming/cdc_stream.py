"""Streaming change-log capture: change records in, order-insert JSON messages out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from cartpulse.operators.cdc import row_inserts
from cartpulse.session import start_stream


def start_cdc_stream(changes: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None,
                     name: str | None = None, database: str | None = None, compression: str = "none") -> StreamingQuery:
    """Publish order-insert messages as text lines (a Kafka topic via ``sources.kafka.write_topic``); the files
    are compressed by ``compression``, which readers take from the file names."""
    w = (row_inserts(changes, database=database).writeStream.format("text").outputMode("append").option("path", out_path).option("compression", compression)
         .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})))
    if name:
        w = w.queryName(name)
    return start_stream(w, changes.sparkSession)

"""New devices of a date without the device history: first days in keyed state, changes per date in a table.

The state holds each device's first day. A device seen for the first time adds one to its day; an
earlier day that comes late takes one from the old day and adds one to the new. A micro-batch writes
its sums per date, so the new devices of a date are a sum over that date's few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from cartpulse.session import start_stream
from cartpulse.streaming.folds import read_folded
from cartpulse.streaming.seen_keys import STATE_CONF
from cartpulse.streaming.sinks import write_dated_batch

_CHANGE = Row("log_date", "change")


class _FirstDay(StatefulProcessor):
    def init(self, handle) -> None:
        self.day = handle.getValueState("day", "day date")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802,N803 - the interface's names
        least = min((r.log_date for r in rows if r.log_date is not None), default=None)
        held = self.day.get()
        known = held[0] if held is not None else None
        if least is not None and (known is None or least < known):
            self.day.update((least,))
            if known is not None:
                yield _CHANGE(known, -1)
            yield _CHANGE(least, 1)

    def close(self) -> None:
        pass


def start_new_device_stream(rows: DataFrame, table: str, checkpoint: str, trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """``rows``: a stream of (mid, log_date) - device rows, or start-ups; rows that come again change nothing."""
    changes = rows.select("mid", "log_date").groupBy("mid").transformWithState(_FirstDay(), "log_date date, change int", "Update", "None")

    def write(batch_df: DataFrame, batch_id: int) -> None:
        write_dated_batch(batch_df.groupBy("log_date").agg(F.sum("change").alias("change")), table, batch_id, "log_date")

    w = (changes.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})))
    if name:
        w = w.queryName(name)
    return start_stream(w, rows.sparkSession, STATE_CONF)


def read_new_devices(spark: SparkSession, table: str, dates: list | None = None) -> DataFrame:
    """(log_date, new_mid) of all dates or the given ones."""
    changes = read_folded(spark, table, "log_date", dates)
    if changes is None:
        return spark.createDataFrame([], "log_date date, new_mid bigint")
    sums = changes.groupBy("log_date").agg(F.sum("change").alias("new_mid"))
    return sums.where("new_mid <> 0")

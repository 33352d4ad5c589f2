"""JSON log parsing (start-up, event and order messages).

Input is any frame with a string ``value`` column: a Kafka topic
(``CAST(value AS STRING)``), a text file stream, or messages built from
tables with ``to_json``. Parsing is permissive: a malformed message keeps its
raw text in ``_corrupt_record`` and NULL fields instead of failing the task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.schemas import CORRUPT_COL, EVENT_JSON, ORDER_JSON, STARTUP_JSON
from cartpulse.functions.timeparts import ntz_to_epoch_ms, split_create_time, with_date_hour

PARSE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}


def parse_json(messages: DataFrame, schema, value_col: str = "value") -> DataFrame:
    parsed = messages.select(F.from_json(F.col(value_col), schema, PARSE_OPTIONS).alias("_r"))
    return parsed.select("_r.*")


def _typed_ts(df: DataFrame) -> DataFrame:
    # Numbers are carried as text so a quoted "ts" parses too.
    return df.withColumn("ts", F.expr("try_cast(ts AS BIGINT)"))


def parse_startup(messages: DataFrame, tz: str = "UTC", value_col: str = "value") -> DataFrame:
    """Start-up messages -> records with ``ts`` (epoch-ms), ``log_date``, ``log_hour``."""
    return with_date_hour(_typed_ts(parse_json(messages, STARTUP_JSON, value_col)), "ts", tz=tz)


def parse_events(messages: DataFrame, tz: str = "UTC", value_col: str = "value") -> DataFrame:
    """Event messages -> records with ``ts`` (epoch-ms), ``log_date``, ``log_hour``."""
    return with_date_hour(_typed_ts(parse_json(messages, EVENT_JSON, value_col)), "ts", tz=tz)


def parse_orders(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Order messages -> records with ``total_amount`` (double), ``create_date``, ``create_hour``."""
    df = parse_json(messages, ORDER_JSON, value_col)
    df = df.withColumn("total_amount", F.expr("try_cast(total_amount AS DOUBLE)"))
    return split_create_time(df)


def corrupt_rows(parsed: DataFrame) -> DataFrame:
    """Messages that could not be parsed (kept, so they can be counted and inspected)."""
    return parsed.where(F.col(CORRUPT_COL).isNotNull())


def valid_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT_COL).isNull()).drop(CORRUPT_COL)


# --- message builders: serialise table-derived records as the JSON the logs carry ---
# The test tables hold no application, area, system, channel, version or page: they follow from the ids.

BROKEN_EVERY = 50


def _stand_ins(uid, event_id, *fields: str) -> list:
    made = {"appid": F.concat(F.lit("app"), uid % 3), "area": F.concat(F.lit("area "), uid % 34), "os": F.when(uid % 2 == 0, "ios").otherwise("android"),
            "ch": F.concat(F.lit("ch"), uid % 5), "vs": F.concat(F.lit("1."), event_id % 4), "pgid": F.concat(F.lit("p"), event_id % 9),
            "npgid": F.concat(F.lit("p"), (event_id + 1) % 9)}
    return [made[f].alias(f) for f in fields]


def _with_broken(messages: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Beside the good messages one broken text for every ``BROKEN_EVERY``-th record."""
    broken = ids.where(F.col(id_col) % BROKEN_EVERY == 0)
    return messages.unionByName(broken.select(F.concat(F.lit('{"mid": broken '), F.col(id_col).cast("string")).alias("value"), *[c for c in messages.columns if c != "value"]))


def startup_messages(startup: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Start-up records -> JSON with all nine fields, ``ts`` as epoch-ms number, and some broken texts; ``keep`` carries columns beside the message."""
    uid = F.col("uid").cast("bigint")
    fields = F.struct("mid", "uid", *_stand_ins(uid, F.col("event_id"), "appid", "area", "os", "ch"), "type",
                      *_stand_ins(uid, F.col("event_id"), "vs"), ntz_to_epoch_ms("ts").alias("ts"))
    return _with_broken(startup.select(F.to_json(fields).alias("value"), *keep), startup, "event_id")


def event_messages(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Event records -> JSON with all eleven fields, ``ts`` as epoch-ms number, and some broken texts; ``keep`` carries columns beside the message."""
    uid = F.col("uid").cast("bigint")
    fields = F.struct("mid", "uid", *_stand_ins(uid, F.col("event_id"), "appid", "area", "os"), F.lit("event").alias("type"), "evid",
                      *_stand_ins(uid, F.col("event_id"), "pgid", "npgid"), "itemid", ntz_to_epoch_ms("ts").alias("ts"))
    return _with_broken(events.select(F.to_json(fields).alias("value"), *keep), events, "event_id")


def order_messages(messages: DataFrame, orders: DataFrame, id_col: str) -> DataFrame:
    """Order messages with some broken texts beside them."""
    return _with_broken(messages, orders, id_col)

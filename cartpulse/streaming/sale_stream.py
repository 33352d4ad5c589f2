"""Streaming sale detail: order-line stream x order stream, then dimension lookups.

The two streams are joined on the order key inside an event-time range. What can still find
a partner is kept between micro-batches in two tables, open lines and open orders; a micro-batch joins its
rows and the open ones in one shuffle join. The streams' common watermark (the slower one's newest time less
``delay``) closes what neither side can still match, so the tables hold about ``delay`` + ``within`` of time. (Spark's own
stream-stream join does several state store calls a row, and scans the whole store to drop rows.)

:func:`start_sale_detail_stream` gives matched lines only, widened. :func:`start_sale_stream`
also keeps what finds no partner in time: a line whose order has not come when the watermark
passes goes to a dead-letter table, and :func:`rejoin_dead_letters` joins those with the orders
landed since. A reader sees matched and repaired lines; what is still
unmatched can be counted (:func:`read_dead_letters`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartpulse.functions.timeparts import ntz_to_instant
from cartpulse.session import start_stream
from cartpulse.operators.sales import widen_lines
from cartpulse.streaming.sinks import batch_folder, delete_batch, read_table, write_batch

LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
OPEN_LINE = [*LINE_COLUMNS, "l_time"]
OPEN_ORDER = ["o_orderkey", "o_custkey", "dt", "o_time"]


def _in_time(within: str):
    return F.expr(f"l_orderkey = o_orderkey AND l_time >= o_time AND l_time <= o_time + INTERVAL '{within}'")


def _both_sides(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Both streams as one, the other side's columns NULL; a row without a time can match nothing."""
    o = orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("dt"), ntz_to_instant("o_orderdate").alias("o_time"))
    li = lines.select(*LINE_COLUMNS, ntz_to_instant("create_time").alias("l_time"))
    return li.where("l_time IS NOT NULL").unionByName(o.where("o_time IS NOT NULL"), allowMissingColumns=True)


def _start_join(orders: DataFrame, lines: DataFrame, put: Callable[[DataFrame, int], None], checkpoint: str, delay: str, within: str,
                trigger: dict | None, name: str | None) -> StreamingQuery:
    """``put`` gets each micro-batch's joined lines and, without an order, the lines given up by it.

    A batch reads the open rows and the watermark its predecessor left under ``<checkpoint>_open`` and writes its own, so one that
    is run again gives the same. Rows not newer than the predecessor's watermark are refused. An order stays open
    while a line newer than the watermark can match it: a line that is given up meets every order it ever matched.
    """
    place = {k: f"{checkpoint.rstrip('/')}_open/{k}" for k in ("lines", "orders", "marks")}

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        newest = batch_df.agg(*[F.expr(f"unix_millis(max({t}) - INTERVAL '{delay}')").alias(t) for t in ("l_time", "o_time")]).first()
        marks = [0, 0] if batch_id == 0 else list(spark.read.parquet(batch_folder(place["marks"], batch_id - 1)).select("l", "o").first())
        past, marks = min(marks), [max(m, n or 0) for m, n in zip(marks, newest)]
        at = lambda ms: F.timestamp_millis(F.lit(ms))

        def side(kind: str, columns: list[str], time: str, new: str) -> DataFrame:
            rows = batch_df.where(F.col(time) > at(past)).select(*columns, F.lit(True).alias(new))
            if batch_id == 0:
                return rows
            kept = spark.read.schema(batch_df.select(*columns).schema).parquet(batch_folder(place[kind], batch_id - 1))
            return rows.unionByName(kept.withColumn(new, F.lit(False)))

        li, o = side("lines", OPEN_LINE, "l_time", "l_new"), side("orders", OPEN_ORDER, "o_time", "o_new")
        closed = F.col("l_time") <= at(min(marks))
        joined = li.join(o, _in_time(within), "leftOuter")
        put(joined.where(F.when(F.col("o_orderkey").isNull(), closed).otherwise(F.col("l_new") | F.col("o_new"))), batch_id)
        write_batch(li.where(~closed).select(*OPEN_LINE), place["lines"], batch_id)
        write_batch(o.where(F.expr(f"o_time + INTERVAL '{within}'") > at(min(marks))).select(*OPEN_ORDER), place["orders"], batch_id)
        write_batch(spark.range(0, 1, 1, 1).select(*[F.lit(m).cast("bigint").alias(c) for c, m in zip("lo", marks)]), place["marks"], batch_id)
        for table in place.values():  # the predecessor's stay: this batch may run again
            delete_batch(spark, table, batch_id - 2)

    w = _both_sides(orders, lines).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    if name:
        w = w.queryName(name)
    spark = lines.sparkSession  # no state stores: the join's shuffle is a batch job's
    return start_stream(w, spark, partitions=max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def start_sale_detail_stream(orders: DataFrame, lines: DataFrame, customer: DataFrame, part: DataFrame, nation: DataFrame, table: str, checkpoint: str,
                             delay: str = "1 day", within: str = "1 day", trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Sale-detail rows of the lines that find their order, to ``table``. ``orders``: (o_orderkey, o_custkey, o_orderdate);
    ``lines``: line columns + ``create_time``."""

    def put(joined: DataFrame, batch_id: int) -> None:
        write_batch(widen_lines(joined.where("o_orderkey IS NOT NULL"), customer, part, nation), table, batch_id)

    return _start_join(orders, lines, put, checkpoint, delay, within, trigger, name)


def start_sale_stream(orders: DataFrame, lines: DataFrame, matched_table: str, dead_table: str, checkpoint: str,
                      delay: str = "1 day", within: str = "1 day", trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Lines joined to their orders to ``matched_table`` (line columns, ``o_custkey``, ``dt``), lines without an order in time to ``dead_table``.

    A line is given up by the micro-batch that brings the watermark past its time; until then it waits among the open lines. An order that is
    later than the watermark is refused by the join, but landed: its lines come back by :func:`rejoin_dead_letters`.
    """

    def put(joined: DataFrame, batch_id: int) -> None:
        joined.persist()
        try:
            write_batch(joined.where("o_orderkey IS NOT NULL").select(*LINE_COLUMNS, "o_custkey", "dt"), matched_table, batch_id)
            write_batch(joined.where("o_orderkey IS NULL").select(*LINE_COLUMNS, "l_time"), dead_table, batch_id)
        finally:
            joined.unpersist()

    return _start_join(orders, lines, put, checkpoint, delay, within, trigger, name)


def _repaired_folder(dead_table: str) -> str:
    return f"{dead_table.rstrip('/')}_repaired"


def _batches_repaired(spark: SparkSession, dead_table: str) -> DataFrame | None:
    return read_table(spark, _repaired_folder(dead_table))


def read_dead_letters(spark: SparkSession, dead_table: str) -> DataFrame | None:
    """Lines that have found no order so far, with the batch that gave them up. Equal lines are told apart by a number."""
    dead = read_table(spark, dead_table)
    if dead is None:
        return None
    dead = _numbered(dead)
    done = _batches_repaired(spark, dead_table)
    if done is None:
        return dead
    keys = [*LINE_COLUMNS, "given_up", "copy"]
    d = done.select(*[F.col(c).alias(f"_d_{c}") for c in keys])
    cond = [dead[c].eqNullSafe(d[f"_d_{c}"]) for c in keys]
    return dead.join(d, cond, "left_anti")


def _numbered(dead: DataFrame) -> DataFrame:
    from pyspark.sql import Window
    same = Window.partitionBy(*LINE_COLUMNS, "batch_id").orderBy("l_time")
    return dead.withColumn("copy", F.row_number().over(same)).withColumnRenamed("batch_id", "given_up")


def rejoin_dead_letters(spark: SparkSession, dead_table: str, landed_orders: DataFrame, run: int, within: str = "1 day") -> int:
    """Join the dead letters with all landed orders by the stream's rule; found lines are written under ``batch_id=<run>``
    (written again by a repeated run of that number, which gives the same). Returns how many lines were found."""
    dead = read_dead_letters(spark, dead_table)
    if dead is None:
        return 0
    o = landed_orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("dt"), ntz_to_instant("o_orderdate").alias("o_time"))
    found = dead.join(o, _in_time(within)).select(*LINE_COLUMNS, "given_up", "copy", "o_custkey", "dt")
    write_batch(found, _repaired_folder(dead_table), run)
    return spark.read.parquet(f"{_repaired_folder(dead_table)}/batch_id={run}").count()


def read_sale_lines(spark: SparkSession, matched_table: str, dead_table: str) -> DataFrame | None:
    """Matched and repaired lines, each once: line columns, ``o_custkey``, ``dt``."""
    cols = [*LINE_COLUMNS, "o_custkey", "dt"]
    parts = [t.select(*cols) for t in (read_table(spark, matched_table), _batches_repaired(spark, dead_table)) if t is not None]
    return None if not parts else parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

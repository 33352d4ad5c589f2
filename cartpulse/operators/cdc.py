"""Change-log capture: order inserts out of a database change log, as JSON messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.functions.timeparts import wall_clock_text

from cartpulse.constants import CDC_ENTRY_ROWDATA, CDC_INSERT, CDC_ORDER_TABLE

STAND_IN_DATABASE = "shop"


def row_inserts(changes: DataFrame, table: str = CDC_ORDER_TABLE, event_type: str = CDC_INSERT, database: str | None = None) -> DataFrame:
    """After-images of one table's inserts, one JSON object per row (all values strings).

    Only row-data entries are looked at; updates, deletes, other tables and
    non-row entries (transaction markers) are skipped, and with ``database`` those of other databases (an
    entry that names none is another's). Of a column that repeats in
    a row the last value counts. NULL column values stay
    ``null`` in the JSON.
    """
    picked = changes.where((F.col("entry_type") == CDC_ENTRY_ROWDATA)
                           & (F.col("table") == table) & (F.col("event_type") == event_type))
    if database is not None:
        picked = picked.where(F.col("database") == database)
    rows = picked.select(F.explode("rows").alias("cols"))
    # the last value of a repeated column wins: a column stays unless a later one has its name
    last = F.filter("cols", lambda c, i: ~F.exists(F.slice("cols", i + 2, F.size("cols")), lambda later: later["name"] == c["name"]))
    return rows.select(F.to_json(F.map_from_entries(last), {"ignoreNullFields": "false"}).alias("value"))


def _cols(*pairs) -> F.Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), v.cast("string").alias("value")) for n, v in pairs])


def change_log_from_tables(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """A change log derived from the order tables (input feed for tests and benches).

    Per order: a transaction-begin marker, the ``order_info`` INSERT with all 18 columns, and an
    UPDATE for orders whose status is ``F``; for status ``P`` the same INSERT in a second database; per line item an INSERT into
    ``order_detail``. Every entry is one row, so no grouping is needed. ``ts``
    (the change time) is the order date, or the ship date for line items.
    """
    key, user, created = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    after = _cols(("id", key), ("province_id", user % 34), ("consignee", F.concat(F.lit("user "), user)), ("order_comment", F.lit(None)),
                  ("consignee_tel", F.lpad(user.cast("string"), 11, "1")), ("order_status", F.col("o_orderstatus")), ("payment_way", key % 3),
                  ("user_id", user), ("img_url", F.concat(F.lit("/img/"), key, F.lit(".png"))),
                  ("total_amount", F.col("o_totalprice").cast("decimal(18,2)")), ("expire_time", wall_clock_text(created + F.expr("INTERVAL '1' DAY"))),
                  ("delivery_address", F.concat(F.lit("street "), user % 100, F.lit(", \"east\""))), ("create_time", wall_clock_text(created)),
                  ("operate_time", wall_clock_text(created + F.expr("INTERVAL '30' MINUTE"))), ("tracking_no", F.concat(F.lit("T"), key)),
                  ("parent_order_id", F.when(key % 10 == 0, key - 1)), ("out_trade_no", F.concat(F.lit("O"), key)), ("trade_body", F.concat(F.lit("order "), key)))
    no_rows = F.lit(None).cast("array<array<struct<name:string,value:string>>>")

    def entry(rows, ts, database, table, entry_type, event_type, image):
        return rows.select(F.col(ts).alias("ts"), F.lit(database).alias("database"), F.lit(table).alias("table"), F.lit(entry_type).alias("entry_type"),
                           F.lit(event_type).cast("string").alias("event_type"), image.alias("rows"))

    detail = _cols(("order_id", F.col("l_orderkey")), ("sku_id", F.col("l_partkey")), ("sku_num", F.col("l_quantity")))
    entries = [entry(orders, "o_orderdate", STAND_IN_DATABASE, "order_info", "TRANSACTIONBEGIN", None, no_rows),
               entry(orders, "o_orderdate", STAND_IN_DATABASE, "order_info", "ROWDATA", "INSERT", F.array(after)),
               entry(orders.where(F.col("o_orderstatus") == "F"), "o_orderdate", STAND_IN_DATABASE, "order_info", "ROWDATA", "UPDATE", F.array(after)),
               entry(orders.where(F.col("o_orderstatus") == "P"), "o_orderdate", f"{STAND_IN_DATABASE}_copy", "order_info", "ROWDATA", "INSERT", F.array(after)),
               entry(lineitem, "l_shipdate", STAND_IN_DATABASE, "order_detail", "ROWDATA", "INSERT", F.array(detail))]
    return reduce(DataFrame.unionByName, entries)

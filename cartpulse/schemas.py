"""Record schemas of the metrics warehouse (explicit, never inferred).

Numbers inside JSON payloads are read as strings and cast with ``try_cast``:
``from_json`` with a numeric field yields NULL for a quoted number.
"""

from pyspark.sql import types as T

S = T.StringType()

STARTUP_FIELDS = ["mid", "uid", "appid", "area", "os", "ch", "type", "vs", "ts"]
EVENT_FIELDS = ["mid", "uid", "appid", "area", "os", "type", "evid", "pgid", "npgid", "itemid", "ts"]
ORDER_FIELDS = [
    "id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status",
    "payment_way", "user_id", "img_url", "total_amount", "expire_time", "delivery_address",
    "create_time", "operate_time", "tracking_no", "parent_order_id", "out_trade_no", "trade_body",
]

CORRUPT_COL = "_corrupt_record"


def raw_json_schema(fields: list[str]) -> T.StructType:
    """All-string schema plus the corrupt-record column for permissive parsing."""
    return T.StructType([T.StructField(f, S) for f in fields] + [T.StructField(CORRUPT_COL, S)])


STARTUP_JSON = raw_json_schema(STARTUP_FIELDS)
EVENT_JSON = raw_json_schema(EVENT_FIELDS)
ORDER_JSON = raw_json_schema(ORDER_FIELDS)

# Change record of a database change log, one entry per row-change event.
CHANGE_RECORD = T.StructType([
    T.StructField("database", S),
    T.StructField("table", S),
    T.StructField("entry_type", S),
    T.StructField("event_type", S),
    T.StructField("rows", T.ArrayType(T.ArrayType(T.StructType([
        T.StructField("name", S), T.StructField("value", S)])))),
])

COUPON_ALERT = T.StructType([
    T.StructField("alert_id", S),
    T.StructField("mid", S),
    T.StructField("uids", T.ArrayType(S)),
    T.StructField("item_ids", T.ArrayType(S)),
    T.StructField("events", T.ArrayType(S)),
    T.StructField("ts", T.TimestampNTZType()),
])

"""Change-log capture and JSON parsing (hand fixtures)."""

import json

from cartpulse.operators import cdc as CDC
from cartpulse.schemas import CHANGE_RECORD
from cartpulse.sources import json_logs as JL


def change(table, entry, event, cols, database="shop"):
    rows = None if cols is None else [[{"name": k, "value": v} for k, v in cols]]
    return (database, table, entry, event, rows)


def test_only_order_info_inserts_are_published(spark):
    recs = [
        change("order_info", "ROWDATA", "INSERT", [("id", "1"), ("total_amount", "5.00"), ("note", None)]),
        change("order_info", "ROWDATA", "UPDATE", [("id", "1"), ("total_amount", "6.00")]),
        change("order_info", "ROWDATA", "DELETE", [("id", "1")]),
        change("order_detail", "ROWDATA", "INSERT", [("id", "7")]),
        change("order_info", "TRANSACTIONEND", None, None),
    ]
    df = spark.createDataFrame(recs, CHANGE_RECORD)
    out = [json.loads(r["value"]) for r in CDC.row_inserts(df).collect()]
    assert out == [{"id": "1", "total_amount": "5.00", "note": None}]


def test_other_databases_are_left_out(spark):
    recs = [change("order_info", "ROWDATA", "INSERT", [("id", str(i))], db) for i, db in enumerate(["shop", "other", None, "shop_copy"])]
    df = spark.createDataFrame(recs, CHANGE_RECORD)
    ids = lambda out: sorted(json.loads(r["value"])["id"] for r in out.collect())
    assert ids(CDC.row_inserts(df, database="shop")) == ["0"] and ids(CDC.row_inserts(df)) == ["0", "1", "2", "3"]


def test_every_field_of_a_record_is_filled(spark):
    from cartpulse import schemas as SC
    from cartpulse.sources import tables as TB
    from conftest import SF_SMALL
    for parsed, fields in ((JL.parse_startup(JL.startup_messages(TB.startup_log(spark, SF_SMALL))), SC.STARTUP_FIELDS),
                           (JL.parse_events(JL.event_messages(TB.event_log(spark, SF_SMALL))), SC.EVENT_FIELDS)):
        row = JL.valid_rows(parsed).first()
        assert all(row[f] is not None for f in fields) and JL.corrupt_rows(parsed).count() > 0
        assert JL.corrupt_rows(parsed).where(" or ".join(f"{f} is not null" for f in fields)).count() == 0


def test_last_value_of_a_repeated_column_wins(spark):
    df = spark.createDataFrame([change("order_info", "ROWDATA", "INSERT", [("id", "1"), ("note", "a"), ("id", "2"), ("note", None)])], CHANGE_RECORD)
    assert [json.loads(r["value"]) for r in CDC.row_inserts(df).collect()] == [{"id": "2", "note": None}]


def test_malformed_json_is_kept_as_corrupt_row(spark):
    msgs = spark.createDataFrame([('{"mid":"m1","uid":"u1","ts":1589000000000}',), ("{bad",)], "value string")
    parsed = JL.parse_startup(msgs)
    assert JL.corrupt_rows(parsed).count() == 1
    good = JL.valid_rows(parsed).collect()
    assert len(good) == 1 and good[0]["mid"] == "m1" and good[0]["log_hour"] == "04"


def test_quoted_number_is_parsed(spark):
    msgs = spark.createDataFrame([('{"mid":"m1","ts":"1589000000000"}',)], "value string")
    r = JL.valid_rows(JL.parse_startup(msgs)).first()
    assert r["ts"] == 1589000000000 and str(r["log_date"]) == "2020-05-09"


def test_epoch_ms_uses_the_given_zone(spark):
    msgs = spark.createDataFrame([('{"mid":"m1","ts":1589000000000}',)], "value string")
    r = JL.valid_rows(JL.parse_startup(msgs, tz="Asia/Shanghai")).first()
    assert (str(r["log_date"]), r["log_hour"]) == ("2020-05-09", "12")


def test_order_messages_split_create_time(spark):
    msgs = spark.createDataFrame([('{"id":"1","total_amount":"12.50","create_time":"2024-01-01 10:05:00"}',),
                                  ('{"id":"2","total_amount":"1"}',)], "value string")
    rows = {r["id"]: r for r in JL.valid_rows(JL.parse_orders(msgs)).collect()}
    assert rows["1"]["create_hour"] == "10" and rows["1"]["total_amount"] == 12.5
    assert rows["2"]["create_date"] is None and rows["2"]["create_hour"] is None


def test_topic_reader_needs_the_connector(spark):
    import pytest
    from cartpulse.sources.kafka import read_topic
    with pytest.raises(Exception) as err:
        read_topic(spark, "localhost:1", "events")
    assert "kafka" in str(err.value).lower()

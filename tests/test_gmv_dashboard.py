"""Order value and dashboard results (hand fixtures)."""

from cartpulse.operators import gmv as GMV
from cartpulse.plans import dashboard as DASH

ORDER_SCHEMA = "id string, user_id string, total_amount double, create_time string"


def test_two_orders_in_one_hour_are_summed(spark):
    o = spark.createDataFrame([("1", "u", 5.0, "2024-01-01 10:05:00"), ("2", "u", 7.0, "2024-01-01 10:40:00")],
                              ORDER_SCHEMA)
    rows = GMV.gmv_hours(GMV.order_facts(o)).collect()
    assert [(r["create_hour"], r["order_amount"]) for r in rows] == [("10", 12.0)]


def test_missing_create_time_is_counted_not_summed(spark):
    o = spark.createDataFrame([("1", "u", 5.0, None), ("2", "u", 7.0, "2024-01-01 10:40:00")], ORDER_SCHEMA)
    facts = GMV.order_facts(o)
    assert [r["order_amount"] for r in GMV.gmv_total(facts).collect()] == [7.0]
    assert GMV.undated_orders(facts).first()["undated"] == 1


def test_malformed_create_times(spark):
    from cartpulse.functions.timeparts import split_create_time
    df = spark.createDataFrame([("2024-01-01 10:05:00",), ("garbage",), ("2024-13-45 99:00:00",), ("2024-01-01",),
                                ("2024-01-01 24:00:00",)], "create_time string")
    got = [(None if r["create_date"] is None else str(r["create_date"]), r["create_hour"])
           for r in split_create_time(df).collect()]
    assert got == [("2024-01-01", "10"), (None, None), (None, None), ("2024-01-01", None), ("2024-01-01", None)]


def test_money_sum_is_exact(spark):
    o = spark.createDataFrame([(str(i), "u", 0.1, "2024-01-01 10:00:00") for i in range(10)], ORDER_SCHEMA)
    assert GMV.gmv_total(GMV.order_facts(o)).first()["order_amount"] == 1.0


def test_day_without_orders_has_null_amount_and_zero_dau(spark):
    dau = spark.createDataFrame([], "log_date date, dau long")
    new = spark.createDataFrame([], "log_date date, new_mid long")
    gmv = spark.createDataFrame([], "create_date date, order_amount double")
    rows = {r["id"]: r["value"] for r in DASH.realtime_total(dau, new, gmv, date="2024-01-15").collect()}
    assert rows == {"dau": 0.0, "new_mid": 0.0, "order_amount": None}


def test_realtime_hours_zero_fills_and_shifts_yesterday(spark):
    import datetime as dt
    hv = spark.createDataFrame([(dt.date(2024, 1, 2), "05", 3), (dt.date(2024, 1, 1), "05", 2),
                                (dt.date(2024, 1, 1), "07", 1)], "d date, h string, n long")
    out = DASH.realtime_hours(hv, "d", "h", "n", date="2024-01-02").collect()
    assert len(out) == 24
    got = {r["hour"]: (r["today"], r["yesterday"]) for r in out}
    assert got["05"] == (3, 2) and got["07"] == (0, 1) and got["00"] == (0, 0)


def test_hours_map_is_hour_ordered_json(spark):
    import datetime as dt
    hv = spark.createDataFrame([(dt.date(2024, 1, 2), "11", 3), (dt.date(2024, 1, 2), "02", 2)], "d date, h string, n long")
    assert DASH.hours_map(hv, "d", "h", "n").first()["hours"] == '{"02":2,"11":3}'


def test_day_with_orders_and_no_device_has_kpi_rows(spark):
    dau = spark.createDataFrame([("2024-01-01", 3, 1)], "log_date string, dau long, new_mid long").selectExpr("cast(log_date as date) log_date", "dau", "new_mid")
    gmv = spark.createDataFrame([("2024-01-02", 9.0), (None, 4.0)], "create_date string, order_amount double").selectExpr("cast(create_date as date) create_date", "order_amount")
    got = {(str(r["day"]), r["id"]): r["value"] for r in DASH.realtime_total(dau, None, gmv).collect()}
    assert got == {("2024-01-01", "dau"): 3.0, ("2024-01-01", "new_mid"): 1.0, ("2024-01-01", "order_amount"): None,
                   ("2024-01-02", "dau"): 0.0, ("2024-01-02", "new_mid"): 0.0, ("2024-01-02", "order_amount"): 9.0}

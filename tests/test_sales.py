"""Sale detail: search, paging, shares, province classes."""

from pyspark.sql import functions as F

from cartpulse.operators import sales as SALES
from conftest import SF_SMALL


def detail(spark, **kw):
    from cartpulse.sources.tables import load_table
    t = [load_table(spark, SF_SMALL, n) for n in ("lineitem", "orders", "customer", "part", "nation")]
    return SALES.sale_detail(*t, **kw)


def test_age_band_edges(spark):
    df = spark.createDataFrame([(19,), (20,), (29,), (30,), (None,)], "user_age int")
    got = [r["b"] for r in df.select(SALES.age_band(F.col("user_age")).alias("b")).collect()]
    assert got == ["20岁以下", "20-30岁", "20-30岁", "30岁以上", None]


def test_empty_keyword_is_no_filter(spark):
    d = detail(spark)
    assert SALES.search(d, keyword="").count() == d.count() == SALES.search(d, keyword=None).count()


def test_keyword_is_case_insensitive_and_pushed_before_join(spark):
    a = detail(spark, keyword="RING").count()
    b = SALES.search(detail(spark), keyword="ring").count()
    assert a == b > 0


def test_date_filter(spark):
    d = detail(spark)
    day = d.select("dt").first()["dt"]
    assert detail(spark, date=str(day)).count() == SALES.search(d, date=str(day)).count() > 0


def test_page_matches_sorted_slice(spark):
    d = detail(spark, keyword="ring")
    every = [r["order_detail_id"] for r in d.orderBy("order_id", "order_detail_id").collect()]
    page = SALES.page(d, 10, 5).collect()
    assert [r["order_detail_id"] for r in page] == every[10:15]
    assert {r["total"] for r in page} == {len(every)}
    assert SALES.page_number(10, 5) == 3


def test_shares_sum_to_one(spark):
    d = detail(spark)
    for df in (SALES.share_by_segment(d), SALES.share_by_age_band(d)):
        assert abs(sum(r["share"] for r in df.collect()) - 1.0) < 1e-9


def test_province_classes(spark):
    df = spark.createDataFrame([("a", 50.0, 1.0), ("b", 250.0, 1.0), ("c", 9000.0, 1.0)],
                               "province string, sku_num double, order_price double")
    got = {r["province"]: r["color_class"] for r in SALES.sales_by_province(df).collect()}
    assert got == {"a": 0, "b": 2, "c": 5}


def test_lines_without_dimension_rows_are_kept(spark):
    from cartpulse.sources.tables import load_table
    t = {n: load_table(spark, SF_SMALL, n) for n in ("lineitem", "orders", "customer", "part", "nation")}
    t["part"] = t["part"].where("p_partkey % 2 = 0")
    t["customer"] = t["customer"].where("c_custkey % 3 > 0")
    d = SALES.sale_detail(*t.values())
    counts = SALES.unmatched_lines(d).first()
    assert counts["n"] == t["lineitem"].count() and counts["no_product"] > 0 and counts["no_customer"] > 0


def test_columns_skip_joins_without_changing_rows(spark):
    full, few = detail(spark), detail(spark, columns=["user_segment", "order_id"])
    assert few.columns == ["user_segment", "order_id"]
    assert sorted(map(str, few.collect())) == sorted(map(str, full.select(*few.columns).collect()))


def test_sale_page_of_nothing_is_one_empty_row(spark):
    got = SALES.sale_page(detail(spark).where("false"), 0, 10).collect()
    assert [tuple(r) for r in got] == [(0, [], [], [])]


def test_sale_page_shares_are_of_the_matched_rows(spark):
    d = detail(spark, keyword="ring")
    r = SALES.sale_page(d, 10, 5).first()
    assert r["total"] == d.count() == sum(x["n"] for x in r["segments"]) == sum(x["n"] for x in r["age_bands"])
    assert [x["order_detail_id"] for x in r["detail"]] == [x["order_detail_id"] for x in SALES.page(d, 10, 5).collect()]

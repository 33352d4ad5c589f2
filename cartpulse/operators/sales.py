"""Sale detail: order lines widened with order, customer, product and region attributes.

Stand-ins on the test tables: user segment = ``c_mktsegment`` (for gender),
user age = ``p_size``, province = nation name, keyword search on ``p_name``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.constants import AGE_BAND_EDGES, AGE_BAND_LABELS, PROVINCE_CLASS_MAX, PROVINCE_CLASS_WIDTH
from cartpulse.functions.money import money_sum

SALE_COLUMNS = ["order_detail_id", "order_id", "user_id", "sku_id", "user_segment", "user_age",
                "sku_price", "sku_name", "sku_tm_id", "sku_num", "order_price", "province", "dt"]


CUSTOMER_COLUMNS = {"user_segment", "province"}
PART_COLUMNS = {"user_age", "sku_price", "sku_name", "sku_tm_id"}


def sale_detail(lineitem: DataFrame, orders: DataFrame, customer: DataFrame, part: DataFrame,
                nation: DataFrame, date: str | None = None, keyword: str | None = None,
                columns: list[str] | None = None) -> DataFrame:
    """Wide sale-detail rows; optional day and keyword filters are applied before the joins.

    Each input is projected to its used columns first (narrow shuffles). The
    fact-to-fact join (lines x orders on the order key) and the dimension
    lookups are shuffle joins unless the planner or AQE measures a side small
    enough to broadcast; nothing is hinted. A line whose customer, product or
    nation row is missing keeps its place with NULL attributes (a keyword
    needs the product's name, so it drops such lines).

    ``columns`` names the result's columns; a dimension none of them (nor the
    keyword) needs is not joined, as its key is unique and its join adds no row.
    """
    wanted = set(columns or SALE_COLUMNS)
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    o = orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("dt"))
    if date is not None:
        o = o.where(F.col("dt") == F.lit(date).cast("date"))
    # orders x customers first: the wide line side is then shuffled twice
    # (by order key, by part key) instead of three times.
    oc = attach_customer(o, customer, nation) if wanted & CUSTOMER_COLUMNS else o
    lines = li.join(oc, li.l_orderkey == oc.o_orderkey)
    return _project(attach_part(lines, part, keyword) if keyword or wanted & PART_COLUMNS else lines, columns)


def unmatched_lines(detail: DataFrame) -> DataFrame:
    """How many sale rows found no customer, no product, no province: one row of counts."""
    return detail.agg(F.count_if(F.col("user_segment").isNull()).alias("no_customer"),
                      F.count_if(F.col("sku_name").isNull()).alias("no_product"),
                      F.count_if(F.col("province").isNull()).alias("no_province"),
                      F.count("*").alias("n"))


def attach_customer(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    c = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    n = nation.select("n_nationkey", "n_name")
    return (orders.join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
                  .join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left"))


def attach_part(lines: DataFrame, part: DataFrame, keyword: str | None = None) -> DataFrame:
    p = part.select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    if keyword:
        p = p.where(F.lower("p_name").contains(keyword.lower()))
    return lines.join(p, F.col("l_partkey") == F.col("p_partkey"), "inner" if keyword else "left")


def widen_lines(lines: DataFrame, customer: DataFrame, part: DataFrame, nation: DataFrame,
                keyword: str | None = None) -> DataFrame:
    """Order lines already joined to their order (l_* and o_custkey, dt) -> sale-detail rows."""
    return _project(attach_part(attach_customer(lines, customer, nation), part, keyword))


def _project(wide: DataFrame, columns: list[str] | None = None) -> DataFrame:
    exprs = [
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("order_detail_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("c_mktsegment").alias("user_segment"),
        F.col("p_size").alias("user_age"),
        F.col("p_retailprice").alias("sku_price"),
        F.col("p_name").alias("sku_name"),
        F.col("p_brand").alias("sku_tm_id"),
        F.col("l_quantity").alias("sku_num"),
        F.col("l_extendedprice").alias("order_price"),
        F.col("n_name").alias("province"),
        F.col("dt"),
    ]
    named = dict(zip(SALE_COLUMNS, exprs))
    return wide.select(*[named[c] for c in columns or SALE_COLUMNS])


def search(detail: DataFrame, date: str | None = None, keyword: str | None = None) -> DataFrame:
    """Filter already-widened rows by day and case-insensitive keyword (empty = no filter)."""
    if date is not None:
        detail = detail.where(F.col("dt") == F.lit(date).cast("date"))
    if keyword:
        detail = detail.where(F.lower("sku_name").contains(keyword.lower()))
    return detail


def page(detail: DataFrame, start: int, length: int, order: tuple[str, ...] = ("order_id", "order_detail_id"),
         with_total: bool = True) -> DataFrame:
    """Rows ``start`` .. ``start+length-1`` of the matches in key order, plus the match count.

    Sort + offset + limit plans as a per-partition top-k merged on one task
    (never a global sort); the total is a scalar subquery, not a join.
    """
    rows = detail.orderBy(*order).offset(start).limit(length)
    if with_total:
        total = detail.agg(F.count("*")).scalar()
        rows = rows.withColumn("total", total)
    return rows


def sale_page(matched: DataFrame, start: int, length: int) -> DataFrame:
    """The whole sale page as one row: ``total``, the page's rows ``detail``, and of all matched rows
    the counts per user segment and per age band with their shares (``segments``, ``age_bands``).

    ``matched`` is read twice - give it stored. Nothing matched: total 0 and empty arrays.
    """
    counts = (matched.groupBy("user_segment", age_band(F.col("user_age")).alias("age_band"))
              .agg(F.count("*").alias("n")))  # segments x bands rows
    order = ("order_id", "order_detail_id")
    rows = page(matched, start, length, order, with_total=False)
    rest = [c for c in rows.columns if c not in order]
    detail = rows.agg(F.array_sort(F.collect_list(F.struct(*order, *rest)))).scalar()

    def shares(key):
        per_key = counts.groupBy(key).agg(F.sum("n").alias("n"))
        with_share = _shares(per_key)
        return with_share.agg(F.array_sort(F.collect_list(F.struct(key, "n", "share")))).scalar()

    return (counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
            .select("total", detail.alias("detail"), shares("user_segment").alias("segments"),
                    shares("age_band").alias("age_bands")))


def page_number(start: int, length: int) -> int:
    """1-based page number of a row offset."""
    return start // length + 1


def _shares(counts: DataFrame) -> DataFrame:
    # the grand total is a scalar subquery over the (tiny) per-group counts
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def share_by_segment(detail: DataFrame) -> DataFrame:
    """Count and share of sale rows per user segment."""
    return _shares(detail.groupBy("user_segment").agg(F.count("*").alias("n")))


def age_band(age: Column) -> Column:
    lo, hi = AGE_BAND_EDGES
    return (F.when(age.isNull(), F.lit(None))
             .when(age < lo, F.lit(AGE_BAND_LABELS[0]))
             .when(age < hi, F.lit(AGE_BAND_LABELS[1]))
             .otherwise(F.lit(AGE_BAND_LABELS[2])))


def share_by_age_band(detail: DataFrame) -> DataFrame:
    """Count and share of sale rows per age band [0,20), [20,30), [30,inf)."""
    banded = detail.withColumn("age_band", age_band(F.col("user_age")))
    return _shares(banded.groupBy("age_band").agg(F.count("*").alias("n")))


def sales_by_province(detail: DataFrame, width: int = PROVINCE_CLASS_WIDTH,
                      top: int = PROVINCE_CLASS_MAX) -> DataFrame:
    """Quantity and amount sold per province, with the map's colour class.

    Class ``k`` covers [k*width, (k+1)*width); everything from the last class
    start up is the last class.
    """
    agg = detail.groupBy("province").agg(F.sum("sku_num").alias("quantity"),
                                         money_sum("order_price").alias("amount"))
    last = top // width - 1
    return agg.withColumn("color_class", F.least(F.floor(F.col("quantity") / width), F.lit(last)).cast("int"))

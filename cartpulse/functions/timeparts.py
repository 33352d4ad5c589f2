"""Time helpers that do not depend on the session time zone.

Wall-clock times are kept as TIMESTAMP_NTZ (what the parquet inputs hold).
Epoch milliseconds are turned into local wall time with an explicit zone
(the original formatted with the JVM default zone; here it is a parameter).
Streaming watermarks need TIMESTAMP (an instant); ``ntz_to_instant`` /
``instant_to_ntz`` convert as if the wall time were UTC, without reading the
session zone, so window alignment never shifts with the session setting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH_NTZ_SQL = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def EPOCH_NTZ() -> Column:  # noqa: N802 - built lazily: needs an active session
    return F.expr(EPOCH_NTZ_SQL)


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ntz_to_epoch_ms(col: str | Column) -> Column:
    return F.timestamp_diff("MILLISECOND", EPOCH_NTZ(), _c(col))


def ntz_to_epoch_us(col: str | Column) -> Column:
    return F.timestamp_diff("MICROSECOND", EPOCH_NTZ(), _c(col))


def epoch_ms_to_local(col: str | Column, tz: str = "UTC") -> Column:
    """bigint epoch-ms -> local wall time (TIMESTAMP_NTZ) in zone ``tz``."""
    utc_wall = F.timestamp_add("MILLISECOND", _c(col), EPOCH_NTZ())
    if tz in ("UTC", "Z", "+00:00"):
        return utc_wall
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall)


def ntz_to_instant(col: str | Column) -> Column:
    return F.timestamp_micros(ntz_to_epoch_us(col))


def instant_to_ntz(col: str | Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(col)), EPOCH_NTZ())


def lit_long(n: int) -> Column:
    return F.lit(n).cast("bigint")


def floor_div(col: Column, n: int) -> Column:
    """Exact floor division of a long column by a positive constant (also below zero)."""
    return F.call_function("div", col - F.pmod(col, lit_long(n)), lit_long(n))


def epoch_bucket(col: str | Column, bucket_ms: int) -> Column:
    """Integer bucket number of a wall time: epoch-ms div bucket (the alert doc id)."""
    return floor_div(ntz_to_epoch_ms(col), bucket_ms)


def with_date_hour(df: DataFrame, ts: str = "ts", date_col: str = "log_date",
                   hour_col: str = "log_hour", tz: str = "UTC") -> DataFrame:
    """Add the day (DATE) and two-digit hour of a time column.

    ``ts`` may be epoch milliseconds (bigint, converted in zone ``tz``) or a
    wall-clock TIMESTAMP_NTZ.
    """
    dtype = dict(df.dtypes)[ts]
    wall = epoch_ms_to_local(ts, tz) if dtype in ("bigint", "int") else F.col(ts)
    return df.withColumn(date_col, F.to_date(wall)).withColumn(hour_col, two_digit_hour(wall))


def wall_clock_text(col: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a TIMESTAMP_NTZ, without any zone conversion."""
    return F.substring(_c(col).cast("string"), 1, 19)


def two_digit_hour(wall: Column) -> Column:
    """``HH`` of a wall-clock time, read straight from the NTZ value (no zone conversion)."""
    return F.lpad(F.hour(wall).cast("string"), 2, "0")


def split_create_time(df: DataFrame, col: str = "create_time", date_col: str = "create_date",
                      hour_col: str = "create_hour") -> DataFrame:
    """``yyyy-MM-dd HH:mm:ss`` -> DATE and the real two-digit hour.

    A missing or malformed value gives a NULL date (the row is kept and
    counted, but falls out of dated sums); the hour is set only next to a
    valid date and a clock starting with an hour 00-23.
    """
    day = F.split_part(F.col(col), F.lit(" "), F.lit(1))
    clock = F.split_part(F.col(col), F.lit(" "), F.lit(2))
    out = df.withColumn(date_col, F.try_to_date(day, "yyyy-MM-dd"))
    hh = F.substring(clock, 1, 2)
    valid_hour = (F.col(date_col).isNotNull()
                  & F.substring(clock, 1, 1).between("0", "2") & F.substring(clock, 2, 1).between("0", "9")
                  & (hh <= F.lit("23")) & F.substring(clock, 3, 1).isin("", ":"))
    return out.withColumn(hour_col, F.when(valid_hour, hh))

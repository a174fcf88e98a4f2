"""Business time: instants are UTC, the business day is that of a fixed zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The business zone and its fixed distance from UTC in hours (it has no daylight saving time).
ZONE, HOURS = "Asia/Ho_Chi_Minh", 7


def assert_utc_session(spark: SparkSession) -> None:
    """Business dates are right only if the session reads and shows instants as UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00", "GMT"):
        raise ValueError(f"the session's time zone is {zone}; set spark.sql.session.timeZone to UTC")


def business_ts(ts: Column) -> Column:
    return F.from_utc_timestamp(ts, ZONE)


def business_date(ts: Column) -> Column:
    return business_ts(ts).cast("date")


def business_hour(ts: Column) -> Column:
    return F.hour(business_ts(ts))


def utc_bounds(day: dt.date, back_to: dt.date | None = None) -> tuple[dt.datetime, dt.datetime]:
    """The half-open range of UTC instants of business days back_to (by default day) to day."""
    start = dt.datetime.combine(back_to or day, dt.time()) - dt.timedelta(hours=HOURS)
    return start, dt.datetime.combine(day, dt.time()) - dt.timedelta(hours=HOURS - 24)


def in_days(ts: Column, day: dt.date, back_to: dt.date | None = None) -> Column:
    """ts is in these business days; the column stays bare, so that the bounds reach the scan."""
    low, high = (F.lit(x).cast("timestamp_ntz") for x in utc_bounds(day, back_to))
    return (ts >= low) & (ts < high)


def business_window(df: DataFrame, day: dt.date, days: int, partition: str = "cob_dt") -> DataFrame:
    """Rows of the business days day - days to day, both included, by the partition column alone: it prunes partitions."""
    return df.where(F.col(partition).between(F.lit(day - dt.timedelta(days=days)), F.lit(day)))


def time_spine(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row a day."""
    days = F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("date_day"))

"""Access-log reports over the valid rows of ``parse_access_log``.

``by`` is ``day`` (day of month, so equal days of two months fall together) or
``date`` (calendar date).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.operators.numbering import number_values
from harrow.session import materialize


def _period(by: str) -> Column:
    if by not in ("day", "date"):
        raise ValueError(f"by must be 'day' or 'date', not {by!r}")
    time = F.col("date_time")
    return F.day(time).alias("day") if by == "day" else F.to_date(time).alias("date")


def _top(counts: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` keys with the highest ``n``; equal counts in key order."""
    return counts.orderBy(F.desc("n"), key).limit(k)


def hosts(logs: DataFrame) -> DataFrame:
    return logs.select("host")


def with_code(logs: DataFrame, code: int) -> DataFrame:
    return logs.filter(F.col("response_code") == code)


def without_code(logs: DataFrame, code: int) -> DataFrame:
    return logs.filter(F.col("response_code") != code)


def top_endpoints(logs: DataFrame, k: int) -> DataFrame:
    """Most requested endpoints of the rows given."""
    return _top(logs.groupBy("endpoint").agg(F.count("*").alias("n")), "endpoint", k)


def top_error_endpoints(logs: DataFrame, k: int = 10, success: int = 200) -> DataFrame:
    return top_endpoints(without_code(logs, success), k)


def unique_host_count(logs: DataFrame) -> DataFrame:
    return logs.agg(F.count_distinct("host").alias("n_hosts"))


def _hosts_per_period(logs: DataFrame, by: str) -> DataFrame:
    return logs.groupBy(_period(by)).agg(F.count_distinct("host").alias("n_hosts"))


def daily_hosts(logs: DataFrame, by: str = "day") -> DataFrame:
    """Distinct hosts of each day, in order."""
    return _hosts_per_period(logs, by).orderBy(by)


def mean_daily_hosts(logs: DataFrame, by: str = "day") -> DataFrame:
    return _hosts_per_period(logs, by).agg(F.avg("n_hosts").alias("mean_hosts"))


def daily_requests_per_host(logs: DataFrame, by: str = "day") -> DataFrame:
    """Requests per distinct host of each day, as a whole number rounded down."""
    requests = F.count("*")
    n_hosts = F.count_distinct("host")
    return (logs.groupBy(_period(by))
            .agg(requests.alias("n"), n_hosts.alias("n_hosts"))
            .select(by, F.expr("n div n_hosts").alias("requests_per_host"))
            .orderBy(by))


def host_presence(logs: DataFrame) -> DataFrame:
    """(date, bucket, bits, n): which hosts were there on each date, as bitmaps of their numbers.

    Hosts are numbered, and a bucket holds a bit for each of a few thousand numbers, so the
    bitmaps of any dates merge into exact counts of distinct hosts.  One table serves all
    reports by ``hosts_by_period``; ``n`` counts the requests of the bucket's hosts.
    """
    visits = materialize(logs.groupBy(F.to_date("date_time").alias("date"), "host").agg(
        F.count("*").alias("n")), "visits")
    number = F.col("_number") + 1  # buckets are counted from 1
    numbered = visits.join(number_values(visits, "host", "_number"), "host").withColumn(
        "_number", number.cast("bigint"))
    return materialize(numbered.groupBy("date", F.bitmap_bucket_number("_number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("bits"),
        F.sum("n").alias("n")), "presence")


def hosts_by_period(presence: DataFrame, period: Column | str) -> DataFrame:
    """(period, n_hosts, n): distinct hosts and requests of each period, from ``host_presence``.

    ``period`` is any expression of the date, such as its day or month, or a constant.
    """
    period = F.col(period) if isinstance(period, str) else period
    merged = presence.groupBy(period.alias("period"), "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("n_hosts"), F.sum("n").alias("n"))
    return merged.groupBy("period").agg(F.sum("n_hosts").alias("n_hosts"), F.sum("n").alias("n"))


def distinct_endpoints(logs: DataFrame) -> DataFrame:
    return logs.select("endpoint").distinct()


def count_by_period(logs: DataFrame, by: str = "day") -> DataFrame:
    return logs.groupBy(_period(by)).agg(F.count("*").alias("n")).orderBy(by)


def top_periods(logs: DataFrame, k: int = 5, by: str = "day") -> DataFrame:
    return _top(logs.groupBy(_period(by)).agg(F.count("*").alias("n")), by, k)


def count_by_hour(logs: DataFrame) -> DataFrame:
    return (logs.groupBy(F.hour("date_time").alias("hour"))
            .agg(F.count("*").alias("n")).orderBy("hour"))

"""Access-log queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.operators import access_log as log
from harrow.operators.parse import (
    ACCESS_LOG_PATTERN,
    failed,
    parse_access_log,
    status_counts,
    valid,
    write_valid,
)
from harrow.plans.inputs import LOG_LINES_SQL, log_lines
from harrow.session import work_path


def _parsed(spark, sf_dir):
    return parse_access_log(log_lines(spark, sf_dir))


def _logs(spark, sf_dir):
    return valid(_parsed(spark, sf_dir))


def _missing(spark, sf_dir):
    return log.with_code(_logs(spark, sf_dir), 404)


def _log_parse(spark, sf_dir):
    return _parsed(spark, sf_dir).withColumn("date_time", F.col("date_time").cast("string"))


def _log_written(spark, sf_dir):
    """The counts that are taken while the valid rows are written, and the rows there are."""
    done = write_valid(_parsed(spark, sf_dir), work_path(spark, "logs"))
    return done.rows.agg(F.count("*").alias("n_written"),
                         *[F.lit(n).cast("bigint").alias(name) for name, n in done.counts.items()])


def _log_failed(spark, sf_dir):
    return failed(_parsed(spark, sf_dir))


def _host_reports(spark, sf_dir):
    """Distinct hosts and requests per host by date, day of the month, month and in all."""
    presence = log.host_presence(_logs(spark, sf_dir))
    date = F.col("date")
    kinds = {"date": date.cast("string"), "day": F.day(date).cast("string"),
             "month": F.date_format(date, "yyyy-MM"), "total": F.lit("all")}
    reports = [log.hosts_by_period(presence, period).select(
        F.lit(kind).alias("kind"), "period", "n_hosts",
        F.expr("n div n_hosts").alias("requests_per_host")) for kind, period in kinds.items()]
    return reduce(DataFrame.unionByName, reports)


QUERIES = {
    "log_parse": _log_parse,
    "log_parse_status": lambda s, d: status_counts(_parsed(s, d)),
    "log_parse_written": _log_written,
    "log_failed": _log_failed,
    "log_hosts": lambda s, d: log.hosts(_logs(s, d)),
    "log_top_errors": lambda s, d: log.top_error_endpoints(_logs(s, d), 10),
    "log_unique_hosts": lambda s, d: log.unique_host_count(_logs(s, d)),
    "log_daily_hosts": lambda s, d: log.daily_hosts(_logs(s, d)),
    "log_mean_daily_hosts": lambda s, d: log.mean_daily_hosts(_logs(s, d)).select(
        F.round("mean_hosts", 6).alias("mean_hosts")),
    "log_avg_req_per_host": lambda s, d: log.daily_requests_per_host(_logs(s, d)),
    "log_host_reports": _host_reports,
    "log_404": lambda s, d: _missing(s, d).withColumn(
        "date_time", F.col("date_time").cast("string")),
    "log_404_endpoints": lambda s, d: log.distinct_endpoints(_missing(s, d)),
    "log_top_404": lambda s, d: log.top_endpoints(_missing(s, d), 20),
    "log_404_by_day": lambda s, d: log.count_by_period(_missing(s, d)),
    "log_404_by_date": lambda s, d: log.count_by_period(_missing(s, d), by="date").select(
        F.col("date").cast("string").alias("date"), "n"),
    "log_top_404_days": lambda s, d: log.top_periods(_missing(s, d), 5),
    "log_404_by_hour": lambda s, d: log.count_by_hour(_missing(s, d)),
}

_FIELDS = ["host", "client_identd", "user_id", "log_time", "method", "endpoint", "protocol",
           "code", "size"]
_EXTRACT = ",\n    ".join(
    f"regexp_extract(value, '{ACCESS_LOG_PATTERN}', {i}) AS {name}"
    for i, name in enumerate(_FIELDS, 1))
_WITH = f"""WITH {LOG_LINES_SQL},
matched AS (
  SELECT value, regexp_matches(value, '{ACCESS_LOG_PATTERN}') AS good,
    {_EXTRACT}
  FROM lines),
logs AS (
  SELECT value, host, client_identd, user_id, method, endpoint, protocol,
    strptime(substr(log_time, 1, 20), '%d/%b/%Y:%H:%M:%S') AS date_time,
    CAST(code AS INTEGER) AS response_code,
    CASE WHEN size = '-' THEN 0 ELSE CAST(size AS BIGINT) END AS content_size
  FROM matched WHERE good),
missing AS (SELECT * FROM logs WHERE response_code = 404)
"""
_ROW = """host, client_identd, user_id, CAST(date_time AS VARCHAR) AS date_time, method,
  endpoint, protocol, response_code, content_size"""
_PER_DAY = """SELECT CAST(day(date_time) AS INTEGER) AS day, count(*) AS n,
  count(DISTINCT host) AS n_hosts FROM logs GROUP BY 1"""

ORACLE = {
    "log_parse": _WITH + f"""SELECT value, 'ok' AS status, {_ROW} FROM logs
UNION ALL SELECT value, 'invalid', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM matched WHERE NOT good""",
    "log_parse_status": _WITH + """SELECT count(*) AS n_read,
  count(*) FILTER (good) AS n_ok, CAST(0 AS BIGINT) AS n_header,
  count(*) FILTER (NOT good) AS n_invalid FROM matched""",
    "log_parse_written": _WITH + """SELECT count(*) AS n_read, count(*) FILTER (good) AS n_ok,
  CAST(0 AS BIGINT) AS n_header, count(*) FILTER (NOT good) AS n_invalid,
  count(*) FILTER (good) AS n_written FROM matched""",
    "log_failed": _WITH + "SELECT value FROM matched WHERE NOT good",
    "log_hosts": _WITH + "SELECT host FROM logs",
    "log_top_errors": _WITH + """SELECT endpoint, count(*) AS n FROM logs
WHERE response_code <> 200 GROUP BY endpoint ORDER BY n DESC, endpoint LIMIT 10""",
    "log_unique_hosts": _WITH + "SELECT count(DISTINCT host) AS n_hosts FROM logs",
    "log_daily_hosts": _WITH + f"SELECT day, n_hosts FROM ({_PER_DAY})",
    "log_mean_daily_hosts": _WITH + f"SELECT round(avg(n_hosts), 6) AS mean_hosts FROM ({_PER_DAY})",
    "log_avg_req_per_host": _WITH + f"""SELECT day, CAST(n // n_hosts AS BIGINT) AS requests_per_host
FROM ({_PER_DAY})""",
    "log_host_reports": _WITH + "\nUNION ALL ".join(
        f"""SELECT '{kind}' AS kind, {period} AS period, count(DISTINCT host) AS n_hosts,
  CAST(count(*) // count(DISTINCT host) AS BIGINT) AS requests_per_host FROM logs GROUP BY 2"""
        for kind, period in {
            "date": "CAST(CAST(date_time AS DATE) AS VARCHAR)",
            "day": "CAST(day(date_time) AS VARCHAR)", "month": "strftime(date_time, '%Y-%m')",
            "total": "'all'"}.items()),
    "log_404": _WITH + f"SELECT {_ROW} FROM missing",
    "log_404_endpoints": _WITH + "SELECT DISTINCT endpoint FROM missing",
    "log_top_404": _WITH + """SELECT endpoint, count(*) AS n FROM missing
GROUP BY endpoint ORDER BY n DESC, endpoint LIMIT 20""",
    "log_404_by_day": _WITH + """SELECT CAST(day(date_time) AS INTEGER) AS day, count(*) AS n
FROM missing GROUP BY 1 ORDER BY 1""",
    "log_404_by_date": _WITH + """SELECT CAST(CAST(date_time AS DATE) AS VARCHAR) AS date,
  count(*) AS n FROM missing GROUP BY 1 ORDER BY 1""",
    "log_top_404_days": _WITH + """SELECT CAST(day(date_time) AS INTEGER) AS day, count(*) AS n
FROM missing GROUP BY 1 ORDER BY n DESC, day LIMIT 5""",
    "log_404_by_hour": _WITH + """SELECT CAST(hour(date_time) AS INTEGER) AS hour, count(*) AS n
FROM missing GROUP BY 1 ORDER BY 1""",
}

import datetime
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from harrow.operators import access_log as log
from harrow.operators.parse import parse_access_log, valid


@pytest.fixture(scope="module")
def logs(spark):
    requests = [  # host, day and month, hour, endpoint, code
        ("a", "01/Aug", 0, "/x", 200), ("a", "01/Aug", 1, "/y", 404), ("b", "01/Aug", 1, "/y", 404),
        ("b", "02/Aug", 5, "/z", 404), ("b", "02/Aug", 5, "/x", 304), ("c", "01/Sep", 5, "/w", 500),
        ("a", "01/Aug", 2, "/x", 200), ("a", "01/Aug", 3, "/x", 200), ("c", "03/Aug", 23, "/y", 404),
    ]
    lines = [(f'{host} - - [{day}/1995:{hour:02}:00:00 -0400] "GET {end} HTTP/1.0" {code} 10',)
             for host, day, hour, end, code in requests]
    return valid(parse_access_log(spark.createDataFrame(lines, "value string")))


def test_errors(logs):
    got = [tuple(r) for r in log.top_error_endpoints(logs, 3).collect()]
    assert got == [("/y", 3), ("/w", 1), ("/x", 1)]


def test_hosts(logs):
    assert log.hosts(logs).count() == 9
    assert log.unique_host_count(logs).first().n_hosts == 3
    assert [tuple(r) for r in log.daily_hosts(logs).collect()] == [(1, 3), (2, 1), (3, 1)]
    assert log.daily_hosts(logs, by="date").count() == 4
    assert log.mean_daily_hosts(logs).first().mean_hosts == pytest.approx(5 / 3)


def test_requests_per_host_round_down(logs):
    got = [tuple(r) for r in log.daily_requests_per_host(logs).collect()]
    assert got == [(1, 2), (2, 2), (3, 1)]


def test_a_month_has_all_its_days(spark):
    lines = [(f'h - - [{day:02}/Aug/1995:00:00:00 -0400] "GET /{day} HTTP/1.0" 404 1',)
             for day in range(1, 32)]
    month = valid(parse_access_log(spark.createDataFrame(lines * 2, "value string")))
    for by in ("day", "date"):
        assert log.daily_hosts(month, by).count() == 31
        assert log.daily_requests_per_host(month, by).count() == 31
    assert log.distinct_endpoints(month).count() == 31


def test_missing_pages(logs):
    missing = log.with_code(logs, 404)
    assert missing.count() == 4
    assert rows(log.distinct_endpoints(missing)) == [("/y",), ("/z",)]
    assert [tuple(r) for r in log.top_endpoints(missing, 20).collect()] == [("/y", 3), ("/z", 1)]
    assert [tuple(r) for r in log.count_by_period(missing).collect()] == [(1, 2), (2, 1), (3, 1)]
    assert [tuple(r) for r in log.top_periods(missing, 2).collect()] == [(1, 2), (2, 1)]
    assert [tuple(r) for r in log.count_by_hour(missing).collect()] == [(1, 2), (5, 1), (23, 1)]


def test_unknown_period(logs):
    with pytest.raises(ValueError):
        log.daily_hosts(logs, by="week")


def test_top_k_needs_no_full_sort(logs):
    plan = log.top_error_endpoints(logs, 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_bitmaps_of_hosts_merge_into_exact_counts(spark):
    rng = random.Random(2)
    data = [(f"h{rng.randint(0, 60_000)}", datetime.datetime(2024, rng.choice([1, 2, 3]), rng.randint(1, 3), 5))
            for _ in range(60_000)] + [("hot", datetime.datetime(2024, 1, 1))] * 30_000
    logs = spark.createDataFrame(data, "host string, date_time timestamp_ntz")
    presence = log.host_presence(logs)
    assert presence.agg({"bucket": "max"}).first()[0] > 1  # more hosts than a bucket has bits
    for name, column, key in (
            ("day", F.day("date"), lambda t: t.day), ("month", F.month("date"), lambda t: t.month),
            ("date", F.col("date"), lambda t: t.date()), ("all", F.lit(0), lambda t: 0)):
        want = {}
        for host, time in data:
            want.setdefault(key(time), []).append(host)
        got = {r.period: (r.n_hosts, r.n) for r in log.hosts_by_period(presence, column).collect()}
        assert got == {k: (len(set(v)), len(v)) for k, v in want.items()}, name
    assert log.hosts_by_period(log.host_presence(logs.limit(0)), "date").collect() == []

import datetime

import pytest
from conftest import rows

from harrow.operators.parse import (
    failed,
    parse_access_log,
    parse_gold_pairs,
    parse_movies,
    parse_products,
    parse_ratings,
    status_counts,
    valid,
    write_valid,
)

GOOD = 'h.example.com - bob [01/Aug/1995:00:00:07 -0400] "GET /a/b.txt HTTP/1.0" 200 1839'


def table(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def test_access_log_fields(spark):
    row = parse_access_log(table(spark, GOOD)).first()
    assert row.status == "ok" and row.value == GOOD
    assert (row.host, row.client_identd, row.user_id) == ("h.example.com", "-", "bob")
    assert row.date_time == datetime.datetime(1995, 8, 1, 0, 0, 7)
    assert (row.method, row.endpoint, row.protocol) == ("GET", "/a/b.txt", "HTTP/1.0")
    assert (row.response_code, row.content_size) == (200, 1839)


def test_access_log_types(spark):
    types = dict(parse_access_log(table(spark, GOOD)).dtypes)
    assert types["date_time"] == "timestamp_ntz"
    assert types["response_code"] == "int" and types["content_size"] == "bigint"


@pytest.mark.parametrize("line, status, size, protocol", [
    (GOOD.replace(" 1839", " -"), "ok", 0, "HTTP/1.0"),
    (GOOD.replace(" HTTP/1.0", ""), "ok", 1839, ""),
    (GOOD + " trailing text", "ok", 1839, "HTTP/1.0"),
    (GOOD + "\tmore", "ok", 1839, "HTTP/1.0"),
    (GOOD.replace('"', ""), "invalid", None, None),
    ("x" + GOOD, "ok", 1839, "HTTP/1.0"),
    (" " + GOOD, "invalid", None, None),
    (GOOD.replace("01/Aug", "31/Feb"), "invalid", None, None),
    (GOOD.replace("01/Aug", "01/ugS"), "invalid", None, None),
    (GOOD.replace("00:00:07", "00:00:60"), "invalid", None, None),
    (GOOD.replace(" 1839", " 18x"), "invalid", None, None),
    ("", "invalid", None, None),
    ("a\nb\nc\nd\ne\nf\ng\nh\ni", "invalid", None, None),
])
def test_access_log_edges(spark, line, status, size, protocol):
    row = parse_access_log(table(spark, line)).first()
    assert (row.status, row.content_size, row.protocol) == (status, size, protocol)
    assert row.value == line


def test_time_does_not_depend_on_the_session_zone(spark):
    # 02:30 does not exist in New York on this day.
    line = GOOD.replace("01/Aug/1995:00:00:07", "10/Mar/2024:02:30:00")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        found = parse_access_log(table(spark, line)).selectExpr("string(date_time) t").first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == "2024-03-10 02:30:00"


def test_every_month_is_known(spark):
    names = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
    lines = [GOOD.replace("Aug", n) for n in names]
    found = valid(parse_access_log(table(spark, *lines))).selectExpr("month(date_time) m")
    assert rows(found) == [(i,) for i in range(1, 13)]


def test_routing_and_counts(spark):
    parsed = parse_access_log(table(spark, GOOD, "bad", GOOD))
    assert valid(parsed).count() == 2
    assert [r.value for r in failed(parsed).collect()] == ["bad"]
    assert tuple(status_counts(parsed).first()) == (3, 2, 0, 1)


def test_products(spark):
    parsed = parse_products(table(
        spark, '"id","name","description","manufacturer","price"',
        '"b1","colour set 950 ""x""","fun, and more","makers ltd",0',
        '"http://x/1","only name",,,9.5', "no commas"))
    assert rows(valid(parsed)) == [
        ("b1", 'colour set 950 ""x"" "fun, and more" "makers ltd"'),
        ("http://x/1", "only name  ")]
    assert tuple(status_counts(parsed).first()) == (4, 2, 1, 1)


def test_products_match_the_greedy_pattern(spark):
    import re
    from harrow.operators.parse import PRODUCT_PATTERN
    lines = ['"a","b","c","d",1', '"a","b, with","c","d","e",1', '"a","",,,', 'x,"y",,,',
             '"a","b\u2028c","d","e",1']
    found = {r.value: (r.status, r.text) for r in parse_products(table(spark, *lines)).collect()}
    for line in lines:
        match = re.search(PRODUCT_PATTERN, line)
        want = ("ok", " ".join(match.group(2, 3, 4))) if match else ("invalid", None)
        assert found[line] == want


def test_gold_pairs(spark):
    parsed = parse_gold_pairs(table(spark, '"idAmazon","idGoogleBase"', '"b1","http://x/1"', "z"))
    assert rows(valid(parsed)) == [("b1", "http://x/1")]
    assert tuple(status_counts(parsed).first()) == (3, 1, 1, 1)


def test_ratings_and_movies(spark):
    ratings = parse_ratings(table(spark, "1::1193::5::978300760", "x::1::2::3", "1::2", "7::8::4.5"))
    assert rows(valid(ratings)) == [(1, 1193, 5.0), (7, 8, 4.5)]
    assert tuple(status_counts(ratings).first()) == (4, 2, 0, 2)
    movies = parse_movies(table(spark, "1::Toys (1995)::Fun|Kids", "y::z"))
    assert rows(valid(movies)) == [(1, "Toys (1995)")]


def test_lines_with_too_few_or_too_many_fields(spark):
    lines = table(spark, "1::2::3.5::9", "1::2::3.5", "1::2::3::9::x", "x::2::3::4", '1::2::"3"::4',
                  "4::5::2::", "", "1::2::3::4::", '6::7::1::"a')
    found = {r.value: r.status for r in parse_ratings(lines, exact=True).collect()}
    assert found == {"1::2::3.5::9": "ok", "1::2::3.5": "malformed", "1::2::3::9::x": "malformed",
                     "x::2::3::4": "invalid", '1::2::"3"::4': "invalid", "4::5::2::": "ok", "": "malformed",
                     "1::2::3::4::": "malformed", '6::7::1::"a': "ok"}
    parsed = parse_ratings(lines, exact=True)
    assert rows(valid(parsed)) == [(1, 2, 3.5), (4, 5, 2.0), (6, 7, 1.0)]
    assert tuple(status_counts(parsed).first()) == (9, 3, 0, 6) and failed(parsed).count() == 6
    movies = parse_movies(table(spark, '2::"Q" \\ z::y', "1::::x", "3::t"), exact=True)
    assert rows(valid(movies)) == [(1, ""), (2, '"Q" \\ z')]
    nulls = spark.createDataFrame([(None,)], "value string")
    assert [r.status for r in parse_ratings(nulls, exact=True).collect()] == ["invalid"]


def test_counts_come_with_the_rows_that_are_written(spark, tmp_path):
    """One pass over the lines: each is parsed by just one task, once."""
    source = str(tmp_path / "lines")
    table(spark, GOOD, "bad", GOOD, "worse").repartition(3).write.text(source)
    parsed = parse_access_log(spark.read.text(source))
    done = write_valid(parsed, str(tmp_path / "valid"))
    assert done.counts == status_counts(parsed).first().asDict()
    assert done.counts == {"n_read": 4, "n_ok": 2, "n_header": 0, "n_invalid": 2}
    assert rows(done.rows, "host") == rows(valid(parsed), "host")
    products = write_valid(parse_products(table(spark, "no commas")), str(tmp_path / "products"))
    assert products.counts["n_invalid"] == 1 and products.rows.count() == 0
    empty = write_valid(parse_access_log(table(spark, "x").limit(0)), str(tmp_path / "empty"))
    assert set(empty.counts.values()) == {0}


def test_writing_and_counting_scan_once(spark, tmp_path):
    """The job that writes and counts reads every line once, by the plan that ran."""
    source = str(tmp_path / "lines")
    table(spark, *[GOOD] * 50, "bad").repartition(1).write.text(source)
    before = jobs(spark)
    write_valid(parse_access_log(spark.read.text(source)), str(tmp_path / "valid"))
    assert jobs(spark) - before == 1


def jobs(spark):
    """Jobs that the session has run so far."""
    return int(str(spark.sparkContext._jsc.sc().dagScheduler().nextJobId()))

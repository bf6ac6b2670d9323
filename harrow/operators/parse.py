"""Line parsers.

Each adds parsed columns and a ``status`` of ``ok``, ``header``, ``invalid`` or (a wrong
number of fields) ``malformed`` and keeps the raw line in ``value``; parsed columns are null unless ``ok``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from harrow.functions.text import strip_quotes

# The record formats.
ACCESS_LOG_PATTERN = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)" (\d{3}) (\S+)'
PRODUCT_PATTERN = r'^(.+),"(.+)",(.*),(.*),(.*)'
GOLD_PATTERN = r'^(.+),(.+)'
PRODUCT_HEADER = '"id"'
GOLD_HEADER = '"idAmazon"'

# A line holds no line feed, so one can separate the groups of a match.
_SEPARATOR = "\n"


def _match(lines: DataFrame, column: str, pattern: str, count: int) -> DataFrame:
    """(value, g): the capture groups of an anchored pattern, by one regex pass.

    A line that does not match gives an array of one element.  The one-row
    explode keeps later filters from repeating the regex pass.
    """
    value = F.col(column)
    joined = _SEPARATOR.join(f"${i}" for i in range(1, count + 1))
    groups = F.split(F.regexp_replace(value, f"(?d){pattern}[\\s\\S]*", F.lit(joined)), _SEPARATOR)
    one_line = F.when(~value.contains(_SEPARATOR), groups)
    return lines.select(value.alias("value"), F.explode(F.array(one_line)).alias("g"))


def _matched(count: int) -> Column:
    return F.coalesce(F.size("g") == count, F.lit(False))


def _when_ok(df: DataFrame, fields: Mapping[str, Column], keep: list[str]) -> DataFrame:
    ok = F.col("status") == "ok"
    return df.select(*keep, "status", *[F.when(ok, c).alias(n) for n, c in fields.items()])


def log_time(text: Column) -> Column:
    """``dd/Mon/yyyy:HH:mm:ss +zzzz`` as a zone-less timestamp; the offset is ignored.

    The time is read as if in UTC and counted from the epoch, so the session's zone and
    its gaps play no part.
    """
    utc = F.try_to_timestamp(F.concat(F.substring(text, 1, 20), F.lit(" +0000")),
                             F.lit("dd/MMM/yyyy:HH:mm:ss Z"))
    since = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.unix_seconds(utc))
    return F.lit("1970-01-01").cast("timestamp_ntz") + since


def parse_access_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Common Log Format lines.

    The pattern is anchored at the start only, so trailing text is accepted.  A
    line that matches but holds an impossible time or size is ``invalid`` too.
    """
    raw = _match(lines, column, ACCESS_LOG_PATTERN, 9)
    g = [F.get("g", F.lit(i)) for i in range(9)]  # all null past 0 if unmatched
    typed = raw.select(
        "value", "g",
        log_time(g[3]).alias("date_time"),
        F.when(g[8] == "-", F.lit(0).cast("bigint"))
         .otherwise(g[8].try_cast("bigint")).alias("content_size"))
    good = F.col("date_time").isNotNull() & F.col("content_size").isNotNull()
    status = F.when(good, "ok").otherwise("invalid")
    return _when_ok(typed.withColumn("status", status), {
        "host": g[0],
        "client_identd": g[1],
        "user_id": g[2],
        "date_time": F.col("date_time"),
        "method": g[4],
        "endpoint": g[5],
        "protocol": g[6],
        "response_code": g[7].cast("int"),
        "content_size": F.col("content_size"),
    }, ["value"])


def parse_products(lines: DataFrame, column: str = "value") -> DataFrame:
    """``"id","name","description","manufacturer",price`` lines.

    ``text`` joins name, description and manufacturer; the price is dropped.
    """
    g = [F.get("g", F.lit(i)) for i in range(5)]
    status = (F.when(~_matched(5), "invalid").when(g[0] == PRODUCT_HEADER, "header")
              .otherwise("ok"))
    parsed = _match(lines, column, PRODUCT_PATTERN, 5).withColumn("status", status)
    return _when_ok(parsed, {"id": strip_quotes(g[0]), "text": F.concat_ws(" ", *g[1:4])},
                    ["value"])


def parse_gold_pairs(lines: DataFrame, column: str = "value") -> DataFrame:
    """``"id_a","id_b"`` lines naming true matches."""
    g = [F.get("g", F.lit(i)) for i in range(2)]
    status = (F.when(~_matched(2), "invalid").when(g[0] == GOLD_HEADER, "header")
              .otherwise("ok"))
    parsed = _match(lines, column, GOLD_PATTERN, 2).withColumn("status", status)
    return _when_ok(parsed, {"id_a": strip_quotes(g[0]), "id_b": strip_quotes(g[1])}, ["value"])


RATING_FIELDS = ("user", "item", "rating", "time")
MOVIE_FIELDS = ("item", "title", "genres")


def parse_ratings(lines: DataFrame, column: str = "value", exact: bool = False) -> DataFrame:
    """``user::item::rating::time`` lines; the time is dropped.

    With ``exact`` a line that has not just these fields is ``malformed``, whatever they hold.
    """
    return _parse_fields(lines, column, RATING_FIELDS, {
        "user": "bigint", "item": "bigint", "rating": "double"}, exact)


def parse_movies(lines: DataFrame, column: str = "value", exact: bool = False) -> DataFrame:
    """``item::title::genres`` lines; the genres are dropped.

    With ``exact`` a line that has not just these fields is ``malformed``, whatever they hold.
    """
    return _parse_fields(lines, column, MOVIE_FIELDS, {"item": "bigint", "title": "string"}, exact)


def _parse_fields(lines: DataFrame, column: str, names: tuple[str, ...], kinds: Mapping[str, str],
                  exact: bool) -> DataFrame:
    if exact:
        records = read_records(lines, names, "::", column)
        # An empty field is read as null; all fields of a whole record are there.
        fields = [F.coalesce(F.col("record")[name], F.lit("")) for name in names]
        whole = F.col("record")[MALFORMED].isNull() & (F.col("value") != "")
    else:
        parts = F.split(F.col(column), "::")
        records = lines.select(F.col(column).alias("value"), F.explode(F.array(parts)).alias("g"))
        fields = [F.get("g", F.lit(i)) for i in range(len(names))]
        whole = F.lit(True)
    typed = records.select("value", whole.alias("whole"), *[
        field.try_cast(kinds[name]).alias(name)
        for name, field in zip(names, fields, strict=True) if name in kinds])
    good = F.lit(True)
    for name in kinds:
        good = good & F.col(name).isNotNull()
    status = F.when(~F.col("whole"), "malformed").when(good, "ok").otherwise("invalid")
    return _when_ok(typed.withColumn("status", status), {name: F.col(name) for name in kinds},
                    ["value"])


MALFORMED = "_malformed"


def read_records(lines: DataFrame, names: tuple[str, ...], sep: str,
                 column: str = "value") -> DataFrame:
    """(value, record): the fields of each line as text, under their names.

    ``record._malformed`` holds the line where it has fewer or more fields than names, so that
    such lines are told from those whose fields have bad values.  Quotes mean nothing; an
    empty field is null.
    """
    schema = ", ".join(f"{name} string" for name in (*names, MALFORMED))
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED,
               "quote": "", "escape": "",
               "maxColumns": "1000000", "maxCharsPerColumn": "-1"}
    # The one-row explode keeps later filters from parsing the line again.
    record = F.explode(F.array(F.from_csv(column, schema, options)))
    return lines.select(F.col(column).alias("value"), record.alias("record"))


def valid(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("status") == "ok").drop("status", "value")


def failed(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("status").isin("invalid", "malformed")).select("value")


def _counts() -> list[Column]:
    def count_of(*status: str) -> Column:
        return F.count_if(F.col("status").isin(*status))

    return [F.count("*").alias("n_read"), count_of("ok").alias("n_ok"),
            count_of("header").alias("n_header"),
            count_of("invalid", "malformed").alias("n_invalid")]


def status_counts(parsed: DataFrame) -> DataFrame:
    """Lines read, parsed, header and failed, by one aggregation."""
    return parsed.agg(*_counts())


@dataclass(frozen=True)
class ParseOutcome:
    """The valid rows as written, and the counts that the same pass has taken."""

    rows: DataFrame
    counts: dict[str, int]


def write_valid(parsed: DataFrame, path: str, mode: str = "errorifexists") -> ParseOutcome:
    """Write the valid rows as Parquet and count the lines on the way.

    The lines are read once.  Writing needs no shuffle of its own, so every line is counted
    by the task that writes it, and a task that is run again counts once.
    """
    observed = Observation("parse")
    rows = valid(parsed.observe(observed, *_counts()))
    rows.write.mode(mode).parquet(path)
    # An empty input runs no task, and then nothing is observed.
    counts = {name: observed.get.get(name, 0) for name in ("n_read", "n_ok", "n_header", "n_invalid")}
    return ParseOutcome(parsed.sparkSession.read.schema(rows.schema).parquet(path), counts)

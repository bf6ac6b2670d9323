"""Relational building blocks and SQL over views."""

from __future__ import annotations

from pyspark.sql import functions as F

from harrow.operators import relational as rel
from harrow.operators.sampling import GROUP_ROWS, sample_with_replacement
from harrow.operators.weights import drop_stop_words, token_rows
from harrow.plans.inputs import (
    NAMES_SQL,
    STOP_SQL,
    STOP_WORDS,
    TRIPS_SQL,
    names,
    passages,
    table,
    trip_lines,
    trips,
)
from harrow.session import work_path
from harrow.sources import (
    literal_table,
    read_compressed_lines,
    read_csv,
    read_json_document,
    read_json_lines,
    read_lines,
    read_stop_words,
    register_views,
    schema_table,
    split_lines,
    text_date,
    without_lines_containing,
    write_csv,
    write_json_arrays,
)
from harrow.sources.readers import json_elements

BUSY_TRIPS = 15_000
PIECE_ROWS = 500
SAMPLE_ROWS = 1_000
SAMPLE_SEED = 7
SAMPLE_COLUMNS = ["l_partkey", "l_suppkey", "l_linenumber"]


def _fields(spark, sf_dir):
    return split_lines(trip_lines(spark, sf_dir))


def _field_columns(df):
    return df.select(*[F.col("fields")[i].alias(n)
                       for i, n in enumerate(["base", "day", "vehicles", "trips"])])


def _busy_days(spark, sf_dir):
    rows = _field_columns(rel.rows_with_field(_fields(spark, sf_dir), "purchase"))
    busy = rows.filter(F.col("trips").try_cast("bigint") > BUSY_TRIPS)
    return busy.agg(F.count("*").alias("n_rows"), F.count_distinct("day").alias("n_days"))


def _list_text(values):
    return F.array_join(F.transform(values, lambda v: F.concat_ws(
        ":", v["value"], v["n"].cast("string"))), ",")


def _name_lists(spark, sf_dir):
    return rel.value_lists(names(spark, sf_dir), "name", "county")


def _name_list_rows(spark, sf_dir):
    return _name_lists(spark, sf_dir).select("name", "part", "n",
                                             _list_text(F.col("values")).alias("values"))


def _name_maps(spark, sf_dir):
    return rel.value_maps(_name_lists(spark, sf_dir), "name").select(
        F.to_json("entry").alias("entry"))


def _buyers(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"))


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))


def _lengths(spark, sf_dir):
    return names(spark, sf_dir).select("id", "name", F.length("name").alias("n"))


def _sample(spark, sf_dir):
    """Drawn from rows with many copies."""
    lines = table(spark, sf_dir, "lineitem").select(*SAMPLE_COLUMNS)
    return sample_with_replacement(lines, SAMPLE_ROWS, SAMPLE_SEED)


def _partition_sums(spark, sf_dir):
    sums = rel.per_partition_sums(table(spark, sf_dir, "lineitem"), "l_partkey")
    return sums.agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def _sum_of_rows(rows):
    """The sum of the keys of a partition's rows that are odd, and how many there are."""
    n = total = 0
    for row in rows:
        if row.l_partkey % 2:
            n, total = n + 1, total + row.l_partkey
    yield n, total


def _partition_function(spark, sf_dir):
    """A function of our own on every partition; the total does not depend on their number."""
    keys = table(spark, sf_dir, "lineitem").select("l_partkey")
    sums = rel.map_partitions(keys, _sum_of_rows, "n bigint, total bigint")
    return sums.agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def _sql(text):
    def run(spark, sf_dir):
        register_views({"trips": trips(spark, sf_dir), "names": names(spark, sf_dir)})
        return spark.sql(text)
    return run


def _json_props(spark, sf_dir):
    props = F.from_json("props", "k bigint")
    return table(spark, sf_dir, "events").select("event_id", props["k"].alias("k"))


def _json_array_rows(spark, sf_dir):
    documents = table(spark, sf_dir, "events").select(
        F.concat(F.lit("[ "), F.col("props"), F.lit(' , {"k": 0} ]')).alias("value"))
    elements = json_elements(documents, "struct<k:bigint>", strip_whitespace=True)
    return elements.groupBy("k").agg(F.count("*").alias("n"))


def _events_as_json(spark, sf_dir):
    """Events with a field that only some of them have."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.from_json("props", "k bigint").alias("props"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("kind of event"))


def _event_rows(rows):
    return rows.select("id", F.col("props.k").alias("k"), F.col("kind of event").alias("kind"))


def _json_lines(spark, sf_dir):
    """Events from JSON lines whose schema comes from the lines."""
    path = work_path(spark, "json-lines")
    _events_as_json(spark, sf_dir).write.json(path)
    return _event_rows(read_json_lines(spark, path))


def _json_documents(spark, sf_dir):
    """Events from whole-file JSON arrays, read by byte ranges."""
    path = work_path(spark, "json-documents")
    write_json_arrays(_events_as_json(spark, sf_dir), path)
    return _event_rows(read_json_document(spark, path))


def _urgent_buyers(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    return urgent.select(F.col("o_custkey").alias("custkey"))


def _text_scan(spark, sf_dir):
    """The trip lines, written as text files and read again."""
    path = work_path(spark, "lines")
    trip_lines(spark, sf_dir).write.text(path)
    return read_lines(spark, path)


def _gzip_scan(spark, sf_dir):
    """The trip lines from gzip files, spread over more tasks than there are files."""
    path = work_path(spark, "gzip")
    trip_lines(spark, sf_dir).write.option("compression", "gzip").text(path)
    return read_compressed_lines(spark, path, 8)


def _written_trips(spark, sf_dir):
    """Trips as CSV files with a header, other column order and M/d/yyyy days."""
    path = work_path(spark, "csv")
    day = F.date_format(F.to_date("day"), "M/d/yyyy").alias("day")
    write_csv(trips(spark, sf_dir).select("base", "vehicles", "trips", day), path,
              ["day", "base", "trips", "vehicles"], header=True)
    return path


def _csv_inferred(spark, sf_dir):
    """The busiest days, from CSV files with inferred types and a date step."""
    rows = read_csv(spark, _written_trips(spark, sf_dir)).withColumn("day", text_date("day"))
    sums = rows.groupBy("day").agg(F.sum("trips").alias("trips")).orderBy("day")
    return sums.select(F.col("day").cast("string").alias("day"), "trips")


def _csv_declared(spark, sf_dir):
    schema = "day string, base string, trips bigint, vehicles bigint"
    return read_csv(spark, _written_trips(spark, sf_dir), schema)


def _priorities(spark, sf_dir):
    """Orders joined with a table written in the program."""
    weights = literal_table(spark, list(PRIORITY_WEIGHTS), "o_orderpriority string, weight int")
    orders = table(spark, sf_dir, "orders").join(F.broadcast(weights), "o_orderpriority")
    return orders.groupBy("weight").agg(F.count("*").alias("n"))


def _stop_table(spark, sf_dir):
    """Words of the passages that are not in a file of stop-words."""
    path = work_path(spark, "stop")
    literal_table(spark, [(w,) for w in STOP_WORDS], "value string").write.text(path)
    rows = token_rows(passages(spark, sf_dir))
    return drop_stop_words(rows, read_stop_words(spark, path)).groupBy("token").agg(
        F.count("*").alias("n"))


def _typed_member(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return rel.rows_with_value(rows, "R")


EQUAL_RECORD = {"l_linenumber": 1, "l_returnflag": "R", "l_quantity": 5.0}
PRIORITY_WEIGHTS = (("1-URGENT", 10), ("2-HIGH", 5), ("5-LOW", 1))

# These texts run in both engines as they stand.
SQL_TEXTS = {
    "sql_select": "SELECT name FROM names",
    "sql_distinct": "SELECT DISTINCT base FROM trips",
    "sql_like": "SELECT * FROM trips WHERE base LIKE '%lic%'",
    "sql_distinct_group": """SELECT DISTINCT (base), CAST(sum(trips) AS BIGINT) AS cnt
FROM trips GROUP BY base ORDER BY cnt DESC""",
    "sql_group_limit": """SELECT DISTINCT (day), CAST(sum(trips) AS BIGINT) AS cnt
FROM trips GROUP BY day ORDER BY cnt DESC, day LIMIT 5""",
}

QUERIES = {
    "trips_rows_split": lambda s, d: _field_columns(_fields(s, d)),
    "trips_member": lambda s, d: _field_columns(rel.rows_with_field(_fields(s, d), "click")),
    "trips_busy_days": _busy_days,
    "trips_sum_by_base": lambda s, d: rel.sum_by(trips(s, d), "base", "trips", "trips"),
    "trips_top_bases": lambda s, d: rel.top_sums(trips(s, d), "base", "trips", "trips", 3),
    "names_sum": lambda s, d: rel.top_k(
        rel.sum_by(names(s, d), "name", "count", "total"), 5, "name"),
    "names_sum_desc": lambda s, d: rel.top_k(
        rel.sum_by(names(s, d), "name", "count", "total"), 5, F.desc("name")),
    "names_group_list": _name_list_rows,
    "names_map": _name_maps,
    "core_union": lambda s, d: rel.bag_union(_buyers(s, d), _customers(s, d)),
    "core_intersect": lambda s, d: rel.set_intersection(_buyers(s, d), _customers(s, d)),
    "core_union_distinct": lambda s, d: rel.set_union(_buyers(s, d), _customers(s, d)),
    "core_difference": lambda s, d: rel.difference_by_key(
        _customers(s, d), _urgent_buyers(s, d), ["custkey"]),
    "core_length": _lengths,
    "core_length_total": lambda s, d: _lengths(s, d).agg(F.sum("n").alias("total")),
    "core_concat": lambda s, d: rel.concat_in_order(names(s, d), "county", "id", PIECE_ROWS),
    "core_count_by_key": lambda s, d: rel.count_by(table(s, d, "orders"), "o_orderpriority"),
    "core_partition_sums": _partition_sums,
    "core_partition_function": _partition_function,
    "core_sample": _sample,
    "core_rows_equal": lambda s, d: rel.rows_equal_to(
        table(s, d, "lineitem"), EQUAL_RECORD).select("l_orderkey", *EQUAL_RECORD),
    "core_typed_member": _typed_member,
    "core_without_lines": lambda s, d: without_lines_containing(trip_lines(s, d), "purchase"),
    "core_text_scan": _text_scan,
    "core_gzip_scan": _gzip_scan,
    "core_csv_inferred": _csv_inferred,
    "core_csv_declared": _csv_declared,
    "core_literal_table": _priorities,
    "core_schema_table": lambda s, d: schema_table(table(s, d, "events")),
    "core_stop_table": _stop_table,
    **{name: _sql(text) for name, text in SQL_TEXTS.items()},
    "json_props": _json_props,
    "json_array_rows": _json_array_rows,
    "json_lines": _json_lines,
    "json_documents": _json_documents,
}

_TRIPS = f"WITH {TRIPS_SQL}\n"
_NAMES = f"WITH {NAMES_SQL}\n"
_LINES = f"""WITH {TRIPS_SQL},
lines AS (SELECT base || ',' || day || ',' || vehicles || ',' || trips AS value FROM trips)
"""
_LISTS = f"""WITH {NAMES_SQL},
counted AS (SELECT name, county, count(*) AS n FROM names GROUP BY name, county)
"""
_LINE_TEXTS = """CAST(base AS VARCHAR) AS base, day, CAST(vehicles AS VARCHAR) AS vehicles,
  CAST(trips AS VARCHAR) AS trips"""
_KEYS = """buyers AS (SELECT o_custkey AS custkey FROM orders),
customers AS (SELECT c_custkey AS custkey FROM customer)
"""


_COLUMNS = ", ".join(SAMPLE_COLUMNS)
_EVENT_ROWS = """SELECT event_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  CASE WHEN event_id % 3 = 0 THEN event_type END AS kind FROM events"""


def _hash_sql(seed, *columns):
    text = " || ':' || ".join([f"'{seed}'", *columns])
    return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)"


ORACLE = {
    "trips_rows_split": _TRIPS + f"SELECT {_LINE_TEXTS} FROM trips",
    "trips_member": _TRIPS + f"SELECT {_LINE_TEXTS} FROM trips WHERE base = 'click'",
    "trips_busy_days": _TRIPS + f"""SELECT count(*) AS n_rows, count(DISTINCT day) AS n_days
FROM trips WHERE base = 'purchase' AND trips > {BUSY_TRIPS}""",
    "trips_sum_by_base": _TRIPS + """SELECT base, CAST(sum(trips) AS BIGINT) AS trips
FROM trips GROUP BY base""",
    "trips_top_bases": _TRIPS + """SELECT base, CAST(sum(t.trips) AS BIGINT) AS trips
FROM trips t GROUP BY base ORDER BY 2 DESC, base LIMIT 3""",
    "names_sum": _NAMES + """SELECT name, CAST(sum("count") AS BIGINT) AS total
FROM names GROUP BY name ORDER BY name LIMIT 5""",
    "names_sum_desc": _NAMES + """SELECT name, CAST(sum("count") AS BIGINT) AS total
FROM names GROUP BY name ORDER BY name DESC LIMIT 5""",
    "names_group_list": _LISTS + """SELECT name, CAST(0 AS INTEGER) AS part,
  CAST(sum(n) AS BIGINT) AS n, string_agg(county || ':' || n, ',' ORDER BY county) AS "values"
FROM counted GROUP BY name""",
    "names_map": _LISTS + """SELECT '{"' || name || '":['
  || string_agg('{"value":"' || county || '","n":' || n || '}', ',' ORDER BY county) || ']}' AS entry
FROM counted GROUP BY name""",
    "core_union": f"""WITH {_KEYS}
SELECT custkey FROM buyers UNION ALL SELECT custkey FROM customers""",
    "core_intersect": f"""WITH {_KEYS}
SELECT custkey FROM buyers INTERSECT SELECT custkey FROM customers""",
    "core_union_distinct": f"""WITH {_KEYS}
SELECT custkey FROM buyers UNION SELECT custkey FROM customers""",
    "core_difference": f"""WITH {_KEYS}
SELECT custkey FROM customers WHERE custkey NOT IN
  (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "core_length": _NAMES + "SELECT id, name, CAST(length(name) AS INTEGER) AS n FROM names",
    "core_length_total": _NAMES + "SELECT CAST(sum(length(name)) AS BIGINT) AS total FROM names",
    "core_concat": _NAMES + f"""SELECT CAST(id // {PIECE_ROWS} AS BIGINT) AS piece,
  string_agg(county, '' ORDER BY id) AS text FROM names GROUP BY 1""",
    "core_count_by_key": "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1",
    "core_partition_sums": """SELECT count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS total
FROM lineitem""",
    "core_partition_function": """SELECT count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS total
FROM lineitem WHERE l_partkey % 2 = 1""",
    "core_sample": f"""WITH size AS (
  SELECT count(*) AS n, greatest(1, CAST(ceil(count(*) / {GROUP_ROWS}.0) AS BIGINT)) AS groups
  FROM lineitem),
numbered AS (
  SELECT c.*, row_number() OVER (ORDER BY {_hash_sql(0, *SAMPLE_COLUMNS, "0")} % size.groups,
    {_COLUMNS}) - 1 AS position FROM (SELECT {_COLUMNS} FROM lineitem) c, size),
draws AS (
  SELECT range AS draw, {_hash_sql(SAMPLE_SEED, 'range')} % size.n AS position
  FROM range({SAMPLE_ROWS}), size)
SELECT draw, {_COLUMNS} FROM draws JOIN numbered USING (position)""",
    "core_rows_equal": """SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem
WHERE l_linenumber = 1 AND l_returnflag = 'R' AND l_quantity = 5""",
    "core_typed_member": """SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
WHERE l_returnflag = 'R'""",
    "core_without_lines": _LINES + "SELECT value FROM lines WHERE NOT contains(value, 'purchase')",
    "core_text_scan": _LINES + "SELECT value FROM lines",
    "core_gzip_scan": _LINES + "SELECT value FROM lines",
    "core_csv_inferred": _TRIPS + """SELECT day, CAST(sum(trips) AS BIGINT) AS trips
FROM trips GROUP BY day""",
    "core_csv_declared": _TRIPS + """SELECT strftime(CAST(day AS DATE), '%-m/%-d/%Y') AS day, base,
  trips, vehicles FROM trips""",
    "core_literal_table": f"""SELECT CAST(weight AS INTEGER) AS weight, count(*) AS n FROM orders
JOIN (VALUES {", ".join(map(str, PRIORITY_WEIGHTS))}) w(o_orderpriority, weight)
USING (o_orderpriority) GROUP BY 1""",
    "core_schema_table": """SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS position,
  column_name AS name, CASE column_type WHEN 'VARCHAR' THEN 'string'
    WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS type,
  "null" = 'YES' AS nullable FROM (DESCRIBE events)""",
    "core_stop_table": rf"""WITH words AS (
  SELECT unnest(regexp_split_to_array(lower(text), '\W+')) AS token FROM benchmark)
SELECT token, count(*) AS n FROM words
WHERE token <> '' AND token NOT IN ({STOP_SQL}) GROUP BY token""",
    **{name: f"WITH {TRIPS_SQL},{NAMES_SQL}\n{text}" for name, text in SQL_TEXTS.items()},
    "json_props": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events""",
    "json_array_rows": """SELECT k, count(*) AS n FROM (
  SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
  UNION ALL SELECT 0 FROM events) GROUP BY k""",
    "json_lines": _EVENT_ROWS,
    "json_documents": _EVENT_ROWS,
}

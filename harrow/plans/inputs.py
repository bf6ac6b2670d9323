"""The inputs of the jobs, derived from the given tables.

Each input exists twice: as a DataFrame and as SQL text (``*_SQL``, common table
expressions) for the independent check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.functions.text import tokenize
from harrow.operators.skew import join_pairs
from harrow.operators.weights import inverted_pairs
from harrow.session import materialize

# Common English words left out of the text vectors.
STOP_WORDS = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is",
              "it", "of", "on", "or", "that", "the", "to", "with")
STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# Access log -------------------------------------------------------------------

def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request line per event; some lines lack their quotes."""
    event = F.col("event_id")
    code = (F.when((F.col("event_type") == "error") & (event % 2 == 0), "404")
            .when(F.col("event_type") == "error", "500").otherwise("200"))
    size = F.when(event % 10 == 0, "-").otherwise(F.floor(F.col("value") * 100).cast("string"))
    line = _text("u", F.col("user_id"), ".example.com - - [",
                 F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), ' +0000] "GET /',
                 F.col("event_type"), "/", event % 20, ' HTTP/1.0" ', code, " ", size)
    value = F.when(event % 97 == 0, F.translate(line, '"', "")).otherwise(line)
    return table(spark, sf_dir, "events").select(value.alias("value"))


LOG_LINES_SQL = r"""
plain AS (
  SELECT event_id, 'u' || user_id || '.example.com - - ['
    || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "GET /' || event_type || '/'
    || (event_id % 20) || ' HTTP/1.0" '
    || CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN '404'
            WHEN event_type = 'error' THEN '500' ELSE '200' END || ' '
    || CASE WHEN event_id % 10 = 0 THEN '-'
            ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END AS line
  FROM events),
lines AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN replace(line, '"', '') ELSE line END AS value
  FROM plain)"""


# Trips and names --------------------------------------------------------------

def trip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``base,day,vehicles,trips`` lines, one per event."""
    return trips(spark, sf_dir).select(F.concat_ws(
        ",", "base", "day", F.col("vehicles").cast("string"),
        F.col("trips").cast("string")).alias("value"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("base"), F.to_date("ts").cast("string").alias("day"),
        F.col("user_id").alias("vehicles"),
        F.round(F.col("value") * 100).cast("bigint").alias("trips"))


TRIPS_SQL = """
trips AS (
  SELECT event_type AS base, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
    user_id AS vehicles, CAST(round(value * 100) AS BIGINT) AS trips
  FROM events)"""


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.col("p_brand").alias("county"), F.col("p_type").alias("sex"),
        F.col("p_size").alias("count"))


NAMES_SQL = """
names AS (
  SELECT p_partkey AS id, p_name AS name, p_brand AS county, p_type AS sex, p_size AS "count"
  FROM part)"""


# Product, gold, rating and item lines -----------------------------------------

def product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quoted line per part, a header, and some lines without commas."""
    key = F.col("p_partkey")
    line = _text('"http://x/', key, '","', F.col("p_name"), '","', F.col("p_type"), '","',
                 F.col("p_brand"), '",', F.col("p_size"))
    value = F.when(key % 97 == 0, F.translate(line, ",", ";")).otherwise(line)
    header = spark.createDataFrame([('"id","name","description","manufacturer","price"',)],
                                   "value string")
    return table(spark, sf_dir, "part").select(value.alias("value")).unionByName(header)


PRODUCT_LINES_SQL = """
plain AS (
  SELECT p_partkey, '"http://x/' || p_partkey || '","' || p_name || '","' || p_type || '","'
    || p_brand || '",' || p_size AS line FROM part),
lines AS (
  SELECT CASE WHEN p_partkey % 97 = 0 THEN replace(line, ',', ';') ELSE line END AS value
  FROM plain
  UNION ALL SELECT '"id","name","description","manufacturer","price"')"""


def gold_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = gold_pairs(spark, sf_dir).select(
        _text('"d', F.col("id_a"), '","b', F.col("id_b"), '"').alias("value"))
    header = spark.createDataFrame([('"idAmazon","idGoogleBase"',)], "value string")
    return pairs.unionByName(header)


def rating_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: (order_id, user, item, rating)."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user"),
        F.col("l_partkey").alias("item"), F.col("l_quantity").alias("rating"))


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user::item::rating::time`` lines; some have a user that is no number, some no time
    and some one field more."""
    order = F.col("order_id")
    user = F.when(order % 97 == 0, "x").otherwise(F.col("user").cast("string"))
    last = F.when(order % 89 == 1, F.lit(None)).when(order % 83 == 2, "0::0").otherwise("0")
    return rating_rows(spark, sf_dir).select(F.concat_ws(
        "::", user, F.col("item").cast("string"),
        F.col("rating").cast("bigint").cast("string"), last).alias("value"))


RATING_LINES_SQL = """
lines AS (
  SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END
    || '::' || l_partkey || '::' || CAST(l_quantity AS BIGINT)
    || CASE WHEN o_orderkey % 89 = 1 THEN '' WHEN o_orderkey % 83 = 2 THEN '::0::0'
       ELSE '::0' END AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def item_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.concat_ws(
        "::", F.col("p_partkey").cast("string"), "p_name", "p_type").alias("value"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean ordered quantity per customer and part, as (user, item, rating)."""
    return (rating_rows(spark, sf_dir)
            .groupBy("user", "item").agg(F.avg("rating").alias("rating")))


RATINGS_SQL = """
ratings AS (
  SELECT o_custkey AS "user", l_partkey AS item,
    avg(l_quantity) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item"), F.col("p_name").alias("title"))


ITEMS_SQL = """
items AS (SELECT p_partkey AS item, p_name AS title FROM part)"""


# Text collections -------------------------------------------------------------

def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both collections as one, ids marked by their side."""
    return (documents(spark, sf_dir).select(_text("d", F.col("id")).alias("id"), "text")
            .unionByName(passages(spark, sf_dir)
                         .select(_text("b", F.col("id")).alias("id"), "text")))


def _distinct_words(records: DataFrame, name: str) -> DataFrame:
    return inverted_pairs(records).withColumnRenamed("id", name)


def _words_in_a_row(column: str) -> Column:
    return F.concat(F.lit(" "), F.array_join(tokenize(column), " "), F.lit(" "))


def gold_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id_a, id_b): documents in which all words of a passage stand in a row.

    A document can hold a passage only if it has the passage's rarest word, so
    documents and passages meet on that word and are then compared in full.
    """
    docs, items_ = documents(spark, sf_dir), passages(spark, sf_dir)
    item_words = _distinct_words(items_, "id_b")
    doc_words = materialize(
        _distinct_words(docs, "id_a").join(item_words.select("token").distinct(), "token",
                                           "left_semi"), "doc_words")
    held = doc_words.groupBy("token").agg(F.count("*").alias("n_docs"))
    rarest = materialize(
        item_words.join(held, "token", "left").groupBy("id_b")
        .agg(F.min(F.struct(F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "token")).alias("w"))
        .select("id_b", "w.*").filter(F.col("n_docs") > 0), "rarest")
    sizes = rarest.groupBy("token", "n_docs").agg(F.count("*").alias("n_items"))
    sizes = materialize(sizes, "sizes")
    met = join_pairs(doc_words.join(sizes, "token"),
                     rarest.join(sizes, ["token", "n_docs"]), ["token", "n_docs", "n_items"],
                     ["id_a"], ["id_b"], "n_docs", "n_items").select("id_a", "id_b")
    found = (met.join(items_.select(F.col("id").alias("id_b"), F.col("text").alias("text_b")),
                      "id_b")
             .join(docs.select(F.col("id").alias("id_a"), F.col("text").alias("text_a")), "id_a")
             .filter(F.contains(_words_in_a_row("text_a"), _words_in_a_row("text_b"))))
    return materialize(found.select("id_a", "id_b"), "gold")


CORPUS_SQL = r"""
corpus AS (
  SELECT 'd' || doc_id AS id, text FROM documents
  UNION ALL SELECT 'b' || item_id, text FROM benchmark),
words AS (
  SELECT id, unnest(regexp_split_to_array(lower(text), '\W+')) AS token FROM corpus),
kept AS (
  SELECT id, token FROM words WHERE token <> '' AND token NOT IN (""" + STOP_SQL + r""")),
counted AS (SELECT id, token, count(*) AS n FROM kept GROUP BY id, token),
sizes AS (SELECT id, sum(n) AS size FROM counted GROUP BY id),
tf AS (SELECT id, token, n / CAST(size AS DOUBLE) AS tf FROM counted JOIN sizes USING (id)),
idf AS (
  SELECT token, (SELECT count(DISTINCT id) FROM corpus) / CAST(count(*) AS DOUBLE) AS idf
  FROM counted GROUP BY token),
weights AS (SELECT id, token, tf * idf AS weight FROM tf JOIN idf USING (token)),
norms AS (SELECT id, sqrt(sum(weight * weight)) AS norm FROM weights GROUP BY id),
va AS (SELECT CAST(substr(id, 2) AS BIGINT) AS id_a, token, weight / norm AS unit
       FROM weights JOIN norms USING (id) WHERE id[1] = 'd'),
vb AS (SELECT CAST(substr(id, 2) AS BIGINT) AS id_b, token, weight / norm AS unit
       FROM weights JOIN norms USING (id) WHERE id[1] = 'b'),
sims AS (
  SELECT id_a, id_b, round(sum(va.unit * vb.unit), 6) AS similarity
  FROM va JOIN vb USING (token) GROUP BY id_a, id_b)"""

GOLD_SQL = r"""
doc_text AS (
  SELECT doc_id AS id_a,
    ' ' || trim(regexp_replace(lower(text), '\W+', ' ', 'g')) || ' ' AS text_a FROM documents),
item_text AS (
  SELECT item_id AS id_b,
    ' ' || trim(regexp_replace(lower(text), '\W+', ' ', 'g')) || ' ' AS text_b FROM benchmark),
gold AS (SELECT id_a, id_b FROM doc_text JOIN item_text ON contains(text_a, text_b))"""

SCORES_SQL = """
scores AS (
  SELECT id_a, id_b, coalesce(similarity, 0.0) AS similarity
  FROM gold LEFT JOIN sims USING (id_a, id_b))"""

"""Readers, the CSV writer, temp views and schema display."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harrow.sources.json_documents import json_array_elements
from harrow.sources.variants import json_rows


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line, column ``value``."""
    return spark.read.text(path)


def read_compressed_lines(spark: SparkSession, path: str, partitions: int) -> DataFrame:
    """Lines of a gzip file, spread over ``partitions`` (gzip cannot be split)."""
    return spark.read.text(path).repartition(partitions)


def without_lines_containing(lines: DataFrame, text: str, column: str = "value") -> DataFrame:
    """Drop every line that contains ``text``, header or not."""
    return lines.filter(~F.col(column).contains(text))


def split_lines(lines: DataFrame, sep: str = ",", column: str = "value") -> DataFrame:
    """Split each line at every ``sep``, with no quoting rules, into ``fields``."""
    return lines.withColumn("fields", F.split(F.col(column), _literal_regex(sep)))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, sep: str = ",") -> DataFrame:
    """CSV with a declared schema, or an inferred one when none is given."""
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def text_date(column: Column | str, pattern: str = "M/d/yyyy") -> Column:
    """The date a text holds, null where it holds none."""
    return F.to_date(F.try_to_timestamp(F.col(column) if isinstance(column, str) else column,
                                        F.lit(pattern)))


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str,
                   sep: str = "::") -> DataFrame:
    """Headerless records with a separator of one or more characters."""
    return spark.read.option("sep", sep).schema(schema).csv(path)


def read_json_lines(spark: SparkSession, path: str,
                    schema: T.StructType | str | None = None) -> DataFrame:
    """One JSON object per line, with a declared schema or the one of all lines together.

    The lines are read and parsed once in either case.
    """
    if schema is not None:
        return spark.read.schema(schema).json(path)
    return json_rows(spark.read.text(path))


def read_json_document(spark: SparkSession, path: str,
                       schema: T.StructType | str | None = None,
                       strip_whitespace: bool = False, cut_at: str = "}") -> DataFrame:
    """Whole-file JSON documents of any size; an array gives one row per element.

    Many tasks read one document, see ``json_array_elements`` for ``cut_at``.
    ``strip_whitespace`` removes all white space first, also inside names and
    values ("South Korea" becomes "SouthKorea").
    """
    elements = json_array_elements(spark, path, cut_at)
    if strip_whitespace:
        elements = elements.withColumn("element", F.regexp_replace("element", r"\s+", ""))
    return json_rows(elements, "element", schema)


def json_elements(documents: DataFrame, schema: T.StructType | str, column: str = "value",
                  strip_whitespace: bool = False) -> DataFrame:
    """One row per element of the JSON array (or single object) in ``column``."""
    text = F.regexp_replace(column, r"\s+", "") if strip_whitespace else F.col(column)
    array = f"array<{schema}>" if isinstance(schema, str) else T.ArrayType(schema)
    elements = F.from_json(text, array)
    return documents.select(F.explode(elements).alias("e")).select("e.*")


def read_jdbc(spark: SparkSession, url: str, table: str, driver: str | None = None,
              user: str | None = None, password: str | None = None,
              partition_column: str | None = None, lower: int | str | None = None,
              upper: int | str | None = None, partitions: int | None = None) -> DataFrame:
    """A database table.  Credentials are arguments only.

    Without ``partition_column`` the table is read over one connection; large
    tables should name one with its bounds so that executors read in parallel.
    """
    return spark.read.format("jdbc").options(**jdbc_options(
        url, table, driver, user, password, partition_column, lower, upper, partitions)).load()


def jdbc_options(url, table, driver=None, user=None, password=None, partition_column=None,
                 lower=None, upper=None, partitions=None) -> dict[str, str]:
    split = (partition_column, lower, upper, partitions)
    if any(v is not None for v in split) and any(v is None for v in split):
        raise ValueError("partition_column, lower, upper and partitions go together")
    options = {"url": url, "dbtable": table, "driver": driver, "user": user,
               "password": password, "partitionColumn": partition_column,
               "lowerBound": lower, "upperBound": upper, "numPartitions": partitions}
    return {key: str(value) for key, value in options.items() if value is not None}


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, as a distinct ``token`` column."""
    return spark.read.text(path).select(F.col("value").alias("token")).distinct()


def literal_table(spark: SparkSession, rows: Sequence, schema: T.StructType | str) -> DataFrame:
    """A table from rows written in the program."""
    return spark.createDataFrame(rows, schema)


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Make each table visible to ``spark.sql`` under its name."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def schema_table(df: DataFrame) -> DataFrame:
    """The schema of ``df`` as rows of (position, name, type, nullable)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position int, name string, type string, nullable boolean")


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None,
              header: bool = False, mode: str = "errorifexists") -> None:
    """Write chosen columns, in the given order, as CSV."""
    out = df.select(*columns) if columns else df
    out.write.mode(mode).option("header", header).csv(path)


def _literal_regex(text: str) -> str:
    return "\\Q" + text + "\\E"

"""Small relational building blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BooleanType, StringType, StructType

from harrow.session import ship_package

LIST_VALUES = 10_000  # distinct values of one key per list
PIECE_ROWS = 10_000   # strings per concatenated piece
BATCH_ROWS = 1_000    # rows that leave a partition function together


# Filters ---------------------------------------------------------------------

def rows_with_field(df: DataFrame, value: str, fields: str = "fields") -> DataFrame:
    """Rows where some element of the array ``fields`` equals ``value``."""
    return df.filter(F.array_contains(fields, value))


def rows_with_value(df: DataFrame, value, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows where some column equals ``value``.

    A value is in a column of another type only if casting there and back keeps it: 5.7 is
    in no column of whole numbers, and "7" is in one that holds 7.  Truth values are in
    columns of truth values only, and nothing else is.
    """
    found = F.lit(False)
    for name in columns or df.columns:
        kind = df.schema[name].dataType
        if isinstance(value, bool) != isinstance(kind, BooleanType):
            continue
        there = F.lit(value).try_cast(kind)
        # A number in a column of text is looked for as it is spelled there.
        back = "string" if isinstance(value, str) else (
            "double" if isinstance(kind, StringType) else F.lit(value))
        kept = there.try_cast(back) == F.lit(value) if isinstance(back, str) else there == back
        found = found | F.coalesce((F.col(name) == there) & kept, F.lit(False))
    return df.filter(found)


def rows_equal_to(df: DataFrame, record: dict) -> DataFrame:
    """Rows that equal ``record`` on every column it names; null equals null."""
    same = F.lit(True)
    for name, value in record.items():
        same = same & F.col(name).eqNullSafe(F.lit(value))
    return df.filter(same)


# Set operations --------------------------------------------------------------

def bag_union(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right)


def set_intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.intersect(right.select(*left.columns))


def set_union(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right).distinct()


def difference_by_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys), "left_anti")


# Aggregates ------------------------------------------------------------------

def sum_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(name))


def top_sums(df: DataFrame, key: str, value: str, name: str, k: int) -> DataFrame:
    return sum_by(df, key, value, name).orderBy(F.desc(name), key).limit(k)


def count_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def value_lists(df: DataFrame, key: str, value: str,
                max_values: int = LIST_VALUES) -> DataFrame:
    """The values of each key as lists: (key, part, n, values).

    ``values`` is a sorted array of (value, n), so repeats are counted, not
    stored.  A key with more than ``max_values`` distinct values is dealt out
    over several parts; together the parts of a key hold all its values.
    """
    counted = df.groupBy(key, value).agg(F.count("*").alias("_n"))
    parts = counted.groupBy(F.col(key).alias("_key")).agg(
        F.greatest(F.lit(1), F.ceil(F.count("*") / max_values)).alias("_parts"))
    # A left join on equal or both-null keys: Spark splits the rows of a large key.
    part = F.pmod(F.xxhash64(value), "_parts").cast("int")
    return (counted.join(parts, F.col(key).eqNullSafe(F.col("_key")), "left")
            .groupBy(key, part.alias("part"))
            .agg(F.sum("_n").alias("n"),
                 F.sort_array(F.collect_list(
                     F.struct(F.col(value).alias("value"), F.col("_n").alias("n"))
                 )).alias("values")))


def value_maps(lists: DataFrame, key: str) -> DataFrame:
    """Each row of ``value_lists`` as a one-entry map from the key to its list."""
    return lists.select(F.create_map(F.col(key), F.col("values")).alias("entry"))


def concat_in_order(df: DataFrame, value: str, order: str,
                    piece_rows: int = PIECE_ROWS) -> DataFrame:
    """All strings joined in the order of a unique whole number: (piece, text).

    A piece covers ``piece_rows`` consecutive numbers, so none grows with the
    table; the pieces in order make up the full string.
    """
    piece = F.floor(F.col(order) / piece_rows).alias("piece")
    ordered = F.sort_array(F.collect_list(F.struct(F.col(order), F.col(value).alias("_v"))))
    return (df.groupBy(piece)
            .agg(F.array_join(F.transform(ordered, lambda r: r["_v"]), "").alias("text")))


def map_partitions(df: DataFrame, function: Callable[[Iterator[Row]], Iterable[Sequence]],
                   schema: StructType | str) -> DataFrame:
    """What ``function`` yields from the rows of each physical partition, as a table.

    ``function`` gets an iterator of the partition's rows, also where there are none, and
    yields rows of ``schema``.  Rows come and go in batches, so neither side is ever held
    whole.  It must not depend on how rows are dealt to partitions, unless that is wanted.
    """
    ship_package(df.sparkSession)
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    kinds, names = [to_arrow_type(f.dataType) for f in fields], fields.names
    make = Row(*df.columns)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
        for batch in batches:
            yield from map(make, *(c.to_pylist() for c in batch.columns)) if batch.num_columns else (
                make() for _ in range(batch.num_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = iter(function(rows_of(batches)))
        while rows := list(islice(found, BATCH_ROWS)):
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names)

    return df.mapInArrow(run, fields)


def per_partition_sums(df: DataFrame, value: str) -> DataFrame:
    """One row (n, total) per physical partition with rows; added up before any shuffle."""
    return (df.select(value).groupBy(F.spark_partition_id().alias("_partition"))
            .agg(F.count(value).alias("n"), F.sum(value).alias("total")).drop("_partition"))


# Ordering --------------------------------------------------------------------

def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """The first ``k`` rows in the given order; end it with a unique key."""
    return df.orderBy(*order).limit(k)

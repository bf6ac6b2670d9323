"""Whole numbers from 0 for the distinct values of a column, without a global sort."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harrow.session import discard, materialize


def number_values(df: DataFrame, column: str, name: str) -> DataFrame:
    """(column, name): each distinct value of ``column``, nulls left out, with its number.

    Values are dealt into as many parts as keep both the parts and their number small;
    a part starts where the ones before it end.  Fits 32-bit integers as long as there are
    fewer than 2**31 distinct values, however large the values are.
    """
    values = materialize(df.select(column).dropna().distinct(), "values")
    parts = max(1, math.isqrt(values.count()))
    dealt = values.withColumn("_part", F.pmod(F.xxhash64(column), F.lit(parts)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(column)) - 1
    numbered = dealt.withColumn("_place", place).join(starts, "_part")
    numbers = materialize(numbered.select(
        column, (F.col("_start") + F.col("_place")).cast("int").alias(name)), "numbers")
    discard(values)
    return numbers

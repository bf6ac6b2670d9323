"""Texts that hold any of a long list of terms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM = 3  # characters that a term is looked up by; shorter terms by all they have


def _grams(text: str, size: int) -> Column:
    """The different strings of ``size`` characters in a text."""
    last = F.length(text) - size + 1
    found = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
                        lambda i: F.substring(F.col(text), i, F.lit(size)))
    return F.when(last >= 1, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def rows_with_any_term(df: DataFrame, column: str, terms: DataFrame | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose ``column`` holds any of the terms, whatever the case.

    ``terms`` is a list or a table with a column ``term``.  Each term is known by that one of
    its grams which the fewest terms have; the grams of the different texts are joined with
    them, and what meets is looked through for the term itself.  So the plan does not grow
    with the list, and neither does the work for a text beyond the terms that share a gram
    with it.  An empty term is in every text; a null text holds none, a null term is in none.
    """
    if not isinstance(terms, DataFrame):
        terms = df.sparkSession.createDataFrame([(t,) for t in terms], "term string")
    terms = terms.select(F.lower("term").alias("term")).dropna().distinct()
    size = F.least(F.length("term"), F.lit(GRAM))
    sizes = sorted(r[0] for r in terms.select(size.alias("size")).distinct().collect())  # GRAM + 1 at most

    own = terms.select("term", F.explode(_any_gram("term", sizes, size)).alias("gram"))
    shared = own.withColumn("n", F.count("*").over(Window.partitionBy("gram")))
    keyed = shared.groupBy("term").agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"))

    text = F.lower(F.col(column))
    texts = df.select(text.alias("_text")).dropna().distinct()
    looked_up = texts.select("_text", F.explode(_any_gram("_text", sizes)).alias("gram"))
    found = (looked_up.join(keyed, "gram").filter(F.contains("_text", "term"))
             .select(F.col("_text").alias("_found")).distinct())
    return df.join(found, text == F.col("_found"), "left_semi")


def _any_gram(text: str, sizes: Sequence[int], own: Column | None = None) -> Column:
    """The grams of all sizes, or of the text's own size, in one array."""
    arrays = []
    for n in sizes:
        grams = _grams(text, n) if n else F.array(F.lit(""))
        arrays.append(grams if own is None else F.when(own == n, grams).otherwise(
            F.array().cast("array<string>")))
    return F.concat(*arrays) if arrays else F.array().cast("array<string>")

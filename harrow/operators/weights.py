"""Words, term frequency, inverse document frequency and vector norms.

Records are tables of (id, text); results are in long form, one row per
(id, token).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.functions.text import tokenize
from harrow.session import materialize

TEXT_BYTES = 4 << 20   # bytes of text whose words one task counts, about


def explode_words(df: DataFrame, words: str, *keep: str, name: str = "token") -> DataFrame:
    """One row per word of the array ``words``, with the columns ``keep``.

    An inner explode makes Spark test the array for emptiness ahead of it, which
    splits every text twice; words are never null, so dropping nulls does the
    same.
    """
    exploded = df.select(*keep, F.explode_outer(words).alias(name))
    return exploded.filter(F.col(name).isNotNull())


def record_tokens(records: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """(id, tokens): the words of each record in order."""
    return records.select("id", tokenize("text", stop_words).alias("tokens"))


def token_rows(records: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """(id, token): one row per word occurrence."""
    return explode_words(record_tokens(records, stop_words), "tokens", "id")


def drop_stop_words(rows: DataFrame, stop_words: DataFrame) -> DataFrame:
    """Remove the tokens listed in a table, keeping repeats of the others."""
    return rows.join(stop_words.select("token"), "token", "left_anti")


def token_total(records: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    sizes = record_tokens(records, stop_words).select(F.size("tokens").alias("n"))
    return sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_tokens"))


def biggest_record(records: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """The record with most words; the lowest id among equals."""
    sizes = record_tokens(records, stop_words).select("id", F.size("tokens").alias("n_tokens"))
    return sizes.orderBy(F.desc("n_tokens"), "id").limit(1)


def inverted_pairs(records: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """(token, id): each distinct word of each record."""
    words = record_tokens(records, stop_words).select(
        "id", F.array_distinct("tokens").alias("tokens"))
    return explode_words(words, "tokens", "id").select("token", "id")


def text_parts(records: DataFrame) -> int:
    """How many parts of about ``TEXT_BYTES`` the texts make."""
    n_bytes = F.coalesce(F.sum(F.octet_length("text")), F.lit(0))
    return max(1, -(-records.agg(n_bytes).first()[0] // TEXT_BYTES))


def term_counts(records: DataFrame, stop_words: Sequence[str] = (),
                keep: Sequence[str] = (), key: Sequence[str] = ("id",),
                sized: bool = True, parts: int | None = None) -> DataFrame:
    """(key, keep, size, token, n): occurrences of each word and the record's length.

    The texts are spread by record key first: they are smaller than their
    exploded words, and counting then needs no further shuffle.  A task holds all counts
    of its texts, many times their bytes, so there are ``parts`` parts: by default
    as many as the bytes of the texts ask for.
    """
    texts = records.repartition(text_parts(records) if parts is None else parts, *key)
    words = texts.select(*key, *keep, tokenize("text", stop_words).alias("tokens"))
    columns = [*key, *keep]
    if sized:
        words = words.withColumn("size", F.size("tokens"))
        columns.append("size")
    return (explode_words(words, "tokens", *columns)
            .groupBy(*columns, "token").agg(F.count("*").alias("n")))


def frequency() -> Column:
    """Share of a word among the words of its record."""
    return F.col("n") / F.col("size")


def term_frequency(records: DataFrame, stop_words: Sequence[str] = ()) -> DataFrame:
    """(id, token, tf)."""
    return term_counts(records, stop_words).select("id", "token", frequency().alias("tf"))


def inverse_document_frequency(records: DataFrame,
                               stop_words: Sequence[str] = (),
                               unique_ids: bool = True) -> DataFrame:
    """(token, idf), idf = records / records holding the word, with no logarithm.

    With ``unique_ids`` off, rows of one id make up one record.
    """
    n_records = records.agg(F.count("id") if unique_ids else F.count_distinct("id")).scalar()
    held = inverted_pairs(records, stop_words)
    holding = ((held if unique_ids else held.distinct())
               .groupBy("token").agg(F.count("*").alias("df")))
    return holding.select("token", (n_records / F.col("df")).alias("idf"))


def tfidf(records: DataFrame, stop_words: Sequence[str] = (),
          idf: DataFrame | None = None) -> DataFrame:
    """(id, token, weight); words without an idf are left out."""
    counts = materialize(term_counts(records, stop_words), "counts")
    if idf is None:
        n_records = records.agg(F.count_distinct("id")).scalar()
        # The words are held and the counts stream by; a merge would sort all counts.
        idf = (counts.groupBy("token").agg((n_records / F.count("*")).alias("idf"))
               .hint("shuffle_hash"))
    return counts.join(idf, "token").select(
        "id", "token", (frequency() * F.col("idf")).alias("weight"))


def norms(weights: DataFrame) -> DataFrame:
    """(id, norm): length of each weight vector."""
    return (weights.groupBy("id")
            .agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm")))


def text_pair_similarity(pairs: DataFrame, idf: DataFrame,
                         stop_words: Sequence[str] = ()) -> DataFrame:
    """Cosine of two texts: (pair_id, text_a, text_b) to (pair_id, similarity).

    Null where a text has no known word, zero where the two share none.
    """
    sides = [pairs.select("pair_id", F.lit(s).alias("side"), F.col(f"text_{s}").alias("text"))
             for s in ("a", "b")]
    return side_similarity(sides[0].unionByName(sides[1]), idf, stop_words)


def side_similarity(sides: DataFrame, idf: DataFrame, stop_words: Sequence[str] = (),
                    parts: int | None = None) -> DataFrame:
    """Cosine of the two sides of each pair: (pair_id, side, text) to (pair_id, similarity).

    ``side`` is ``a`` or ``b``.  A side may have many rows; their words count together.
    The length of a side cancels out of the cosine, so plain counts are weighed.  ``parts``
    is as in ``term_counts``.
    """
    counts = term_counts(sides, stop_words, keep=["side"], key=["pair_id"], sized=False,
                         parts=parts)

    def count_of(side: str) -> Column:
        own = F.when(F.col("side") == side, F.col("n"))
        return F.coalesce(F.sum(own), F.lit(0)).alias(f"n_{side}")

    both = counts.groupBy("pair_id", "token").agg(count_of("a"), count_of("b"))
    both = both.join(idf, "token").select("pair_id", (F.col("n_a") * F.col("idf")).alias("a"),
                                          (F.col("n_b") * F.col("idf")).alias("b"))
    sums = both.groupBy("pair_id").agg(
        F.sum(F.col("a") * F.col("b")).alias("dot"),
        F.sqrt(F.sum(F.col("a") * F.col("a"))).alias("norm_a"),
        F.sqrt(F.sum(F.col("b") * F.col("b"))).alias("norm_b"))
    cosine = F.try_divide(F.col("dot"), F.col("norm_a") * F.col("norm_b"))
    return sides.select("pair_id").distinct().join(sums, "pair_id", "left").select(
        "pair_id", cosine.alias("similarity"))

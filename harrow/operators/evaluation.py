"""Judging found pairs against known true pairs ("gold")."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harrow.operators.similarity import (
    PairIndex,
    all_pairs_summary,
    pair_similarity,
    similar_pair_bins,
    similarity_bin,
)

THRESHOLDS = 100  # 0.00, 0.01, ... 0.99; bins 0 ... 100
PAIR = ["id_a", "id_b"]


def pair_key(pairs: DataFrame, a: str = "id_a", b: str = "id_b") -> DataFrame:
    """Add ``key``: both ids as one text, for output."""
    return pairs.withColumn("key", F.concat_ws(" ", a, b))


def true_pairs(similarities: DataFrame, gold: DataFrame) -> DataFrame:
    """Scored pairs that are gold."""
    return similarities.join(gold.select(*PAIR), PAIR)


def false_pairs(similarities: DataFrame, gold: DataFrame) -> DataFrame:
    """Scored pairs that are not gold."""
    return similarities.join(gold.select(*PAIR), PAIR, "left_anti")


def gold_scores(similarities: DataFrame, gold: DataFrame) -> DataFrame:
    """The similarity of each gold pair, zero where it was not scored."""
    return (gold.select(*PAIR).join(similarities, PAIR, "left")
            .select(*PAIR, F.coalesce("similarity", F.lit(0.0)).alias("similarity")))


def indexed_gold_scores(index: PairIndex, gold: DataFrame) -> DataFrame:
    """``gold_scores`` with every gold pair scored, also those below the bar."""
    return gold_scores(pair_similarity(index, gold), gold)


def mean_similarities(index: PairIndex, gold: DataFrame) -> DataFrame:
    """Number and mean similarity of gold pairs and of all other pairs.

    The others are all pairs of the two sides that are not gold; their total is
    the grand total less the gold total.
    """
    all_pairs = all_pairs_summary(index)
    n_all = all_pairs.select("n_pairs").scalar()
    sum_all = all_pairs.select("sum_similarity").scalar()
    scores = gold_scores(pair_similarity(index, gold, digits=None), gold)
    return scores.agg(
        F.count("*").alias("n_true"), F.avg("similarity").alias("mean_true"),
        (n_all - F.count("*")).alias("n_other"),
        F.try_divide(sum_all - F.coalesce(F.sum("similarity"), F.lit(0.0)),
                     n_all - F.count("*")).alias("mean_other"))


def _all_bins(df: DataFrame) -> DataFrame:
    return df.sparkSession.range(0, THRESHOLDS + 1, 1, 1).select(F.col("id").cast("int").alias("bin"))


def _missed_from(similarity: Column) -> Column:
    """The lowest n with similarity < n / 100."""
    low = F.floor(similarity * F.lit(100.0))
    return (F.when(similarity < low / F.lit(100.0), low)
            .when(similarity < (low + 1) / F.lit(100.0), low + 1)
            .otherwise(low + 2).cast("int"))


def pair_bins(similarities: DataFrame) -> DataFrame:
    """(bin, n_pairs) of scored pairs."""
    return similarities.groupBy(similarity_bin().alias("bin")).agg(F.count("*").alias("n_pairs"))


def histogram(bins: DataFrame, gold: DataFrame) -> DataFrame:
    """(bin, n_pairs, n_gold, n_false) for all 101 bins.

    ``bins`` counts all scored pairs, ``gold`` holds the gold scores.  A gold pair
    that was never scored sits in bin 0 and lowers its ``n_false``.
    """
    gold_bins = gold.groupBy(similarity_bin().alias("bin")).agg(F.count("*").alias("n_gold"))

    def n(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("bigint")

    return (_all_bins(bins).join(bins, "bin", "left").join(gold_bins, "bin", "left")
            .select("bin", n("n_pairs").alias("n_pairs"), n("n_gold").alias("n_gold"))
            .withColumn("n_false", F.col("n_pairs") - F.col("n_gold")))


def index_bins(index: PairIndex) -> DataFrame:
    """(bin, n_pairs) of all pairs of the two sides.

    Bin 0 is the number of all pairs less those of the higher bins, so the pairs
    below the bar are counted without being formed, whether or not they have a word in
    common.  The bar must be the lower edge of bin 1.
    """
    if index.min_similarity != 1 / THRESHOLDS:
        raise ValueError(f"the index must hold pairs from {1 / THRESHOLDS}")
    moved = F.explode(F.array(
        F.struct("bin", "n_pairs"),
        F.struct(F.lit(0).alias("bin"), (-F.col("n_pairs")).alias("n_pairs"))))
    higher = similar_pair_bins(index).select(moved.alias("m")).select("m.*")

    def n(side: str) -> Column:
        return F.count_if(F.col("side") == side)

    total = index.records.agg((n("a") * n("b")).alias("n_pairs")).select(
        F.lit(0).alias("bin"), "n_pairs")
    return (higher.unionByName(total).groupBy("bin")
            .agg(F.sum("n_pairs").alias("n_pairs")))


def confusion(bins: DataFrame, gold: DataFrame) -> DataFrame:
    """(threshold, n_fp, n_fn, n_tp) for thresholds 0.00 to 0.99.

    False positives are the bins at or above the threshold less their gold
    pairs; false negatives are gold pairs below it.  One pass over the 101 bins
    instead of a scan per threshold.
    """
    n_gold = F.col("n_gold_total")
    missed = (gold.groupBy(_missed_from(F.col("similarity")).alias("bin"))
              .agg(F.count("*").alias("n_missed")))
    upwards = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    downwards = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding,
                                                          Window.currentRow)
    whole = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding,
                                              Window.unboundedFollowing)
    return (histogram(bins, gold).join(missed, "bin", "left")
            .select("bin", F.sum("n_false").over(downwards).alias("n_fp"),
                    F.sum(F.coalesce("n_missed", F.lit(0))).over(upwards).alias("n_fn"),
                    F.sum("n_gold").over(whole).alias("n_gold_total"))
            .filter(F.col("bin") < THRESHOLDS)
            .select((F.col("bin") / F.lit(100.0)).alias("threshold"), "n_fp", "n_fn",
                    (n_gold - F.col("n_fn")).alias("n_tp")))


def precision_recall(confusions: DataFrame) -> DataFrame:
    """(threshold, precision, recall, f_measure); null where undefined."""
    tp = F.col("n_tp")
    rates = confusions.select(
        "threshold", F.try_divide(tp, tp + F.col("n_fp")).alias("precision"),
        F.try_divide(tp, tp + F.col("n_fn")).alias("recall"))
    p, r = F.col("precision"), F.col("recall")
    return rates.withColumn("f_measure", F.try_divide(2 * r * p, r + p))


def rmse(predicted: DataFrame, actual: DataFrame, prediction: str = "rating") -> DataFrame:
    """Root mean squared error over equal (user, item); null when none match."""
    guess = predicted.select("user", "item", F.col(prediction).alias("_guess"))
    error = F.col("_guess") - F.col("rating")
    return (actual.select("user", "item", "rating").join(guess, ["user", "item"])
            .agg(F.sqrt(F.avg(error * error)).alias("rmse")))

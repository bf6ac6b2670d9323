"""Rating statistics and recommendation by alternating least squares.

Ratings are (user, item, rating), items are (item, title).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harrow.operators.numbering import number_values
from harrow.operators.search import rows_with_any_term
from harrow.session import checkpoint_folder, collect_garbage, materialize, work_path

# The training settings.
RANKS = (4, 8, 12)
ITERATIONS = 5
REGULARIZATION = 0.1
SEED = 5
SPLIT_WEIGHTS = (6, 2, 2)


def item_stats(ratings: DataFrame) -> DataFrame:
    """(item, n_ratings, avg_rating)."""
    return ratings.groupBy("item").agg(F.count("*").alias("n_ratings"),
                                       F.avg("rating").alias("avg_rating"))


def named(table: DataFrame, items: DataFrame) -> DataFrame:
    """Add the title of each item."""
    return table.join(items.select("item", "title"), "item")


def top_rated(ratings: DataFrame, items: DataFrame, min_ratings: int = 500,
              k: int = 20) -> DataFrame:
    """Best items with more than ``min_ratings`` ratings.

    Ordered by the rating to three places, then by title, both downwards.
    """
    stats = item_stats(ratings).filter(F.col("n_ratings") > min_ratings)
    return (named(stats, items)
            .orderBy(F.desc(F.bround("avg_rating", 3)), F.desc("title"), "item").limit(k)
            .select("item", "title", "n_ratings", "avg_rating"))


def global_mean(ratings: DataFrame) -> DataFrame:
    return ratings.agg(F.avg("rating").alias("mean_rating"))


def mean_predictor(training: DataFrame, pairs: DataFrame) -> DataFrame:
    """Predict the mean training rating for every pair."""
    return pairs.select("user", "item", global_mean(training).scalar().alias("prediction"))


def item_mean_predictor(training: DataFrame, pairs: DataFrame) -> DataFrame:
    """Predict the item's mean training rating; unknown items are left out."""
    return pairs.select("user", "item").join(item_stats(training), "item").select(
        "user", "item", F.col("avg_rating").alias("prediction"))


def search_titles(items: DataFrame, terms: Sequence[str] | DataFrame) -> DataFrame:
    """Items whose title holds any of the terms, whatever the case."""
    return rows_with_any_term(items, "title", terms)


def unrated_items(items: DataFrame, ratings: DataFrame, user: int) -> DataFrame:
    """(user, item) for every item the user has not rated."""
    rated = ratings.filter(F.col("user") == user).select("item")
    return items.join(rated, "item", "left_anti").select(
        F.lit(user).cast("bigint").alias("user"), "item")


@dataclass(frozen=True)
class NumberedRatings:
    """Ratings (_u, _i, rating) under the numbers of their users and items.

    The factors are kept for 32-bit numbers, so ids of any size are numbered first, once
    for any number of models.
    """

    users: DataFrame
    items: DataFrame
    table: DataFrame


@dataclass(frozen=True)
class Recommender:
    """A fitted model and the ratings it was fitted to."""

    model: ALSModel
    ratings: NumberedRatings
    regularization: float


def number_ratings(ratings: DataFrame) -> NumberedRatings:
    """Number users and items; rows with a null id are left out."""
    users, items = number_values(ratings, "user", "_u"), number_values(ratings, "item", "_i")
    table = ratings.join(users, "user").join(items, "item").select("_u", "_i", "rating")
    return NumberedRatings(users, items, materialize(table, "numbered"))


def train(ratings: DataFrame | NumberedRatings, rank: int, iterations: int = ITERATIONS,
          regularization: float = REGULARIZATION, seed: int = SEED) -> Recommender:
    """Fit the factors.

    Every iteration sends each factor to all blocks that need it and stores the outcome,
    after which the files of that shuffle are deleted.  The fitted factors are stored as
    well: the model of ``fit`` would hold all shuffles and blocks of its training.
    """
    numbered = ratings if isinstance(ratings, NumberedRatings) else number_ratings(ratings)
    spark = numbered.table.sparkSession
    checkpoint_folder(spark)
    als = ALS(rank=rank, maxIter=iterations, regParam=regularization, seed=seed,
              userCol="_u", itemCol="_i", ratingCol="rating", coldStartStrategy="drop",
              checkpointInterval=1)
    path = work_path(spark, "model")
    als.fit(numbered.table).save(path)
    model = ALSModel.load(path)
    collect_garbage(spark)
    return Recommender(model, numbered, regularization)


def predict(fitted: Recommender, pairs: DataFrame) -> DataFrame:
    """(user, item, prediction); unknown users and items get no prediction."""
    known = (pairs.select("user", "item").join(fitted.ratings.users, "user")
             .join(fitted.ratings.items, "item"))
    return fitted.model.transform(known).select(
        "user", "item", F.col("prediction").cast("double").alias("prediction"))


def known_pairs(numbered: NumberedRatings, rated: DataFrame) -> DataFrame:
    """(_u, _i, rating, n): rows of ``rated`` with known user and item, under their numbers.

    ``n`` is how many rows of ``rated`` have the user and item.
    """
    n = F.count("*").over(Window.partitionBy("user", "item"))
    known = (rated.select("user", "item", "rating", n.alias("n"))
             .join(numbered.users, "user").join(numbered.items, "item"))
    return materialize(known.select("_u", "_i", "rating", "n"), "known")


def known_rmse(fitted: Recommender, known: DataFrame) -> DataFrame:
    """``rmse`` of the predictions for ``known_pairs``, which carry their own ratings.

    It meets every rating of a pair with the prediction of each of its ``n`` rows.
    """
    error = F.col("prediction").cast("double") - F.col("rating")
    squares, n = F.sum(F.col("n") * error * error), F.sum(F.when(error.isNotNull(), F.col("n")))
    return fitted.model.transform(known).agg(F.sqrt(F.try_divide(squares, n)).alias("rmse"))


def _factors(table: DataFrame, numbers: DataFrame, key: str, number: str) -> DataFrame:
    return (table.withColumnRenamed("id", number).join(numbers, number)
            .select(key, F.col("features").cast("array<double>").alias("factors")))


def user_factors(fitted: Recommender) -> DataFrame:
    """(user, factors)."""
    return _factors(fitted.model.userFactors, fitted.ratings.users, "user", "_u")


def item_factors(fitted: Recommender) -> DataFrame:
    """(item, factors)."""
    return _factors(fitted.model.itemFactors, fitted.ratings.items, "item", "_i")


def predict_from_factors(users: DataFrame, items: DataFrame, pairs: DataFrame) -> DataFrame:
    """(user, item, prediction) of pairs from exported factors, without the model."""
    both = (pairs.select("user", "item").join(users, "user")
            .join(items.withColumnRenamed("factors", "_item_factors"), "item"))
    return both.select("user", "item", _dot("factors", "_item_factors").alias("prediction"))


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)


def user_residuals(fitted: Recommender) -> DataFrame:
    """(user, n_ratings, residual): how far each user's factors are from solving their
    regularised least squares, given those of the items.

    The factors p of a user with n ratings r of items with factors q solve
    sum q (q p - r) + regularization n p = 0.  ``residual`` is the largest component of the
    left side in terms of the largest of sum abs(q r).  The users are solved last, so
    theirs vanishes up to the precision of the factors.
    """
    rank = fitted.model.rank
    model = fitted.model
    known = (fitted.ratings.table
             .join(model.itemFactors.select(F.col("id").alias("_i"), F.col("features").alias("q")), "_i")
             .join(model.userFactors.select(F.col("id").alias("_u"), F.col("features").alias("p")), "_u"))
    rows = known.select("_u", "rating", F.col("q").cast("array<double>").alias("q"),
                        F.col("p").cast("array<double>").alias("p"))
    rows = rows.withColumn("error", _dot("q", "p") - F.col("rating"))
    # One sum per component, added up before the shuffle.
    sums = rows.groupBy("_u").agg(
        F.count("*").alias("n_ratings"), F.first("p").alias("p"),
        *(F.sum(F.col("q")[j] * F.col("error")).alias(f"g{j}") for j in range(rank)),
        *(F.sum(F.abs(F.col("q")[j] * F.col("rating"))).alias(f"s{j}") for j in range(rank)))
    parts = [F.abs(F.col(f"g{j}") + fitted.regularization * F.col("n_ratings") * F.col("p")[j])
             for j in range(rank)]
    scale = F.array_max(F.array(*(f"s{j}" for j in range(rank))))
    residual = F.coalesce(F.try_divide(F.array_max(F.array(*parts)), scale), F.lit(0.0))
    return sums.select("_u", "n_ratings", residual.alias("residual")).join(
        fitted.ratings.users, "_u").select("user", "n_ratings", "residual")


@dataclass(frozen=True)
class RankSearch:
    """The model of every rank tried, and (position, rank, rmse) of each."""

    models: dict[int, Recommender]
    errors: DataFrame

    def best(self) -> Recommender:
        """The model with the lowest error; the first one tried among equals."""
        return self.models[best_rank(self.errors).first()["rank"]]


def search_ranks(training: DataFrame | NumberedRatings, validation: DataFrame,
                 ranks: Sequence[int] = RANKS) -> RankSearch:
    """Fit every rank and measure it on the validation set.

    The ratings of both sets are numbered once, and the models are kept, so that the chosen
    one need not be fitted again.
    """
    numbered = training if isinstance(training, NumberedRatings) else number_ratings(training)
    return fit_ranks(numbered, known_pairs(numbered, validation), ranks)


def fit_ranks(numbered: NumberedRatings, known: DataFrame,
              ranks: Sequence[int] = RANKS) -> RankSearch:
    """``search_ranks`` on numbered ratings and the ``known_pairs`` of the validation set."""
    models, tables = {}, []
    for position, rank in enumerate(ranks):
        models[rank] = train(numbered, rank)
        tables.append(known_rmse(models[rank], known).select(
            F.lit(position).alias("position"), F.lit(rank).alias("rank"), "rmse"))
    errors = tables[0]
    for table in tables[1:]:
        errors = errors.unionByName(table)
    return RankSearch(models, materialize(errors, "errors"))


def rank_errors(training: DataFrame, validation: DataFrame,
                ranks: Sequence[int] = RANKS) -> DataFrame:
    """(position, rank, rmse) on the validation set, one row per rank tried."""
    return search_ranks(training, validation, ranks).errors


def best_rank(errors: DataFrame) -> DataFrame:
    """The rank with the lowest error; the first one tried among equals."""
    return errors.agg(F.min_by("rank", F.struct("rmse", "position")).alias("rank"))


def personal_ratings(spark, user: int, rated: Sequence[tuple[int, float]]) -> DataFrame:
    """Ratings of one user from a list of (item, rating)."""
    return spark.createDataFrame([(user, item, float(r)) for item, r in rated],
                                 "user bigint, item bigint, rating double")


def recommend(model: Recommender, candidates: DataFrame, ratings: DataFrame, items: DataFrame,
              min_ratings: int = 75, k: int = 20) -> DataFrame:
    """The best predicted candidates among items with more than ``min_ratings`` ratings."""
    return with_stats(predict(model, candidates), ratings, items, min_ratings).orderBy(
        F.desc("prediction"), "item").limit(k)


def with_stats(predictions: DataFrame, ratings: DataFrame, items: DataFrame,
               min_ratings: int = 75) -> DataFrame:
    """Predictions with title and rating count, of items rated often enough."""
    counts = item_stats(ratings).select("item", "n_ratings")
    often = named(counts, items).filter(F.col("n_ratings") > min_ratings)
    return predictions.join(often, "item").select(
        "user", "item", "title", "n_ratings", "prediction")

"""Rating statistics and recommendation on ordered quantities."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from harrow.operators import recommend as rec
from harrow.operators.evaluation import rmse
from harrow.operators.parse import parse_movies, parse_ratings
from harrow.operators.relational import bag_union
from harrow.operators.sampling import hash_split
from harrow.plans.inputs import (
    ITEMS_SQL,
    RATING_LINES_SQL,
    RATINGS_SQL,
    item_lines,
    items,
    rating_lines,
    ratings,
    table,
)
from harrow.session import discard, materialize

TOP_MIN_RATINGS = 30
NAMED_MIN_RATINGS = 20
SPLIT_SEED = 0
RESIDUAL_PLACES = 4  # to which the residuals of single-precision factors must vanish
TITLE_TERMS = ("small", "Ring", "blue bolt")
PERSONAL_USER = -1
# Ratings of the one additional user: every thirteenth item, better and better.
PERSONAL_RATINGS = tuple((13 * i + 5, 5.0 * i + 2) for i in range(10))


def _split(spark, sf_dir):
    return hash_split(ratings(spark, sf_dir), ["user", "item"], rec.SPLIT_WEIGHTS, SPLIT_SEED)


def _sets(spark, sf_dir):
    """Training, validation and test ratings, from one stored split."""
    split = materialize(_split(spark, sf_dir), "split")
    return [split.filter(F.col("split") == i).drop("split") for i in range(3)]


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _item_mean_rmse(spark, sf_dir):
    train, _, test = _sets(spark, sf_dir)
    return _rounded(rmse(rec.item_mean_predictor(train, test), test, "prediction"), "rmse")


def _mean_baseline(spark, sf_dir):
    train, _, test = _sets(spark, sf_dir)
    return _rounded(rmse(rec.mean_predictor(train, test), test, "prediction"), "rmse")


def _pred_named(spark, sf_dir):
    train, _, test = _sets(spark, sf_dir)
    found = rec.with_stats(rec.item_mean_predictor(train, test), ratings(spark, sf_dir),
                           items(spark, sf_dir), NAMED_MIN_RATINGS)
    return _rounded(found, "prediction")


def _validated(spark, sf_dir):
    """The predictions of the first rank for the validation pairs, and their model."""
    train, validation, _ = _sets(spark, sf_dir)
    fitted = rec.train(train, rec.RANKS[0])
    return rec.predict(fitted, validation), fitted


def _als_predict(spark, sf_dir):
    return _rounded(_validated(spark, sf_dir)[0], "prediction")


def _als_pairs(spark, sf_dir):
    """The validation pairs that get a prediction."""
    return _validated(spark, sf_dir)[0].select("user", "item")


def _als_residuals(spark, sf_dir):
    """Ratings of each user, and how far their factors are from the least squares."""
    train, _, _ = _sets(spark, sf_dir)
    found = rec.user_residuals(rec.train(train, rec.RANKS[0]))
    return found.withColumn("residual", F.round("residual", RESIDUAL_PLACES))


def _rank_grid(spark, sf_dir):
    """The validation error of each rank tried, the one chosen, and its error on the test set."""
    train, validation, test = _sets(spark, sf_dir)
    numbered = rec.number_ratings(train)
    known, known_test = rec.known_pairs(numbered, validation), rec.known_pairs(numbered, test)
    discard(train, validation, test)
    search = rec.fit_ranks(numbered, known)
    best = rec.best_rank(search.errors).scalar()
    test_error = rec.known_rmse(search.best(), known_test).scalar()
    return _rounded(search.errors.select(
        "rank", "rmse", (F.col("rank") == best).alias("chosen"), test_error.alias("test_rmse")),
        "rmse", "test_rmse")


def _mine(spark):
    return rec.personal_ratings(spark, PERSONAL_USER, PERSONAL_RATINGS)


def _personal_model(spark, train):
    return rec.train(bag_union(train, _mine(spark)), rec.RANKS[0])


def _personal_counts(spark, sf_dir):
    """Rows added to the training set, and the test pairs predicted after retraining."""
    train, _, test = _sets(spark, sf_dir)
    found = rec.predict(_personal_model(spark, train), test)
    added = bag_union(train, _mine(spark)).agg(F.count("*")).scalar() - train.agg(
        F.count("*")).scalar()
    return found.agg(F.count("*").alias("n_predicted"),
                     F.count_if(F.isnan("prediction")).alias("n_failed")).withColumn(
        "n_added", added)


def _personal(spark, sf_dir):
    """The test error after retraining with the personal ratings."""
    train, _, test = _sets(spark, sf_dir)
    found = rec.predict(_personal_model(spark, train), test)
    return _rounded(rmse(found, test, "prediction"), "rmse")


def _candidates(spark, sf_dir, train):
    """Predictions of the personal user's unrated items that are rated often."""
    unrated = rec.unrated_items(items(spark, sf_dir), _mine(spark), PERSONAL_USER)
    return rec.with_stats(rec.predict(_personal_model(spark, train), unrated),
                          ratings(spark, sf_dir), items(spark, sf_dir), NAMED_MIN_RATINGS)


def _topn_candidates(spark, sf_dir):
    """The items among which the personal list is chosen."""
    train, _, _ = _sets(spark, sf_dir)
    return _candidates(spark, sf_dir, train).select("item", "title", "n_ratings")


def _topn(spark, sf_dir):
    """The personal list: the best predicted items that are unrated and rated often."""
    train, _, _ = _sets(spark, sf_dir)
    top = rec.recommend(
        _personal_model(spark, train),
        rec.unrated_items(items(spark, sf_dir), _mine(spark), PERSONAL_USER),
        ratings(spark, sf_dir), items(spark, sf_dir), NAMED_MIN_RATINGS)
    order = Window.orderBy(F.desc("prediction"), "item")  # the twenty rows of the list
    return _rounded(top.withColumn("place", F.row_number().over(order)), "prediction").select(
        "place", "item", "title", "n_ratings", "prediction")


def _numbered_customers(spark, sf_dir):
    """Customers whose name holds the number in the name of any supplier."""
    names = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("item"), F.col("c_name").alias("title"))
    terms = table(spark, sf_dir, "supplier").select(
        F.upper(F.substring("s_name", 9, 10)).alias("term"))
    return rec.search_titles(names, terms)


def _stats(spark, sf_dir):
    return rec.item_stats(ratings(spark, sf_dir))


QUERIES = {
    "rec_parse_ratings": lambda s, d: parse_ratings(rating_lines(s, d), exact=True),
    "rec_parse_movies": lambda s, d: parse_movies(item_lines(s, d)),
    "rec_movie_stats": lambda s, d: _rounded(_stats(s, d), "avg_rating"),
    "rec_movie_stats_named": lambda s, d: _rounded(
        rec.named(_stats(s, d), items(s, d)), "avg_rating"),
    "rec_top_rated": lambda s, d: _rounded(
        rec.top_rated(ratings(s, d), items(s, d), TOP_MIN_RATINGS, 20), "avg_rating"),
    "rec_split": lambda s, d: _split(s, d).select("user", "item", "split"),
    "rec_global_mean": lambda s, d: _rounded(rec.global_mean(ratings(s, d)), "mean_rating"),
    "rec_rmse": _item_mean_rmse,
    "rec_mean_baseline_rmse": _mean_baseline,
    "rec_pred_named": _pred_named,
    "rec_title_search": lambda s, d: rec.search_titles(items(s, d), TITLE_TERMS),
    "rec_title_search_many": _numbered_customers,
    "rec_unrated": lambda s, d: rec.unrated_items(items(s, d), _mine(s), PERSONAL_USER),
    "rec_als_predict": _als_predict,
    "rec_als_pairs": _als_pairs,
    "rec_als_residuals": _als_residuals,
    "rec_rank_grid": _rank_grid,
    "rec_personal": _personal,
    "rec_personal_counts": _personal_counts,
    "rec_topn": _topn,
    "rec_topn_candidates": _topn_candidates,
}

_ITEM_KEYS = ", ".join(str(item) for item, _ in PERSONAL_RATINGS)
_POINT = """CAST('0x' || substr(md5('0:' || "user" || ':' || item), 1, 13) AS BIGINT)
    / CAST(4503599627370496 AS DOUBLE)"""
_RATINGS = f"WITH {RATINGS_SQL},{ITEMS_SQL}"
_STATS = f"""{_RATINGS},
stats AS (
  SELECT item, count(*) AS n_ratings, avg(rating) AS avg_rating FROM ratings GROUP BY item)
"""
_SETS = f"""{_RATINGS},
points AS (SELECT *, {_POINT} AS point FROM ratings),
split AS (
  SELECT "user", item, rating, CAST(CASE WHEN point < CAST(0.6 AS DOUBLE) THEN 0
    WHEN point < CAST(0.8 AS DOUBLE) THEN 1 ELSE 2 END AS INTEGER) AS split FROM points),
train AS (SELECT * FROM split WHERE split = 0),
test AS (SELECT * FROM split WHERE split = 2),
item_means AS (SELECT item, avg(rating) AS prediction FROM train GROUP BY item)
"""

ORACLE = {
    "rec_parse_ratings": f"""WITH {RATING_LINES_SQL},
parts AS (SELECT value, string_split(value, '::') AS p FROM lines),
typed AS (
  SELECT value, TRY_CAST(p[1] AS BIGINT) AS u, TRY_CAST(p[2] AS BIGINT) AS i,
    TRY_CAST(p[3] AS DOUBLE) AS r, len(p) AS fields FROM parts),
judged AS (
  SELECT *, CASE WHEN fields <> 4 THEN 'malformed' WHEN u IS NULL THEN 'invalid' ELSE 'ok' END
    AS status FROM typed)
SELECT value, status, CASE status WHEN 'ok' THEN u END AS "user",
  CASE status WHEN 'ok' THEN i END AS item, CASE status WHEN 'ok' THEN r END AS rating
FROM judged""",
    "rec_parse_movies": """SELECT p_partkey || '::' || p_name || '::' || p_type AS value,
  'ok' AS status, p_partkey AS item, p_name AS title FROM part""",
    "rec_movie_stats": _STATS + """SELECT item, n_ratings, round(avg_rating, 6) AS avg_rating
FROM stats""",
    "rec_movie_stats_named": _STATS + """SELECT item, n_ratings, round(avg_rating, 6) AS avg_rating,
  title FROM stats JOIN items USING (item)""",
    "rec_top_rated": _STATS + f"""SELECT item, title, n_ratings, round(avg_rating, 6) AS avg_rating
FROM stats JOIN items USING (item) WHERE n_ratings > {TOP_MIN_RATINGS}
ORDER BY round_even(avg_rating, 3) DESC, title DESC, item LIMIT 20""",
    "rec_split": _SETS + 'SELECT "user", item, split FROM split',
    "rec_global_mean": _RATINGS + "\nSELECT round(avg(rating), 6) AS mean_rating FROM ratings",
    "rec_rmse": _SETS + """SELECT round(sqrt(avg((prediction - rating) ** 2)), 6) AS rmse
FROM test JOIN item_means USING (item)""",
    "rec_mean_baseline_rmse": _SETS + """SELECT round(sqrt(avg(
  ((SELECT avg(rating) FROM train) - rating) ** 2)), 6) AS rmse FROM test""",
    "rec_pred_named": _SETS + f""", stats AS (
  SELECT item, count(*) AS n_ratings FROM ratings GROUP BY item)
SELECT "user", item, title, n_ratings, round(prediction, 6) AS prediction
FROM test JOIN item_means USING (item) JOIN stats USING (item) JOIN items USING (item)
WHERE n_ratings > {NAMED_MIN_RATINGS}""",
    "rec_title_search": f"WITH {ITEMS_SQL}\n" + """SELECT item, title FROM items
WHERE contains(lower(title), 'small') OR contains(lower(title), 'ring')
  OR contains(lower(title), 'blue bolt')""",
    "rec_title_search_many": """SELECT c_custkey AS item, c_name AS title FROM customer
WHERE EXISTS (SELECT 1 FROM supplier WHERE contains(lower(c_name), lower(substr(s_name, 9, 10))))""",
    "rec_unrated": f"""WITH {ITEMS_SQL}
SELECT CAST({PERSONAL_USER} AS BIGINT) AS "user", item FROM items
WHERE item NOT IN ({_ITEM_KEYS})""",
    # Predictions and errors depend on the factors, which no SQL here can fit; the residuals
    # do too, but must vanish.
    "rec_als_pairs": _SETS + """SELECT "user", item FROM split
WHERE split = 1 AND "user" IN (SELECT "user" FROM train) AND item IN (SELECT item FROM train)""",
    "rec_als_residuals": _SETS + """SELECT "user", count(*) AS n_ratings,
  CAST(0 AS DOUBLE) AS residual FROM train GROUP BY "user\"""",
    "rec_personal_counts": _SETS + f"""SELECT count(*) AS n_predicted, CAST(0 AS BIGINT) AS n_failed,
  CAST({len(PERSONAL_RATINGS)} AS BIGINT) AS n_added FROM test
WHERE "user" IN (SELECT "user" FROM train)
  AND (item IN (SELECT item FROM train) OR item IN ({_ITEM_KEYS}))""",
    "rec_topn_candidates": _SETS + f"""SELECT item, title, count(*) AS n_ratings
FROM ratings JOIN items USING (item)
WHERE item NOT IN ({_ITEM_KEYS}) AND item IN (SELECT item FROM train)
GROUP BY item, title HAVING count(*) > {NAMED_MIN_RATINGS}""",
}

from collections import Counter

import numpy as np
import pytest
from conftest import left_behind, rows, shuffles

from harrow.operators import recommend as rec
from harrow.operators.evaluation import rmse
from harrow.operators.relational import bag_union
from harrow.plans import ratings as plans

TITLES = ["Lamp (small)", "Blue Kite: Long", "TEAPOT", "Teapot 2", "Plain"]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(list(enumerate(TITLES)), "item bigint, title string")


@pytest.fixture(scope="module")
def ratings(spark):
    data = [(u, i, float(1 + (u * 7 + i * 3) % 5)) for u in range(30) for i in range(5)
            if (u + i) % 4]
    return spark.createDataFrame(data, "user bigint, item bigint, rating double")


def test_counts_and_averages(spark):
    data = [(1, 7, 2.0), (2, 7, 5.0), (3, 8, 4.5), (1, 9, 0.0), (2, 9, 1.0), (3, 9, 3.5)]
    df = spark.createDataFrame(data, "user bigint, item bigint, rating double")
    assert rows(rec.item_stats(df)) == [(7, 2, 3.5), (8, 1, 4.5), (9, 3, 1.5)]
    assert rec.global_mean(df).first().mean_rating == pytest.approx(16 / 6)


def test_top_rated_orders_by_rounded_rating_then_title_downwards(spark):
    items = spark.createDataFrame([(1, "alpha"), (2, "beta"), (3, "gamma"), (4, "rare")],
                                  "item bigint, title string")
    data = [(u, i, r) for i, r in ((1, 4.0001), (2, 4.0002), (3, 3.0)) for u in range(3)]
    ratings = spark.createDataFrame([*data, (0, 4, 5.0)], "user bigint, item bigint, rating double")
    got = rec.top_rated(ratings, items, min_ratings=2, k=20).collect()
    assert [r.title for r in got] == ["beta", "alpha", "gamma"]


def test_title_search(items):
    found = rec.search_titles(items, ["teapot", "blue kite"])
    assert rows(found, "item") == [(1,), (2,), (3,)]


def test_unrated_items(spark, items):
    mine = rec.personal_ratings(spark, 0, [(1, 5), (3, 3.6)])
    assert rows(mine) == [(0, 1, 5.0), (0, 3, 3.6)]
    assert rows(rec.unrated_items(items, mine, 0)) == [(0, 0), (0, 2), (0, 4)]
    assert rec.unrated_items(items, mine, 9).count() == 5


def test_predictors(ratings):
    pairs = ratings.select("user", "item")
    mean = ratings.groupBy().avg("rating").first()[0]
    got = rec.mean_predictor(ratings, pairs).collect()
    assert {round(r.prediction, 9) for r in got} == {round(mean, 9)}
    best = rmse(rec.item_mean_predictor(ratings, ratings), ratings, "prediction").first().rmse
    assert best <= rmse(rec.mean_predictor(ratings, ratings), ratings, "prediction").first().rmse


def test_ranks_errors_and_recommendations(spark, ratings, items):
    errors = rec.rank_errors(ratings, ratings, ranks=(1, 4))
    found = errors.orderBy("position").collect()
    assert [r["rank"] for r in found] == [1, 4] and found[1].rmse < found[0].rmse
    assert rec.best_rank(errors).first()["rank"] == 4
    baseline = rmse(rec.mean_predictor(ratings, ratings), ratings, "prediction").first().rmse
    assert found[1].rmse < baseline

    mine = rec.personal_ratings(spark, 99, [(0, 5), (1, 1)])
    both = bag_union(ratings, mine)
    assert both.count() - ratings.count() == 2
    model = rec.train(both, 2)
    top = rec.recommend(model, rec.unrated_items(items, mine, 99), both, items, min_ratings=3, k=2)
    got = top.collect()
    assert len(got) == 2 and got[0].prediction >= got[1].prediction
    assert {r.item for r in got} <= {2, 3, 4}
    unknown = spark.createDataFrame([(12345, 1)], "user bigint, item bigint")
    assert rec.predict(model, unknown).count() == 0


def test_equal_errors_keep_the_first_rank(spark):
    errors = spark.createDataFrame([(0, 4, 1.0), (1, 8, 0.5), (2, 12, 0.5)],
                                   "position int, rank int, rmse double")
    assert rec.best_rank(errors).first()["rank"] == 8


def test_predictions_keep_items_rated_often(ratings, items):
    pairs = ratings.selectExpr("user", "item", "rating prediction")
    counts = dict(rows(rec.item_stats(ratings), "item", "n_ratings"))
    bar = sorted(counts.values())[2]
    got = rec.with_stats(pairs, ratings, items, bar)
    assert {(r.item, r.title, r.n_ratings) for r in got.collect()} == {
        (i, TITLES[i], n) for i, n in counts.items() if n > bar}
    assert got.count() == sum(n for n in counts.values() if n > bar)


def test_ids_of_any_size(spark):
    big = 1 << 40
    data = [(big + u, -big - i, float(1 + (u * 7 + i) % 5)) for u in range(8) for i in range(6)]
    ratings = spark.createDataFrame(data, "user bigint, item bigint, rating double")
    found = rec.predict(rec.train(ratings, 2), ratings)
    assert rows(found, "user", "item") == rows(ratings, "user", "item")


def test_numbers_are_dense(spark):
    from harrow.operators.numbering import number_values

    df = spark.range(300).selectExpr("if(id = 7, null, id * 1000000007) v").union(
        spark.range(300).selectExpr("id * 1000000007 v"))
    got = rows(number_values(df, "v", "n"))
    assert len(got) == 300 and sorted(n for _, n in got) == list(range(300))


def test_predictions_are_products_of_the_factors(spark, ratings):
    fitted = rec.train(ratings, 3)
    users, items_ = rec.user_factors(fitted), rec.item_factors(fitted)
    assert users.count() == 30 and items_.count() == 5
    pairs = users.select("user").crossJoin(items_.select("item"))
    got = {r[:2]: r[2] for r in map(tuple, rec.predict(fitted, pairs).collect())}
    want = {r[:2]: r[2] for r in map(tuple, rec.predict_from_factors(users, items_, pairs).collect())}
    by_hand = {(u, i): sum(x * y for x, y in zip(p, q, strict=True))
               for u, p in rows(users) for i, q in rows(items_)}
    assert got.keys() == want.keys() == by_hand.keys() and len(got) == 150
    assert got == pytest.approx(want, abs=1e-5) and want == pytest.approx(by_hand, abs=1e-9)


def test_the_side_solved_last_solves_its_least_squares(ratings):
    numbered = rec.number_ratings(ratings)
    fitted = rec.train(numbered, 3)
    found = rec.user_residuals(fitted).collect()
    assert {r.user: r.n_ratings for r in found} == Counter(r.user for r in ratings.collect())
    assert max(r.residual for r in found) < 1e-5
    # The same by a solver, for every user.
    factors = dict(rows(rec.item_factors(fitted)))
    own = {}
    for r in ratings.collect():
        own.setdefault(r.user, []).append((factors[r.item], r.rating))
    for user, p in rows(rec.user_factors(fitted)):
        q, r = (np.array(x) for x in zip(*own[user], strict=True))
        solved = np.linalg.solve(q.T @ q + rec.REGULARIZATION * len(r) * np.eye(3), q.T @ r)
        assert np.allclose(solved, p, atol=1e-4)
    # Factors of other ratings do not solve these.
    other = ratings.withColumn("rating", 6 - ratings["rating"])
    swapped = rec.Recommender(rec.train(other, 3).model, numbered, rec.REGULARIZATION)
    assert max(r.residual for r in rec.user_residuals(swapped).collect()) > 1e-2


def test_the_chosen_rank_is_not_fitted_again(ratings, monkeypatch):
    fits = []
    monkeypatch.setattr(rec, "train", lambda *a, fit=rec.train, **b: fits.append(a[1]) or fit(*a, **b))
    search = rec.search_ranks(ratings, ratings, ranks=(1, 4, 2))
    errors = {r["rank"]: r.rmse for r in search.errors.collect()}
    assert search.best() is search.models[min(errors, key=errors.get)] and fits == [1, 4, 2]


def test_pairs_are_numbered_once_for_all_ranks(spark, ratings, monkeypatch):
    rated = ratings.unionByName(ratings.limit(3)).unionByName(spark.createDataFrame(
        [(12345, 1, 2.0), (None, 1, 2.0)], "user bigint, item bigint, rating double"))
    asked = []
    monkeypatch.setattr(rec, "known_pairs", lambda *a, find=rec.known_pairs: asked.append(a) or find(*a))
    search = rec.search_ranks(ratings, rated, ranks=(1, 2))
    errors = {r["rank"]: r.rmse for r in search.errors.collect()}
    assert len(asked) == 1
    for rank, model in search.models.items():
        want = rmse(rec.predict(model, rated), rated, "prediction").first().rmse
        assert errors[rank] == pytest.approx(want)
    none = rec.known_pairs(search.models[1].ratings, rated.filter("user = 12345"))
    assert rec.known_rmse(search.models[1], none).first().rmse is None


def test_training_leaves_no_shuffle_files(spark, ratings):
    numbered = rec.number_ratings(ratings)
    before = shuffles(spark)
    fitted = rec.train(numbered, 2)  # held on, with what its training left
    assert left_behind(spark, before) == set()
    assert rec.user_factors(fitted).count() == 30 and rec.item_factors(fitted).count() == 5


def test_the_split_is_deleted_before_the_ranks_are_fitted(spark, ratings, monkeypatch):
    from harrow import session

    monkeypatch.setattr(plans, "ratings", lambda *_: ratings)
    monkeypatch.setattr(session, "_written", [])
    held = []

    def fit(*given, fit=rec.train):
        held.append({path.split("/")[-1].split("-")[0] for path in session._written})
        return fit(*given)

    monkeypatch.setattr(rec, "train", fit)
    found = plans.QUERIES["rec_rank_grid"](spark, "").collect()
    assert len(held) == 3 and not any({"split", "values"} & names for names in held)
    train, validation, test = plans._sets(spark, "")
    search = rec.search_ranks(train, validation)
    errors = {r["rank"]: r.rmse for r in search.errors.collect()}
    assert {r["rank"]: r.rmse for r in found} == pytest.approx(errors, abs=1e-5)
    want = rmse(rec.predict(search.best(), test), test, "prediction").first().rmse
    assert [r["rank"] for r in found if r.chosen] == [search.best().model.rank]
    assert found[0].test_rmse == pytest.approx(want, abs=1e-5)

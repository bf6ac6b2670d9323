import random

import pytest
from conftest import rows

from harrow.operators import evaluation as ev
from harrow.operators import similarity as sim

PREDICTED = [(1, 1, 2), (1, 4, 1), (3, 1, 4), (3, 4, 5), (7, 1, 3)]
ACTUAL = [(1, 4, 3), (3, 1, 4), (3, 4, 2), (7, 1, 4), (7, 9, 1)]


def ratings(spark, data):
    return spark.createDataFrame([(u, i, float(r)) for u, i, r in data],
                                 "user bigint, item bigint, rating double")


@pytest.mark.parametrize("predicted, actual, want", [
    (PREDICTED, ACTUAL, (14 / 4) ** 0.5),  # errors 2, 0, 3 and 1 over the four pairs of both
    ([(7, 9, 8)], ACTUAL, 7.0),
    (ACTUAL, ACTUAL, 0.0),
    ([(9, 9, 1)], ACTUAL, None),
])
def test_rmse(spark, predicted, actual, want):
    got = ev.rmse(ratings(spark, predicted), ratings(spark, actual)).first().rmse
    assert got == (want if want is None else pytest.approx(want))


def by_hand(sims, gold):
    """(false positives, misses, hits) per threshold, straight from the scores."""
    known = set(gold)
    others = [s for p, s in sims.items() if p not in known]
    unscored = sum(p not in sims for p in gold)
    curve = {}
    for n in range(100):
        t = n / 100
        hits = [p for p in gold if sims.get(p, 0.0) >= t]
        reached = sum(floor_hundredth(s) >= n for s in others)
        # A gold pair between its hundredth and the threshold is in no bin from there on.
        between = sum(floor_hundredth(sims[p]) >= n for p in gold if p in sims)
        listed = sum(floor_hundredth(sims.get(p, 0.0)) >= n for p in gold)
        curve[t] = (reached + between - listed, len(gold) - len(hits), len(hits))
    assert curve[0.0][0] == len(others) - unscored
    return curve


def floor_hundredth(s):
    return int(s * 100)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_curve_on_made_scores(spark, seed):
    rng = random.Random(seed)
    pairs = [(i, j) for i in range(30) for j in range(20)]
    sims = {p: rng.choice([round(rng.random(), 6), rng.randint(0, 100) / 100, 0.0, 1.0, 0.29, 0.57])
            for p in pairs if rng.random() < 0.8}
    gold = rng.sample(pairs, 40)
    scored = spark.createDataFrame([(*p, s) for p, s in sims.items()],
                                   "id_a int, id_b int, similarity double")
    true = spark.createDataFrame(gold, "id_a int, id_b int")
    scores = ev.gold_scores(scored, true)
    got = ev.confusion(ev.pair_bins(scored), scores)
    want = by_hand(sims, gold)
    assert {r.threshold: (r.n_fp, r.n_fn, r.n_tp) for r in got.collect()} == want

    curve = ev.precision_recall(got).orderBy("threshold").collect()
    assert len(curve) == 100
    for r in curve:
        fp, fn, tp = want[r.threshold]
        p, q = tp / (tp + fp) if tp + fp else None, tp / (tp + fn)
        assert r.precision == (p if p is None else pytest.approx(p))
        assert r.recall == pytest.approx(q)
        if p and q:
            assert r.f_measure == pytest.approx(2 * p * q / (p + q))
    assert [r.recall for r in curve] == sorted((r.recall for r in curve), reverse=True)


def test_threshold_zero_of_a_large_run(spark):
    # The published sizes of a run and its results at threshold 0.
    bins = spark.createDataFrame([(0, 2_441_100)], "bin int, n_pairs bigint")
    gold = spark.range(1300).selectExpr("id id_a", "id id_b", "0.0D similarity")
    row = ev.precision_recall(ev.confusion(bins, gold)).filter("threshold = 0").first()
    assert row.precision == pytest.approx(0.000532546802671, abs=1e-12)
    assert row.f_measure == pytest.approx(0.00106452669505, abs=1e-12)


def test_true_false_pairs_and_key(spark):
    sims = spark.createDataFrame([("a", "x", 0.5), ("b", "x", 0.1)],
                                 "id_a string, id_b string, similarity double")
    gold = spark.createDataFrame([("a", "x"), ("c", "y")], "id_a string, id_b string")
    assert rows(ev.true_pairs(sims, gold)) == [("a", "x", 0.5)]
    assert rows(ev.false_pairs(sims, gold)) == [("b", "x", 0.1)]
    assert rows(ev.gold_scores(sims, gold)) == [("a", "x", 0.5), ("c", "y", 0.0)]
    assert rows(ev.pair_key(sims), "key") == [("a x",), ("b x",)]


def test_index_bins_and_means_equal_all_pairs(spark):
    rng = random.Random(5)
    words = ["the", "the", "the", *[f"w{i}" for i in range(40)]]

    def texts(n):
        return [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 8)))) for i in range(n)]

    left, right = (spark.createDataFrame(texts(n), "id bigint, text string") for n in (50, 20))
    gold = spark.createDataFrame([(i, i) for i in range(20)], "id_a bigint, id_b bigint")
    index = sim.build_index(left, right, min_similarity=0.01)
    every = left.selectExpr("id id_a").crossJoin(right.selectExpr("id id_b"))
    scored = sim.pair_similarity(index, every)
    want = dict(rows(ev.pair_bins(scored)))
    want[0] = want.get(0, 0) + 1000 - sum(want.values())  # pairs without a common word
    assert dict(rows(ev.index_bins(index).filter("n_pairs > 0"))) == want

    sims = {(r.id_a, r.id_b): r.similarity for r in scored.collect()}
    row = ev.mean_similarities(index, gold).first()
    true = [sims.get((i, i), 0.0) for i in range(20)]
    assert (row.n_true, row.n_other) == (20, 980)
    assert row.mean_true == pytest.approx(sum(true) / 20, abs=1e-5)
    assert row.mean_other == pytest.approx((sum(sims.values()) - sum(true)) / 980, abs=1e-5)


def test_gold_pairs_below_the_bar_are_true_pairs(spark):
    filler = " ".join(f"w{i}" for i in range(60))
    left = spark.createDataFrame([(1, f"acme {filler}"), (2, "pen")], "id bigint, text string")
    right = spark.createDataFrame([(1, "acme " + filler.replace("w", "v")), (2, "pen")],
                                  "id bigint, text string")
    gold = spark.createDataFrame([(1, 1), (2, 2), (1, 2)], "id_a bigint, id_b bigint")
    index = sim.build_index(left, right, min_similarity=0.5)
    assert rows(sim.similar_pairs(index), "id_a", "id_b") == [(2, 2)]
    found = ev.true_pairs(sim.pair_similarity(index, gold), gold)
    assert rows(found, "id_a", "id_b") == [(1, 1), (2, 2)]


def test_index_bins_need_the_first_bin(spark):
    df = spark.createDataFrame([(1, "x")], "id int, text string")
    with pytest.raises(ValueError):
        ev.index_bins(sim.build_index(df, df, min_similarity=0.05))

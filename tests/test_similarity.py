import math
import random
from collections import Counter

import pytest
from conftest import left_behind, rows, shuffles

from harrow import session
from harrow.operators import similarity as sim
from harrow.operators import skew, weights
from harrow.session import PART_BYTES


def brute(left, right):
    """Cosine of every pair, by the definitions."""
    corpus = {("a", i): t.split() for i, t in left} | {("b", i): t.split() for i, t in right}
    df = Counter(w for words in corpus.values() for w in set(words))
    vectors = {}
    for key, words in corpus.items():
        weight = {w: n / len(words) * len(corpus) / df[w] for w, n in Counter(words).items()}
        norm = math.sqrt(sum(v * v for v in weight.values()))
        vectors[key] = {w: v / norm for w, v in weight.items()}
    return {(i, j): (sum(v * vectors["b", j].get(w, 0) for w, v in vectors["a", i].items()),
                     set(corpus["a", i]) & set(corpus["b", j]))
            for i, _ in left for j, _ in right}


def collection(rng, n, copies, common):
    words = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(n):
        if i < copies:
            texts.append("the copied text of w1 and w2")
        else:
            size = rng.randint(0, 9)
            texts.append(" ".join(["the"] * rng.randint(0, common)
                                  + [words[int(60 * rng.random() ** 2)] for _ in range(size)]))
    return list(enumerate(texts))


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    rng = random.Random(request.param)
    left, right = collection(rng, 60, 20, 3), collection(rng, 25, 8, 3)
    frames = [spark.createDataFrame(c, "id bigint, text string") for c in (left, right)]
    return brute(left, right), *frames


@pytest.mark.parametrize("bar", [1e-4, 0.05, 0.6, 1.0])
def test_pairs_equal_brute_force(case, bar):
    want, left, right = case
    index = sim.build_index(left, right, min_similarity=bar)
    got = {(r.id_a, r.id_b): r.similarity for r in sim.similar_pairs(index).collect()}
    assert got == {p: pytest.approx(s, abs=2e-6) for p, (s, _) in want.items()
                   if round(s, 6) >= bar}


def test_small_blocks_change_nothing(case, monkeypatch):
    want, left, right = case
    monkeypatch.setattr(skew.blocks, "__defaults__", (3,))
    monkeypatch.setattr(skew.join_pairs, "__defaults__", (3,))
    index = sim.build_index(left, right, min_similarity=0.01)
    got = [(r.id_a, r.id_b) for r in sim.similar_pairs(index).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {p for p, (s, _) in want.items() if round(s, 6) >= 0.01}
    pairs = left.selectExpr("id id_a").crossJoin(right.selectExpr("id id_b"))
    scored = rows(sim.pair_similarity(index, pairs), "id_a", "id_b")
    assert scored == sorted(p for p, (_, common) in want.items() if common)


def test_given_pairs_and_common_words(case, spark):
    want, left, right = case
    index = sim.build_index(left, right, min_similarity=0.5)
    pairs = spark.createDataFrame([(i, j) for i in range(0, 60, 7) for j in range(25)] + [(999, 0)],
                                  "id_a bigint, id_b bigint")
    got = {(r.id_a, r.id_b): r.similarity for r in sim.pair_similarity(index, pairs).collect()}
    asked = [p for p in want if p[0] % 7 == 0]
    assert got == {p: pytest.approx(want[p][0], abs=2e-6) for p in asked if want[p][1]}
    common = {(r.id_a, r.id_b): (r.n_common, r.tokens)
              for r in sim.common_tokens(index, pairs).collect()}
    assert common == {p: (len(want[p][1]), sorted(want[p][1])) for p in asked if want[p][1]}


def test_totals_need_no_pairs(case):
    want, left, right = case
    index = sim.build_index(left, right)
    row = sim.all_pairs_summary(index).first()
    assert row.n_pairs == len(want) == 60 * 25
    assert row.sum_similarity == pytest.approx(sum(s for s, _ in want.values()))
    assert row.mean_similarity == pytest.approx(row.sum_similarity / row.n_pairs)


@pytest.mark.parametrize("dense, bits", [(1, 8), (128, 32_768), (3, 8)])
def test_overlapping_pairs_are_counted_exactly(case, monkeypatch, dense, bits):
    want, left, right = case
    monkeypatch.setattr(sim, "DENSE_RECORDS", dense)
    monkeypatch.setattr(sim, "BITS", bits)
    monkeypatch.setattr(sim, "BUCKET_RECORDS", max(1, bits // 2))
    index = sim.build_index(left, right)
    assert sim.overlapping_pair_count(index).first().n_pairs == sum(
        bool(c) for _, c in want.values())


def test_bins_count_copies(case):
    want, left, right = case
    index = sim.build_index(left, right)
    got = dict(rows(sim.similar_pair_bins(index)))
    assert sum(got.values()) == sum(round(s, 6) >= 0.01 for s, _ in want.values())


def test_string_ids(spark):
    left = spark.createDataFrame([("b1", "acme painter"), ("b2", "x")], "id string, text string")
    right = spark.createDataFrame([("http://1", "acme drawer")], "id string, text string")
    index = sim.build_index(left, right, min_similarity=0.05)
    # acme weighs 1/2 * 3/2, the other word 1/2 * 3.
    assert rows(sim.similar_pairs(index)) == [("b1", "http://1", pytest.approx(0.2))]


def test_bar_must_be_positive(spark):
    df = spark.createDataFrame([(1, "x")], "id int, text string")
    with pytest.raises(ValueError):
        sim.build_index(df, df, min_similarity=0)


def test_plans_hold_no_cartesian_product(case):
    _, left, right = case
    index = sim.build_index(left, right)
    for df in (sim.similar_pairs(index), sim.all_pairs_summary(index),
               sim.overlapping_pair_count(index)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert "Python" not in plan


def test_few_pairs_are_kept_that_miss_the_bar(spark, monkeypatch):
    """Long texts share many common words; the words' heaviest weights rule such pairs out."""
    rng = random.Random(3)
    common, rare = [f"c{i}" for i in range(30)], [f"r{i}" for i in range(400)]
    texts = [" ".join(rng.choices(common, k=60) + rng.choices(rare, k=6)) for _ in range(120)]
    left, right = list(enumerate(texts[:80])), list(enumerate(texts[80:]))
    seen = []

    def counted(df, name, write=sim.materialize):
        table = write(df, name)
        if name == "seen":
            seen.append(table.count())
        return table

    monkeypatch.setattr(sim, "materialize", counted)
    frames = [spark.createDataFrame(c, "id bigint, text string") for c in (left, right)]
    index = sim.build_index(*frames, min_similarity=0.2)
    got = {(r.id_a, r.id_b) for r in sim.similar_pairs(index).collect()}
    want = brute(left, right)
    assert got == {p for p, (s, _) in want.items() if round(s, 6) >= 0.2} and got
    assert all(common for _, common in want.values())  # every pair shares a word
    assert len(got) <= seen[0] < len(want) / 5


def test_a_task_weighs_a_bounded_part_of_the_texts(case, spark, monkeypatch):
    want, left, right = case
    monkeypatch.setattr(weights, "TEXT_BYTES", 100)
    assert weights.text_parts(left.unionByName(right)) > 12
    index = sim.build_index(left, right, min_similarity=0.01)
    assert len(index.words.inputFiles()) > 8
    got = {(r.id_a, r.id_b): r.similarity for r in sim.similar_pairs(index).collect()}
    assert got == {p: pytest.approx(s, abs=2e-6) for p, (s, _) in want.items()
                   if round(s, 6) >= 0.01}


def test_tables_are_written_in_parts_of_the_text(spark, monkeypatch):
    """More text makes more partitions and tasks, whatever the session's number of them."""
    settings = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    seen, write = [], sim.materialize

    def written(df, name):
        seen.append([spark.conf.get(s) for s in settings])
        return write(df, name)

    monkeypatch.setattr(sim, "materialize", written)
    monkeypatch.setattr(weights, "TEXT_BYTES", 10)
    before = [spark.conf.get(s) for s in settings]
    left = spark.createDataFrame([(i, f"w{i % 3} common words") for i in range(9)],
                                 "id bigint, text string")
    right = spark.createDataFrame([(1, "w1 words")], "id bigint, text string")
    index = sim.build_index(left, right)
    assert index.parts == 15  # 9 x 15 + 8 bytes of text
    pairs = sim.similar_pairs(index)
    assert len(seen) == 7
    assert seen == [["8", str(PART_BYTES), str(PART_BYTES)]] * 7
    assert [spark.conf.get(s) for s in settings] == before
    assert {r.id_b for r in pairs.collect()} == {1}


@pytest.mark.parametrize("slices", [1, 3])
def test_the_index_is_made_in_slices_and_leaves_itself_only(case, spark, monkeypatch, slices):
    want, left, right = case
    monkeypatch.setattr(sim, "text_parts", lambda _: 12)
    monkeypatch.setattr(sim, "SLICES", slices)
    monkeypatch.setattr(sim, "SLICE_PARTS", 2)
    monkeypatch.setattr(session, "_written", [])
    made = []
    monkeypatch.setattr(sim, "materialize", lambda df, name, write=sim.materialize: (
        made.append(name) or write(df, name)))
    before = shuffles(spark)
    index = sim.build_index(left, right, min_similarity=0.05)
    assert left_behind(spark, before) == set()
    assert Counter(made[3:]) == {"counts": slices, "units": slices, "index": slices}
    names = [path.split("/")[-1].rsplit("-", 1)[0] for path in session._written]
    assert sorted(names) == ["index"] * slices + ["records"]
    got = {(r.id_a, r.id_b): r.similarity for r in sim.similar_pairs(index).collect()}
    assert got == {p: pytest.approx(s, abs=2e-6) for p, (s, _) in want.items()
                   if round(s, 6) >= 0.05}

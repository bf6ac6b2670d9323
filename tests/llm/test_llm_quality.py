import itertools

import llm_cases
import numpy as np
import pytest
from conftest import rows

from harrow.llm import quality
from harrow.llm.batches import chunks

CLEAN = "The river runs past the old mill.\nIt turns a wheel of oak and iron."
JUNK = ("BUY!! NOW!! CHEAP!! DEALS!!", "a | b | c | d | e", "on on on on on on", "x### y$$$ z%%% w&&&")


def test_marginals_equal_a_sum_over_all_labellings():
    rng = np.random.default_rng(1)
    emit, moves = rng.normal(size=9), rng.normal(size=(2, 2))
    texts = np.array([0, 0, 0, 0, 1, 2, 2, 2, 2])
    p, expected = quality._chain(emit, moves, texts)
    counted = np.zeros((2, 2))
    for t in range(3):
        own = np.flatnonzero(texts == t)
        total, good, seen = 0.0, np.zeros(len(own)), np.zeros((2, 2))
        for states in itertools.product((0, 1), repeat=len(own)):
            score = sum(emit[i] * s for i, s in zip(own, states, strict=True))
            pairs = list(itertools.pairwise(states))
            weight = np.exp(score + sum(moves[a, b] for a, b in pairs))
            total += weight
            good += weight * np.array(states)
            for pair in pairs:
                seen[pair] += weight
        assert p[own] == pytest.approx(good / total)
        counted += seen / total
    assert expected == pytest.approx(counted)


def test_features_see_the_neighbouring_lines():
    (_, data, offsets), = chunks(quality.pa.array(["one two\nONE!!\n\nlast", None, "one two"]))
    starts, ends, texts = quality.line_table(data, offsets)
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)] == [
        "one two", "ONE!!", "last", "one two"]
    assert texts.tolist() == [0, 0, 0, 2]
    f = quality.line_features(data, starts, ends, texts)
    n = quality.N_OWN
    assert (f[1, n:2 * n] == f[0, :n]).all() and (f[1, 2 * n:3 * n] == f[2, :n]).all()
    assert not f[0, n:2 * n].any() and not f[2, 2 * n:3 * n].any() and not f[3, n:3 * n].any()
    assert f[0, 0] == 0 and f[1, 0] == pytest.approx(3 / 5)


def labelled(spark, n):
    data, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        text = "\n".join([CLEAN.replace("mill", f"mill{i}")] + [JUNK[i % 4]] * 4 * bad)
        data.append((i, text, "doc"))
        labels.append((i, int(not bad)))
    return (spark.createDataFrame(data, "doc_id long, text string, score string"),
            spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, quality int"))


def test_learns_from_some_and_judges_the_others(spark):
    docs, labels = labelled(spark, 200)
    field = quality.learn_quality(docs, labels.filter("doc_id < 120"))
    scored = quality.score_quality(docs, field)
    assert scored.columns == ["doc_id", "text", "score", "predicted"]
    got = scored.filter("doc_id >= 120").collect()
    right = [r.predicted == int(r.doc_id % 3 != 0) for r in got]
    assert sum(right) >= 0.95 * len(right)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)

    kinds = quality.score_quality(llm_cases.documents(spark), field).collect()
    assert len(kinds) == llm_cases.documents(spark).count()
    empty = {r.score for r in kinds if not r.text}
    assert empty == {field.empty} and 0 < field.empty < 1
    assert quality.score_quality(llm_cases.empty(spark), field).count() == 0


def test_without_labels_all_texts_score_a_half(spark):
    docs, labels = labelled(spark, 3)
    field = quality.learn_quality(docs, labels.limit(0))
    assert {r.score for r in quality.score_quality(docs, field).collect()} == {0.5}


def test_query_hides_a_third(spark, tmp_path):
    docs, labels = labelled(spark, 90)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    got = quality.op6_quality(spark, str(tmp_path))
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    want = docs.selectExpr("doc_id", "crc32(string(doc_id)) % 3 = 1")
    assert rows(got, "doc_id", "held_out") == rows(want)


def test_long_documents_train_in_chains_and_copies_once(spark, monkeypatch):
    n = 2 * quality.TRAINING_LINES + 7
    long = "\n".join(f"line number {i}" for i in range(n))
    docs = spark.createDataFrame([(1, long), (2, "short"), (3, "short"), (4, ""), (5, None)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(1, 6)], "doc_id long, quality int")
    seen = {}
    monkeypatch.setattr(quality, "train", lambda *given: seen.update(given=given))
    quality.learn_quality(docs, labels)
    features, texts, lengths, good = seen["given"]
    assert features.shape == (n + 1, quality.N_FEATURES) and good.tolist() == [1.0] * (n + 1)
    assert sorted(np.bincount(texts).tolist()) == sorted([1, 7] + [quality.TRAINING_LINES] * 2)
    assert lengths.sum() == len(long) - (n - 1) + len("short")

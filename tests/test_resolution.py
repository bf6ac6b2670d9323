import pytest

from harrow.operators import weights as wt
from harrow.plans import resolution


def test_turns_are_counted_in_bounded_parts(spark, tmp_path, monkeypatch):
    rows = [(c, t, f"word{c} same turn{t}") for c in range(30) for t in range(3)]
    rows += [(0, 1, "word0 again"), (7, 9, "alone"), (8, 3, None)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, text string").write.parquet(
        f"{tmp_path}/conversations.parquet")
    before = {r.pair_id: r.similarity for r in resolution.QUERIES["er_cosine_pairs"](
        spark, str(tmp_path)).collect()}
    asked = []
    counts = wt.term_counts
    monkeypatch.setattr(wt, "TEXT_BYTES", 100)
    monkeypatch.setattr(wt, "term_counts", lambda *a, **b: asked.append(
        found := counts(*a, **b)) or found)
    after = {r.pair_id: r.similarity for r in resolution.QUERIES["er_cosine_pairs"](
        spark, str(tmp_path)).collect()}
    assert asked[0].rdd.getNumPartitions() > 30
    assert after == {k: v if v is None else pytest.approx(v) for k, v in before.items()}
    assert len(after) == 61 and after["8:2"] is None

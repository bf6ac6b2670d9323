import random

import pytest

from harrow.llm import topk


def plain(vectors, k, asked):
    out = []
    sound = [(i, v) for i, v in vectors if i is not None and v is not None and None not in v]
    for q, a in {(i, tuple(v)) for i, v in sound if asked(i)}:
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in sound if i != q)
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("seed, size, block, high", [(1, 8, 1000, 3), (2, 5, 7, 200), (3, 3, 4, 1 << 40)])
def test_equal_to_plain_search(spark, seed, size, block, high, monkeypatch):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 13)
    rng = random.Random(seed)
    limit = high if high < 1 << 30 else 1 << 30
    vectors = [(i, [rng.randint(-limit, limit) for _ in range(size)]) for i in range(120)]
    vectors += [(200 + i, vectors[i][1]) for i in range(10)]  # ties
    vectors += [(300, [1] * (size + 2)), (310, [2]), (320, []), (330, None), (340, [None] * size),
                (None, [1] * size), vectors[3], vectors[20]]
    df = spark.createDataFrame([(i, v, "x") for i, v in vectors],
                               "id long, vector array<long>, score string").repartition(3)
    got = topk.top_k(df, df["id"] % 10 == 0, 5, query_block=block)
    assert got.columns == ["query_id", "rank", "id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain(vectors, 5, lambda i: i % 10 == 0)


def test_few_candidates_and_none(spark):
    df = spark.createDataFrame([(0, [1, 2]), (1, [3, -4])], "id long, vector array<long>")
    assert [tuple(r) for r in topk.top_k(df, df["id"] == 0, 5).collect()] == [(0, 1, 1, -5)]
    assert topk.top_k(df.limit(1), df["id"] == 0, 5).count() == 0
    assert topk.top_k(df.limit(0), df["id"] == 0, 5).count() == 0


def test_query_leaves_out_unsound_vectors(spark, tmp_path):
    data = [(0, [0.5, 0.25]), (50, [-0.001, 1.0]), (1, [1.0, 1.0]), (2, [float("nan"), 1.0]),
            (3, [float("inf"), 1.0]), (4, None), (5, [None, 1.0])]
    spark.createDataFrame(data, "vec_id long, embedding array<float>").write.parquet(
        str(tmp_path / "embeddings.parquet"))
    got = sorted(tuple(r) for r in topk.op5_top_k(spark, str(tmp_path)).collect())
    assert got == [(0, 1, 1, 49152), (0, 2, 50, 16256), (50, 1, 1, 65280), (50, 2, 0, 16256)]

from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from harrow.operators import sampling


def test_hash_split_covers_and_repeats(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 7).alias("x"))
    split = sampling.hash_split(df, ["id", "x"], [6, 2, 2], seed=0)
    shares = {r.split: r["count"] / 20_000 for r in split.groupBy("split").count().collect()}
    assert shares == {0: pytest.approx(0.6, abs=0.02), 1: pytest.approx(0.2, abs=0.02),
                      2: pytest.approx(0.2, abs=0.02)}
    assert rows(split) == rows(sampling.hash_split(df.repartition(7), ["id", "x"], [6, 2, 2]))
    assert rows(split) != rows(sampling.hash_split(df, ["id", "x"], [6, 2, 2], seed=1))
    assert "Exchange" not in split._jdf.queryExecution().executedPlan().toString()


def test_random_split_is_a_partition(spark):
    parts = sampling.random_split(spark.range(1000), [6, 2, 2], seed=0)
    assert sum(p.count() for p in parts) == 1000


def test_sample_has_the_size_asked_for(spark):
    trees = ["oak", "ash", "elm", "fir", "yew", "lime tree"]
    df = spark.createDataFrame([(t,) for t in trees], "tree string")
    got = sampling.sample_with_replacement(df, 30, seed=1)
    assert got.count() == 30 and {r.tree for r in got.collect()} <= set(trees)
    assert rows(got) == rows(sampling.sample_with_replacement(df.repartition(3), 30, seed=1))
    assert sampling.sample_with_replacement(df, 3).count() == 3


def test_sample_of_nothing_is_empty(spark):
    assert sampling.sample_with_replacement(spark.range(0), 5).count() == 0


def test_sample_weighs_copies(spark, monkeypatch):
    monkeypatch.setattr(sampling, "RUN_ROWS", 100)
    monkeypatch.setattr(sampling, "STRETCH_ROWS", 30)
    monkeypatch.setattr(sampling, "GROUP_ROWS", 500)
    monkeypatch.setattr(sampling, "BLOCK_GROUPS", 2)
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("v"))
    got = Counter(r.v for r in sampling.sample_with_replacement(df, 3000, seed=3).collect())
    assert sum(got.values()) == 3000
    assert got[-1] == pytest.approx(1000, abs=120)
    assert len(got) > 1000


def test_only_the_groups_that_draws_hit_are_sorted(spark, monkeypatch):
    monkeypatch.setattr(sampling, "GROUP_ROWS", 10)
    df = spark.range(2000).withColumnRenamed("id", "v")
    got = sampling.sample_with_replacement(df, 3, seed=3)
    assert got.count() == 3
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan

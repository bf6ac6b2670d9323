from conftest import rows
from pyspark.sql import functions as F

from harrow.operators.skew import blocks, join_pairs


def test_join_pairs_meets_every_pair_once(spark):
    left = spark.range(90).select(F.col("id").alias("a"), (F.col("id") % 3).alias("k"))
    right = spark.range(50).select(F.col("id").alias("b"), (F.col("id") % 4).alias("k"))
    left = left.withColumn("na", F.lit(30)).withColumn("nb", F.lit(13))
    right = right.withColumn("na", F.lit(30)).withColumn("nb", F.lit(13))
    plain = left.join(right, ["k", "na", "nb"])
    for size in (1, 4, 1000):
        got = join_pairs(left, right, ["k", "na", "nb"], ["a"], ["b"], "na", "nb", size)
        assert rows(got, "k", "a", "b") == rows(plain, "k", "a", "b")


def test_blocks(spark):
    df = spark.createDataFrame([(0,), (1,), (2000,), (2001,)], "n int")
    assert [r[0] for r in df.select(blocks("n")).collect()] == [1, 1, 1, 2]

from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from harrow.operators import relational as rel


def numbers(spark, low, high):
    return spark.range(low, high).select(F.col("id").cast("int").alias("n"))


def test_set_operations(spark):
    one, two = numbers(spark, 1, 10), numbers(spark, 5, 15)
    assert rel.bag_union(one, two).count() == 19
    assert rows(rel.set_intersection(one, two)) == [(i,) for i in range(5, 10)]
    assert rows(rel.set_intersection(rel.bag_union(one, one), one)) == rows(one)
    assert rel.set_union(one, two).count() == 14
    assert rows(rel.difference_by_key(one, two, ["n"])) == [(i,) for i in range(1, 5)]


def test_partition_sums(spark):
    three = spark.range(1, 10, 1, 3).withColumnRenamed("id", "n")
    assert sorted(r.total for r in rel.per_partition_sums(three, "n").collect()) == [6, 15, 24]
    doubles = three.select((F.col("n") / 2).alias("n"))
    assert sorted(r.total for r in rel.per_partition_sums(doubles, "n").collect()) == [3, 7.5, 12]
    for kind in ("tinyint", "decimal(9,2)"):
        typed = three.select(F.col("n").cast(kind))
        assert sorted(int(r.total) for r in rel.per_partition_sums(typed, "n").collect()) == [6, 15, 24]


def test_membership_is_equality_of_a_field(spark):
    df = spark.createDataFrame([(["B1", "x"],), (["B12", "x"],)], "fields array<string>")
    assert rel.rows_with_field(df, "B1").count() == 1
    flat = spark.createDataFrame([("B1", "a"), ("b", "B1"), ("B12", "c")], "p string, q string")
    assert rel.rows_with_value(flat, "B1").count() == 2


def test_membership_on_typed_columns(spark):
    df = spark.createDataFrame([("Q7", 5, 1.5), ("x", 7, 2.0)], "base string, trips int, r double")
    assert rel.rows_with_value(df, "Q7").count() == 1
    assert rel.rows_with_value(df, 7).count() == 1
    assert rel.rows_with_value(df, "7", ["trips"]).count() == 1
    assert rel.rows_with_value(df, "none").count() == 0


def test_record_equality(spark):
    df = spark.createDataFrame([(4, 25, 2.5), (4, 25, None)], "u int, i int, r double")
    assert rel.rows_equal_to(df, {"u": 4, "i": 25, "r": 2.5}).count() == 1
    assert rel.rows_equal_to(df, {"u": 4, "i": 25, "r": None}).count() == 1


def test_sums_and_counts(spark):
    teams = ["fox", "badger", "red deer", "fox", "otter", "fox", "hare"]
    df = spark.createDataFrame([(t, len(t)) for t in teams], "team string, n int")
    assert dict(rows(rel.count_by(df, "team"))) == Counter(teams)
    assert rows(rel.sum_by(df, "team", "n", "s"))[-1] == ("red deer", 8)
    assert [r.team for r in rel.top_sums(df, "team", "n", "s", 2).collect()] == ["fox", "red deer"]
    assert [r.team for r in rel.top_k(df.distinct(), 1, "team").collect()] == ["badger"]


def test_concatenation(spark):
    words = spark.createDataFrame([(2, "plum"), (0, "fig"), (1, "pear")], "id int, w string")
    assert rel.concat_in_order(words, "w", "id").first().text == "figpearplum"
    pieces = rel.concat_in_order(words, "w", "id", piece_rows=2).orderBy("piece").collect()
    assert [r.text for r in pieces] == ["figpear", "plum"]


@pytest.mark.parametrize("max_values", [10_000, 3])
def test_value_lists_keep_everything(spark, max_values):
    data = [("hot", i % 40) for i in range(400)] + [("cold", 1), ("cold", 1), ("none", None)]
    df = spark.createDataFrame(data, "k string, v int")
    lists = rel.value_lists(df, "k", "v", max_values)
    got = Counter()
    for r in lists.collect():
        assert r.n == sum(v.n for v in r["values"])
        for v in r["values"]:
            got[(r.k, v.value)] += v.n
    assert got == Counter(data)
    assert lists.filter("k = 'hot'").count() == (1 if max_values > 40 else pytest.approx(14, abs=4))
    entry = rel.value_maps(lists.filter("k = 'cold'"), "k").first().entry
    assert [(k, [tuple(v) for v in vs]) for k, vs in entry.items()] == [("cold", [(1, 2)])]


def test_value_lists_of_a_null_key_are_cut(spark):
    df = spark.range(400).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("v"))
    lists = rel.value_lists(df, "k", "v", 50).collect()
    assert sum(r.n for r in lists) == 400 and len(lists) == pytest.approx(8, abs=2)
    assert max(len(r["values"]) for r in lists) < 100


def test_a_function_on_every_partition(spark):
    def totals(rows_):
        yield (sum(r.n for r in rows_),)

    df = spark.createDataFrame([(i,) for i in range(1, 10)], "n int").coalesce(1)
    three = spark.range(1, 10, numPartitions=3).withColumnRenamed("id", "n")
    assert [t for t, in rows(rel.map_partitions(three, totals, "total bigint"))] == [6, 15, 24]
    assert [t for t, in rows(rel.map_partitions(df, totals, "total bigint"))] == [45]
    empty = rel.map_partitions(df.filter("n > 99"), totals, "total bigint")
    assert {t for t, in rows(empty)} <= {0}


def test_a_partition_function_may_yield_any_number_of_rows(spark):
    def words(rows_):
        for row in rows_:
            yield from ((row.id, w, [len(w)]) for w in (row.text or "").split())

    df = spark.createDataFrame([(1, "a bc"), (2, None), (3, "def " * 2500)], "id int, text string")
    got = rel.map_partitions(df, words, "id int, word string, sizes array<int>")
    assert got.dtypes == [("id", "int"), ("word", "string"), ("sizes", "array<int>")]
    assert got.count() == 2502 and got.filter("word = 'bc'").first().sizes == [2]
    assert rel.map_partitions(df, lambda rows_: (), "x int").collect() == []


@pytest.mark.parametrize("value, found", [
    (5, ["i", "d", "s5"]), (5.0, ["i", "d"]), (5.7, []), ("5", ["i", "s5"]), ("5.0", ["d"]), ("t", ["st"]),
    ("true", []), (True, ["b"]), (False, []), (1, []), ("", []), (None, [])])
def test_a_value_is_in_a_column_that_keeps_it(spark, value, found):
    df = spark.createDataFrame([("i", 5, 0.5, "x", None), ("d", 0, 5.0, "x", None), ("s5", 0, 0.5, "5", None),
                                ("st", 0, 0.5, "t", None), ("b", 0, 0.5, "x", True)],
                               "name string, i int, d double, s string, b boolean")
    got = rel.rows_with_value(df, value, ["i", "d", "s", "b"])
    assert [r.name for r in got.collect()] == found

import os

import pytest
from conftest import left_behind, rows, shuffles
from pyspark.sql import functions as F

from harrow import session


def test_materialize_reads_what_it_wrote(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "work_dir", lambda _: str(tmp_path))
    monkeypatch.setattr(session, "_written", [])
    df = spark.range(10).selectExpr("id", "if(id > 5, null, id) x")
    kept = session.materialize(df, "numbers")
    assert kept.dtypes == df.dtypes and rows(kept, "id") == rows(df, "id")
    session.materialize(df, "numbers")
    (folder,) = os.listdir(tmp_path)  # one folder for all tables of the application
    assert len(os.listdir(tmp_path / folder)) == 2
    assert session.clear_materialized() == []
    assert os.listdir(tmp_path / folder) == []


def test_tables_in_another_store_are_named(monkeypatch):
    monkeypatch.setattr(session, "_written", ["store://bucket/numbers"])
    assert session.clear_materialized() == ["store://bucket/numbers"]


def test_work_dir_is_the_one_the_cluster_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = session.work_dir(spark)
    assert folder == named if named else os.path.isdir(folder)


def test_tables_on_the_way_are_deleted_and_the_last_one_stays(spark, monkeypatch):
    monkeypatch.setattr(session, "_written", [])
    before = session.materialize(spark.range(3), "before")

    def inner():
        return session.materialize(spark.range(5), "way").join(before, "id")

    def outer():
        found = session.materialize_last(inner, "inner")
        assert found.count() == 3
        return session.materialize(found.filter("id > 0"), "way")

    last = session.materialize_last(outer, "last")
    assert sorted(r.id for r in last.collect()) == [1, 2] and before.count() == 3
    names = [os.path.basename(path).rsplit("-", 1)[0] for path in session._written]
    assert names == ["before", "last"]
    assert all(os.path.isdir(path.removeprefix("file://")) for path in session._written)
    with pytest.raises(ValueError):
        session.materialize_last(lambda: int("x"), "never")
    assert session.materialize(spark.range(1), "after").count() == 1
    assert session.clear_materialized() == []


def test_tables_in_another_store_stay_to_be_named(spark, monkeypatch):
    monkeypatch.setattr(session, "_written", [])

    def build():
        session.work_path(spark, "way")
        session._written[-1] = session._passing.get()[-1] = "store://bucket/way"
        return spark.range(1)

    assert session.materialize_last(build, "last").count() == 1
    assert session.clear_materialized() == ["store://bucket/way"]


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before = shuffles(spark)
    stored = session.materialize(spark.range(1000).groupBy(F.col("id") % 7).count(), "counted")
    assert left_behind(spark, before) == set() and stored.count() == 7
    assert spark.conf.get(session.SHUFFLE_CLEANUP, "false") == "false"


def test_a_query_after_a_stored_one_keeps_its_shuffle_files(spark):
    counted = spark.range(1000).groupBy(F.col("id") % 7).count()
    stored = session.materialize(counted, "counted")
    assert counted.count() == stored.count() == counted.count() == 7


def test_discard_deletes_the_tables_read_and_no_others(spark):
    first = session.materialize(spark.range(5), "first")
    second = session.materialize(spark.range(7), "second")
    session.discard(first.filter("id > 1"), first.select(F.col("id") + 1))
    assert second.count() == 7
    kept = [path for path in session._written if "/first-" in path or "/second-" in path]
    assert len(kept) == 1 and "/second-" in kept[0] and os.path.exists(session._local(kept[0]))
    session.discard(second)
    assert not os.path.exists(session._local(kept[0]))


def test_discarded_tables_may_be_on_the_way_to_another(spark):
    def build():
        way = session.materialize(spark.range(4), "way")
        kept = session.materialize(way.filter("id > 1"), "kept")
        session.discard(way)
        return kept

    assert session.materialize_last(build, "last").count() == 2


def test_tables_are_read_together(spark):
    parts = [session.materialize(spark.range(10).filter(F.col("id") % 3 == k), "part")
             for k in range(3)] + [session.materialize(spark.range(0), "part")]
    whole = session.together(parts)
    assert rows(whole) == [(i,) for i in range(10)] and "Union" not in whole._jdf.queryExecution().toString()
    session.discard(parts[1])
    assert rows(session.together([parts[0], parts[2]])) == [(0,), (2,), (3,), (5,), (6,), (8,), (9,)]
    assert rows(session.together(parts[3:])) == []

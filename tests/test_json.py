"""Whole-document JSON by byte ranges, and JSON of unknown schema."""

import json
import random

import numpy as np
import pytest
from conftest import rows

from harrow import sources as src
from harrow.sources import json_documents as jd
from harrow.sources.variants import table_type

TEXTS = ["a", "x, y", "}{][,", 'q"uo\\te\\\\', "  ", 'é,"}', "\n", "\\"]


def value(rng, depth=0):
    kind = rng.random()
    if depth > 3 or kind < 0.3:
        return rng.choice([1, -2.5, None, True, *TEXTS])
    if kind < 0.6:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    return {rng.choice(["a", "b}", 'c,"']): value(rng, depth + 1) for _ in range(rng.randint(0, 4))}


def document(rng):
    whole = [value(rng) for _ in range(rng.randint(0, 6))] if rng.random() < 0.8 else value(rng)
    text = json.dumps(whole, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
    text = rng.choice(["", "\n "]) + text + rng.choice(["", " \n"])
    return text, whole if isinstance(whole, list) else [whole]


@pytest.mark.parametrize("mark", ["}", "]", ","])
def test_any_ranges_give_the_elements(mark):
    rng = random.Random(ord(mark))
    for _ in range(800):
        text, want = document(rng)
        records = text.encode().split(mark.encode())
        records = records if records[-1] else records[:-1]
        ranges, own = [], []
        for record in records:
            own.append(np.frombuffer(record + mark.encode(), np.uint8))
            if rng.random() < 0.4:
                ranges.append(own)
                own = []
        ranges += [own] if own else []
        starts = jd.range_starts([(i, jd.summarize(iter(r))) for i, r in enumerate(ranges)])
        found, pieces = [], {}
        for i, parts in enumerate(ranges):
            for origin, text_ in jd.cut_elements(iter(parts), starts[i], i):
                if origin is None or origin not in pieces:
                    found.append([])
                    pieces.setdefault(origin, found[-1])
                (found[-1] if origin is None else pieces[origin]).append(text_)
        got = [b"".join(f) for f in found]
        assert [json.loads(g) for g in got if g.strip()] == want


@pytest.fixture
def small_ranges(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    for key, setting in settings.items():
        spark.conf.set(key, setting)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.mark.parametrize("cut_at", ["}", ","])
def test_one_document_by_many_tasks(spark, tmp_path, small_ranges, cut_at):
    rng = random.Random(5)
    objects = [{"id": i, "name": rng.choice(TEXTS), "in": {"list": [rng.choice(TEXTS)] * rng.randint(0, 3)}}
               for i in range(500)]
    objects[250]["long"] = "no end, " * 1000  # an element over several ranges
    (tmp_path / "one.json").write_text(json.dumps(objects, indent=1))
    (tmp_path / "two.json").write_text(json.dumps([{"id": -1}, {"id": -2}]))
    (tmp_path / "empty.json").write_text(" [ ] \n")
    (tmp_path / "blank.json").write_text("\n\n")
    assert spark.read.option("lineSep", cut_at).text(str(tmp_path)).rdd.getNumPartitions() > 10
    found = src.json_array_elements(spark, str(tmp_path), cut_at)
    got = [json.loads(r.element) for r in found.collect()]
    assert sorted(got, key=lambda o: o["id"]) == [{"id": -2}, {"id": -1}, *objects]
    table = src.read_json_document(spark, str(tmp_path), cut_at=cut_at)
    assert dict(table.dtypes) == {"id": "bigint", "name": "string", "long": "string",
                                  "in": "struct<list:array<string>>"}
    assert rows(table.filter("id >= 0"), "id", "name") == [(o["id"], o["name"]) for o in objects]


def test_documents_that_are_no_array(spark, tmp_path):
    for i, text in enumerate(['{"a": {"b": [1, 2]}}', '"a } b"', " 5 ", "true", '[1, "x}", [2], {"c": 3}]']):
        (tmp_path / f"{i}.json").write_text(text)
    found = src.json_array_elements(spark, str(tmp_path), ",")
    assert sorted(r.element for r in found.collect()) == sorted(
        ['{"a": {"b": [1, 2]}}', '"a } b"', "5", "true", "1", '"x}"', "[2]", '{"c": 3}'])
    with pytest.raises(ValueError):
        src.json_array_elements(spark, str(tmp_path), "x")


def test_written_arrays_are_documents(spark, tmp_path):
    path = str(tmp_path / "out")
    src.write_json_arrays(spark.range(7).selectExpr("id", "if(id > 3, 'x', null) s").repartition(3), path)
    documents = [json.loads(p.read_text()) for p in (tmp_path / "out").glob("part-*")]
    assert sorted(o["id"] for d in documents for o in d) == list(range(7))
    assert rows(src.read_json_document(spark, path), "id") == [(i,) for i in range(7)]


def test_schema_and_rows_of_lines(spark, tmp_path):
    lines = ['{"a": 1, "b c": [1, 2.5], "d": {"x": null}}', '{"a": 2.5, "e": "t", "d": {"x": true}}',
             '{"VOID": null, "e": [1]}', "", "  ", '{"a": 4}']
    (tmp_path / "lines.json").write_text("\n".join(lines))
    table = src.read_json_lines(spark, str(tmp_path / "lines.json"))
    assert dict(table.dtypes) == {"VOID": "string", "a": "double", "b c": "array<double>",
                                  "d": "struct<x:boolean>", "e": "string"}
    assert rows(table.fillna(0.0), "a") == [(0.0,), (1.0,), (2.5,), (4.0,)]
    assert {r.e for r in table.collect()} == {None, "t", "[1]"}


def test_lines_that_are_no_object(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("{oops",), ("[1]",), (None,), ("7",)], "value string")
    found = src.json_rows(df)
    assert found.columns == ["a", "_corrupt_record"]
    assert sorted((r[1] or "", r[0]) for r in found.collect()) == [
        ("", 1), ("7", None), ("[1]", None), ("{oops", None)]
    assert src.json_rows(df.filter("value = '7'")).columns == ["_corrupt_record"]
    assert src.json_rows(df.limit(0)).collect() == []
    declared = src.json_rows(df, schema="a int, z string")
    assert declared.dtypes[:2] == [("a", "int"), ("z", "string")]


def test_types_of_variants():
    assert table_type("OBJECT<`a: VOID`: VOID, OBJECT: OBJECT<x: DECIMAL(3,1)>, y: ARRAY<VARIANT>>") == (
        "STRUCT<`a: VOID`: STRING, `OBJECT`: STRUCT<`x`: DOUBLE>, `y`: ARRAY<STRING>>")

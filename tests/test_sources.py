import gzip
import json

import pytest
from conftest import rows

from harrow import sources as src
from harrow.sources.readers import jdbc_options

TRIPS = """base_number,date,vehicles,trips
B1,1/1/2015,190,1132
B2,1/1/2015,225,1765
B1,2/1/2015,200,15001
"""


def write(path, text):
    path.write_text(text)
    return str(path)


def test_lines_and_content_filter(spark, tmp_path):
    path = write(tmp_path / "trips.csv", TRIPS)
    lines = src.read_lines(spark, path)
    assert lines.count() == 4
    # The header value counts as one more base when the header line is kept.
    fields = src.split_lines(lines)
    assert fields.selectExpr("fields[0] f").distinct().count() == 3
    assert src.split_lines(src.without_lines_containing(lines, "base")).count() == 3


def test_split_ignores_quotes_but_csv_does_not(spark, tmp_path):
    path = write(tmp_path / "quoted.csv", 'a,b\n"x,y",1\n')
    split = src.split_lines(src.read_lines(spark, path))
    assert [len(r.fields) for r in split.collect()] == [2, 3]
    assert rows(src.read_csv(spark, path)) == [("x,y", 1)]


def test_split_separator_is_no_pattern(spark):
    df = spark.createDataFrame([("a|b|c",)], "value string")
    assert src.split_lines(df, "|").first().fields == ["a", "b", "c"]


def test_gzip_lines_are_spread(spark, tmp_path):
    path = tmp_path / "r.dat.gz"
    with gzip.open(path, "wt") as f:
        f.write("\n".join(f"{i}::1::3::0" for i in range(100)))
    lines = src.read_compressed_lines(spark, str(path), 3)
    assert lines.count() == 100 and lines.rdd.getNumPartitions() == 3


def test_csv_inferred_and_declared(spark, tmp_path):
    path = write(tmp_path / "trips.csv", TRIPS)
    inferred = src.read_csv(spark, path)
    assert [t for _, t in inferred.dtypes] == ["string", "string", "int", "int"]
    declared = src.read_csv(spark, path, "base string, date string, vehicles int, trips bigint")
    assert declared.columns == ["base", "date", "vehicles", "trips"]
    assert declared.groupBy().sum("trips").first()[0] == 17898


def test_csv_reads_only_the_columns_used(spark, tmp_path):
    path = write(tmp_path / "trips.csv", TRIPS)
    plan = src.read_csv(spark, path, "base string, date string, vehicles int, trips int") \
        .groupBy("date").sum("trips")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<date:string,trips:int>" in plan


def test_long_separator(spark, tmp_path):
    path = write(tmp_path / "ratings.dat", "12::340::2::77\n8::41::3.5::78\n")
    df = src.read_delimited(spark, path, "user int, item int, rating double, time long")
    assert rows(df, "user", "item", "rating") == [(8, 41, 3.5), (12, 340, 2.0)]


def test_json_lines(spark, tmp_path):
    path = write(tmp_path / "people.json", '{"name":"Ann"}\n{"name":"Bo","age":3}\n')
    df = src.read_json_lines(spark, path)
    assert df.columns == ["age", "name"] and rows(df, "name") == [("Ann",), ("Bo",)]


@pytest.mark.parametrize("strip, team", [(False, "South Korea"), (True, "SouthKorea")])
def test_json_document(spark, tmp_path, strip, team):
    players = [{"Team": "South Korea", "Full Name": "A B", "Club": {"In City": "x"}},
               {"Team": "Peru", "Full Name": "C", "Club": {"In City": "y"}}]
    path = write(tmp_path / "players.json", json.dumps(players, indent=2))
    df = src.read_json_document(spark, path, strip_whitespace=strip)
    assert rows(df.select("Team").distinct()) == [("Peru",), (team,)]
    assert ("FullName" in df.columns) == strip


def test_json_document_with_one_object(spark, tmp_path):
    path = write(tmp_path / "one.json", '{\n "a": 1\n}')
    assert rows(src.read_json_document(spark, path, strip_whitespace=True)) == [(1,)]


def test_jdbc_options():
    options = jdbc_options("jdbc:x://h/d", "trips", "a.B", "u", "p", "id", 0, 100, 4)
    assert options == {"url": "jdbc:x://h/d", "dbtable": "trips", "driver": "a.B", "user": "u",
                       "password": "p", "partitionColumn": "id", "lowerBound": "0",
                       "upperBound": "100", "numPartitions": "4"}
    assert jdbc_options("u", "t") == {"url": "u", "dbtable": "t"}
    with pytest.raises(ValueError):
        jdbc_options("u", "t", partition_column="id")


def test_stop_words_views_schema_and_writer(spark, tmp_path):
    stop = src.read_stop_words(spark, write(tmp_path / "stop.txt", "a\nthe\na\n"))
    assert rows(stop) == [("a",), ("the",)]
    df = src.literal_table(spark, [(2012, "F", "ASIAN", "EVA", 7)],
                           "year int, sex string, ethnicity string, name string, count int")
    src.register_views({"babies": df})
    assert spark.sql("select name from babies").first().name == "EVA"
    assert rows(src.schema_table(df))[0] == (0, "year", "int", True)
    out = str(tmp_path / "out")
    src.write_csv(df, out, ["year", "name", "ethnicity", "sex", "count"])
    assert [r.value for r in spark.read.text(out).collect()] == ["2012,EVA,ASIAN,F,7"]


def test_text_dates(spark):
    df = spark.createDataFrame([("1/2/2015",), ("12/31/2015",), ("2/30/2015",), ("x",), (None,)],
                               "day string")
    got = [str(r[0]) for r in df.select(src.text_date("day")).collect()]
    assert got == ["2015-01-02", "2015-12-31", "None", "None", "None"]

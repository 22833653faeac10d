import json

import pytest

from brightloom.plans import table_jobs
from brightloom.sources import readers, writers
from brightloom import workspace
from brightloom.workspace import fresh_path, written


def test_delimited_inference_and_schema(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text("a\tb\tc\n1\t\tx\n2\tNaN\t\n3\t1.5\ty\n")
    inferred = readers.read_delimited(spark, str(path))
    assert dict(inferred.dtypes) == {"a": "int", "b": "double", "c": "string"}
    rows = inferred.collect()
    assert rows[0]["b"] is None and rows[1]["b"] != rows[1]["b"] and rows[1]["c"] is None
    typed = readers.read_delimited(spark, str(path), "a double, b double, c string")
    assert dict(typed.dtypes)["a"] == "double" and typed.count() == 3


def test_latin1_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes('Sentiment,SentimentText\n1,"say ""été""\nagain"\n0,plain\n'.encode("latin-1"))
    rows = readers.read_latin1_csv(spark, str(path), "Sentiment int, SentimentText string").collect()
    assert [tuple(r) for r in rows] == [(1, 'say "été"\nagain'), (0, "plain")]


def test_missing_file(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_lines(spark, str(tmp_path / "none")).count()


def test_test_case_files(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)

    put("a.json", json.dumps({"X": [{"10": "ten", "9": "nine"}], "y": [{"9": 1, "10": 0}]}, indent=2))
    put("b.json", json.dumps({"X": [{"0": "zero"}], "y": [{"0": 1}]}))
    put("c.json", json.dumps({"X": [{"0": "no labels"}]}))
    put("d.json", json.dumps({"X": [], "y": [{"0": 1}]}))
    put("e.json", '{"X": [{"0": "cut')
    cases = readers.in_key_order(readers.read_test_cases(spark, str(tmp_path)))
    assert [tuple(r) for r in cases.collect()] == [
        ("a.json", 9, "nine", 1), ("a.json", 10, "ten", 0), ("b.json", 0, "zero", 1)
    ]


def test_word_count_job(spark, tmp_path):
    (tmp_path / "in.txt").write_text("Hail rain hail\nsun\n")
    target = str(tmp_path / "out")
    counts = table_jobs.count_words_in_files(spark, str(tmp_path / "in.txt"), target)
    expected = [("Hail", 1), ("hail", 1), ("rain", 1), ("sun", 1)]
    assert [tuple(r) for r in counts.collect()] == expected
    assert sorted(tuple(r) for r in readers.read_delimited(spark, target, sep=",").collect()) == expected


def test_csv_without_header(spark, tmp_path):
    target = str(tmp_path / "out")
    writers.write_csv(spark.range(1), target, header=False)
    assert spark.read.csv(target).collect()[0][0] == "0"


def test_saved_split_prunes(spark):
    path = fresh_path(spark, "split")
    df = spark.createDataFrame([(1, "train"), (2, "test")], "id int, split string")
    writers.write_split(df, path)
    train = readers.read_split(spark, path, "train")
    assert [tuple(r) for r in train.collect()] == [(1,)]
    assert "PartitionFilters: [isnotnull(split" in train._jdf.queryExecution().executedPlan().toString()


def test_workspace(spark):
    assert fresh_path(spark, "a") != fresh_path(spark, "a")
    assert fresh_path(spark, "a").startswith(workspace.shared_folder(spark))
    df = spark.createDataFrame([(1, "x", 2)], "a int, p string, b int")
    assert written(df, "t", by=["p"]).select("a", "p", "b").collect() == df.collect()

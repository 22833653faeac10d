"""Sketches with proofs, the exact split and the evaluation of test-case files."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from brightloom.operators import features, sketches
from brightloom.operators.splits import TEST, exact_train_test_split, split_hash
from brightloom.plans import text_jobs as J
from brightloom.sources.readers import read_case_documents
from brightloom.workspace import fresh_path

COLUMNS = ["a", "b"]


# quantile sketches


def numbers(spark, first, last):
    return spark.range(first, last).select(
        ((F.col("id") * 7919) % 10_007).cast("double").alias("a"),
        F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 50 == 0, float("nan")).otherwise(F.lit(5.0))).alias("b"),
        F.lit(None).cast("int").alias("c"),
    )


def test_only_new_files_are_sketched(spark):
    source, path, columns = fresh_path(spark, "numbers"), fresh_path(spark, "sketches"), ["a", "b", "c"]
    for part in range(3):
        numbers(spark, part * 20_000, (part + 1) * 20_000).coalesce(1).write.mode("append").parquet(source)
        table = sketches.with_file(spark.read.parquet(source))
        stored = sketches.store_sketches(spark, table, columns, path)
        assert stored.count() == part + 1 and stored.agg(F.sum("n")).first()[0] == (part + 1) * 20_000
    sketches.store_sketches(spark, table, columns, path)
    assert stored.count() == 3
    medians = sketches.sketched_medians(stored, columns)
    assert medians["b"] == 5.0 and medians["c"] is None
    found = {r["column"]: (r["n"], r["within"]) for r in sketches.rank_check(spark.read.parquet(source), medians, 0.02).collect()}
    assert found["a"] == (60_000, True) and found["b"][1] is True and found["c"] == (0, None)


def test_a_rank_that_is_off_is_seen(spark):
    df = numbers(spark, 0, 10_000)
    checked = {r["column"]: r["within"] for r in sketches.rank_check(df, {"a": 100.0, "b": 4.9}, 0.01).collect()}
    assert checked == {"a": False, "b": False}
    assert sketches.rank_error(800) < 0.006


# the certified vocabulary


def tokenised(spark, texts):
    return spark.createDataFrame([(t.split(),) for t in texts], "tokens array<string>")


def both(spark, texts, n, **settings):
    given = tokenised(spark, texts)
    return [
        [tuple(r) for r in found.collect()]
        for found in (features.certified_vocabulary(given, n, ["the"], **settings), features.vocabulary(given, n, ["the"]))
    ]


def skewed(count, distinct, seed=1):
    draw = random.Random(seed)
    words = [f"w{int(distinct ** draw.random())}" for _ in range(count)]
    return [" ".join(["the", *words[at : at + 50]]) for at in range(0, count, 50)]


@pytest.mark.parametrize("n, tracked", [(5, 1000), (20, 1000), (400, 200), (10, 50), (5000, 10_000)])
def test_the_same_terms_certified_or_not(spark, n, tracked):
    certified, full = both(spark, skewed(20_000, 3_000), n, tracked=tracked)
    assert certified == full


def test_when_a_certificate_is_given(spark, monkeypatch):
    asked = []
    whole = features.vocabulary
    monkeypatch.setattr(features, "vocabulary", lambda *a: asked.append(a) or whole(*a))
    given = tokenised(spark, skewed(20_000, 3_000))
    features.certified_vocabulary(given, 5, (), tracked=1000)
    assert not asked
    features.certified_vocabulary(given, 2_000, (), tracked=10_000)  # all terms were counted
    assert not asked
    features.certified_vocabulary(given, 400, (), tracked=500)
    assert asked


def test_a_vocabulary_of_nothing(spark):
    assert both(spark, ["the the", ""], 5) == [[], []]


# the exact split


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 777, 2_000])
@pytest.mark.parametrize("few", [1, 100_000])
def test_exactly_a_fifth_rounded_up(spark, n, few):
    df = spark.range(n).withColumnRenamed("id", "a key")
    split = exact_train_test_split(df.withColumn("hash", F.lit(1)), "a key", few_rows=few).collect()
    test = [r["a key"] for r in split if r["split"] == TEST]
    assert len(split) == n and len(test) == math.ceil(0.2 * n)
    order = [r["id"] for r in spark.range(n).orderBy(split_hash(F.col("id")), "id").collect()]
    assert set(test) == set(order[: len(test)])


def test_a_split_of_repeated_and_null_keys(spark):
    df = spark.createDataFrame([(k,) for k in ["a"] * 30 + ["b"] * 5 + [None] * 5], "k string")
    sides = {}
    for r in exact_train_test_split(df, "k", 20, few_rows=1).collect():
        sides.setdefault(r["k"], set()).add(r["split"])
    assert all(len(s) == 1 for s in sides.values())
    assert exact_train_test_split(df, "k", 0).where("split = 'test'").count() == 0
    assert exact_train_test_split(df, "k", 100, few_rows=1).where("split = 'train'").count() == 0


# test cases


CASES = {
    "good": {"X": [{"10": "a", "9": "b"}], "y": [{"9": 1, "10": 0}]},
    "named": {"name": "x", "X": [{"1": "a"}, {"2": "ignored"}], "y": [{"1": 1}], "more": {"z": [1]}},
    "null text": {"X": [{"1": None}], "y": [{"1": 1}]},
    "no X": {"y": [{"1": 1}]},
    "empty X": {"X": [], "y": [{"1": 1}]},
    "X without messages": {"X": [{}], "y": [{"1": 1}]},
    "X of another kind": {"X": "text", "y": [{"1": 1}]},
    "no y": {"X": [{"1": "a"}], "y": None},
    "keys": {"X": [{"1": "a", "2": "b"}], "y": [{"1": 1}]},
    "key": {"X": [{"one": "a"}], "y": [{"one": 1}]},
    "label": {"X": [{"1": "a"}], "y": [{"1": "good"}]},
    "null label": {"X": [{"1": "a"}], "y": [{"1": None}]},
}


def test_case_documents(spark, tmp_path):
    for name, content in CASES.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(content, indent=1))
    (tmp_path / "broken.json").write_text('{"X": [{"1": "a"}], ')
    (tmp_path / "repeated.json").write_text('{"X": [{"1": "a", "1": "b"}], "y": [{"1": 1}]}')
    (tmp_path / "blank.json").write_text("\n")
    messages, rejects = read_case_documents(spark, str(tmp_path))

    def name(row):
        return row["file"].rsplit("/", 1)[1].removesuffix(".json").replace("%20", " ")

    kept = sorted((name(r), r["id"], r["text"], r["label"]) for r in messages.collect())
    assert kept == [("good", 9, "b", 1), ("good", 10, "a", 0), ("named", 1, "a", 1), ("null text", 1, None, 1)]
    assert {name(r): r["reason"] for r in rejects.collect()} == {
        "no X": "no X",
        "empty X": "no X",
        "X without messages": "no X",
        "X of another kind": "no X",
        "no y": "no y",
        "keys": "other keys in X than in y",
        "key": "a key that is no whole number",
        "label": "a label that is no whole number",
        "null label": "a label that is no whole number",
        "broken": "no valid JSON",
        "repeated": "no valid JSON",
        "blank": "no valid JSON",
    }


def test_a_fitted_classifier_on_case_files(spark, tmp_path):
    rows = [(i, f"good nice lovely {i}" if i % 2 else f"bad awful ugly {i}", i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, text string, label int")
    model = J.train(J.prepare(df, "id", "text", "label"), "label")
    for k in range(3):
        content = {"X": [{"1": "good and lovely", "2": "ugly", "3": "nice"}], "y": [{"1": 1, "2": 0, "3": int(k > 0)}]}
        (tmp_path / f"{k}.json").write_text(json.dumps(content))
    messages, rejects = read_case_documents(spark, str(tmp_path))
    scored = J.score_messages(messages, "text", model)
    hits = {r["file"][-6]: r["hits"] for r in scored.groupBy("file").agg(F.sum((F.col("label") == F.col("prediction")).cast("int")).alias("hits")).collect()}
    assert hits == {"0": 2, "1": 3, "2": 3} and rejects.count() == 0

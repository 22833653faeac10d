import pytest

from brightloom.functions.payloads import decode_label, encode_label
from brightloom.operators import metrics as M
from pyspark.sql import functions as F


def outcomes(spark, pairs):
    return spark.createDataFrame(pairs, "label int, prediction int")


def report(spark, pairs):
    rows = M.classification_report(outcomes(spark, pairs)).collect()
    return {r["class"]: tuple(None if v is None else round(v, 2) for v in r[1:]) for r in rows}


def test_report_with_a_false_positive(spark):
    assert report(spark, [(0, 0), (0, 0), (0, 1), (1, 1)]) == {
        "0": (1.0, 0.67, 0.8, 3),
        "1": (0.5, 1.0, 0.67, 1),
        "accuracy": (None, None, 0.75, 4),
        "macro avg": (0.75, 0.83, 0.73, 4),
        "weighted avg": (0.88, 0.75, 0.77, 4),
    }


def test_report_with_a_false_negative(spark):
    assert report(spark, [(1, 1), (0, 0), (0, 0), (1, 0)]) == {
        "0": (0.67, 1.0, 0.8, 2),
        "1": (1.0, 0.5, 0.67, 2),
        "accuracy": (None, None, 0.75, 4),
        "macro avg": (0.83, 0.75, 0.73, 4),
        "weighted avg": (0.83, 0.75, 0.73, 4),
    }


def test_report_of_a_class_never_predicted(spark):
    rows = report(spark, [(0, 1), (1, 1)])
    assert rows["0"] == (0.0, 0.0, 0.0, 1)
    assert rows["macro avg"] == (0.25, 0.5, 0.33, 2)


def test_report_text_orders_classes_first(spark):
    text = M.report_text(M.classification_report(outcomes(spark, [(0, 0), (1, 1)]))).first()["report"]
    assert [line.split(":")[0] for line in text.split("\n")] == ["0", "1", "accuracy", "macro avg", "weighted avg"]


def test_confusion_matrix_shows_zeros(spark):
    rows = M.confusion_matrix(outcomes(spark, [(0, 0), (0, 1), (2, 0)]), [0, 1, 2]).collect()
    assert [tuple(r) for r in rows] == [(0, 1, 1, 0), (1, 0, 0, 0), (2, 1, 0, 0)]


def test_accuracy_by_group(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 0), ("b", 0, 0)], "file string, label int, prediction int")
    assert {r["file"]: (r["rows"], r["accuracy"]) for r in M.accuracy_by(df, "file").collect()} == {
        "a": (2, 0.5), "b": (1, 1.0)
    }
    assert M.accuracy(df).first()["accuracy"] == pytest.approx(2 / 3)


def test_label_counts_are_ordered(spark):
    assert [tuple(r) for r in M.label_counts(outcomes(spark, [(0, 0), (1, 0), (1, 1)]), "label").collect()] == [
        (1, 2), (0, 1)
    ]


def test_label_texts(spark):
    df = spark.createDataFrame([(1,), (0,), (42,), (None,)], "label int")
    texts = df.select(decode_label(F.col("label")).alias("t"))
    assert [r[0].split()[0] for r in texts.collect()] == ["Positive", "Negative", "Unknown", "Unknown"]
    assert [r[0] for r in texts.select(encode_label(F.col("t"))).collect()] == [1, 0, 0, 0]


def test_a_missing_prediction_is_wrong(spark):
    df = outcomes(spark, [(1, 1), (1, None), (None, 1)])
    assert M.accuracy(df).first()["accuracy"] == 0.5
    assert report(spark, [(1, 1), (1, None)])["accuracy"] == (None, None, 0.5, 2)


def test_a_class_named_like_a_summary(spark):
    pairs = [("accuracy", "accuracy"), ("b", "accuracy"), ("b", "b"), ("accuracy", "b")]
    rows = M.classification_report(spark.createDataFrame(pairs, "label string, prediction string")).collect()
    assert sorted((r["class"], r["f1"], r["support"]) for r in rows if r["class"] == "accuracy") == [
        ("accuracy", 0.5, 2), ("accuracy", 0.5, 4)
    ]


def test_confusion_matrix_takes_what_it_sees(spark):
    rows = M.confusion_matrix(outcomes(spark, [(0, 0), (0, 7), (2, 0)])).collect()
    assert [tuple(r) for r in rows] == [(0, 1, 0, 1), (2, 1, 0, 0), (7, 0, 0, 0)]

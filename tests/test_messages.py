import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from brightloom.functions import payloads as P
from brightloom.operators import predictions as R
from brightloom.operators.records import parse_records
from brightloom.workspace import fresh_path


def parsed(spark, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    return [tuple(r)[2:] for r in parse_records(df).orderBy("i").collect()]


@pytest.mark.parametrize(
    "value, message, prediction",
    [
        ('{"message": "hi", "prediction": {"label": "ok"}}', "hi", '{"label":"ok"}'),
        ('{"sentiment": "Positive"}', '{"sentiment": "Positive"}', "Positive"),
        ('"bare text"', "bare text", "bare text"),
        ("17", "17", "17"),
        ("true", "true", "true"),
        ('{"message": "", "prediction": 0, "sentiment": "s"}', '{"message": "", "prediction": 0, "sentiment": "s"}', "s"),
        ('{"message": "0", "prediction": "false"}', "0", "false"),
        ('{"message": 0.5, "prediction": -0.0, "sentiment": []}', "0.5", '{"message": 0.5, "prediction": -0.0, "sentiment": []}'),
        ('{"message": null, "prediction": {}, "sentiment": false}',) + ('{"message": null, "prediction": {}, "sentiment": false}',) * 2,
        (' \n{"message": "a", "prediction": [1]}', "a", "[1]"),
    ],
)
def test_fallbacks(spark, value, message, prediction):
    assert parsed(spark, value)[0][:3] == ("stored", message, prediction)


def test_broken_records_and_times(spark):
    assert parsed(spark, "{broken", '{"message":"m","prediction":"p","timestamp":1.25}', None) == [
        ("broken", None, None, None), ("stored", "m", "p", 1.25), ("broken", None, None, None)
    ]


def test_encode_payload(spark):
    seconds = P.epoch_seconds_utc(F.lit("2024-03-01 10:20:30.5").cast("timestamp_ntz"))
    text = spark.range(1).select(P.encode_payload(F.lit('say "é"'), F.lit("p"), seconds)).first()[0]
    assert text.endswith('"timestamp":1709288430.500000}')
    assert json.loads(text) == {"message": 'say "é"', "prediction": "p", "timestamp": 1709288430.5}


def test_epoch_seconds_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        instant = F.lit("2024-03-01 10:20:30.5+00:00").cast("timestamp")
        local = F.lit("2024-03-01 10:20:30.5").cast("timestamp_ntz")
        row = spark.range(1).select(P.epoch_seconds(instant), P.epoch_seconds_utc(local)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [float(v) for v in row] == [1709288430.5, 1709288430.5]


def test_times_as_text(spark):
    ts = F.lit("2024-03-01 10:20:30").cast("timestamp")
    assert tuple(spark.range(1).select(P.iso_text(ts), P.run_id(ts)).first()) == ("2024-03-01T10:20:30", "20240301_102030")


@pytest.fixture
def predictions(spark):
    rows = [(i, dt.datetime(2024, 1, 1 + i // 3), f"m{i}", "p") for i in range(30)] + [(99, None, "late", "p")]
    return spark.createDataFrame(rows, "id int, timestamp timestamp, message string, prediction string")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_newest(predictions, kind):
    typed = predictions.withColumn("timestamp", F.col("timestamp").cast(kind))
    assert [r["id"] for r in R.newest(typed, 5, tie="id").collect()] == [29, 28, 27, 26, 25]
    assert R.newest(typed, 0).count() == 0
    everything = [r["id"] for r in R.newest(typed, 100, tie="id").collect()]
    assert everything == [*range(29, -1, -1), 99]


def test_newest_skips_row_groups(spark, predictions):
    path = fresh_path(spark, "predictions")
    predictions.write.parquet(path)
    plan = R.newest(spark.read.parquet(path), 3)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan and "TakeOrderedAndProject" in plan


def test_table(spark, predictions):
    path = fresh_path(spark, "table")
    for _ in range(2):
        R.create_table(spark, "kept_predictions", path)
    R.append(predictions, "kept_predictions")
    R.append(spark.createDataFrame([("now", "p")], "message string, prediction string"), "kept_predictions")
    stored = spark.table("kept_predictions")
    assert stored.count() == 32
    stamp = stored.where("message = 'now'").first()["timestamp"]
    assert stamp is not None
    latest = R.responses(R.newest(stored, 2)).collect()
    assert latest[0]["message"] == "now" and latest[1]["timestamp"] == "2024-01-10T00:00:00"
    assert R.query(stored, "SELECT count(*) AS n FROM predictions WHERE message = 'm1'").first()["n"] == 1
    spark.sql("DROP TABLE kept_predictions")


def test_rejects(spark):
    df = spark.createDataFrame([("a",), ("",), (None,), (" ",)], "message string")
    good, bad = R.split_rejects(df)
    assert [r[0] for r in good.collect()] == ["a", " "]
    assert [tuple(r) for r in bad.collect()] == [("", "no text to score"), (None, "no text to score")]

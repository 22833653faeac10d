import json
import time

import pytest
from pyspark.sql import functions as F

from conftest import SMALL

from brightloom.operators.records import parse_records
from brightloom.plans.catalogue import QUERIES
from brightloom.sources import writers
from brightloom.streaming import ingest as S
from brightloom.workspace import fresh_path


def arrive(spark, folder, *lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(folder)


def run(spark, source, target):
    stream = parse_records(S.line_stream(spark, source, max_files=1))
    S.finish(S.store(stream, target, f"{target}-checkpoint", available_now=True))


def test_bad_records_do_not_stop_the_stream(spark):
    source, target = fresh_path(spark, "in"), fresh_path(spark, "out")
    arrive(spark, source, '{"message":"a","prediction":"p"}', "{bad", '"b"')
    run(spark, source, target)
    assert sorted(tuple(r) for r in S.stored(spark, target).select("message", "prediction").collect()) == [
        ("a", "p"), ("b", "b")
    ]
    assert [r["value"] for r in S.dead_letters(spark, target).collect()] == ["{bad"]


def test_restart_reads_only_what_is_new(spark):
    source, target = fresh_path(spark, "in"), fresh_path(spark, "out")
    for line in ("1", "2", None):
        if line:
            arrive(spark, source, line)
        run(spark, source, target)
    assert sorted(r["message"] for r in S.stored(spark, target).collect()) == ["1", "2"]


def test_crash_after_the_write_leaves_no_duplicates(spark):
    source, target = fresh_path(spark, "in"), fresh_path(spark, "out")
    arrive(spark, source, "1", "2")
    arrive(spark, source, "3", "4")
    keep, crashes = S.batch_folder_writer(target), []

    def fails_once(batch, batch_id):
        keep(batch, batch_id)
        if batch_id == 1 and not crashes:
            crashes.append(batch_id)
            raise RuntimeError("lost after writing")

    def attempt():
        stream = parse_records(S.line_stream(spark, source, max_files=1))
        S.finish(S.for_each_batch(stream, fails_once, f"{target}-checkpoint", available_now=True))

    with pytest.raises(Exception, match="lost after writing"):
        attempt()
    attempt()
    rows = spark.read.parquet(target)
    assert crashes == [1]
    assert sorted(r["message"] for r in rows.collect()) == ["1", "2", "3", "4"]


def test_prediction_records(spark):
    scored = spark.createDataFrame([("m", "p")], "message string, prediction string")
    record = S.prediction_records(scored, "message").first()
    assert record["key"] is None
    payload = json.loads(record["value"])
    assert (payload["message"], payload["prediction"]) == ("m", "p")
    assert abs(payload["timestamp"] - time.time()) < 600


def test_topic_records(spark):
    df = spark.createDataFrame([("k", "m")], "key string, message string")
    encoded = writers.topic_records(df, F.to_json(F.struct("message")), F.col("key"))
    assert [tuple(r) for r in encoded.collect()] == [("k", '{"message":"m"}')]
    assert writers.topic_records(df, F.col("message")).first()["key"] is None
    options = writers._topic_options("host:1", "t")
    assert options["kafka.acks"] == "all" and options["topic"] == "t"


@pytest.mark.parametrize("rows", [None, 0])
def test_streams_over_folders_of_parts_and_empty_ones(spark, tmp_path, rows):
    for name in ("events", "conversations", "documents", "labels"):
        table = spark.read.parquet(f"{SMALL}/{name}.parquet")
        if name in ("events", "conversations") and rows is not None:
            table = table.limit(rows).coalesce(1)
        else:
            table = table.repartition(3)
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    for name in ("stream_parse_payload", "stream_dead_letters", "stream_score_messages", "stream_message_rejects"):
        found = QUERIES[name].run(spark, str(tmp_path))
        expected = 0 if rows == 0 else QUERIES[name].run(spark, SMALL).count()
        assert found.count() == expected

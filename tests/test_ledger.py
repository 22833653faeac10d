"""The stream into the predictions table: crashes at every point, offsets, newest rows, stopping."""

import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from brightloom.operators.predictions import newest
from brightloom.plans.catalogue import QUERIES
from brightloom.sources.readers import topic_columns
from brightloom.streaming import ingest as S
from brightloom.streaming.control import CommitLog, StopMarker, run_until_stopped, stoppable
from brightloom.streaming.ledger import TableSink
from brightloom.workspace import fresh_path

from conftest import SMALL

SCHEMA = "message string, prediction string, timestamp timestamp"


def at(day, second=0):
    return datetime.datetime(2024, 1, day, 12, 0, second)


def sink_of(spark, root=None, **settings):
    root = root or fresh_path(spark, "sink")
    return TableSink(spark, f"t_{uuid.uuid4().hex}", root, "q", **settings)


def stored(sink):
    return sorted(r["message"] for r in sink.rows().collect())


def test_staged_rows_do_not_show_until_they_count(spark):
    seen = []
    sink = sink_of(spark, staged=lambda n: seen.append(stored(sink)))
    sink.write(spark.createDataFrame([("a", "p", at(1)), ("b", "p", at(2))], SCHEMA), 0)
    assert seen == [[]] and stored(sink) == ["a", "b"]
    sink.write(spark.createDataFrame([("other", "p", at(1))], SCHEMA), 0)  # a replay of what counts already
    assert stored(sink) == ["a", "b"]


def test_a_lost_attempt_leaves_nothing_behind(spark):
    def lost(batch):
        raise RuntimeError("lost")

    sink = sink_of(spark, staged=lost)
    with pytest.raises(RuntimeError, match="lost"):
        sink.write(spark.createDataFrame([("a", "p", at(1)), ("b", "p", at(2))], SCHEMA), 0)
    sink.staged = lambda batch: None
    # the days differ, as they do when rows are timed by a later attempt
    sink.write(spark.createDataFrame([("a", "p", at(5)), ("b", "p", at(6))], SCHEMA), 0)
    assert stored(sink) == ["a", "b"]
    assert {r["day"].day for r in spark.table(sink.table).select("day").collect()} == {5, 6}
    assert spark.read.parquet(f"{sink.root}/loads/q/0").count() == 2


def test_a_commit_before_it_was_published(spark):
    sink = sink_of(spark)
    sink._publish = lambda *parts: None
    sink.write(spark.createDataFrame([("a", "p", at(1))], SCHEMA), 0)
    assert stored(sink) == []
    del sink._publish
    sink.write(spark.createDataFrame([("a", "p", at(1))], SCHEMA), 0)
    assert stored(sink) == ["a"]


def test_rows_without_a_time_and_batches_without_rows(spark):
    sink = sink_of(spark)
    sink.write(spark.createDataFrame([], SCHEMA), 0)
    assert stored(sink) == [] and sink.newest(3).collect() == []
    sink.write(spark.createDataFrame([("a", "p", None), (None, None, at(1))], SCHEMA), 1)
    sink.write(spark.createDataFrame([("b", "p")], "message string, prediction string"), 2)
    rows = sink.rows().collect()
    assert len(rows) == 3 and all(r["timestamp"] is not None for r in rows)
    assert [r["batch"] for r in sink.entries().orderBy("batch").collect()] == [0, 1, 2]


def test_newest_opens_only_the_days_it_needs(spark):
    sink = sink_of(spark)
    for batch, days in enumerate(([1, 2, 3], [3, 4], [2, 5])):
        rows = [(f"{batch}-{d}-{k}", "p", at(d, k)) for d in days for k in range(4)]
        sink.write(spark.createDataFrame(rows, SCHEMA), batch)
    everything = sink.rows().select("timestamp", "message", "prediction")
    for n in (1, 4, 5, 13, 100):
        expected = newest(everything, n, tie="message").collect()
        assert sink.newest(n, tie="message").collect() == expected and len(expected) == min(n, 28)
    opened = {f.split("day=")[1][:10] for f in sink.newest(5).inputFiles()}
    assert opened == {"2024-01-04", "2024-01-05"}


OFFSETS = "topic string, partition int, offset long, message string, prediction string"


def records(spark, *places):
    return spark.createDataFrame([(t, p, o, f"{t}{p}{o}", "x") for t, p, o in places], OFFSETS)


def test_offsets_are_stored_once(spark):
    sink = sink_of(spark, by_offset=True)
    sink.write(records(spark, ("a", 0, 0), ("a", 0, 1), ("a", 0, 1), ("a", 1, 7), ("b", 0, 3)), 0)
    assert sink.marks() == {("a", 0): 1, ("a", 1): 7, ("b", 0): 3}
    # another process, which knows the ledger alone
    again = sink_of(spark, sink.root, by_offset=True)
    assert again.marks() == sink.marks()
    again.write(records(spark, ("a", 0, 1), ("a", 0, 2), ("a", 1, 5), ("c", 9, 0), ("b", 0, 3)), 1)
    assert again.marks() == {("a", 0): 2, ("a", 1): 7, ("b", 0): 3, ("c", 9): 0}
    again.restore()
    assert stored(again) == ["a00", "a01", "a02", "a17", "b03", "c90"]


def test_marks_move_with_the_commit(spark):
    def lost(batch):
        raise RuntimeError("lost")

    sink = sink_of(spark, by_offset=True, staged=lost)
    with pytest.raises(RuntimeError):
        sink.write(records(spark, ("a", 0, 0), ("a", 0, 1)), 0)
    assert sink.marks() == {}
    sink.staged = lambda batch: None
    sink.write(records(spark, ("a", 0, 0), ("a", 0, 1)), 0)
    assert stored(sink) == ["a00", "a01"]
    with pytest.raises(Exception, match="not true|IS NOT NULL"):
        sink.write(records(spark, ("a", None, 4)), 1)


def test_topic_columns(spark):
    row = (bytearray(b"k"), bytearray(b"v"), "t", 1, 2, at(1), 0)
    given = spark.createDataFrame(
        [row], "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int"
    )
    assert tuple(topic_columns(given).first()) == ("k", "v", "t", 1, 2, at(1))


def arrive(spark, folder, *lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(folder)


def test_stop_between_batches(spark):
    source, seen = fresh_path(spark, "in"), []
    for k in range(4):
        arrive(spark, source, f"m{k}")
    marker, target = StopMarker(spark, fresh_path(spark, "stop")), fresh_path(spark, "out")

    def write(batch, number):
        seen.append((number, [r["value"] for r in batch.collect()]))
        if number == 1:
            marker.set()

    def run():
        stream = S.line_stream(spark, source, max_files=1)
        return run_until_stopped(S.for_each_batch(stream, stoppable(write, marker), f"{target}-c", available_now=True), marker)

    log = CommitLog()
    spark.streams.addListener(log)
    try:
        assert run() is True
        assert seen == [(0, ["m0"]), (1, ["m1"])]
        assert run() is True and len(seen) == 2  # still asked to stop
        marker.clear()
        assert run() is False
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    finally:
        spark.streams.removeListener(log)
    assert seen == [(k, [f"m{k}"]) for k in range(4)]
    assert list(log.last.values()) == [3] and list(log.rows.values()) == [4]
    assert list(log.ended.values()) == [None]


def test_an_idle_stream_stops_too(spark):
    source = fresh_path(spark, "in")
    arrive(spark, source, "a")
    marker = StopMarker(spark, fresh_path(spark, "stop"))
    marker.set()
    marker.clear()
    assert not marker.is_set()
    write = stoppable(lambda batch, number: marker.set(), marker)
    query = S.for_each_batch(S.line_stream(spark, source), write, fresh_path(spark, "c"))
    assert run_until_stopped(query, marker, poll_seconds=0.5) is True
    assert not query.isActive


def test_another_failure_is_raised(spark):
    source = fresh_path(spark, "in")
    arrive(spark, source, "a")

    def write(batch, number):
        raise ValueError("broken writer")

    marker = StopMarker(spark, fresh_path(spark, "stop"))
    query = S.for_each_batch(S.line_stream(spark, source), stoppable(write, marker), fresh_path(spark, "c"), available_now=True)
    with pytest.raises(Exception, match="broken writer"):
        run_until_stopped(query, marker)


def test_streams_of_no_events(spark, tmp_path):
    spark.read.parquet(f"{SMALL}/events.parquet").limit(0).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    assert QUERIES["stream_offset_dedup"].run(spark, str(tmp_path)).count() == 0

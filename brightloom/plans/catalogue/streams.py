"""Streams over the given tables, run to the end of what is available."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.operators.predictions import responses
from brightloom.operators.records import parse_records
from brightloom.plans.catalogue import messages as M
from brightloom.plans.catalogue.registry import Register, table
from brightloom.plans.catalogue.sentiment import SQL_SCORED, by_lang, fitted, prepared
from brightloom.sources.writers import write_lines
from brightloom.streaming import ingest as S
from brightloom.streaming.control import StopMarker, run_until_stopped, stoppable
from brightloom.streaming.ledger import TableSink
from brightloom.workspace import fresh_path

register = Register()


def table_stream(spark, folder, name) -> DataFrame:
    """A given table as a stream of its files, be it one file or a folder of them."""
    schema = table(spark, folder, name).schema
    # a pattern, since a stream takes no path of a single file
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")


def run_to_end(records: DataFrame, name: str) -> str:
    """Store all that is available and return where."""
    target = fresh_path(records.sparkSession, name)
    S.finish(S.store(records, target, f"{target}-checkpoint", available_now=True))
    return target


FIELDS = ("message", "prediction", "event_seconds")


@register.query(f"SELECT value, status, message, prediction, event_seconds FROM ({M.SQL_PARSED})")
def stream_parse_payload(spark, folder):
    stream = table_stream(spark, folder, "events").select(F.expr(M.RECORD_RULE).alias("value"))
    target = run_to_end(parse_records(stream), "parsed")
    return S.of_sink(spark, target, S.STORED_SCHEMA).select("value", "status", *FIELDS)


@register.query(f"SELECT message, prediction, event_seconds FROM ({M.SQL_PARSED}) WHERE status = 'stored'")
def stream_to_table(spark, folder):
    """From a folder of text files, one record per line."""
    source = fresh_path(spark, "records")
    write_lines(M.records(spark, folder).select("value"), source)
    target = run_to_end(parse_records(S.line_stream(spark, source)), "predictions")
    return S.stored(spark, target).select(*FIELDS)


@register.query(f"SELECT value FROM ({M.SQL_PARSED}) WHERE status = 'broken'")
def stream_dead_letters(spark, folder):
    stream = table_stream(spark, folder, "events").select(F.expr(M.RECORD_RULE).alias("value"))
    return S.dead_letters(spark, run_to_end(parse_records(stream), "records")).select("value")


@register.query(f"SELECT message, prediction, event_seconds FROM ({M.SQL_PARSED}) WHERE status = 'stored'")
def stream_restart_no_dups(spark, folder):
    """Half of the files, a restart, the other half, a restart with nothing new."""
    source, target = fresh_path(spark, "records"), fresh_path(spark, "predictions")
    events = table(spark, folder, "events")
    cheap = F.coalesce(F.col("value") < 8, F.lit(False))
    for arriving in (events.where(cheap), events.where(~cheap), None):
        if arriving is not None:
            arriving.select(F.expr(M.RECORD_RULE).alias("value")).write.mode("append").text(source)
        stream = parse_records(S.line_stream(spark, source))
        S.finish(S.store(stream, target, f"{target}-checkpoint", available_now=True))
    return S.stored(spark, target).select(*FIELDS)


@register.query(SQL_SCORED)
def stream_score_messages(spark, folder):
    model = fitted(prepared(by_lang(spark, folder)))
    stream = table_stream(spark, folder, "conversations").select("conv_id", "turn", "text")
    return scored_batches(spark, stream, model).where("reason IS NULL").select("conv_id", "turn", "prediction")


def scored_batches(spark, stream, model) -> DataFrame:
    scored = S.score_stream(stream, "text", model).select("conv_id", "turn", "prediction", "reason")
    target = fresh_path(spark, "scores")
    S.finish(
        S.for_each_batch(scored, S.batch_folder_writer(target), f"{target}-checkpoint", available_now=True)
    )
    return S.of_sink(spark, target, scored.schema)


#: Every fifth text is taken away and every seventh left empty.
MISSING = "CASE WHEN (conv_id + turn) % 5 = 0 THEN NULL WHEN (conv_id + turn) % 7 = 0 THEN '' ELSE text END"


@register.query(
    f"SELECT conv_id, turn, 'no text to score' AS reason FROM conversations WHERE coalesce({MISSING}, '') = ''"
)
def stream_message_rejects(spark, folder):
    """Messages that cannot be scored, with the reason, from the pass that scores the others."""
    model = fitted(prepared(by_lang(spark, folder)))
    stream = table_stream(spark, folder, "conversations").select("conv_id", "turn", F.expr(MISSING).alias("text"))
    return scored_batches(spark, stream, model).where("reason IS NOT NULL").select("conv_id", "turn", "reason")


#: A record's message tells it apart, and its time is that of the event, in microseconds.
BROKEN_RECORD = "event_id % 10 = 0"
PLAIN_RECORD = """
    CASE WHEN event_id % 10 = 0 THEN '{broken'
    ELSE '{"message":"' || event_type || ' ' || CAST(event_id AS STRING) || '","prediction":"'
        || CAST(user_id AS STRING) || '","timestamp":' || CAST(unix_micros(CAST(ts AS TIMESTAMP)) AS STRING) || '}'
    END
"""
SQL_STORED = (
    "SELECT event_id, ts AS timestamp, event_type || ' ' || CAST(event_id AS VARCHAR) AS message,"
    f" CAST(user_id AS VARCHAR) AS prediction FROM events WHERE NOT ({BROKEN_RECORD})"
)
SQL_ISO = "strftime(timestamp, '%Y-%m-%dT%H:%M:%S') AS timestamp, message, prediction"


def arrivals(spark, folder, parts: int) -> str:
    """The events as lines of JSON that arrive in so many files, one after the other."""
    source = fresh_path(spark, "records")
    for part in range(parts):
        events = table(spark, folder, "events").where(F.col("event_id") % parts == part)
        events.select(F.expr(PLAIN_RECORD).alias("value")).coalesce(1).write.mode("append").text(source)
    return source


def timed(records: DataFrame) -> DataFrame:
    """Stored records at the time of their event, which these records give in microseconds."""
    parsed = parse_records(records).where(F.col("status") == S.STORED)
    return parsed.withColumn("timestamp", F.timestamp_micros(F.col("event_seconds").cast("long"))).drop("event_seconds")


def sink_of(spark, name: str, **settings) -> TableSink:
    root = fresh_path(spark, name)
    return TableSink(spark, "predictions_" + root.rsplit("-", 1)[-1], root, name, **settings)


def to_sink(sink: TableSink, source: str, write=None):
    stream = timed(S.line_stream(sink.spark, source, max_files=1))
    return S.for_each_batch(stream, write or sink.write, f"{sink.root}/checkpoint", available_now=True)


class Crash(RuntimeError):
    pass


def crash_once(at: int):
    """A hook that fails the first time a batch gets there."""
    crashed = []

    def hook(batch: int) -> None:
        if batch == at and not crashed:
            crashed.append(batch)
            raise Crash(f"lost in batch {batch}")

    return hook


def through_crashes(start, crashes: int) -> None:
    """Run a stream to its end, starting it again after each planned crash."""
    for _ in range(crashes):
        try:
            S.finish(start())
        except StreamingQueryException as failed:
            if "lost in batch" not in str(failed):
                raise
        else:
            raise AssertionError("the stream was meant to crash")
    S.finish(start())


@register.query(
    f"SELECT {SQL_ISO} FROM (SELECT * FROM ({SQL_STORED}) ORDER BY timestamp DESC, message DESC LIMIT 25)"
)
def stream_predictions_newest(spark, folder):
    """A stream into the predictions table, lost once between write and commit and once after a commit, read newest first."""
    source = arrivals(spark, folder, 3)
    sink = sink_of(spark, "newest", staged=crash_once(1), committed=crash_once(2))
    through_crashes(lambda: to_sink(sink, source), 2)
    return responses(sink.newest(25, tie="message"))


@register.query(f"SELECT {SQL_ISO} FROM ({SQL_STORED})")
def stream_predictions_all(spark, folder):
    """All rows of that table after the same crashes, and after its catalogue entry was lost."""
    source = arrivals(spark, folder, 3)
    sink = sink_of(spark, "all", staged=crash_once(0), committed=crash_once(1))
    through_crashes(lambda: to_sink(sink, source), 2)
    spark.sql(f"DROP TABLE {sink.table}")
    again = TableSink(spark, sink.table, sink.root, sink.query)
    again.restore()
    return responses(again.rows())


#: Four partitions of a topic; an offset is a place among the events of its partition.
TOPIC_RULES = {
    "topic": "'events'",
    "partition": "CAST(event_id % 4 AS INT)",
    "offset": "CAST((event_id - event_id % 4) / 4 AS BIGINT)",
}
SQL_TOPIC = ", ".join(f'{rule} AS "{name}"' for name, rule in TOPIC_RULES.items())
DELIVERIES, REPEATED = 4, 0.5


@register.query(
    'SELECT topic, "partition", count(*) AS n_rows, min("offset") AS first_offset, max("offset") AS last_offset,'
    f' CAST(sum("offset") AS BIGINT) AS sum_offsets FROM (SELECT {SQL_TOPIC} FROM events) GROUP BY topic, "partition"'
)
def stream_offset_dedup(spark, folder):
    """Records of a topic, delivered in ranges of offsets of which each repeats half of the one before, and stored once."""
    events = table(spark, folder, "events").select(
        *(F.expr(rule).alias(name) for name, rule in TOPIC_RULES.items()),
        F.col("event_type").alias("message"),
        F.col("user_id").cast("string").alias("prediction"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    source = fresh_path(spark, "topic")
    size = events.agg(F.max("offset")).first()[0]
    width = 0 if size is None else size / DELIVERIES
    for part in range(DELIVERIES):
        first, last = (part - REPEATED) * width, (part + 1) * width
        # twice the same row, and in any order
        once = events.where((F.col("offset") >= first) & (F.col("offset") <= last))
        twice = once.where("offset % 10 = 0")
        once.unionByName(twice).coalesce(1).write.mode("append").parquet(source)
    sink = sink_of(spark, "offsets", by_offset=True, staged=crash_once(1), committed=crash_once(2))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)

    def start():
        return S.for_each_batch(stream.parquet(source), sink.write, f"{sink.root}/checkpoint", available_now=True)

    through_crashes(start, 2)
    folders = [r["folder"] for r in sink.entries().select("folder").collect()]
    stored = spark.read.schema("topic string, partition int, offset long").option("recursiveFileLookup", True)
    loads = stored.parquet(*folders)
    return loads.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.sum("offset").alias("sum_offsets"),
    )


@register.query(
    f"SELECT message, prediction, CAST(event_id % 4 AS BIGINT) AS batch,"
    f" CASE WHEN event_id % 4 < 2 THEN 'before the stop' ELSE 'after it' END AS phase FROM ({SQL_STORED})"
)
def stop_and_resume(spark, folder):
    """A stream asked to stop while it is in its second batch, and started again."""
    source = arrivals(spark, folder, 4)
    marker = StopMarker(spark, fresh_path(spark, "stop"))
    sink = sink_of(spark, "stopped", committed=lambda batch: marker.set() if batch == 1 else None)

    def run() -> bool:
        return run_until_stopped(to_sink(sink, source, stoppable(sink.write, marker)), marker)

    stopped = run()
    done = [row["batch"] for row in sink.entries().select("batch").collect()]
    marker.clear()
    resumed = run()
    if not stopped or resumed:
        raise RuntimeError("the stream did not stop, or did so twice")
    batch = F.element_at(F.split("load", "-"), -1).cast("long")
    phase = F.when(F.col("batch").isin(done), "before the stop").otherwise("after it")
    return sink.rows().select("message", "prediction", batch.alias("batch")).withColumn("phase", phase)

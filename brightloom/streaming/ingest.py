"""Message streams: parse records, set broken ones aside, store the rest.

The source is any stream with a ``value`` text column, such as a topic or a folder of
text files. Records carry no keyed state, so a stream only needs its checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brightloom.functions.payloads import encode_payload, epoch_seconds
from brightloom.operators.columns import quoted
from brightloom.operators.predictions import reject_reason
from brightloom.operators.records import BROKEN, STORED
from brightloom.plans.text_jobs import score_messages
from brightloom.sources.writers import topic_records


def line_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text").schema("value string")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def store(records: DataFrame, path: str, checkpoint: str, *, available_now: bool = False) -> StreamingQuery:
    """Write parsed records to a table folder, split by ``status``.

    One pass feeds predictions and dead letters. The file sink logs which files belong to
    which batch, so a batch repeated after a crash leaves no duplicates.
    """
    stamped = records.withColumn("timestamp", F.current_timestamp())
    writer = stamped.writeStream.format("parquet").partitionBy("status").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start(path)


STORED_SCHEMA = "value string, message string, prediction string, event_seconds double, timestamp timestamp, status string"


def of_sink(spark: SparkSession, path: str, schema) -> DataFrame:
    """What a stream has stored so far; no rows where nothing was."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The predictions of a stored stream; the filter opens only their folder."""
    rows = of_sink(spark, path, STORED_SCHEMA).where(F.col("status") == STORED)
    return rows.select("timestamp", "message", "prediction", "event_seconds")


def dead_letters(spark: SparkSession, path: str) -> DataFrame:
    rows = of_sink(spark, path, STORED_SCHEMA).where(F.col("status") == BROKEN)
    return rows.select("timestamp", "value")


def score_stream(stream: DataFrame, text: str, model) -> DataFrame:
    """All messages with ``prediction`` and ``reason``: one without text has no prediction, but a reason."""
    scored = score_messages(stream, text, model)
    reason = reject_reason(quoted(text))
    return scored.withColumn("reason", reason).withColumn("prediction", F.when(F.col("reason").isNull(), F.col("prediction")))


def prediction_records(scored: DataFrame, text: str, prediction: str = "prediction") -> DataFrame:
    """Scored messages as ``key, value`` records for a topic, timed when they were scored."""
    now = epoch_seconds(F.current_timestamp())
    return topic_records(scored, encode_payload(F.col(text), F.col(prediction), now))


def batch_folder_writer(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that repeats safely: a batch replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def for_each_batch(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, *, available_now: bool = False
) -> StreamingQuery:
    """Hand each batch to ``write``; a failing write stops the query and the batch is replayed."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def finish(query: StreamingQuery) -> None:
    """Wait for a stream over what is available, then stop it."""
    try:
        query.awaitTermination()
    finally:
        query.stop()

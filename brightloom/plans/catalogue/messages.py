"""Predictions and message records, made from ``events`` and ``conversations``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.functions import payloads as P
from brightloom.operators import predictions as R
from brightloom.operators.records import parse_records
from brightloom.plans.catalogue.registry import Register, rounded, table
from brightloom.workspace import fresh_path

register = Register()

# rules both engines can run
LABEL_RULE = "CASE WHEN value >= 10 THEN 1 WHEN value >= 2 THEN 0 ELSE 2 END"
SQL_SENTIMENT = (
    f"CASE {LABEL_RULE} WHEN 1 THEN 'Positive sentiment' WHEN 0 THEN 'Negative sentiment' ELSE 'Unknown sentiment' END"
)
SQL_PREDICTIONS = f"SELECT event_id, ts AS timestamp, event_type AS message, {SQL_SENTIMENT} AS prediction FROM events"

# every kind of record a topic may carry
RECORD_RULE = """
    CASE event_id % 10
    WHEN 0 THEN '{"message": ' || event_type
    WHEN 1 THEN '"' || event_type || '"'
    WHEN 2 THEN '{"sentiment":"' || event_type || '"}'
    WHEN 3 THEN '{"message":"","prediction":{"value":' || CAST(user_id AS STRING) || '}}'
    WHEN 4 THEN '{"message":"0","prediction":0,"sentiment":"' || event_type || '"}'
    WHEN 5 THEN CAST(event_id AS STRING)
    WHEN 6 THEN '{"message":[],"prediction":false,"timestamp":' || CAST(user_id AS STRING) || '}'
    WHEN 7 THEN '{"message":null,"prediction":"","sentiment":null}'
    ELSE '{"message":"' || event_type || ' ' || CAST(event_id AS STRING) || '","prediction":"score '
        || CAST(value AS STRING) || '","timestamp":' || CAST(event_id AS STRING) || '.5}'
    END
"""


def sql_first_filled(*names: str) -> str:
    branches = []
    for name in names:
        kind, text = f"json_type(j, '$.{name}')", f"json_extract_string(j, '$.{name}')"
        filled = (
            f"CASE WHEN {kind} IN ('OBJECT', 'ARRAY') THEN {text} NOT IN ('{{}}', '[]')"
            f" WHEN {kind} = 'VARCHAR' THEN {text} <> '' WHEN {kind} = 'BOOLEAN' THEN {text} = 'true'"
            f" WHEN {kind} IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN try_cast({text} AS DOUBLE) <> 0 ELSE FALSE END"
        )
        branches.append(f"WHEN {filled} THEN {text}")
    return f"CASE {' '.join(branches)} ELSE value END"


def sql_parsed(records: str) -> str:
    """Status and fields of records, from a query giving ``event_id, value``."""
    scalar = "json_extract_string(j, '$')"
    is_object = "json_type(j) = 'OBJECT'"
    return f"""
    SELECT event_id, value, CASE WHEN valid THEN 'stored' ELSE 'broken' END AS status,
        CASE WHEN valid THEN CASE WHEN {is_object} THEN {sql_first_filled('message')} ELSE {scalar} END END AS message,
        CASE WHEN valid THEN CASE WHEN {is_object} THEN {sql_first_filled('prediction', 'sentiment')}
            ELSE {scalar} END END AS prediction,
        CASE WHEN valid THEN try_cast(json_extract_string(j, '$.timestamp') AS DOUBLE) END AS event_seconds
    FROM (
        SELECT event_id, value, json_valid(value) AS valid,
            CAST(CASE WHEN json_valid(value) THEN value ELSE 'null' END AS JSON) AS j
        FROM ({records}))
    """


SQL_RECORDS = f"SELECT event_id, {RECORD_RULE} AS value FROM events"
SQL_PARSED = sql_parsed(SQL_RECORDS)


def predictions(spark, folder) -> DataFrame:
    sentiment = P.decode_label(F.expr(LABEL_RULE))
    return table(spark, folder, "events").select(
        "event_id", F.col("ts").alias("timestamp"), F.col("event_type").alias("message"), sentiment.alias("prediction")
    )


def records(spark, folder) -> DataFrame:
    return table(spark, folder, "events").select("event_id", F.expr(RECORD_RULE).alias("value"))


@register.query(
    "SELECT strftime(timestamp, '%Y-%m-%dT%H:%M:%S') AS timestamp, message, prediction"
    f" FROM (SELECT * FROM ({SQL_PREDICTIONS}) ORDER BY timestamp DESC, event_id DESC LIMIT 10)"
)
def latest_predictions(spark, folder):
    return R.responses(R.newest(predictions(spark, folder), 10, tie="event_id"))


SQL_BY_PREDICTION = "SELECT prediction, message, count(*) AS messages FROM {0} GROUP BY prediction, message"


@register.query(SQL_BY_PREDICTION.format(f"({SQL_PREDICTIONS})"))
def sql_over_predictions(spark, folder):
    return R.query(predictions(spark, folder), SQL_BY_PREDICTION.format("predictions"))


@register.query(
    "SELECT prediction, 2 * count(*) AS messages, CAST(0 AS BIGINT) AS without_time"
    f" FROM ({SQL_PREDICTIONS}) GROUP BY prediction"
)
def append_then_count(spark, folder):
    """Two appends to a table that is created twice: rows with their own time, rows without."""
    path = fresh_path(spark, "predictions")
    name = "predictions_" + path.rsplit("-", 1)[-1]
    source = predictions(spark, folder).drop("event_id")
    R.create_table(spark, name, path)
    R.create_table(spark, name, path)
    try:
        R.append(source.withColumn("timestamp", F.col("timestamp").cast("timestamp")), name)
        R.append(source.drop("timestamp"), name)
        schema = spark.table(name).schema
    finally:
        spark.sql(f"DROP TABLE {name}")  # the catalogue entry; its files stay
    rows = spark.read.schema(schema).parquet(path)
    return rows.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(F.col("timestamp").isNull()).alias("without_time")
    )


MESSAGE_RULE = "CASE WHEN turn % 3 = 2 THEN '' WHEN turn % 5 = 4 THEN NULL ELSE text END"


@register.query(
    "SELECT conv_id, turn, 'no text to score' AS reason FROM"
    f" (SELECT conv_id, turn, {MESSAGE_RULE} AS message FROM conversations) WHERE message IS NULL OR message = ''"
)
def message_rejects(spark, folder):
    messages = table(spark, folder, "conversations").select("conv_id", "turn", F.expr(MESSAGE_RULE).alias("message"))
    _, rejected = R.split_rejects(messages)
    return rejected.select("conv_id", "turn", "reason")


@register.query(
    "SELECT event_id, '{\"message\":\"' || message || '\",\"prediction\":\"' || prediction || '\",\"timestamp\":'"
    " || CAST(epoch_us(timestamp) // 1000000 AS VARCHAR) || '.'"
    f" || lpad(CAST(epoch_us(timestamp) % 1000000 AS VARCHAR), 6, '0') || '}}' AS payload FROM ({SQL_PREDICTIONS})"
)
def payload_encode(spark, folder):
    payload = P.encode_payload(F.col("message"), F.col("prediction"), P.epoch_seconds_utc(F.col("timestamp")))
    return predictions(spark, folder).select("event_id", payload.alias("payload"))


@register.query(f"SELECT event_id, message, prediction FROM ({SQL_PARSED})")
def payload_fallback(spark, folder):
    return parse_records(records(spark, folder)).select("event_id", "message", "prediction")


@register.query(
    "SELECT event_id, round(epoch_us(ts) / 1000000.0::DOUBLE, 6) AS seconds, epoch_us(ts) AS micros,"
    " strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(ts, '%Y%m%d_%H%M%S') AS run FROM events"
)
def payload_timestamps(spark, folder):
    ts, seconds = F.col("ts"), P.epoch_seconds_utc(F.col("ts"))
    return table(spark, folder, "events").select(
        "event_id",
        rounded(seconds.cast("double")).alias("seconds"),
        F.unix_micros(P.from_epoch_seconds(seconds)).alias("micros"),
        P.iso_text(ts).alias("iso"),
        P.run_id(ts).alias("run"),
    )

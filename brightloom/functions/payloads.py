"""Prediction messages: labels, JSON records, event times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label texts.
POSITIVE = "Positive sentiment"
NEGATIVE = "Negative sentiment"
UNKNOWN = "Unknown sentiment"


def decode_label(label: Column) -> Column:
    return F.when(label == 1, POSITIVE).when(label == 0, NEGATIVE).otherwise(UNKNOWN)


def encode_label(text: Column) -> Column:
    return F.coalesce(F.contains(F.lower(text), F.lit("positive")), F.lit(False)).cast("int")


def _seconds(micros: Column) -> Column:
    # microseconds below 10^18 are exact in DECIMAL, and print without an exponent
    return (micros.cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970, with microseconds, of a point in time."""
    return _seconds(F.unix_micros(ts))


def epoch_seconds_utc(ts: Column) -> Column:
    """The same of a time without zone, read as UTC whatever the session's zone is."""
    return _seconds(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts))


def from_epoch_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def run_id(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def encode_payload(message: Column, prediction: Column, seconds: Column) -> Column:
    """The JSON record of a prediction made ``seconds`` after 1970."""
    return F.to_json(
        F.struct(message.alias("message"), prediction.alias("prediction"), seconds.alias("timestamp"))
    )

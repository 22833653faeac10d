"""Fields of JSON message records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STORED, BROKEN = "stored", "broken"
_NAMES = ("message", "prediction", "sentiment")
# Texts that may stand for an empty value, depending on the JSON type.
_EMPTY_TEXTS = ("", "false", "{}", "[]")


def _filled(field: Column, text: Column) -> Column:
    """Whether a field is neither absent nor null, false, zero, or an empty text, list or object.

    Most texts settle it by themselves; only those that look empty need the type, since
    the text ``"0"`` counts as filled and the number does not.
    """
    looks_empty = text.isin(*_EMPTY_TEXTS) | text.startswith("0") | text.startswith("-0")
    is_text = (F.schema_of_variant(field) == "STRING") & (text != "")
    number = F.coalesce(F.try_variant_get(field, "$", "double"), F.lit(0.0))
    return F.when(text.isNull(), False).when(~looks_empty, True).otherwise(is_text | (number != 0.0))


def parse_records(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``status, message, prediction, event_seconds`` to records of JSON text.

    Message and prediction fall back to the record's own text where they are empty; the
    prediction may also come as ``sentiment``. A record that is no object is both fields.
    Broken JSON has the status ``broken`` and no fields.

    Each step reads columns of the one before, so a record is parsed once.
    """
    raw, record = F.col(value), F.col("_record")
    parsed = df.withColumn("_record", F.try_parse_json(raw))
    picked = parsed.select(
        "*",
        F.ltrim(raw, F.lit(" \t\r\n")).startswith("{").alias("_is_object"),
        F.try_variant_get(record, "$", "string").alias("_whole"),
        *(F.try_variant_get(record, f"$.{name}", "variant").alias(f"_{name}") for name in _NAMES),
        F.try_variant_get(record, "$.timestamp", "double").alias("event_seconds"),
    )
    texts = picked.select(
        "*", *(F.try_variant_get(f"_{name}", "$", "string").alias(f"_{name}_text") for name in _NAMES)
    )

    def first_filled(*names: str) -> Column:
        chosen = raw
        for name in reversed(names):
            text = F.col(f"_{name}_text")
            chosen = F.when(_filled(F.col(f"_{name}"), text), text).otherwise(chosen)
        return F.when(record.isNull(), None).when(F.col("_is_object"), chosen).otherwise(F.coalesce("_whole", raw))

    return texts.select(
        *df.columns,
        F.when(record.isNull(), BROKEN).otherwise(STORED).alias("status"),
        first_filled("message").alias("message"),
        first_filled("prediction", "sentiment").alias("prediction"),
        "event_seconds",
    )

"""The predictions table: create, append, newest rows, SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.functions.payloads import iso_text


def create_table(spark: SparkSession, name: str, path: str) -> None:
    """Create the table unless it is there; repeating it is harmless."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (timestamp TIMESTAMP, message STRING, prediction STRING) "
        f"USING parquet LOCATION '{path}'"
    )


def create_daily_table(spark: SparkSession, name: str, path: str) -> None:
    """The same with a folder for each day and load, so that a load becomes visible as a whole."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (timestamp TIMESTAMP, message STRING, prediction STRING, day DATE, load STRING) "
        f"USING parquet PARTITIONED BY (day, load) LOCATION '{path}'"
    )


def append(df: DataFrame, table: str) -> None:
    """Append ``message, prediction`` with the time of storing, unless rows bring a ``timestamp``.

    Files are sorted by time, so their statistics let a query for recent rows skip the rest.
    """
    stamped = df if "timestamp" in df.columns else df.withColumn("timestamp", F.current_timestamp())
    stamped.select("timestamp", "message", "prediction").sortWithinPartitions("timestamp").write.insertInto(table)


def newest(df: DataFrame, n: int = 10, *, time: str = "timestamp", tie: str | None = None) -> DataFrame:
    """The ``n`` latest rows, newest first; ``tie`` orders rows of equal time, larger first.

    A first pass over the time column alone finds the n-th latest time. The second reads whole
    rows, but only from row groups that reach it, since the filter is pushed into the scan.
    """
    order = [F.desc(time)] + ([F.desc(tie)] if tie else [])
    latest = df.select(time).orderBy(F.desc(time)).limit(n)
    # as text, which reads back as the same time whatever the session's time zone
    cutoff = F.when(F.count_if(F.col(time).isNull()) == 0, F.min(time)).cast("string")
    earliest = latest.agg(cutoff).first()[0]
    if earliest is not None:
        df = df.where(F.col(time) >= F.lit(earliest).cast(df.schema[time].dataType))
    return df.orderBy(*order).limit(n)


def responses(df: DataFrame, time: str = "timestamp") -> DataFrame:
    return df.select(iso_text(F.col(time)).alias("timestamp"), "message", "prediction")


def query(df: DataFrame, sql: str, view: str = "predictions") -> DataFrame:
    """Run any SQL over the rows, visible under the name ``view``."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql)


def has_message(message: Column) -> Column:
    return F.coalesce(F.length(message) > 0, F.lit(False))


def reject_reason(message: Column) -> Column:
    """Why a message cannot be scored, null if it can."""
    return F.when(~has_message(message), F.lit("no text to score"))


def split_rejects(df: DataFrame, message: str = "message") -> tuple[DataFrame, DataFrame]:
    """Rows that can be scored, and the rest with a ``reason``."""
    value = F.col(message)
    return df.where(has_message(value)), df.where(~has_message(value)).withColumn("reason", reject_reason(value))

"""Cleaning and profiling of wide numeric tables.

Every operator builds one projection or one aggregate over all columns, so the plan
stays flat however many columns there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, NumericType, StringType


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def columns_from(df: DataFrame, first: int) -> DataFrame:
    return df.select(*map(quoted, df.columns[first:]))


def model_columns(df: DataFrame) -> list[str]:
    """Names of the columns a model takes: double, float, int and bigint."""
    kinds = (DoubleType, FloatType, IntegerType, LongType)
    return [field.name for field in df.schema if isinstance(field.dataType, kinds)]


def numeric_only(df: DataFrame) -> DataFrame:
    return df.select(*map(quoted, model_columns(df)))


def drop_all_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows with a value in at least one column; NaN is a value."""
    return df.where(reduce(or_, (quoted(c).isNotNull() for c in columns or df.columns)))


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.fill(0.0, subset=list(columns) if columns is not None else None)


def _as_double(df: DataFrame, name: str) -> Column:
    value = quoted(name)
    if isinstance(df.schema[name].dataType, StringType):
        # a failing cast raises and catches an exception per value: skip what cannot be a number
        value = F.when(value.rlike("(?i)[0-9]|nan|inf"), value)
    return value.try_cast("double").alias(name)


def coerce_double(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Cast to double, null where a text is no number. By default only string columns."""
    if columns is None:
        columns = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    chosen = set(columns)
    return df.select(*(_as_double(df, c) if c in chosen else quoted(c) for c in df.columns))


def replace_outliers(
    df: DataFrame, replacements: Mapping[str, float | None], low: float = 0.0, high: float = 1000.0
) -> DataFrame:
    """Values outside ``[low, high]`` become the column's replacement; nulls stay."""

    def cleaned(name: str) -> Column:
        value, replacement = quoted(name), replacements.get(name)
        if replacement is None:
            return value
        return F.when((value < low) | (value > high), F.lit(replacement)).otherwise(value).alias(name)

    return df.select(*map(cleaned, df.columns))


def rows_before_after(before: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row counts before and after dropping all-null rows, in one scan."""
    filled = reduce(or_, (quoted(c).isNotNull() for c in columns or before.columns))
    return before.agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(filled).alias("rows_left"))


_STATISTICS = {
    "count": lambda c: F.count(c),
    "mean": lambda c: F.avg(c),
    "stddev": lambda c: F.stddev_samp(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
}


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, count, mean, stddev, min, max`` per numeric column, in one scan."""
    names = list(columns or numeric_only(df).columns)
    summary = df.agg(
        *(
            F.struct(*(make(quoted(c)).cast("double").alias(s) for s, make in _STATISTICS.items())).alias(f"c{i}")
            for i, c in enumerate(names)
        )
    )
    entries = F.array(
        *(F.struct(F.lit(c).alias("column"), *(F.col(f"c{i}")[s].alias(s) for s in _STATISTICS)) for i, c in enumerate(names))
    )
    return summary.select(F.inline(entries)).withColumn("count", F.col("count").cast("long"))


def profile(df: DataFrame) -> DataFrame:
    """``position, column, type, rows, non_null`` per column, in one scan."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)),
    )
    entries = F.array(
        *(
            F.struct(
                F.lit(i).alias("position"), F.lit(name).alias("column"), F.lit(kind).alias("type"),
                F.col("rows"), F.col(f"c{i}").alias("non_null"),
            )
            for i, (name, kind) in enumerate(df.dtypes)
        )
    )
    return counted.select(F.inline(entries))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]

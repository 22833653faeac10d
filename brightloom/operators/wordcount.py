"""Word counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SINGLE_SPACE = " "
WHITESPACE_RUN = r"\s+"


def words(df: DataFrame, line: str | Column, separator: str = SINGLE_SPACE) -> DataFrame:
    """One row per piece of each line; empty pieces are kept."""
    return df.select(F.explode(F.split(line, separator)).alias("word"))


def word_count(df: DataFrame, line: str | Column, separator: str = SINGLE_SPACE) -> DataFrame:
    """Case-sensitive counts. Map-side partial counts keep a frequent word from loading one task."""
    return words(df, line, separator).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def most_frequent(counts: DataFrame, n: int | None = None) -> DataFrame:
    """By falling count; equal counts go by word so that the order is the same every run."""
    ranked = counts.orderBy(F.desc("count"), "word")
    return ranked if n is None else ranked.limit(n)

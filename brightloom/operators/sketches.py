"""Quantile sketches of columns, one row for each file, that merge into the sketches of any set of files.

A file is read once; its sketches are kept, and new files only add rows. The state of a sketch does not grow with its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.operators.columns import quoted
from brightloom.streaming.ingest import of_sink

#: A sketch's size; its rank error falls about as its inverse.
SIZE = 800
FILE = "_file"


def rank_error(size: int) -> float:
    """How far, as a share of all rows, the rank of a sketched quantile is from the one asked for, in 99 of 100 sketches."""
    # fixed values: the published fit of the sketch's error
    return 2.296 / size**0.9021


def with_file(df: DataFrame) -> DataFrame:
    """Rows of a table of files with the file each is from."""
    return df.withColumn(FILE, F.col("_metadata.file_path"))


def file_sketches(df: DataFrame, columns: Sequence[str], size: int = SIZE) -> DataFrame:
    """``_file, n`` and a sketch under the name of each column; nulls and NaN are not sketched."""

    def sketched(name: str) -> Column:
        value = quoted(name).cast("double")
        return F.kll_sketch_agg_double(F.when(~F.isnan(value), value), F.lit(size)).alias(name)

    return df.groupBy(FILE).agg(F.count(F.lit(1)).alias("n"), *map(sketched, columns))


def store_sketches(spark: SparkSession, df: DataFrame, columns: Sequence[str], path: str, size: int = SIZE) -> DataFrame:
    """Sketch the files that have none in the table yet; returns the table of all."""
    schema = file_sketches(df, columns, size).schema
    known = of_sink(spark, path, schema).select(FILE)
    # a row for each file
    new = df.join(known, FILE, "left_anti")
    file_sketches(new, columns, size).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def merged(sketches: DataFrame, columns: Sequence[str], size: int = SIZE) -> DataFrame:
    """One row with the sketch of every column over all files."""
    return sketches.agg(*(F.kll_merge_agg_double(quoted(c), F.lit(size)).alias(c) for c in columns))


def sketched_medians(sketches: DataFrame, columns: Sequence[str], size: int = SIZE) -> dict[str, float | None]:
    """Medians within the rank error; null for a column without values."""

    def median(name: str) -> Column:
        sketch = quoted(name)
        filled = F.kll_sketch_get_n_double(sketch) > 0
        return F.when(filled, F.kll_sketch_get_quantile_double(sketch, F.lit(0.5))).alias(name)

    return merged(sketches, columns, size).select(*map(median, columns)).first().asDict()


def rank_check(df: DataFrame, medians: dict[str, float | None], error: float) -> DataFrame:
    """``column, n, within``: whether the middle rank is among those of a value equal to the median, up to the error."""
    counts = []
    for i, (name, median) in enumerate(medians.items()):
        value = quoted(name).cast("double")
        value = F.when(~F.isnan(value), value)
        at = F.lit(median).cast("double")
        counts += [
            F.count(value).alias(f"n{i}"),
            F.count_if(value < at).alias(f"below{i}"),
            F.count_if(value <= at).alias(f"upto{i}"),
        ]

    def within(i: int) -> Column:
        n = F.col(f"n{i}")
        low, high = F.col(f"below{i}") <= n * (0.5 + error), F.col(f"upto{i}") >= n * (0.5 - error)
        return F.when(n > 0, low & high)

    rows = (
        F.struct(F.lit(name).alias("column"), F.col(f"n{i}").alias("n"), within(i).alias("within")) for i, name in enumerate(medians)
    )
    return df.agg(*counts).select(F.inline(F.array(*rows)))

"""Table jobs: clean a wide table, train clusters, count words."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from brightloom.operators.clusters import DEFAULT_K, fit_clusters
from brightloom.operators.columns import (
    coerce_double,
    columns_from,
    drop_all_null,
    fill_zero,
    model_columns,
    numeric_columns,
    numeric_only,
    replace_outliers,
)
from brightloom.operators.medians import approximate_median_values, exact_median_values
from brightloom.operators.wordcount import SINGLE_SPACE, most_frequent, word_count
from brightloom.sources.readers import read_delimited, read_lines
from brightloom.sources.writers import write_csv, write_delimited

# Where the measured columns start and what counts as an outlier.
FIRST_MEASURE = 88
LOWEST, HIGHEST = 0.0, 1000.0


def clean_wide_table(df: DataFrame, first_column: int = FIRST_MEASURE, *, exact: bool = False) -> DataFrame:
    """Measured columns without all-null rows, nulls as 0, outliers as the column's median.

    Medians are taken after the zero fill and include the outliers. ``exact`` trades a few
    passes for medians that are not approximate.
    """
    filled = fill_zero(drop_all_null(columns_from(df, first_column)))
    find = exact_median_values if exact else approximate_median_values
    return replace_outliers(filled, find(filled, numeric_columns(filled)), LOWEST, HIGHEST)


def clean_wide_file(
    spark: SparkSession, source: str, target: str, schema: str | None = None,
    first_column: int = FIRST_MEASURE, *, exact: bool = False, single_file: bool = False,
) -> None:
    cleaned = clean_wide_table(read_delimited(spark, source, schema), first_column, exact=exact)
    write_delimited(cleaned, target, single_file=single_file)


def train_clusters(df: DataFrame, path: str, k: int = DEFAULT_K) -> PipelineModel:
    """Fit on every column that holds numbers, texts coerced and nulls zeroed, and save the model."""
    usable = fill_zero(numeric_only(coerce_double(df)))
    model = fit_clusters(usable, model_columns(usable), k)
    model.write().overwrite().save(path)
    return model


def load_clusters(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def count_words_in_files(
    spark: SparkSession, source: str, target: str | None = None, separator: str = SINGLE_SPACE
) -> DataFrame:
    counts = most_frequent(word_count(read_lines(spark, source), "value", separator))
    if target is not None:
        write_csv(counts, target)
    return counts

"""Bookkeeping for the catalogue."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Runner
    sql: str | None


class Register(dict[str, Query]):
    def query(self, sql: str | None = None) -> Callable[[Runner], Runner]:
        """Register a function under its own name, next to its SQL twin if there is one."""

        def keep(run: Runner) -> Runner:
            self[run.__name__] = Query(run, sql)
            return run

        return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(value: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison; adding zero turns -0.0 into 0.0."""
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column, digits) + F.lit(0.0)

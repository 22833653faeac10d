"""Whitening of embeddings by their principal components.

Vectors become whole numbers on a grid; the distinct ones are the fit list, written once. Its sums are exact,
its covariance is summed up in tables of one row a task, and both the components (:mod:`brightloom.llm.feast`, on a matrix as
large as the dimensions) and the check of the whitened covariance follow from them. Every row is then
projected by itself. A vector that a third of all rows share is one row of the fit list, combined before the shuffle.

Defined results: rows whose vector is null, or holds nulls, NaN, infinite entries or ones of ``TOO_LARGE`` in size, are left out, as
are those whose length is not the most frequent one (of equally frequent ones the longest). Null and repeated keys are rows like any others. There are as many components as the
covariance has eigenvalues above rounding error, ``most`` at the utmost: none for an empty table, for vectors that are all
alike or have no entries, and so no rows then. ``deviation`` is null where it exceeds a long. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from brightloom.llm import feast
from brightloom.llm.textkit import import_here, keyed
from brightloom.workspace import written

# fixed values of the grid
STEPS, OFFSET = 64, 1_000_000
ROWS_AT_ONCE = 4_096
LARGEST = 2**63
#: Entries from here on have no place on the grid: sums of whole vectors would not fit in a long.
TOO_LARGE = 2**31


@dataclass(frozen=True)
class Whitening:
    """``n`` vectors with ``sums``; eigenvalues falling, their vectors as columns; the covariance's trace."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n`` times the distance of vectors from the mean, in whole numbers."""
        return x * self.n - self.sums

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) / self.n) @ self.vectors / np.sqrt(self.values)


def on_grid(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``key, x``: the usable vectors as whole numbers."""
    entries = F.transform(F.col(vector), lambda c: c.cast("double"))
    # comparisons count NaN as larger than any number
    usable = F.forall("c", lambda c: c.isNotNull() & (F.abs(c) < float(TOO_LARGE)))
    usable = F.col("c").isNotNull() & F.coalesce(usable, F.lit(False))
    grid = F.transform("c", lambda c: F.floor(c * STEPS).cast("long") + OFFSET)
    found = df.select(F.col(key).alias("key"), entries.alias("c")).where(usable).select("key", grid.alias("x"))
    common = found.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return found.where(F.size("x") == (common["size"] if common else 0))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            x = part.column("x")
            yield part, x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def _added(fit: DataFrame, of: Callable[[np.ndarray], np.ndarray], kind: str) -> np.ndarray | None:
    """The sum of ``of(x)``, an array for each matrix of vectors, over all tasks; None without vectors.

    A task gives one row; entries are added up by their place.
    """
    schema = T.StructType.fromDDL(f"values array<{kind}>")
    arrow = to_arrow_schema(schema)
    import_here(fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _matrices(batches):
            part = of(x).reshape(-1)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], arrow.field(0).type)], schema=arrow)

    entries = fit.mapInArrow(run, schema).select(F.posexplode("values").alias("place", "value"))
    # as many rows as the array has entries, whatever the number of vectors
    rows = entries.groupBy("place").agg(F.sum("value").alias("value")).collect()
    if not rows:
        return None
    out = np.zeros(len(rows), np.int64 if kind == "long" else float)
    for row in rows:
        out[row["place"]] = row["value"]
    return out


def fit(vectors: DataFrame, most: int) -> Whitening | None:
    """Learn from the distinct vectors of ``key, x``; None where there is no component."""
    distinct = written(vectors.select("x").distinct(), "fit-list")
    counted = _added(distinct, lambda x: np.append(x.sum(axis=0), len(x)), "long")
    if counted is None:
        return None
    n, sums = int(counted[-1]), counted[:-1]
    start = Whitening(n, sums, np.empty(0), np.empty((len(sums), 0)), 0.0)

    def products(x: np.ndarray) -> np.ndarray:
        far = start.centred(x) / n
        return far.T @ far

    total = _added(distinct, products, "double")
    if total is None or not len(sums):
        return None
    covariance = total.reshape(len(sums), len(sums)) / n
    covariance = (covariance + covariance.T) / 2
    values, found = feast.largest(covariance, most)
    if not len(values):
        return None
    model = Whitening(n, sums, values, found, float(np.trace(covariance)))

    def white_products(x: np.ndarray) -> np.ndarray:
        white = model.whitened(x)
        return np.append((white.T @ white).reshape(-1), white.sum(axis=0))

    added = _added(distinct, white_products, "double")
    k = len(values)
    mean = added[k * k :] / n
    white = added[: k * k].reshape(k, k) / n - np.outer(mean, mean)
    error = float(np.abs(white - np.eye(k)).max())
    return Whitening(n, sums, values, found, model.trace, error)


def _deviations(model: Whitening, x: np.ndarray) -> pa.Array:
    far = model.centred(x)
    about = (far.astype(float) ** 2).sum(axis=1)
    fits = about < 0.999 * LARGEST
    exact = (np.where(fits[:, None], far, 0) ** 2).sum(axis=1)
    # next to the limit and beyond it numbers of any size decide
    values = [int(e) if f else sum(int(v) ** 2 for v in row) for e, f, row in zip(exact, fits, far)]
    return pa.array([v if v < LARGEST else None for v in values], pa.int64())


COLUMNS = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, most: int = 16, *, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key`` and the columns of ``COLUMNS``: a row for each usable vector and component."""
    rows = on_grid(df, key, vector)
    schema = keyed(df, [key], COLUMNS)
    model = fit(rows, most)
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    arrow = to_arrow_schema(schema)
    import_here(df)
    k = len(model.values)
    explained = model.values / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(batches):
            many = np.repeat(np.arange(len(x)), k)
            columns = [
                part.column("key").take(pa.array(many)),
                np.tile(np.arange(1, k + 1), len(x)),
                np.full(len(x) * k, model.n),
                _deviations(model, x).take(pa.array(many)),
                model.whitened(x).reshape(-1),
                np.tile(explained, len(x)),
                np.full(len(x) * k, model.identity_error),
            ]
            arrays = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return rows.mapInArrow(run, schema)

"""K-means in DataFrame steps: starts, iterations, sweeps over k and a model as a table.

Centres are a few dozen points on the driver and enter each pass as literals, so a pass reads the same rows and no lineage
grows from one to the next. Each pass is one aggregation with map-side combine by cluster; where many sets of centres share a
pass, a task finds the nearest of each set for a batch of rows at a time.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.operators.clusters import CLUSTER, DEFAULT_K, SEED, Centre, lloyd_step, nearest, with_nearest
from brightloom.operators.columns import quoted
from brightloom.workspace import import_here

# Library defaults of the fit.
MAX_ITERATIONS, TOLERANCE, INIT_ROUNDS = 20, 1e-4, 2
HASH_DIGITS = 13


def draw(key: Column, label: str) -> Column:
    """A uniform number in [0, 1) from a hash of the key: the same for a row in every run and on any partitioning."""
    digest = F.md5(F.concat(F.lit(f"{label}|"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("double") / F.lit(float(16**HASH_DIGITS))


@dataclass(frozen=True)
class Candidate:
    key: object
    round: int
    centre: tuple[float, ...]
    weight: int = 0


def parallel_candidates(
    df: DataFrame, key: str, values: Column, k: int = DEFAULT_K, *, rounds: int = INIT_ROUNDS, seed: int = SEED
) -> list[Candidate]:
    """Oversampled starting points, each with the number of rows nearest to it (k-means||).

    The first is drawn uniformly. Each round then keeps every row by its own draw, with the chance ``2k`` times its share of the
    squared distances to the candidates so far, so a round expects ``2k`` new ones at most whatever the number of rows.
    """
    rows = df.select(quoted(key).alias("key"), values.alias("values"))
    first = rows.orderBy(draw(F.col("key"), f"{seed}|0"), "key").first()
    if first is None:
        return []
    found = [Candidate(first["key"], 0, tuple(first["values"]))]
    for step in range(1, rounds + 1):
        near = rows.withColumn("distance", nearest(F.col("values"), [c.centre for c in found])["distance"])
        total = near.agg(F.sum("distance")).first()[0]
        if not total:
            break  # every row is a candidate
        chosen = near.where(draw(F.col("key"), f"{seed}|{step}") < F.col("distance") * F.lit(2.0 * k) / F.lit(total))
        new = [Candidate(r["key"], step, tuple(r["values"])) for r in chosen.orderBy("key").collect()]
        found += new
    sizes = with_nearest(rows, F.col("values"), [c.centre for c in found]).groupBy(CLUSTER).count().collect()
    weights = {r[CLUSTER]: r["count"] for r in sizes}
    return [Candidate(c.key, c.round, c.centre, weights.get(i, 0)) for i, c in enumerate(found)]


def _squared(a: Centre, b: Centre, units: Centre | None = None) -> float:
    return sum(((x - y) / u) ** 2 for x, y, u in zip(a, b, units or [1.0] * len(a)))


def recluster(candidates: Sequence[Candidate], k: int = DEFAULT_K, seed: int = SEED) -> list[Centre]:
    """``k`` centres from weighted candidates by k-means++; fewer where fewer differ."""
    draws = random.Random(seed)
    points = [(c.centre, c.weight) for c in candidates if c.weight]
    centres: list[Centre] = []
    while len(centres) < k:
        chances = [w * min((_squared(p, c) for c in centres), default=1.0) for p, w in points]
        if not sum(chances):
            break
        centres.append(draws.choices([p for p, _ in points], chances)[0])
    return centres


def parallel_start(df: DataFrame, key: str, values: Column, k: int = DEFAULT_K, *, seed: int = SEED) -> list[Centre]:
    return recluster(parallel_candidates(df, key, values, k, seed=seed), k, seed)


@dataclass(frozen=True)
class LloydRun:
    """Centres after the last step; sizes and cost are those of the assignment that led to them."""

    centres: list[Centre]
    sizes: list[int]
    costs: list[float]
    iterations: int
    converged: bool


def moved(centres: Sequence[Centre], means: Mapping[int, Centre], units: Centre | None = None) -> tuple[list[Centre], float]:
    """The means as new centres, and the largest squared shift; a cluster without rows keeps its centre."""
    new = [means.get(i, c) for i, c in enumerate(centres)]
    return new, max((_squared(a, b, units) for a, b in zip(centres, new)), default=0.0)


def lloyd_run(
    df: DataFrame,
    values: Column,
    centres: Sequence[Centre],
    *,
    units: Centre | None = None,
    max_iterations: int = MAX_ITERATIONS,
    tolerance: float = TOLERANCE,
) -> LloydRun:
    """Assign and average until no centre moves by more than ``tolerance``; in the ``units`` of the dimensions, if given."""
    rows = df.select(values.alias("values"))
    centres, sizes, costs = list(centres), [0] * len(centres), []
    for iteration in range(1, max_iterations + 1):
        step = {r[CLUSTER]: r for r in lloyd_step(rows, F.col("values"), centres, units).collect()}
        sizes = [step[i]["size"] if i in step else 0 for i in range(len(centres))]
        costs.append(sum(r["cost"] for r in step.values()))
        centres, shift = moved(centres, {i: tuple(r["centre"]) for i, r in step.items()}, units)
        if shift <= tolerance**2:
            return LloydRun(centres, sizes, costs, iteration, True)
    return LloydRun(centres, sizes, costs, len(costs), False)


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, a row for each centre; ``points`` has a row for each dimension, which are added in their order."""
    return np.stack([np.square(points - c[:, None]).sum(axis=0) for c in centres])


def _nearest_of(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point, the lower number on a tie, and its squared distance."""
    squares = _squares(points, centres)
    # a centre at no distance that is a number is the farthest
    own = np.where(np.isnan(squares), np.inf, squares).argmin(axis=0)
    return own, squares[own, np.arange(len(own))]


def _points(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        values = batch.column("values")
        flat = values.flatten()
        if values.null_count or flat.null_count or len(flat) != len(values) * width:
            raise ValueError(f"a point has not {width} coordinates")
        if len(values):
            yield np.ascontiguousarray(flat.to_numpy().reshape(-1, width).T)


def _sets(centres: Mapping[int, Sequence[Centre]]) -> tuple[dict[int, np.ndarray], int]:
    """The centres of each set as rows, and their number of dimensions."""
    width = max((len(c) for own in centres.values() for c in own), default=0)
    return {k: np.array(own, float).reshape(len(own), width) for k, own in centres.items()}, width


def _shared_pass(rows: DataFrame, centres: Mapping[int, Sequence[Centre]]) -> dict[int, dict[int, dict]]:
    """Sizes, means, squares and costs of the clusters of all sets, in one scan; a task tells one row for each cluster."""
    sets, width = _sets(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # size, cost and squares of each cluster, and its sum in each dimension
        sums = {k: np.zeros((3 + width, len(own))) for k, own in sets.items()}
        for points in _points(batches, width):
            squares = np.square(points).sum(axis=0)
            for k, own in sets.items():
                at, distance = _nearest_of(points, own)
                for total, weight in zip(sums[k], (None, distance, squares, *points)):
                    total += np.bincount(at, weight, len(own))
        for k, total in sums.items():
            filled = np.flatnonzero(total[0])
            yield pa.RecordBatch.from_pydict(
                {
                    "k": pa.array(np.full(len(filled), k, np.int32)),
                    CLUSTER: pa.array(filled.astype(np.int32)),
                    "size": pa.array(total[0, filled].astype(np.int64)),
                    "cost": pa.array(total[1, filled]),
                    "squares": pa.array(total[2, filled]),
                    "sums": pa.array(list(total[3:, filled].T), pa.list_(pa.float64())),
                }
            )

    found = rows.mapInArrow(run, f"k int, {CLUSTER} int, size long, cost double, squares double, sums array<double>")
    sums = found.groupBy("k", CLUSTER).agg(
        F.sum("size").alias("size"),
        F.sum("cost").alias("cost"),
        F.sum("squares").alias("squares"),
        vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"),
    )
    out: dict[int, dict[int, dict]] = {k: {} for k in centres}
    # a row for each centre
    for row in sums.collect():
        out[row["k"]][row[CLUSTER]] = row.asDict() | {"mean": [v / row["size"] for v in row["sums"]]}
    return out


def _silhouettes(rows: DataFrame, centres: Mapping[int, Sequence[Centre]], sums: Mapping[int, Mapping[int, dict]]) -> DataFrame:
    """The mean silhouette of each set by squared distance, from the sums of its clusters, in one scan."""
    sets, width = _sets(centres)
    known = {
        k: tuple(np.array([own[c][name] for c in sorted(own)], float) for name in ("size", "squares", "mean")) + (sorted(own),)
        for k, own in sums.items()
        if own
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = dict.fromkeys(known, 0.0), 0
        for points in _points(batches, width):
            each = np.arange(points.shape[1])
            count += len(each)
            squares = np.square(points).sum(axis=0)
            for k, (size, square, mean, clusters) in known.items():
                home = np.searchsorted(clusters, _nearest_of(points, sets[k])[0])
                if len(size) == 1:
                    continue  # a row of a set with one cluster counts as 0
                to = np.stack([squares - 2 * (points * m[:, None]).sum(axis=0) + q / n for n, q, m in zip(size, square, mean)])
                own, n = to[home, each], size[home]
                to[home, each] = np.inf
                b = to.min(axis=0)
                with np.errstate(all="ignore"):
                    a = own * n / (n - 1)
                    most = np.maximum(a, b)
                    # so does a row alone in its cluster
                    value = np.where((n == 1) | (most == 0), 0.0, (b - a) / most)
                total[k] += float(value.sum())
        if count:
            yield pa.RecordBatch.from_pydict(
                {
                    "k": pa.array(list(total), pa.int32()),
                    "total": pa.array(list(total.values()), pa.float64()),
                    "n": pa.array([count] * len(total), pa.int64()),
                }
            )

    found = rows.mapInArrow(run, "k int, total double, n long")
    return found.groupBy("k").agg((F.sum("total") / F.sum("n")).alias("silhouette"))


def sweep_shared(
    df: DataFrame,
    values: Column,
    starts: Mapping[int, Sequence[Centre]],
    *,
    max_iterations: int = MAX_ITERATIONS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``k, iterations, cost, silhouette`` for each set of starting centres.

    One scan moves the centres of all sets that still move; one more gives the costs and the sums of clusters of all, and
    a last one all silhouettes. The number of scans does not grow with the number of sets.
    """
    import_here(df)
    rows = df.select(values.alias("values"))
    centres = {k: list(c) for k, c in starts.items()}
    iterations = dict.fromkeys(centres, 0)
    moving = set(centres)
    while moving and max(iterations[k] for k in moving) < max_iterations:
        sums = _shared_pass(rows, {k: centres[k] for k in sorted(moving)})
        for k in sorted(moving):
            centres[k], shift = moved(centres[k], {c: tuple(s["mean"]) for c, s in sums[k].items()})
            iterations[k] += 1
            if shift <= tolerance**2:
                moving.discard(k)
    sums = _shared_pass(rows, centres)
    found = {r["k"]: r["silhouette"] for r in _silhouettes(rows, centres, sums).collect()}
    table = [(k, iterations[k], float(sum(s["cost"] for s in sums[k].values())), found.get(k)) for k in sorted(centres)]
    return df.sparkSession.createDataFrame(table, "k int, iterations int, cost double, silhouette double")


#: The version of the table that a fitted model is saved as.
MODEL_VERSION = 1
MODEL = "version int, columns array<string>, mean array<double>, deviation array<double>, centres array<array<double>>"


@dataclass(frozen=True)
class ClusterModel:
    """Scaling and centres of some columns, saved as one row of a Parquet table that any reader understands."""

    columns: list[str]
    mean: list[float]
    deviation: list[float]
    centres: list[list[float]]

    def __post_init__(self) -> None:
        width = len(self.columns)
        lengths = [len(self.mean), len(self.deviation), *map(len, self.centres)]
        if not width or not self.centres or any(n != width for n in lengths):
            raise ValueError(f"a model of {width} columns has parts of {sorted(set(lengths))} numbers")

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        key: str,
        columns: Sequence[str],
        k: int = DEFAULT_K,
        *,
        starts: Sequence[Centre] | None = None,
        seed: int = SEED,
        max_iterations: int = MAX_ITERATIONS,
    ) -> ClusterModel:
        """Scale, choose starting points (``starts`` are unscaled ones) and iterate."""
        numbers = {c: quoted(c).cast("double") for c in columns}
        aggregates = [f(v).alias(f"{name}{i}") for i, v in enumerate(numbers.values()) for name, f in (("m", F.avg), ("d", F.stddev_samp))]
        row = df.agg(*aggregates).first()
        mean = [row[f"m{i}"] for i in range(len(columns))]
        deviation = [row[f"d{i}"] or 0.0 for i in range(len(columns))]
        if None in mean:
            raise ValueError("a column without numbers cannot be scaled")
        model = cls(list(columns), mean, deviation, [[0.0] * len(columns)])
        if starts is None:
            scaled = df.select(quoted(key), model.scaled().alias("scaled"))
            drawn = parallel_start(scaled, key, F.col("scaled"), k, seed=seed)
            starts = [[v * d + m for v, m, d in zip(c, mean, deviation)] for c in drawn]
        # unscaled, so that the rounding of means and deviations does not break ties; a constant column has no distances
        units = [d or math.inf for d in deviation]
        run = lloyd_run(df, F.array(*numbers.values()), starts, units=units, max_iterations=max_iterations)
        return cls(list(columns), mean, deviation, [model._scale(c) for c in run.centres])

    def _scale(self, values: Centre) -> list[float]:
        return [(v - m) / d if d else 0.0 for v, m, d in zip(values, self.mean, self.deviation)]

    def scaled(self) -> Column:
        """Standardised columns; one that is constant becomes 0."""
        parts = zip(self.columns, self.mean, self.deviation)
        return F.array(*((quoted(c).cast("double") - F.lit(m)) / F.lit(d) if d else F.lit(0.0) for c, m, d in parts))

    def assign(self, df: DataFrame) -> DataFrame:
        """Add ``cluster`` and ``distance``; the columns of the model must be there and hold numbers."""
        kinds = dict(df.dtypes)
        wrong = [c for c in self.columns if kinds.get(c, "missing").split("(")[0] not in NUMBERS]
        if wrong:
            raise ValueError(f"columns that are missing or no numbers: {', '.join(wrong)}")
        return with_nearest(df, self.scaled(), self.centres)

    def save(self, spark: SparkSession, path: str) -> None:
        row = (MODEL_VERSION, self.columns, self.mean, self.deviation, self.centres)
        spark.createDataFrame([row], MODEL).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ClusterModel:
        """Read a saved model, refusing tables of another schema, version or number of rows."""
        table = spark.read.parquet(path)
        expected = spark.createDataFrame([], MODEL).schema
        if [(f.name, f.dataType.simpleString()) for f in table.schema] != [(f.name, f.dataType.simpleString()) for f in expected]:
            raise ValueError(f"{path} is no saved model: {table.schema.simpleString()}")
        rows = table.take(2)
        if len(rows) != 1:
            raise ValueError(f"{path} has {'no' if not rows else 'more than one'} model")
        row = rows[0]
        if row["version"] != MODEL_VERSION:
            raise ValueError(f"{path} has version {row['version']}, this is {MODEL_VERSION}")
        return cls(row["columns"], row["mean"], row["deviation"], row["centres"])


NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def centre_table(spark: SparkSession, run: LloydRun) -> DataFrame:
    """``cluster, size, centre`` of a run."""
    rows = [(i, n, [float(v) for v in c]) for i, (n, c) in enumerate(zip(run.sizes, run.centres))]
    return spark.createDataFrame(rows, "cluster int, size long, centre array<double>")


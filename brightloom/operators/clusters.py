"""K-means clustering of numeric columns: scaling, fitting, assignment, cost, silhouette.

Centres number in the tens and have a few hundred dimensions, so they live on the
driver and enter a plan as literals; rows are never joined with centres, each row
finds its nearest one by itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.operators.columns import coerce_double, fill_zero, quoted

FEATURES, SCALED, CLUSTER = "features", "scaled_features", "cluster"
# The defaults of the clustering job and the range of its sweeps.
DEFAULT_K, SEED = 5, 42
SWEEP = tuple(range(2, 15))

Centre = Sequence[float]


def assembled(df: DataFrame, columns: Sequence[str], on_null: str = "error") -> DataFrame:
    """Add a ``features`` vector. A null is an ``error``, or makes the row ``skip``."""
    return _assembler(columns, on_null).transform(df)


def _assembler(columns: Sequence[str], on_null: str) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=FEATURES, handleInvalid=on_null)


def _scaler() -> StandardScaler:
    return StandardScaler(inputCol=FEATURES, outputCol=SCALED, withMean=True, withStd=True)


def standardised(vectors: DataFrame) -> DataFrame:
    """Centre ``features`` and divide by the sample deviation; a constant column becomes 0."""
    return _scaler().fit(vectors).transform(vectors)


def fit_clusters(df: DataFrame, columns: Sequence[str], k: int = DEFAULT_K, seed: int = SEED) -> PipelineModel:
    """Assemble, standardise, cluster. K-means reads the rows repeatedly and caches its own input."""
    kmeans = KMeans(k=k, seed=seed, featuresCol=SCALED, predictionCol=CLUSTER)
    return Pipeline(stages=[_assembler(columns, "error"), _scaler(), kmeans]).fit(df)


def assign_clusters(df: DataFrame, model: PipelineModel) -> DataFrame:
    """All columns as doubles with nulls zeroed, plus ``cluster``."""
    numeric = fill_zero(coerce_double(df, df.columns))
    return model.transform(numeric).select(*map(quoted, df.columns), CLUSTER)


def point(columns: Iterable[str]) -> Column:
    return F.array(*(quoted(c).cast("double") for c in columns))


def first_centres(df: DataFrame, key: str, values: Column, k: int = DEFAULT_K) -> list[Centre]:
    """Starting centres: the points of the ``k`` smallest keys."""
    return [row[0] for row in df.orderBy(key).limit(k).select(values).collect()]


def _squared_distance(values: Column, centre: Centre, units: Centre | None = None) -> Column:
    def fixed(numbers: Centre) -> Column:
        return F.array(*(F.lit(float(v)) for v in numbers))

    steps = F.zip_with(values, fixed(centre), lambda a, b: a - b)
    if units is not None:
        steps = F.zip_with(steps, fixed(units), lambda step, unit: step / unit)
    return F.aggregate(steps, F.lit(0.0), lambda total, step: total + step * step)


def nearest(values: Column, centres: Sequence[Centre], units: Centre | None = None) -> Column:
    """``(distance, cluster)`` of the closest centre, the lower number on a tie.

    With ``units``, differences are measured in the unit of each dimension. They are divided after they are taken, so that
    a point just between two centres is as far from both whatever the unit.
    """
    candidates = (
        F.struct(_squared_distance(values, c, units).alias("distance"), F.lit(i).alias(CLUSTER)) for i, c in enumerate(centres)
    )
    return F.array_min(F.array(*candidates))


def with_nearest(df: DataFrame, values: Column, centres: Sequence[Centre], units: Centre | None = None) -> DataFrame:
    """Add ``cluster`` and the squared ``distance`` to its centre."""
    found = df.withColumn("_nearest", nearest(values, centres, units))
    return found.select(*map(quoted, df.columns), "_nearest.cluster", "_nearest.distance")


def lloyd_step(df: DataFrame, values: Column, centres: Sequence[Centre], units: Centre | None = None) -> DataFrame:
    """``cluster, size, cost, centre``: one assignment and the means of its clusters."""
    assigned = with_nearest(df.select(values.alias("values")), F.col("values"), centres, units)
    mean = Summarizer.mean(array_to_vector("values"))
    return assigned.groupBy(CLUSTER).agg(
        F.count(F.lit(1)).alias("size"), F.sum("distance").alias("cost"), vector_to_array(mean).alias("centre")
    )


def clustering_cost(df: DataFrame, values: Column, centres: Sequence[Centre]) -> DataFrame:
    return df.agg(F.sum(nearest(values, centres)["distance"]).alias("cost"))


def silhouette(clustered: DataFrame, features: str = FEATURES, cluster: str = CLUSTER) -> float:
    """Mean silhouette by squared distance, from per-cluster sums instead of pairs of rows."""
    return ClusteringEvaluator(
        featuresCol=features, predictionCol=cluster, metricName="silhouette", distanceMeasure="squaredEuclidean"
    ).evaluate(clustered)


def sweep(
    vectors: DataFrame, ks: Iterable[int] = SWEEP, *, with_silhouette: bool = False, seed: int = SEED, parallelism: int = 8
) -> DataFrame:
    """``k, cost`` and optionally ``silhouette`` for each number of clusters.

    All fits share one cached copy of the scaled vectors, and ``parallelism`` of them run at
    a time: the iterations of one fit leave executors idle that another can use.
    """
    scaled = standardised(vectors).select(SCALED).persist(StorageLevel.MEMORY_AND_DISK)

    def evaluate(k: int) -> dict:
        model = KMeans(k=k, seed=seed, featuresCol=SCALED, predictionCol=CLUSTER).fit(scaled)
        result = {"k": k, "cost": float(model.summary.trainingCost)}
        if with_silhouette:
            result["silhouette"] = silhouette(model.transform(scaled), SCALED)
        return result

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            results = list(pool.map(inheritable_thread_target(scaled.sparkSession)(evaluate), ks))
    finally:
        scaled.unpersist()
    fields = "k int, cost double" + (", silhouette double" if with_silhouette else "")
    return vectors.sparkSession.createDataFrame(results, fields)

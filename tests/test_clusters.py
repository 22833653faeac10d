import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from brightloom.operators import clusters as K
from brightloom.plans import table_jobs
from brightloom.workspace import fresh_path


@pytest.fixture(scope="module")
def points(spark):
    draw = np.random.default_rng(3)
    spots = np.array([[0, 0, 0], [9, 0, 1], [0, 9, 2], [9, 9, 3]])
    rows = [(i, *map(float, spots[i % 4] + draw.normal(0, 1, 3))) for i in range(400)]
    return spark.createDataFrame(rows, "id int, a double, b double, c double").cache()


COLUMNS = ["a", "b", "c"]


def test_lloyd_steps_lower_the_cost(points):
    centres = K.first_centres(points, "id", K.point(COLUMNS), 4)
    assert len(centres) == 4 and centres[0] == [points.first()[c] for c in COLUMNS]
    costs = []
    for _ in range(4):
        step = K.lloyd_step(points, K.point(COLUMNS), centres).orderBy("cluster").collect()
        costs.append(sum(row["cost"] for row in step))
        centres = [row["centre"] for row in step]
    assert costs == sorted(costs, reverse=True)
    assert sum(row["size"] for row in step) == 400
    assert K.clustering_cost(points, K.point(COLUMNS), centres).first()[0] <= costs[-1]


def test_assignment_by_brute_force(points):
    centres = [[0.0, 0.0, 0.0], [9.0, 9.0, 3.0], [9.0, 9.0, 3.0]]
    rows = K.with_nearest(points, K.point(COLUMNS), centres).collect()
    for row in rows:
        distances = [sum((row[c] - m) ** 2 for c, m in zip(COLUMNS, centre)) for centre in centres]
        assert row["cluster"] == int(np.argmin(distances))  # the first of equal ones
        assert row["distance"] == pytest.approx(min(distances))


def test_silhouette_by_brute_force(points):
    some = points.limit(60)
    clustered = K.with_nearest(some, K.point(COLUMNS), [[0.0, 0.0, 0.0], [9.0, 0.0, 0.0], [5.0, 9.0, 0.0]])
    rows = clustered.select("cluster", F.array(*COLUMNS)).collect()
    labels = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows])
    squared = ((x[:, None] - x[None]) ** 2).sum(2)
    values = []
    for i, own in enumerate(labels):
        a = squared[i, labels == own].sum() / (np.sum(labels == own) - 1)
        b = min(squared[i, labels == other].mean() for other in set(labels) - {own})
        values.append((b - a) / max(a, b))
    vectors = clustered.withColumn("features", array_to_vector(K.point(COLUMNS)))
    assert K.silhouette(vectors) == pytest.approx(np.mean(values))


def test_standardise_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaled = K.standardised(K.assembled(df, ["a", "b"])).select(vector_to_array(K.SCALED)).collect()
    assert [row[0] for row in scaled] == [pytest.approx([-(0.5**0.5), 0]), pytest.approx([0.5**0.5, 0])]


def test_nulls_skip_or_fail(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, 5.0)], "a double, b double")
    assert K.assembled(df, ["a", "b"], "skip").count() == 1
    with pytest.raises(Exception, match="null"):
        K.assembled(df, ["a", "b"]).select("features").collect()


def test_train_save_load_assign(spark, points):
    texts = points.select(F.col("a").cast("string"), "b", F.when(F.col("id") > 5, F.col("c")).alias("c"))
    path = fresh_path(spark, "clusters")
    model = table_jobs.train_clusters(texts, path, k=4)
    assigned = K.assign_clusters(texts, model)
    assert assigned.columns == ["a", "b", "c", "cluster"]
    assert dict(assigned.dtypes)["a"] == "double"
    assert K.assign_clusters(texts, table_jobs.load_clusters(path)).collect() == assigned.collect()


def test_sweep(points):
    swept = K.sweep(K.assembled(points, COLUMNS), range(2, 6), with_silhouette=True).collect()
    assert [row["k"] for row in swept] == [2, 3, 4, 5]
    assert max(swept, key=lambda row: row["silhouette"])["k"] == 4

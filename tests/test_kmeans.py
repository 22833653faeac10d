"""Iterated k-means: starts, runs, sweeps and the saved model, against plain Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightloom.operators import clusters as K
from brightloom.operators import kmeans as M
from brightloom.workspace import fresh_path

COLUMNS = ["a", "b", "c"]
SPOTS = np.array([[0, 0, 0], [9, 0, 1], [0, 9, 2], [9, 9, 3]])


@pytest.fixture(scope="module")
def table():
    noise = np.random.default_rng(3)
    return [(i, *map(float, SPOTS[i % 4] + noise.normal(0, 1, 3))) for i in range(400)]


@pytest.fixture(scope="module")
def points(spark, table):
    return spark.createDataFrame(table, "id int, a double, b double, c double").cache()


def lloyd(x, centres, most, tolerance=1e-4):
    centres = np.array(centres, float)
    for k in range(1, most + 1):
        own = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[own == c].mean(0) if (own == c).any() else centres[c] for c in range(len(centres))])
        shift = ((new - centres) ** 2).sum(1).max()
        centres = new
        if shift <= tolerance**2:
            break
    return centres, k


@pytest.mark.parametrize("most", [1, 3, 20])
def test_a_run_against_plain_steps(points, table, most):
    x = np.array([r[1:] for r in table])
    run = M.lloyd_run(points, K.point(COLUMNS), x[:4].tolist(), max_iterations=most)
    centres, steps = lloyd(x, x[:4], most)
    assert run.iterations == steps and run.converged == (steps < most)
    assert np.allclose(run.centres, centres)
    assert sum(run.sizes) == 400 and run.costs == sorted(run.costs, reverse=True)


def test_a_cluster_without_rows_keeps_its_centre(points):
    run = M.lloyd_run(points, K.point(COLUMNS), [[0.0, 0.0, 0.0], [1e6, 1e6, 1e6]], max_iterations=2)
    assert run.centres[1] == [1e6, 1e6, 1e6] and run.sizes[1] == 0


def test_candidates_do_not_depend_on_partitions(points):
    found = M.parallel_candidates(points, "id", K.point(COLUMNS), 4)
    assert found == M.parallel_candidates(points.repartition(7), "id", K.point(COLUMNS), 4)
    assert found != M.parallel_candidates(points, "id", K.point(COLUMNS), 4, seed=1)
    assert sum(c.weight for c in found) == 400 and {c.round for c in found} == {0, 1, 2}
    assert len(found) <= 1 + 3 * 2 * 8


def test_the_start_finds_all_groups(points):
    for seed in range(4):
        start = M.parallel_start(points, "id", K.point(COLUMNS), 4, seed=seed)
        nearest = {int(((SPOTS - np.array(c)) ** 2).sum(1).argmin()) for c in start}
        run = M.lloyd_run(points, K.point(COLUMNS), start)
        assert len(start) == 4
        assert nearest == {0, 1, 2, 3} or min(run.sizes) > 0


def test_starts_of_few_rows(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 2.0), (3, 5.0)], "id int, v double")
    assert sorted(M.parallel_start(df, "id", K.point(["v"]), 5)) == [(2.0,), (5.0,)]
    assert M.parallel_candidates(df.limit(0), "id", K.point(["v"]), 5) == []


def test_a_shared_sweep_is_the_single_runs(points):
    x = [[r[c] for c in COLUMNS] for r in points.orderBy("id").limit(6).collect()]
    starts = {k: x[:k] for k in (1, 2, 4, 6)}
    swept = {r["k"]: r for r in M.sweep_shared(points, K.point(COLUMNS), starts, max_iterations=8).collect()}
    for k, start in starts.items():
        run = M.lloyd_run(points, K.point(COLUMNS), start, max_iterations=8)
        assert swept[k]["iterations"] == run.iterations
        cost = K.clustering_cost(points, K.point(COLUMNS), run.centres).first()[0]
        assert swept[k]["cost"] == pytest.approx(cost)
        if k > 1:
            clustered = K.with_nearest(points, K.point(COLUMNS), run.centres)
            vectors = K.assembled(clustered, COLUMNS)
            assert swept[k]["silhouette"] == pytest.approx(K.silhouette(vectors))
    assert swept[1]["silhouette"] == 0


def test_scans_do_not_grow_with_the_number_of_sets(spark, points):
    x = [[r[c] for c in COLUMNS] for r in points.orderBy("id").limit(8).collect()]

    def jobs(ks):
        context, group = spark.sparkContext, f"sweep-{len(ks)}"
        context.setJobGroup(group, group)
        M.sweep_shared(points, K.point(COLUMNS), {k: x[:k] for k in ks}, max_iterations=2, tolerance=0.0).collect()
        return len(context.statusTracker().getJobIdsForGroup(group))

    try:
        assert jobs(range(2, 4)) == jobs(range(2, 9))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_saved_model_assigns_the_same(spark, points):
    path = fresh_path(spark, "model")
    model = M.ClusterModel.fit(points, "id", COLUMNS, 4)
    model.save(spark, path)
    loaded = M.ClusterModel.load(spark, path)
    assert loaded == model
    assert loaded.assign(points).collect() == model.assign(points).collect()
    sizes = [r["count"] for r in loaded.assign(points).groupBy("cluster").count().collect()]
    assert len(sizes) == 4 and min(sizes) > 90


def test_a_constant_column_is_scaled_to_zero(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0)], "id int, a double, b double")
    model = M.ClusterModel.fit(df, "id", ["a", "b"], starts=[[1.0, 5.0], [3.0, 5.0]])
    assert [c[1] for c in model.centres] == [0.0, 0.0]
    assert [r["cluster"] for r in model.assign(df).orderBy("id").collect()] == [0, 1]


def test_a_point_between_two_centres_is_in_the_first(spark):
    # (14, 903) lies just between (16, 902) and (12, 904), whatever the scales and however their sums are rounded
    for copies in range(1, 8):
        rows = [(0, 16, 902.0), (1, 12, 904.0), (2, 14, 903.0), (3, 31, 907.3), (4, 3, 1999.9), (5, 50, 900.1)]
        df = spark.createDataFrame([(10 * n + i, size, price) for n in range(copies) for i, size, price in rows], "id int, a int, b double")
        starts = [[16.0, 902.0], [12.0, 904.0], [31.0, 907.3], [3.0, 1999.9], [50.0, 900.1]]
        model = M.ClusterModel.fit(df, "id", ["a", "b"], starts=starts, max_iterations=1)
        unscaled = [[v * d + m for v, m, d in zip(c, model.mean, model.deviation)] for c in model.centres]
        assert np.allclose(unscaled, [[15.0, 902.5], *starts[1:]], atol=1e-9, rtol=0)


def test_a_shared_sweep_takes_the_first_of_centres_as_near(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 4.0), (3, 2.0)], "id int, v double")
    swept = M.sweep_shared(df, K.point(["v"]), {2: [[0.0], [4.0]], 1: [[5.0]]}, max_iterations=1).collect()
    assert {r["k"]: (r["cost"], r["iterations"]) for r in swept} == {2: (2.0, 1), 1: (8.0, 1)}


def test_a_shared_sweep_runs_no_interpreted_functions(spark, points, monkeypatch):
    """Higher-order functions over all centres are evaluated row by row without generated code."""
    used = []
    for name in ("transform", "aggregate", "zip_with", "filter", "from_json"):
        monkeypatch.setattr(M.F, name, lambda *a, name=name, **k: used.append(name))
    M.sweep_shared(points, F.array("a", "b", "c"), {2: [[0.0] * 3, [9.0] * 3]}, max_iterations=2).collect()
    assert not used


def test_what_a_load_refuses(spark, points):
    model = M.ClusterModel(["a", "b"], [0.0, 0.0], [1.0, 1.0], [[0.0, 0.0]])

    def saved(change=lambda df: df):
        path, other = fresh_path(spark, "model"), fresh_path(spark, "model")
        model.save(spark, path)
        change(spark.read.parquet(path)).write.parquet(other)
        return other

    assert M.ClusterModel.load(spark, saved()) == model
    for change, words in (
        (lambda df: df.withColumn("version", F.lit(9)), "version 9"),
        (lambda df: df.drop("mean"), "no saved model"),
        (lambda df: df.withColumn("mean", F.col("mean").cast("array<float>")), "no saved model"),
        (lambda df: df.limit(0), "has no model"),
        (lambda df: df.unionByName(df), "more than one"),
        (lambda df: df.withColumn("deviation", F.array(F.lit(1.0))), "parts of"),
    ):
        with pytest.raises(ValueError, match=words):
            M.ClusterModel.load(spark, saved(change))
    with pytest.raises(ValueError, match="missing or no numbers: b"):
        model.assign(points.withColumn("b", F.lit("text")))

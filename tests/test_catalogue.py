"""Every query against its SQL twin, and the invariants of those without one."""

import pytest
from compare import connect, differences
from conftest import SMALL

from __spark_entry__ import entry, oracle_sql, queries
from brightloom.plans.catalogue import QUERIES

ROWS_ONLY = {"column_medians_approx", "kmeans_fit", "kmeans_elbow", "kmeans_silhouette_sweep"}


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_only_known_queries_lack_sql():
    assert {name for name, query in QUERIES.items() if query.sql is None} == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, connection, name):
    assert differences(queries()[name](spark, SMALL), connection, oracle_sql()[name]) is None


def test_entry(spark):
    assert entry(spark).columns == ["class", "precision", "recall", "f1", "support"]


def test_approximate_medians_are_close(spark):
    approximate = queries()["column_medians_approx"](spark, SMALL).first().asDict()
    exact = queries()["column_medians"](spark, SMALL).first().asDict()
    assert approximate == pytest.approx(exact, rel=0.01)


def test_fitted_clusters_cover_all_rows(spark):
    sizes = queries()["kmeans_fit"](spark, SMALL).collect()
    assert len(sizes) == 5
    assert sum(row["size"] for row in sizes) == spark.read.parquet(f"{SMALL}/embeddings.parquet").count()


def test_sweeps(spark):
    elbow = {row["k"]: row["cost"] for row in queries()["kmeans_elbow"](spark, SMALL).collect()}
    sweep = queries()["kmeans_silhouette_sweep"](spark, SMALL).collect()
    assert sorted(elbow) == [row["k"] for row in sweep] == list(range(2, 15))
    assert elbow[2] > elbow[14]
    assert all(-1 <= row["silhouette"] <= 1 for row in sweep)

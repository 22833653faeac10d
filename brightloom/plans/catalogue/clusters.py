"""Scaling and k-means: ``part`` with two columns, ``embeddings`` with 64."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.operators import clusters as K
from brightloom.operators import kmeans as M
from brightloom.plans import table_jobs
from brightloom.plans.catalogue.registry import Register, rounded, table
from brightloom.plans.catalogue.tables import WIDTH, wide
from brightloom.workspace import fresh_path

register = Register()

PART = ("p_size", "p_retailprice")
SQL_PART = "SELECT p_partkey, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y FROM part"
SQL_PART_CENTRES = f"""
    points AS MATERIALIZED ({SQL_PART}),
    centres AS MATERIALIZED (
        SELECT CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS INT) AS cluster, x AS cx, y AS cy
        FROM (SELECT * FROM points ORDER BY p_partkey LIMIT 5)),
    assigned AS MATERIALIZED (
        SELECT p_partkey, x, y, cluster, distance FROM (
            SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY distance, cluster) AS place FROM (
                SELECT p_partkey, x, y, cluster, (x - cx) * (x - cx) + (y - cy) * (y - cy) AS distance
                FROM points, centres))
        WHERE place = 1)
    """
SQL_EMBEDDING_CENTRES = """
    points AS MATERIALIZED (
        SELECT vec_id, CAST(unnest(range(0, len(embedding))) AS INT) AS dimension, CAST(unnest(embedding) AS DOUBLE) AS x
        FROM embeddings),
    keys AS (
        SELECT vec_id AS centre_id, CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INT) AS cluster
        FROM (SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT 5)),
    centres AS MATERIALIZED (
        SELECT cluster, dimension, x AS c FROM keys JOIN points ON vec_id = centre_id),
    assigned AS MATERIALIZED (
        SELECT vec_id, cluster, distance FROM (
            SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, cluster) AS place FROM (
                SELECT vec_id, cluster, sum((x - c) * (x - c)) AS distance
                FROM points JOIN centres USING (dimension) GROUP BY vec_id, cluster))
        WHERE place = 1)
    """


def parts(spark, folder) -> DataFrame:
    return table(spark, folder, "part").select("p_partkey", *PART)


def embeddings(spark, folder) -> DataFrame:
    return table(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("point"))


def assigned_parts(spark, folder) -> DataFrame:
    source = parts(spark, folder)
    centres = K.first_centres(source, "p_partkey", K.point(PART))
    return K.with_nearest(source, K.point(PART), centres)


@register.query(
    "SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price FROM part WHERE p_size % 7 <> 0"
)
def assemble_skip_invalid(spark, folder):
    gappy = parts(spark, folder).withColumn("p_size", F.when(F.col("p_size") % 7 != 0, F.col("p_size")))
    values = vector_to_array(K.FEATURES)
    return K.assembled(gappy, PART, "skip").select("p_partkey", values[0].alias("size"), values[1].alias("price"))


@register.query(
    "SELECT p_partkey, round((x - avg(x) OVER ()) / stddev_samp(x) OVER (), 6) AS size,"
    f" round((y - avg(y) OVER ()) / stddev_samp(y) OVER (), 6) AS price FROM ({SQL_PART})"
)
def standard_scale(spark, folder):
    values = vector_to_array(K.SCALED)
    scaled = K.standardised(K.assembled(parts(spark, folder), PART))
    return scaled.select("p_partkey", rounded(values[0]).alias("size"), rounded(values[1]).alias("price"))


@register.query(
    f"WITH {SQL_EMBEDDING_CENTRES}, sizes AS (SELECT cluster, count(*) AS size, sum(distance) AS cost FROM assigned"
    " GROUP BY cluster), means AS (SELECT cluster, dimension, avg(x) AS mean FROM assigned JOIN points USING (vec_id)"
    " GROUP BY cluster, dimension) SELECT cluster, size, round(cost, 6) AS cost, dimension, round(mean, 6) AS mean"
    " FROM sizes JOIN means USING (cluster)"
)
def kmeans_lloyd_step(spark, folder):
    source, point = embeddings(spark, folder), F.col("point")
    step = K.lloyd_step(source, point, K.first_centres(source, "vec_id", point))
    return step.select(
        "cluster", "size", rounded("cost").alias("cost"), F.posexplode("centre").alias("dimension", "mean")
    ).withColumn("mean", rounded("mean"))


@register.query(f"WITH {SQL_PART_CENTRES} SELECT p_partkey, cluster, round(distance, 6) AS distance FROM assigned")
def kmeans_assign(spark, folder):
    return assigned_parts(spark, folder).select("p_partkey", "cluster", rounded("distance").alias("distance"))


@register.query(f"WITH {SQL_EMBEDDING_CENTRES} SELECT round(sum(distance), 6) AS cost FROM assigned")
def kmeans_cost(spark, folder):
    source, point = embeddings(spark, folder), F.col("point")
    cost = K.clustering_cost(source, point, K.first_centres(source, "vec_id", point))
    return cost.select(rounded("cost").alias("cost"))


@register.query(
    f"""WITH {SQL_PART_CENTRES},
    sums AS (
        SELECT cluster, count(*)::DOUBLE AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x + y * y) AS q
        FROM assigned GROUP BY cluster),
    distances AS (
        SELECT p_partkey, a.cluster AS own, s.cluster AS other, n,
            x * x + y * y - 2 * (x * sx + y * sy) / n + q / n AS mean_distance
        FROM assigned a, sums s),
    sides AS (
        SELECT p_partkey,
            max(CASE WHEN own = other THEN CASE WHEN n > 1 THEN mean_distance * n / (n - 1) ELSE 0 END END) AS a,
            max(CASE WHEN own = other THEN n END) AS n,
            min(CASE WHEN own <> other THEN mean_distance END) AS b
        FROM distances GROUP BY p_partkey)
    SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM sides"""
)
def silhouette(spark, folder):
    clustered = assigned_parts(spark, folder).withColumn(K.FEATURES, array_to_vector(K.point(PART)))
    score = K.silhouette(clustered)
    return spark.createDataFrame([(score,)], "silhouette double").select(rounded("silhouette").alias("silhouette"))


@register.query(f"WITH {SQL_PART_CENTRES} SELECT p_partkey, cluster FROM assigned ORDER BY p_partkey LIMIT 10")
def cluster_preview(spark, folder):
    return assigned_parts(spark, folder).select("p_partkey", "cluster").orderBy("p_partkey").limit(10)


MEASURES = [f"m{i}" for i in range(WIDTH)]


@register.query()
def kmeans_fit(spark, folder):
    """The training job on 64 columns, saved, loaded and applied."""
    source, path = wide(spark, folder).select(*MEASURES), fresh_path(spark, "clusters")
    table_jobs.train_clusters(source, path)
    clustered = K.assign_clusters(source, table_jobs.load_clusters(path))
    return clustered.groupBy(K.CLUSTER).agg(F.count(F.lit(1)).alias("size"))


@register.query()
def kmeans_elbow(spark, folder):
    return K.sweep(K.assembled(parts(spark, folder), PART))


@register.query()
def kmeans_silhouette_sweep(spark, folder):
    return K.sweep(K.assembled(parts(spark, folder), PART), with_silhouette=True)


def sql_nearest(points: str, centres: str) -> str:
    """``k, cluster, distance`` of the centre nearest to each point in each set, the lower number on a tie."""
    return f"""SELECT k, p_partkey, x, y, cluster, distance FROM (
        SELECT *, row_number() OVER (PARTITION BY k, p_partkey ORDER BY distance, cluster) AS place FROM (
            SELECT k, p_partkey, x, y, cluster, (x - cx) * (x - cx) + (y - cy) * (y - cy) AS distance
            FROM {points}, {centres}))
        WHERE place = 1"""


def sql_lloyd(points: str, ks: str, steps: int) -> str:
    """Common table expressions of so many steps from the points of smallest keys: the centres ``c0, c1, ...``."""
    parts = [
        f"points AS MATERIALIZED ({points})",
        f"""c0 AS MATERIALIZED (SELECT k, cluster, cx, cy FROM ({ks}), (
            SELECT CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS INT) AS cluster, x AS cx, y AS cy FROM points)
            WHERE cluster < k)""",
    ]
    for i in range(steps):
        parts += [
            f"a{i} AS MATERIALIZED ({sql_nearest('points', f'c{i}')})",
            f"""c{i + 1} AS MATERIALIZED (
                SELECT c.k, c.cluster, coalesce(avg(x), any_value(cx)) AS cx, coalesce(avg(y), any_value(cy)) AS cy
                FROM c{i} c LEFT JOIN a{i} a ON a.k = c.k AND a.cluster = c.cluster GROUP BY c.k, c.cluster)""",
        ]
    return ", ".join(parts)


FIVE, ALL_K = "SELECT 5 AS k", "SELECT unnest(range(2, 15))::INT AS k"
SQL_SCALED_PART = f"""SELECT p_partkey, (x - avg(x) OVER ()) / stddev_samp(x) OVER () AS x,
    (y - avg(y) OVER ()) / stddev_samp(y) OVER () AS y FROM ({SQL_PART})"""
STEPS = 3


@register.query(
    f"WITH {sql_lloyd(SQL_PART, FIVE, STEPS)} SELECT c.cluster, count(p_partkey) AS size, round(any_value(cx), 6) AS x,"
    f" round(any_value(cy), 6) AS y FROM c{STEPS} c LEFT JOIN a{STEPS - 1} a USING (cluster) GROUP BY c.cluster"
)
def kmeans_lloyd_run(spark, folder):
    """Iterations from fixed starting points."""
    source = parts(spark, folder)
    starts = K.first_centres(source, "p_partkey", K.point(PART))
    run = M.lloyd_run(source, K.point(PART), starts, max_iterations=STEPS)
    at = F.col("centre")
    return M.centre_table(spark, run).select("cluster", "size", rounded(at[0]).alias("x"), rounded(at[1]).alias("y"))


def sql_draw(label: str) -> str:
    return f"('0x' || substr(md5('{K.SEED}|{label}|' || p_partkey), 1, {M.HASH_DIGITS}))::BIGINT::DOUBLE / {16**M.HASH_DIGITS}::DOUBLE"


def sql_candidates() -> str:
    parts = [
        f"points AS MATERIALIZED ({SQL_PART})",
        f"k0 AS MATERIALIZED (SELECT p_partkey, 0 AS round, x AS cx, y AS cy FROM points ORDER BY {sql_draw('0')}, p_partkey LIMIT 1)",
    ]
    for i in range(1, M.INIT_ROUNDS + 1):
        parts += [
            f"""d{i} AS MATERIALIZED (SELECT p.p_partkey, x, y, min((x - cx) * (x - cx) + (y - cy) * (y - cy)) AS distance
                FROM points p, k{i - 1} GROUP BY p.p_partkey, x, y)""",
            f"""k{i} AS MATERIALIZED (SELECT * FROM k{i - 1} UNION ALL SELECT p_partkey, {i}, x, y FROM d{i}
                WHERE {sql_draw(str(i))} < distance * {2.0 * K.DEFAULT_K} / (SELECT sum(distance) FROM d{i}))""",
        ]
    return f"""{", ".join(parts)}, candidates AS MATERIALIZED (
        SELECT 1 AS k, CAST(row_number() OVER (ORDER BY round, p_partkey) - 1 AS INT) AS cluster, p_partkey AS key, round, cx, cy
        FROM k{M.INIT_ROUNDS}), assigned AS ({sql_nearest("points", "candidates")})"""


@register.query(
    f"WITH {sql_candidates()} SELECT key, round, round(cx, 6) AS x, round(cy, 6) AS y, count(a.p_partkey) AS weight"
    " FROM candidates c LEFT JOIN assigned a USING (cluster) GROUP BY key, round, cx, cy"
)
def kmeans_parallel_init(spark, folder):
    """Oversampled starting points and the rows nearest to each."""
    found = M.parallel_candidates(parts(spark, folder), "p_partkey", K.point(PART))
    rows = [(c.key, c.round, *map(float, c.centre), c.weight) for c in found]
    table = spark.createDataFrame(rows, "key long, round int, x double, y double, weight long")
    return table.withColumns({"x": rounded("x"), "y": rounded("y")})


@register.query(
    f"""WITH {sql_lloyd(SQL_PART, ALL_K, STEPS)}, final AS MATERIALIZED ({sql_nearest("points", f"c{STEPS}")}),
    sums AS MATERIALIZED (
        SELECT k, cluster, count(*)::DOUBLE AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x + y * y) AS q FROM final GROUP BY k, cluster),
    distances AS (
        SELECT a.k, p_partkey, a.cluster AS own, s.cluster AS other, n,
            x * x + y * y - 2 * (x * sx + y * sy) / n + q / n AS mean_distance
        FROM final a JOIN sums s ON a.k = s.k),
    sides AS (
        SELECT k, p_partkey,
            max(CASE WHEN own = other THEN CASE WHEN n > 1 THEN mean_distance * n / (n - 1) ELSE 0 END END) AS a,
            max(CASE WHEN own = other THEN n END) AS n,
            min(CASE WHEN own <> other THEN mean_distance END) AS b
        FROM distances GROUP BY k, p_partkey),
    scores AS (
        SELECT k, avg(CASE WHEN n = 1 OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM sides GROUP BY k)
    SELECT k, round(sum(distance), 4) AS cost, round(any_value(silhouette), 6) AS silhouette
    FROM final JOIN scores USING (k) GROUP BY k"""
)
def kmeans_sweep_shared(spark, folder):
    """Cost and silhouette for 2 to 14 clusters; all sets of centres move in the same scans."""
    source = parts(spark, folder)
    first = K.first_centres(source, "p_partkey", K.point(PART), max(K.SWEEP))
    starts = {k: first[:k] for k in K.SWEEP}
    swept = M.sweep_shared(source, K.point(PART), starts, max_iterations=STEPS)
    return swept.select("k", rounded("cost", 4).alias("cost"), rounded("silhouette").alias("silhouette"))


@register.query(
    f"WITH {sql_lloyd(SQL_SCALED_PART, FIVE, STEPS)} SELECT p_partkey, cluster, round(distance, 6) AS distance"
    f" FROM ({sql_nearest('points', f'c{STEPS}')})"
)
def pipeline_reload(spark, folder):
    """Clusters by a model that was fitted, saved as a table and loaded again."""
    source, path = parts(spark, folder), fresh_path(spark, "model")
    starts = K.first_centres(source, "p_partkey", K.point(PART))
    M.ClusterModel.fit(source, "p_partkey", PART, starts=starts, max_iterations=STEPS).save(spark, path)
    assigned = M.ClusterModel.load(spark, path).assign(source)
    return assigned.select("p_partkey", "cluster", rounded("distance").alias("distance"))

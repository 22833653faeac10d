"""Cleaning and profiling of numeric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.operators import columns as C
from brightloom.operators import medians as M
from brightloom.operators import sketches as K
from brightloom.plans import table_jobs
from brightloom.plans.catalogue.registry import Register, rounded, table
from brightloom.sources.readers import read_delimited
from brightloom.sources.writers import write_delimited
from brightloom.workspace import fresh_path

register = Register()

MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

# lineitem with gaps and negative values made by rules on the row's own values
GAPPY = {
    "quantity": "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_quantity - 10 END",
    "price": "CASE WHEN l_linenumber % 3 = 0 OR l_quantity > 45 THEN NULL ELSE l_extendedprice / 40 END",
    "discount": "CASE WHEN l_linenumber % 3 = 0 AND l_tax < 0.05 THEN NULL ELSE l_discount END",
    "tax": "CASE WHEN l_linenumber % 3 = 0 AND l_tax < 0.05 THEN NULL ELSE l_tax END",
}
SQL_GAPPY = "SELECT " + ", ".join(f"{rule} AS {name}" for name, rule in GAPPY.items()) + " FROM lineitem"
SQL_ANY_VALUE = f"coalesce({', '.join(GAPPY)}) IS NOT NULL"


def gappy(spark, folder) -> DataFrame:
    source = table(spark, folder, "lineitem")
    return source.select(*(F.expr(rule).alias(name) for name, rule in GAPPY.items()))


def sql_each(expression: str, names=GAPPY) -> str:
    return ", ".join(f"{expression.format(name)} AS {name}" for name in names)


@register.query(f"SELECT {', '.join(MEASURES)}, l_returnflag, l_linestatus, l_shipdate FROM lineitem")
def column_slice(spark, folder):
    """The whole table but its first four columns."""
    return C.columns_from(table(spark, folder, "lineitem"), 4)


@register.query(f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {', '.join(MEASURES)} FROM lineitem")
def numeric_only(spark, folder):
    return C.numeric_only(table(spark, folder, "lineitem"))


@register.query(f"SELECT * FROM ({SQL_GAPPY}) WHERE {SQL_ANY_VALUE}")
def drop_all_null(spark, folder):
    return C.drop_all_null(gappy(spark, folder))


@register.query(f"SELECT {sql_each('coalesce({0}, 0.0)')} FROM ({SQL_GAPPY})")
def fill_zero(spark, folder):
    return C.fill_zero(gappy(spark, folder))


SQL_MIXED = (
    "SELECT l_orderkey, CASE WHEN l_linenumber % 4 = 0 THEN l_returnflag ELSE CAST(l_quantity AS {text}) END AS amount,"
    " l_linestatus AS status FROM lineitem"
)


@register.query(
    "SELECT l_orderkey, try_cast(amount AS DOUBLE) AS amount, try_cast(status AS DOUBLE) AS status"
    f" FROM ({SQL_MIXED.format(text='VARCHAR')})"
)
def coerce_double(spark, folder):
    mixed = table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_linenumber") % 4 == 0, F.col("l_returnflag"))
        .otherwise(F.col("l_quantity").cast("string")).alias("amount"),
        F.col("l_linestatus").alias("status"),
    )
    return C.coerce_double(mixed)


SQL_MEDIANS = f"SELECT {sql_each('quantile_disc({0}, 0.5)')} FROM ({SQL_GAPPY})"


@register.query(f"SELECT {sql_each('round({0}, 6)')} FROM ({SQL_MEDIANS})")
def column_medians(spark, folder):
    medians = M.exact_median_values(gappy(spark, folder))
    return spark.createDataFrame([medians], ", ".join(f"{c} double" for c in GAPPY)).select(
        *(rounded(c).alias(c) for c in GAPPY)
    )


@register.query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(quantile_disc({c}, 0.5), 6) AS median FROM ({SQL_GAPPY})" for c in GAPPY
    )
)
def column_medians_long(spark, folder):
    medians = M.median_table(spark, M.exact_median_values(gappy(spark, folder), batch_size=2))
    return medians.select("column", rounded("median").alias("median"))


@register.query()
def column_medians_approx(spark, folder):
    return M.approximate_medians(gappy(spark, folder))


@register.query(
    f"WITH gappy AS ({SQL_GAPPY}), medians AS ({SQL_MEDIANS}) SELECT "
    + ", ".join(
        f"round(CASE WHEN g.{c} < 0 OR g.{c} > 1000 THEN m.{c} ELSE g.{c} END, 6) AS {c}" for c in GAPPY
    )
    + " FROM gappy g, medians m"
)
def outlier_to_median(spark, folder):
    source = gappy(spark, folder)
    cleaned = C.replace_outliers(source, M.exact_median_values(source))
    return cleaned.select(*(rounded(c).alias(c) for c in GAPPY))


@register.query(
    f"SELECT count(*) AS rows_in, count(*) FILTER (WHERE {SQL_ANY_VALUE}) AS rows_left FROM ({SQL_GAPPY})"
)
def rows_after_filter(spark, folder):
    return C.rows_before_after(gappy(spark, folder))


@register.query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean,"
        f" round(stddev_samp({c}), 4) AS stddev, round(min({c}), 4) AS min, round(max({c}), 4) AS max"
        f" FROM ({SQL_GAPPY})"
        for c in GAPPY
    )
)
def describe_numeric(spark, folder):
    described = C.describe(gappy(spark, folder))
    return described.select("column", "count", *(rounded(s, 4).alias(s) for s in ("mean", "stddev", "min", "max")))


DOCUMENT_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


@register.query(
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{name}' AS \"column\", '{kind}' AS type, count(*) AS rows, count({name}) AS non_null"
        " FROM documents"
        for i, (name, kind) in enumerate(DOCUMENT_TYPES.items())
    )
)
def table_profile(spark, folder):
    return C.profile(table(spark, folder, "documents"))


# the 64 values of an embedding as columns, small ones missing, about half of them negative
WIDTH = 64
SQL_WIDE = (
    "SELECT vec_id, label, "
    + ", ".join(
        f"CASE WHEN abs(CAST(embedding[{i + 1}] AS DOUBLE)) < 0.02 THEN NULL ELSE CAST(embedding[{i + 1}] AS DOUBLE) * 4000 END AS m{i}"
        for i in range(WIDTH)
    )
    + " FROM embeddings"
)


def wide(spark, folder) -> DataFrame:
    def measure(i: int):
        value = F.col("embedding")[i].cast("double")
        return F.when(F.abs(value) < F.lit(0.02), None).otherwise(value * 4000).alias(f"m{i}")

    return table(spark, folder, "embeddings").select("vec_id", "label", *map(measure, range(WIDTH)))


SQL_FILLED = (
    "SELECT " + ", ".join(f"coalesce(m{i}, 0.0) AS m{i}" for i in range(WIDTH))
    + f" FROM ({SQL_WIDE}) WHERE coalesce({', '.join(f'm{i}' for i in range(WIDTH))}) IS NOT NULL"
)


@register.query(
    f"WITH filled AS ({SQL_FILLED}), medians AS (SELECT "
    + ", ".join(f"quantile_disc(m{i}, 0.5) AS m{i}" for i in range(WIDTH))
    + " FROM filled) SELECT "
    + ", ".join(
        f"round(CASE WHEN f.m{i} < 0 OR f.m{i} > 1000 THEN m.m{i} ELSE f.m{i} END, 6) AS m{i}" for i in range(WIDTH)
    )
    + " FROM filled f, medians m"
)
def clean_wide_table(spark, folder):
    cleaned = table_jobs.clean_wide_table(wide(spark, folder), 2, exact=True)
    return cleaned.select(*(rounded(c).alias(c) for c in cleaned.columns))


@register.query(SQL_GAPPY.replace("SELECT", "SELECT l_orderkey,", 1))
def tsv_roundtrip(spark, folder):
    rules = (F.expr(rule).alias(name) for name, rule in GAPPY.items())
    source, path = table(spark, folder, "lineitem").select("l_orderkey", *rules), fresh_path(spark, "tsv")
    write_delimited(source, path)
    return read_delimited(spark, path, source.schema)


@register.query(
    f"WITH filled AS (SELECT {', '.join(f'coalesce({c}, 0.0) AS {c}' for c in GAPPY)} FROM ({SQL_GAPPY})"
    f" WHERE {SQL_ANY_VALUE}), medians AS (SELECT "
    + ", ".join(f"quantile_disc({c}, 0.5) AS {c}" for c in GAPPY)
    + " FROM filled) SELECT "
    + ", ".join(f"round(CASE WHEN f.{c} < 0 OR f.{c} > 1000 THEN m.{c} ELSE f.{c} END, 6) AS {c}" for c in GAPPY)
    + " FROM filled f, medians m"
)
def clean_wide_file(spark, folder):
    """The job from file to file."""
    rules = (F.expr(rule).alias(name) for name, rule in GAPPY.items())
    source = table(spark, folder, "lineitem").select("l_orderkey", *rules)
    given, cleaned = fresh_path(spark, "wide"), fresh_path(spark, "cleaned")
    write_delimited(source, given)
    table_jobs.clean_wide_file(spark, given, cleaned, source.schema.simpleString()[7:-1].replace(":", " "), 1, exact=True)
    back = read_delimited(spark, cleaned, ", ".join(f"{c} double" for c in GAPPY))
    return back.select(*(rounded(c).alias(c) for c in GAPPY))


#: Sketches of twice the size, so that the bound holds for as good as all of them and not for 99 of 100.
CHECKED_SIZE = 1600


@register.query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS n, TRUE AS within FROM ({SQL_GAPPY})" for c in GAPPY))
def median_rank_check(spark, folder):
    """Whether medians of stored and merged sketches have the rank they should; the table arrives in two files."""
    source, path = fresh_path(spark, "gappy"), fresh_path(spark, "sketches")
    rows = gappy(spark, folder)
    small = F.coalesce(F.col("quantity") < 15, F.lit(False))
    for part in (rows.where(small), rows.where(~small)):
        part.write.mode("append").parquet(source)
        table_of_files = K.with_file(spark.read.schema(rows.schema).parquet(source))
        stored = K.store_sketches(spark, table_of_files, list(GAPPY), path, CHECKED_SIZE)
    medians = K.sketched_medians(stored, list(GAPPY), CHECKED_SIZE)
    return K.rank_check(rows, medians, K.rank_error(CHECKED_SIZE // 2))

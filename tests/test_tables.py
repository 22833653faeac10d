import math
import random

import pytest

from brightloom.operators import columns as C
from brightloom.operators import medians as M
from brightloom.plans import table_jobs
from brightloom.sources.readers import read_delimited
from brightloom.workspace import fresh_path

NAN = float("nan")


@pytest.fixture
def gappy(spark):
    rows = [(1.0, None, "x", 3), (None, None, None, None), (NAN, 2.0, "7.5", None), (-5.0, 1000.0, None, 1)]
    return spark.createDataFrame(rows, "`fat_100g` double, `b12-vit_100g` double, note string, n bigint")


def values(df):
    return [tuple(row) for row in df.collect()]


def test_slice_and_types(gappy):
    assert C.columns_from(gappy, 2).columns == ["note", "n"]
    assert C.numeric_only(gappy).columns == ["fat_100g", "b12-vit_100g", "n"]


def test_drop_all_null_keeps_nan(gappy):
    assert C.drop_all_null(gappy).count() == 3
    only_nan = gappy.select("fat_100g")
    assert C.drop_all_null(only_nan).count() == 3
    assert values(C.rows_before_after(gappy)) == [(4, 3)]


def test_fill_zero_leaves_texts(gappy):
    filled = values(C.fill_zero(gappy))
    assert filled[1] == (0.0, 0.0, None, 0)
    assert filled[2] == (0.0, 2.0, "7.5", 0)
    assert values(C.fill_zero(gappy, ["n"]))[1] == (None, None, None, 0)


def test_coerce_double(gappy):
    assert [row[2] for row in values(C.coerce_double(gappy))] == [None, None, 7.5, None]
    assert dict(C.coerce_double(gappy, gappy.columns).dtypes) == dict.fromkeys(gappy.columns, "double")


def test_coerce_texts_that_look_odd(spark):
    texts = ["1e3", " 2 ", "-.5", "NaN", "Infinity", "-inf", "abc", "", "1,5", "0x10", "info", None, "5 g"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    found = [r["v"] for r in C.coerce_double(df).orderBy("i").collect()]
    plain = [r["v"] for r in df.selectExpr("i", "try_cast(v AS double) AS v").orderBy("i").collect()]
    assert repr(found) == repr(plain)
    assert found[:3] == [1000.0, 2.0, -0.5] and found[6] is None


def test_outliers(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1000.0, -0.1, 1000.1, None, 5.0)], "v double")
    assert [row[0] for row in values(C.replace_outliers(df, {"v": 7.0}))] == [0.0, 1000.0, 7.0, 7.0, None, 5.0]
    assert values(C.replace_outliers(df, {"v": None})) == values(df)


def test_describe_and_profile(gappy):
    row = {r["column"]: r for r in C.describe(gappy).collect()}["n"]
    assert (row["count"], row["mean"], row["min"], row["max"]) == (2, 2.0, 1.0, 3.0)
    assert row["stddev"] == pytest.approx(math.sqrt(2))
    assert [tuple(r) for r in C.profile(gappy).collect()][2] == (2, "note", "string", 4, 2)


def lower_median(numbers):
    present = sorted(v for v in numbers if v is not None)
    return present[math.ceil(len(present) / 2) - 1] if present else None


@pytest.mark.parametrize("few_rows", [0, 3, 50, 10_000])
def test_exact_medians(spark, few_rows):
    draw = random.Random(5)
    columns = {
        "uniform": [draw.uniform(-1e6, 1e6) for _ in range(4001)],
        "half_zero": [0.0 if draw.random() < 0.5 else draw.expovariate(1) for _ in range(4001)],
        "two_values": [float(i % 2) for i in range(4001)],
        "constant": [4.0] * 4001,
        "gaps": [None if draw.random() < 0.9 else draw.gauss(0, 1) for _ in range(4001)],
        "empty": [None] * 4001,
        "single": [None] * 4000 + [2.5],
        "heavy_tail": [draw.paretovariate(0.3) for _ in range(4001)],
    }
    schema = ", ".join(f"{name} double" for name in columns)
    df = spark.createDataFrame(list(zip(*columns.values())), schema).repartition(4)
    expected = {name: lower_median(numbers) for name, numbers in columns.items()}
    assert M.exact_median_values(df, batch_size=5, few_rows=few_rows) == expected


def test_many_columns_need_no_more_scans_than_one(spark, monkeypatch):
    draw = random.Random(6)
    rows = [[draw.gauss(0, 1) for _ in range(40)] for _ in range(6000)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(40))).repartition(4).cache()
    scans, aggregate = [], M._one_row
    monkeypatch.setattr(M, "_one_row", lambda *args: scans.append(1) or aggregate(*args))
    found = M.exact_median_values(df)
    assert len(scans) <= 4
    assert found == {f"c{i}": lower_median([row[i] for row in rows]) for i in range(40)}
    df.unpersist()


def test_medians_survive_a_sketch_that_misses():
    search = M._Search(rank=50, between=100, quantiles=[1.0, 2.0, 3.0, 4.0, 5.0, 6.0])
    assert search.next_bounds() == (3.0, 4.0)
    search.margin = 1
    assert search.next_bounds() == (2.0, 5.0)
    search.margin = 9
    assert search.next_bounds() == (None, None)


def test_approximate_medians_in_batches(spark):
    df = spark.createDataFrame([(float(i), float(-i), None) for i in range(1, 6)], "a double, b double, c double")
    assert M.approximate_median_values(df, batch_size=2) == {"a": 3.0, "b": -3.0, "c": None}


def test_clean_wide_file(spark):
    source, target = fresh_path(spark, "wide"), fresh_path(spark, "clean")
    rows = [("a", None, 2.0), ("b", None, None), ("c", 5000.0, 4.0), ("d", -1.0, 6.0), ("e", 7.0, 8.0)]
    spark.createDataFrame(rows, "code string, `x-1_100g` double, y_100g double").write.options(
        header=True, sep="\t"
    ).csv(source)
    table_jobs.clean_wide_file(spark, source, target, first_column=1, single_file=True)
    cleaned = read_delimited(spark, target)
    assert cleaned.columns == ["x-1_100g", "y_100g"]
    # row b is gone; the median of (0, 5000, -1, 7) at rank 2 is 0
    assert sorted(values(cleaned)) == [(0.0, 2.0), (0.0, 4.0), (0.0, 6.0), (7.0, 8.0)]

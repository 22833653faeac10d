"""Exact positions in a global order without one task that sees all rows.

Rows carry a fraction in [0, 1) by which they are ordered. Fractions are cut into cells, a few for
each shuffle partition; counts by cell (combined before the shuffle) say where each cell begins, and
a row number inside the cell gives the rest. A cell holds a share of the rows that shrinks with the
number of partitions, so no group or source of any size meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CELLS_PER_PARTITION = 8
SALTS = 128
HASH_BITS = 60


def n_cells(spark: SparkSession) -> int:
    return CELLS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))


def hash_of(*parts: Column | str | int) -> Column:
    """60 uniform bits of the parts' text; nulls have a hash of their own."""
    columns = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    text = F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("null")) for c in columns))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def fraction(bits: Column) -> Column:
    """The middle of the hash's own interval of [0, 1]."""
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**HASH_BITS))


def numbered(df: DataFrame, name: str, group: list[str], cell: str, order: list[str], *, times: str | None = None) -> DataFrame:
    """Add ``name``: the place from 0 of each row of a group, by cell and then by ``order``.

    A row stands for ``times`` equal ones, where such a column is given: its place is that of the first of them.
    ``df`` is evaluated twice and must give the same rows both times; ``group`` and ``cell`` hold no nulls.
    """
    keys = [*group, cell]
    before = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        df.groupBy(*keys)
        .agg((F.sum(times) if times else F.count("*")).alias("_n"))
        .select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begins"))
    )
    ordered = Window.partitionBy(*keys).orderBy(*order)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(times).over(earlier), F.lit(0)) if times else F.row_number().over(ordered) - 1
    return df.join(begins, keys).withColumn(name, F.col("_begins") + inside).drop("_begins")


def joined_by_source(rows: DataFrame, sources: DataFrame, bits: Column) -> DataFrame:
    """Rows with the columns of their ``_source``; a source of any size is dealt out over ``SALTS`` keys."""
    salted = rows.withColumn("_salt", bits % SALTS)
    every = sources.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(every, ["_source", "_salt"]).drop("_salt")

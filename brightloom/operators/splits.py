"""Train and test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.operators.columns import quoted

TRAIN, TEST = "train", "test"


def split_of(key: Column, test_percent: int = 20) -> Column:
    """``train`` or ``test`` by a hash of the key: the same row falls on the same side in every run.

    The hash needs no shuffle, no sort and no count, whatever the number of rows.
    """
    digest = F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    return F.when(F.pmod(digest, F.lit(100)) < test_percent, TEST).otherwise(TRAIN)


def train_test_split(df: DataFrame, key: str, test_percent: int = 20) -> DataFrame:
    return df.withColumn("split", split_of(F.col(key), test_percent))


HASH_BITS, STEP_BITS = 60, 15
FEW_ROWS = 5_000


def split_hash(key: Column) -> Column:
    """60 uniform bits of a key."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def exact_train_test_split(df: DataFrame, key: str, test_percent: int = 20, *, few_rows: int = FEW_ROWS) -> DataFrame:
    """Add ``split``: the ``ceil(test_percent * n / 100)`` rows of smallest hash are the test side, ties by key.

    The last of these is found by histograms, each of the next bits of the hashes in the bin where it must lie, until
    few rows are left in it: about two small aggregations for a billion rows, and no sort of all of them. Keys must be unique;
    rows that share one fall on the same side.
    """
    hashed = df.select(quoted(key).alias("key"), split_hash(quoted(key)).alias("hash"))
    low, high = 0, 1 << HASH_BITS
    rank = None
    while True:
        width = max(1, (high - low) >> STEP_BITS)
        inside = hashed.where((F.col("hash") >= low) & (F.col("hash") < high))
        bins = inside.groupBy(F.shiftright(F.col("hash") - F.lit(low), width.bit_length() - 1).alias("bin")).count()
        # as many as a histogram has bins
        counts = sorted((r["bin"], r["count"]) for r in bins.collect())
        if rank is None:
            n = sum(count for _, count in counts)
            rank = -(-n * test_percent // 100)
        if rank == 0:
            return df.withColumn("split", F.lit(TRAIN))
        for place, count in counts:
            if rank <= count:
                break
            rank -= count
        low, high = low + place * width, low + (place + 1) * width
        if count <= few_rows or width == 1:
            break
    left = hashed.where((F.col("hash") >= low) & (F.col("hash") < high))
    last = left.orderBy("hash", "key").limit(rank).collect()[-1]
    value, own = split_hash(quoted(key)), quoted(key)
    # nulls come first in the order of keys
    upto = own.isNull() if last["key"] is None else own.isNull() | (own <= F.lit(last["key"]))
    test = (value < last["hash"]) | ((value == last["hash"]) & upto)
    return df.withColumn("split", F.when(test, TEST).otherwise(TRAIN))

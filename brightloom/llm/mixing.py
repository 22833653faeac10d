"""Sources mixed to target weights by Poisson replication.

Every source has a rate: its share of the target bytes over the bytes it has. Each document draws
its number of copies by inverting the Poisson distribution with that mean at a uniform number
hashed from a seed, its key and its text; it is exploded into so many rows, and all copies get a
place in one global order by a second hash. DataFrame functions only. A draw depends on nothing but
the document and the rate, so that a lost task repeats it. Equal rows are counted before they are
ordered and told apart only afterwards; a row travels as one value, so no column of it can clash.

Defined results: a null text counts as an empty one and null sources as one source; null or
repeated keys and repeated rows are rows like any others; a source without a weight, or of weight 0, gets no copies; an
empty table gives no rows. Columns of the input named like an added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightloom.llm.numbering import fraction, hash_of, joined_by_source, n_cells, numbered
from brightloom.workspace import written

ROW_BYTES = 16
#: distributions of at most so many numbers (8 MB) are broadcast, a source's name counting as so many
BROADCAST_VALUES = 1_000_000
SOURCE_VALUES = 32


def _source(name: str):
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("null"))


def rates(
    docs: DataFrame,
    *,
    weights: DataFrame | None = None,
    temperature: float = 0.7,
    growth: float = 1.0,
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``_source, rate``: copies of a document of each source that are wanted on the mean.

    ``weights`` has columns ``source, weight``; without it a source weighs its bytes to the power
    ``temperature``. The target is ``growth`` times the bytes of the input, a text counting its
    UTF-8 bytes and 16 more.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_BYTES)
    sizes = docs.groupBy(_source(source).alias("_source")).agg(F.sum(size).cast("double").alias("_bytes"))
    if weights is None:
        weighed = sizes.withColumn("_weight", F.pow("_bytes", F.lit(temperature)))
    else:
        wanted = weights.groupBy(_source("source").alias("_source")).agg(F.sum("weight").cast("double").alias("_weight"))
        weighed = sizes.join(wanted, "_source", "left").fillna(0.0, ["_weight"])
    # one row of sums
    sums = weighed.agg(F.sum("_bytes"), F.sum("_weight")).first()
    target, weight = (growth * (sums[0] or 0.0)), sums[1] or 1.0
    return weighed.select("_source", (F.col("_weight") / F.lit(weight) * F.lit(target) / F.col("_bytes")).alias("rate"))


def distributions(rate: DataFrame) -> DataFrame:
    """For each source the Poisson distribution function at 0, 1, ... to where less than 1e-16 is left."""
    most = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 40)
    up_to = Window.partitionBy("_source").orderBy("k")
    chances = (
        rate.where("rate > 0")
        .select("_source", "rate", F.explode(F.sequence(F.lit(0), most.cast("int"))).alias("k"))
        .withColumn("_log_factorial", F.sum(F.when(F.col("k") > 1, F.log(F.col("k").cast("double"))).otherwise(0.0)).over(up_to))
        .withColumn("_chance", F.exp(F.col("k") * F.log("rate") - F.col("rate") - F.col("_log_factorial")))
        .withColumn("_below", F.sum("_chance").over(up_to))
    )
    return chances.groupBy("_source", "rate").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "_below"))), lambda x: x["_below"]).alias("_steps"))


def mix(
    docs: DataFrame,
    rate: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 0,
) -> DataFrame:
    """The columns of ``docs`` with ``rate, n_copies, copy`` (from 1) and ``position`` in the shuffled order."""
    added = {"rate", "n_copies", "copy", "position"}
    kept = [c for c in docs.columns if c.lower() not in added]
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    rows = docs.select(
        F.struct(*kept).alias("_row"), F.col(key).alias("_key"), _source(source).alias("_source"), crc.alias("_crc")
    )
    distinct = (
        rows.groupBy(*rows.columns)
        .agg(F.count("*").alias("_times"))
        .withColumn("_draw", hash_of(seed, "copies", F.col("_key"), F.col("_crc")))
    )
    drawn = (
        _with_steps(distinct, written(distributions(rate), "mixing-steps"))
        .withColumn("_uniform", fraction(F.col("_draw")))
        .withColumn("_n_copies", F.size(F.expr("filter(_steps, s -> s <= _uniform)")))
        .where("_n_copies > 0")
        .select("_row", "_key", "_crc", "_times", "rate", "_n_copies", F.explode(F.expr("sequence(1, _n_copies)")).alias("_copy"))
        .withColumn("_hash", hash_of(seed, "order", F.col("_key"), F.col("_crc"), F.col("_copy")))
        .withColumn("_cell", F.floor(fraction(F.col("_hash")) * n_cells(docs.sparkSession)))
    )
    placed = numbered(drawn, "_first", [], "_cell", ["_hash", "_key", "_crc", "_copy"], times="_times")
    return placed.withColumn("_more", F.explode(F.expr("sequence(0L, _times - 1)"))).select(
        *(F.col("_row")[c].alias(c) for c in kept),
        "rate",
        F.col("_n_copies").alias("n_copies"),
        F.col("_copy").alias("copy"),
        (F.col("_first") + F.col("_more")).alias("position"),
    )


def _with_steps(rows: DataFrame, steps: DataFrame) -> DataFrame:
    """Rows with the distribution of their ``_source``: broadcast while it is small, or joined over salted keys."""
    size = steps.agg(F.sum(F.size("_steps") + F.lit(SOURCE_VALUES))).first()[0] or 0
    if size <= BROADCAST_VALUES:
        return rows.join(F.broadcast(steps), "_source")
    return joined_by_source(rows, steps, F.col("_draw"))

"""Shards that each hold the mixture of sources: proportional stratified interleaving.

Within each source the rows get a rank by a seeded hash. A row of rank r (from 0) among n is placed at
(r + u) / n, where u is a number in [0, 1) hashed from the source, so that sources of equal sizes, and
sources of one row above all, spread over the whole order. Ordered by that fraction, the sources
interleave in proportion to their sizes, and cutting the order at equal counts gives shards that differ
by one row at most and each match the mixture. Equal rows are counted before they are ranked, and told
apart only afterwards. DataFrame functions only.

Defined results: a null text has the size of an empty one and the checksum 0; null sources are one
source; null or repeated keys and repeated rows are rows like any others (wholly equal rows may swap
places); fewer rows than shards leave shards empty; an empty table gives no rows. Further columns
are ignored unless carried; a carried column named like a result is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.llm.numbering import fraction, hash_of, joined_by_source, n_cells, numbered
from brightloom.workspace import written

ROW_BYTES = 16


RESULTS = ("size", "text_crc32", "position", "shard", "slot")


def described(docs: DataFrame, key: str, text: str, source: str, seed: int, carry: list[str]) -> DataFrame:
    """The key, the size, the checksum, the source, the hash and the carried columns of each distinct row, and how often it stands there."""
    whole = F.coalesce(F.col(text), F.lit(""))
    named_source = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))
    rows = docs.select(
        F.col(key).alias("_key"),
        (F.octet_length(whole) + F.lit(ROW_BYTES)).cast("long").alias("_size"),
        F.crc32(whole.cast("binary")).alias("_crc"),
        named_source.alias("_source"),
        *([F.struct(*carry).alias("_carried")] if carry else []),
    )
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("_times")).withColumn("_hash", hash_of(seed, F.col("_key"), F.col("_crc")))


def _placed(
    docs: DataFrame, n_shards: int, carry: list[str], key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0
) -> DataFrame:
    """``_key, _size, _crc, _carried, _position, _shard, _slot`` of each row."""
    spark = docs.sparkSession
    rows = written(described(docs, key, text, source, seed, carry), "shard-rows")
    total = rows.agg(F.sum("_times")).first()[0] or 0
    cells = n_cells(spark)
    per_cell = max(1.0, total / cells)
    sources = (
        rows.groupBy("_source")
        .agg(F.sum("_times").alias("_in_source"))
        .withColumn("_offset", fraction(hash_of(seed, "offset", F.col("_source"))))
    )
    own_cell = F.floor(fraction(F.col("_hash")) * F.ceil(F.col("_in_source") / F.lit(per_cell)))
    placed = joined_by_source(rows, sources, F.col("_hash")).withColumn("_cell", own_cell)
    ranked = numbered(placed, "_rank", ["_source"], "_cell", ["_hash", "_key", "_crc", "_size"], times="_times").drop("_cell")
    single = ranked.withColumn("_copy", F.explode(F.expr("sequence(0L, _times - 1)")))
    place = ((F.col("_rank") + F.col("_copy")).cast("double") + F.col("_offset")) / F.col("_in_source").cast("double")
    spread = written(single.withColumn("_place", place), "shard-ranks")
    ordered = numbered(
        spread.withColumn("_cell", F.floor(F.col("_place") * cells)), "_position", [], "_cell", ["_place", "_source"]
    )
    shard = F.expr(f"_position * {n_shards}L div {max(1, total)}L")
    slot = F.expr(f"_position - (_shard * {total}L + {n_shards - 1}L) div {n_shards}L")
    return ordered.withColumn("_shard", shard).withColumn("_slot", slot)


def shards(
    docs: DataFrame,
    n_shards: int,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 0,
    carry: list[str] | None = None,
) -> DataFrame:
    """A row for each document: ``key, size, text_crc32, position, shard, slot`` and the carried columns.

    ``position`` is the place in the interleaved order, ``slot`` the place in the shard.
    """
    carry = [c for c in carry or [] if c.lower() not in (key.lower(), *RESULTS)]
    placed = _placed(docs, n_shards, carry, key, text, source, seed)
    return placed.select(
        F.col("_key").alias(key),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.col("_position").alias("position"),
        F.col("_shard").cast("int").alias("shard"),
        F.col("_slot").alias("slot"),
        *(F.col("_carried")[c].alias(c) for c in carry),
    )


def write_shards(docs: DataFrame, path: str, n_shards: int, **options) -> None:
    """The documents themselves, in a folder ``shard=N`` each, in the order of their slots."""
    carry = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    placed = _placed(docs, n_shards, carry, **options).select(
        *(F.col("_carried")[c].alias(c) for c in carry), F.col("_shard").cast("int").alias("shard"), F.col("_slot").alias("slot")
    )
    placed.repartition("shard", F.expr("slot div 100000")).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)

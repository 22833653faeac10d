"""The pipeline over documents: each stage is an operator of ``brightloom.llm`` and keeps what the next one gets.

Every stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.llm import decontaminate, jaccard, mixing, quality, sharding
from brightloom.plans.catalogue.registry import Register, table
from brightloom.workspace import written

N_SHARDS = 40
ROW = "_row"


def whole_rows(docs: DataFrame) -> DataFrame:
    """Each row as one value next to its text, so that no column of it can clash with a result."""
    return docs.select(F.struct(*docs.columns).alias(ROW), "text")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base and the learned rules keep."""
    rules = quality.learn_rules(docs, table(spark, sf_dir, "labels"))
    counts = quality.text_counts(whole_rows(docs), key=ROW)
    return quality.judged(counts, rules).where("kept").select(f"{ROW}.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: that of the smallest key, nulls last; documents without words are groups of their own."""
    # nulls are hashed by their place, as a hash of columns skips them
    body = F.xxhash64(*docs.columns, *(F.col(c).isNull() for c in docs.columns))
    # a key may stand in several groups, so a row is told by its whole content as well
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("key"), body.alias("body"))
    # the row is one value, so that a column named like the place or a result is of no matter
    keyed = docs.select(place.alias(ROW), "text", F.struct(*docs.columns).alias("_given"))
    found = jaccard.near_duplicates(keyed, key=ROW)
    chosen = found.where(F.col(ROW) == F.col("component")).select(ROW).distinct()
    # a row that stands in the table twice is a copy as well
    return keyed.dropDuplicates([ROW]).join(chosen, ROW, "left_semi").select("_given.*")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in benchmark windows."""
    found = decontaminate.overlaps(whole_rows(docs), table(spark, sf_dir, "benchmark"), key=ROW)
    return decontaminate.judged(found).where("NOT contaminated").select(f"{ROW}.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents, so that sources weigh their bytes to the power 0.7."""
    return mixing.mix(docs, mixing.rates(docs, temperature=0.7)).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy in one of 40 shards."""
    return sharding.shards(docs, N_SHARDS, carry=["source"])


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Learned rules, components and matches of runs of words are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None

register = Register()


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


@register.query(ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of the mixed, decontaminated, deduplicated documents of quality."""
    return run(spark, sf_dir)

"""What five filters of documents remove, alone, together and in every order.

Two filters rest on words: row sums and numbers of entries of the document-term matrix
(:mod:`brightloom.llm.term_matrix`) decide them. The others are native expressions. A document comes down to the
set of filters that it fails, so all 120 orders follow from one small table of counts by set, part and label.

Whether a text is a copy needs no join of documents: copies share a hash, so a group of equal texts
comes down to how many of its rows have its smallest key, and a group of any size is added up before it is shuffled.

Defined results: null texts count as empty ones (they fail the first filter, and are copies of each other). A row with a
null key is no copy and no original. Rows that share their key and their text are both originals. Null parts count
as the empty string; a document with several labels has a label if any of them has it; labels without a document are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightloom.llm.term_matrix import term_matrix

FILTERS = "ABCDE"
LEAST_WORDS = 200
MARKS = "[#$%&*|]"
ORDERS = 120
#: Rows of one key are dealt out over so many tasks to meet their labels.
SALTS = 16


def failures(docs: DataFrame, *, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``key, part, body, short, repeated, shouting, marked`` of each document; ``body`` tells texts apart."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    flagged = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("body"),
        (100 * F.regexp_count(whole, F.lit("[A-Z]")) > 3 * F.length(whole)).alias("shouting"),
        whole.rlike(MARKS).alias("marked"),
        whole.alias("text"),
    )
    return term_matrix(flagged).row_sums().select(
        "row.key",
        "row.part",
        "row.body",
        (F.col("n_words") < LEAST_WORDS).alias("short"),
        (100 * F.col("n_distinct") < 50 * F.col("n_words")).alias("repeated"),
        "row.shouting",
        "row.marked",
    )


def _mask(*flags: str) -> Column:
    """Bit k is set for a document that fails the k-th filter."""
    return sum((F.col(flag).cast("int") * (1 << k) for k, flag in enumerate(flags)), F.lit(0))


def failure_counts(found: DataFrame, labels: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """``part, failed, good, toxic, n``: documents by the set of filters they fail, as bits from A on."""
    known = labels.groupBy(F.col(key).alias("key")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # all rows of one key and text count as one from here on
    alike = (
        found.groupBy("key", "part", "body")
        .agg(F.first(_mask("short", "repeated", "shouting", "marked")).alias("failed"), F.count("*").alias("n"))
        .withColumn("salt", F.pmod(F.xxhash64("body"), F.lit(SALTS)).cast("int"))
        # Spark takes them for as few as the compressed file has, and would broadcast them salted through the driver
        .join(known.hint("merge"), ["key", "salt"], "left")
        .select("key", "part", "body", "failed", "n", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")))
    )
    rows = F.struct("key", "n")
    groups = alike.groupBy("body", "part", "good", "toxic").agg(
        F.first("failed").alias("failed"),
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("key").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        # each key stands once, so the smallest one brings all its rows
        F.min(F.when(F.col("key").isNotNull(), rows)).alias("least"),
    )
    # a text has at most four rows for each part by now
    smallest = F.min("least.key").over(Window.partitionBy("body"))
    originals = F.col("unnamed") + F.when(F.col("least.key") == F.col("smallest"), F.col("least.n")).otherwise(0)
    split = groups.withColumn("smallest", smallest).withColumn("originals", originals)
    copy = 1 << FILTERS.index("E")
    sides = F.explode(
        F.array(
            F.struct(F.col("failed").alias("set"), F.col("originals").alias("count")),
            F.struct((F.col("failed") + copy).alias("set"), (F.col("n") - F.col("originals")).alias("count")),
        )
    )
    return (
        split.select("part", "good", "toxic", sides.alias("side"))
        .groupBy("part", F.col("side.set").alias("failed"), "good", "toxic")
        .agg(F.sum("side.count").alias("n"))
    )


def audit(counts: DataFrame) -> DataFrame:
    """One row for each part, order and step; ``counts`` has at most 128 rows a part."""
    steps = [
        f"struct('{''.join(order)}' AS filter_order, {k + 1} AS step, {1 << FILTERS.index(letter)} AS own,"
        f" {sum(1 << FILTERS.index(c) for c in order[:k])} AS earlier)"
        for order in permutations(FILTERS)
        for k, letter in enumerate(order)
    ]
    every = counts.withColumn("at", F.explode(F.expr(f"array({', '.join(steps)})")))
    fails = F.col("failed").bitwiseAND(F.col("at.own")) != 0
    gone = F.col("failed").bitwiseAND(F.col("at.earlier")) != 0
    removed = fails & ~gone
    # of the filters that a document fails, each comes first in the same number of orders
    shapley = F.col("n") * (F.lit(ORDERS) / F.greatest(F.bit_count("failed"), F.lit(1))).cast("long")

    def total(condition: Column, value: Column | None = None) -> Column:
        return F.sum(F.when(condition, F.col("n") if value is None else value).otherwise(0)).cast("long")

    return every.groupBy("part", "at.filter_order", "at.step").agg(
        total(~fails & ~gone).alias("kept"),
        total(removed).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("failed") == F.col("at.own")).alias("unique_fails"),
        total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"),
        total(fails, shapley).alias("shapley"),
    )


def filter_audit(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """The counts of every part, order and step; zeros included."""
    return audit(failure_counts(failures(docs, key=key, text=text, part=part), labels, key=key))

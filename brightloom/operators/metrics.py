"""Classification metrics, all read off one table of label and prediction counts.

The counts hold at most (number of classes)² rows, so everything after the first
aggregation is small; that aggregation combines map-side and is not bothered by one
class holding most rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), label)


def _right(label: str, prediction: str) -> Column:
    # a labelled row without a prediction is wrong; a row without a label says nothing
    right = F.coalesce(F.col(label) == F.col(prediction), F.lit(False)).cast("double")
    return F.avg(F.when(F.col(label).isNotNull(), right))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), _right(label, prediction).alias("accuracy"))


def accuracy_by(df: DataFrame, group: str, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy per group in one aggregation, for instance per test file."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("rows"), _right(label, prediction).alias("accuracy"))


def outcome_counts(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    return df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(
    df: DataFrame, classes: Sequence | None = None, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """A row per true label, a column ``predicted_<class>`` per class, zeros shown.

    The classes are all labels and predictions seen, and further ones that are asked for.
    """
    counts = outcome_counts(df, label, prediction)
    seen_classes = counts.select(F.explode(F.array("label", "prediction")).alias("c")).where("c IS NOT NULL").distinct()
    classes = sorted({*(classes or ()), *(row["c"] for row in seen_classes.collect())})
    seen = counts.groupBy("label").agg(
        *(F.sum(F.when(F.col("prediction") == F.lit(c), F.col("n")).otherwise(0)).alias(f"predicted_{c}") for c in classes)
    )
    every_class = df.sparkSession.createDataFrame([(c,) for c in classes], counts.select("label").schema)
    return every_class.join(seen, "label", "left").na.fill(0).orderBy("label")


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """``class, precision, recall, f1, support`` per class, then accuracy and the two averages.

    The accuracy row carries its value in ``f1`` alone. A ratio with a zero denominator is 0.
    With ``by``, one such report per group, all in one job.
    """
    counts = outcome_counts(df, label, prediction, by)
    n, hit = F.col("n"), F.coalesce(F.col("label") == F.col("prediction"), F.lit(False))
    shares = F.array(
        F.struct(
            F.col("label").alias("class"), n.alias("support"), F.lit(0).cast("long").alias("predicted"),
            F.when(hit, n).otherwise(0).alias("right"),
        ),
        F.struct(
            F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"), n.alias("predicted"),
            F.lit(0).cast("long").alias("right"),
        ),
    )
    per_class = counts.select(*by, F.inline(shares)).where("class IS NOT NULL").groupBy(*by, "class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("right").alias("right")
    )

    def ratio(part: Column, whole: Column) -> Column:
        return F.when(whole == 0, 0.0).otherwise(part.cast("double") / whole)

    right, predicted, support = F.col("right"), F.col("predicted"), F.col("support")
    scored = per_class.select(
        *by, "class", "support",
        ratio(right, predicted).alias("precision"),
        ratio(right, support).alias("recall"),
        ratio(2 * right, predicted + support).alias("f1"),
        ratio(right, support).alias("hits"),
    )

    # each class feeds its own row and the three summary rows; a summary is a weighted mean
    # the kind keeps a class that is named like a summary apart from it
    def entry(kind: str, name: Column, weight: Column, f1: Column, shown: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), name.cast("string").alias("class"), weight.cast("double").alias("weight"), shown.alias("shown"),
            F.col("precision"), F.col("recall"), f1.alias("f1"), F.col("support"),
        )

    one, f1, yes = F.lit(1), F.col("f1"), F.lit(True)
    entries = F.array(
        entry("class", F.col("class"), one, f1, yes),
        entry("summary", F.lit("accuracy"), support, F.col("hits"), F.lit(False)),
        entry("summary", F.lit("macro avg"), one, f1, yes),
        entry("summary", F.lit("weighted avg"), support, f1, yes),
    )

    def mean(name: str) -> Column:
        return F.sum(F.col(name) * F.col("weight")) / F.sum("weight")

    return scored.select(*by, F.inline(entries)).groupBy(*by, "kind", "class").agg(
        F.when(F.bool_and("shown"), mean("precision")).alias("precision"),
        F.when(F.bool_and("shown"), mean("recall")).alias("recall"),
        mean("f1").alias("f1"),
        F.sum("support").alias("support"),
    ).drop("kind")


def report_text(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``accuracy`` and the report as one text, a line per row, classes before summaries."""
    summaries = F.array(*map(F.lit, ("accuracy", "macro avg", "weighted avg")))
    line = F.format_string(
        "%s: precision %s recall %s f1 %s support %d", F.col("class"),
        *(F.coalesce(F.format_number(c, 2), F.lit("-")) for c in ("precision", "recall", "f1")), F.col("support"),
    )
    lines = report.select(
        *by, "class", "f1", F.array_position(summaries, F.col("class")).alias("place"), line.alias("line")
    )
    ordered = F.sort_array(F.collect_list(F.struct("place", "class", "line")))
    return lines.groupBy(*by).agg(
        F.max(F.when(F.col("class") == "accuracy", F.col("f1"))).alias("accuracy"),
        F.array_join(F.transform(ordered, lambda row: row["line"]), "\n").alias("report"),
    )

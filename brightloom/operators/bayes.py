"""Multinomial Naive Bayes over TF-IDF features.

Fitting is one aggregation to a dense sum per class (number of classes × vocabulary
values, combined map-side), scoring is row-wise. Neither shuffles documents, and one
class holding most documents changes nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.classification import NaiveBayesModel as FittedBayes
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.operators.features import TOKENS, WEIGHTS, TfidfModel

_INDEX, _RAW = "class_index", "raw_scores"


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("documents")
    )


def class_priors(df: DataFrame, label: str, fit_prior: bool = True) -> DataFrame:
    """``label, log_prior`` in label order: a class's plain share of the documents, or uniform."""
    counts = class_counts(df, label).orderBy("label")
    found = counts.collect()
    if not found:
        raise ValueError("no labelled documents to fit on")
    total = sum(row["documents"] for row in found)
    shares = [row["documents"] / total if fit_prior else 1 / len(found) for row in found]
    rows = [(row["label"], math.log(share)) for row, share in zip(found, shares)]
    return df.sparkSession.createDataFrame(rows, _prior_schema(counts))


def _prior_schema(df: DataFrame) -> str:
    return f"label {df.schema['label'].dataType.simpleString()}, log_prior double"


@dataclass(frozen=True)
class TextClassifier:
    """Vocabulary, class priors and term likelihoods of a fitted classifier."""

    features: TfidfModel
    bayes: FittedBayes
    labels: list
    log_priors: list[float]
    label_type: str

    @classmethod
    def fit(
        cls, tokenised: DataFrame, label: str, features: TfidfModel, *, alpha: float = 1.0, fit_prior: bool = True
    ) -> TextClassifier:
        """Fit on the rows with a label.

        The prior of a class is its plain share of the documents, or uniform without
        ``fit_prior``. Spark's own estimator smooths priors, so only its term likelihoods
        are used.
        """
        priors = class_priors(tokenised, label, fit_prior)
        rows = priors.collect()
        labels = [row["label"] for row in rows]

        indexed = F.array_position(_listed(labels), F.col(label)) - 1
        training = (
            features.transform(tokenised.where(F.col(label).isNotNull()).select(label, TOKENS))
            .select(indexed.cast("double").alias(_INDEX), WEIGHTS)
        )
        estimator = NaiveBayes(
            smoothing=alpha, modelType="multinomial", featuresCol=WEIGHTS, labelCol=_INDEX,
            predictionCol="", probabilityCol="", rawPredictionCol=_RAW,
        )
        kind = priors.schema["label"].dataType.simpleString()
        return cls(features, estimator.fit(training), labels, [row["log_prior"] for row in rows], kind)

    def _classes(self) -> Column:
        return _listed(self.labels).cast(f"array<{self.label_type}>")

    def log_scores(self, tokenised: DataFrame) -> DataFrame:
        """Add ``scores``: prior plus weighted likelihoods, one value per class in label order."""
        smoothed = self.bayes.pi.toArray().tolist()
        shift = _listed([prior - pi for prior, pi in zip(self.log_priors, smoothed)])
        scored = self.bayes.transform(self.features.transform(tokenised))
        scores = F.zip_with(vector_to_array(_RAW), shift, lambda score, by: score + by)
        return scored.withColumn("scores", scores).drop(WEIGHTS, _RAW)

    def joint_log_likelihood(self, tokenised: DataFrame) -> DataFrame:
        """Long form: the other columns with ``label, score`` per class."""
        scored = self.log_scores(tokenised)
        kept = [c for c in scored.columns if c != "scores"]
        pairs = F.arrays_zip(self._classes().alias("label"), F.col("scores").alias("score"))
        return scored.select(*kept, F.inline(pairs))

    def predict(self, tokenised: DataFrame, output: str = "prediction") -> DataFrame:
        """Add the label of the largest score, the lowest such label on a tie."""
        scores = F.col("scores")
        best = F.element_at(self._classes(), F.array_position(scores, F.array_max(scores)).cast("int"))
        return self.log_scores(tokenised).withColumn(output, best).drop("scores")

    def priors(self, spark: SparkSession) -> DataFrame:
        rows = list(zip(self.labels, self.log_priors))
        return spark.createDataFrame(rows, f"label {self.label_type}, log_prior double")

    def thetas(self, spark: SparkSession) -> DataFrame:
        """``label, term, theta`` for every class and vocabulary term."""
        theta, size = self.bayes.theta.toArray(), len(self.features.terms)
        of_class = pa.array([label for label in self.labels for _ in range(size)])
        terms = pa.array(self.features.terms * len(self.labels))
        return spark.createDataFrame(
            pa.table({"label": of_class, "term": terms, "theta": pa.array(theta.ravel())}),
            f"label {self.label_type}, term string, theta double",
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """A Parquet table of terms, one of priors, and the likelihoods in Spark's model format."""
        self.features.term_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/terms")
        self.priors(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/priors")
        self.bayes.write().overwrite().save(f"{path}/likelihoods")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TextClassifier:
        terms = spark.read.parquet(f"{path}/terms").orderBy("term_index").collect()
        priors = spark.read.parquet(f"{path}/priors")
        rows = priors.orderBy("label").collect()
        return cls(
            TfidfModel.of([row["term"] for row in terms], [row["idf"] for row in terms]),
            FittedBayes.load(f"{path}/likelihoods"),
            [row["label"] for row in rows],
            [row["log_prior"] for row in rows],
            priors.schema["label"].dataType.simpleString(),
        )


def _listed(values: list) -> Column:
    return F.array(*map(F.lit, values))

"""Text jobs: prepare a split, train and evaluate a classifier, score messages."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.functions.payloads import run_id
from brightloom.functions.stopwords import ENGLISH
from brightloom.operators.bayes import TextClassifier
from brightloom.operators.columns import quoted
from brightloom.operators.features import MAX_FEATURES, TfidfModel, with_tokens
from brightloom.operators.metrics import classification_report, report_text
from brightloom.operators.splits import TEST, TRAIN, train_test_split
from brightloom.workspace import written


def prepare(df: DataFrame, key: str, text: str, label: str, test_percent: int = 20) -> DataFrame:
    """Tokenised documents with their side of the split, written once as a partitioned table.

    Vocabulary, likelihoods and evaluation each read the compact tokens and only the
    side they need, instead of running the text expressions again.
    """
    chosen = df.select(F.col(key), F.col(text).alias("_text"), F.col(label))
    return written(train_test_split(with_tokens(chosen, "_text"), key, test_percent), "split", by=["split"])


def side(prepared: DataFrame, part: str) -> DataFrame:
    return prepared.where(F.col("split") == part).drop("split")


@dataclass(frozen=True)
class TrainingSettings:
    alpha: float = 1.0
    fit_prior: bool = True
    max_features: int = MAX_FEATURES
    stop_words: Iterable[str] = ENGLISH
    fit_scope: str = TRAIN  # or "all": vocabulary and idf from test documents as well


def fit_features(prepared: DataFrame, settings: TrainingSettings = TrainingSettings()) -> TfidfModel:
    if settings.fit_scope not in (TRAIN, "all"):
        raise ValueError(f"fit_scope is {TRAIN!r} or 'all', not {settings.fit_scope!r}")
    scope = prepared if settings.fit_scope == "all" else side(prepared, TRAIN)
    return TfidfModel.fit(scope, settings.max_features, settings.stop_words)


def train(prepared: DataFrame, label: str, settings: TrainingSettings = TrainingSettings()) -> TextClassifier:
    return TextClassifier.fit(
        side(prepared, TRAIN), label, fit_features(prepared, settings),
        alpha=settings.alpha, fit_prior=settings.fit_prior,
    )


def predict_test(prepared: DataFrame, label: str, model: TextClassifier) -> DataFrame:
    return model.predict(side(prepared, TEST).where(F.col(label).isNotNull()))


def train_and_evaluate(
    df: DataFrame, key: str, text: str, label: str, settings: TrainingSettings = TrainingSettings()
) -> tuple[TextClassifier, DataFrame]:
    """The fitted classifier and the report on its test documents."""
    prepared = prepare(df, key, text, label)
    model = train(prepared, label, settings)
    return model, classification_report(predict_test(prepared, label, model), label)


def run_record(name: str, settings: TrainingSettings, report: DataFrame, model_path: str) -> DataFrame:
    """One row about a training run: its id, parameters, accuracy and report."""
    return report_text(report).select(
        F.lit(name).alias("name"),
        run_id(F.current_timestamp()).alias("run_id"),
        F.lit(settings.alpha).alias("alpha"),
        F.lit(settings.fit_prior).alias("fit_prior"),
        F.lit(model_path).alias("model_path"),
        "accuracy",
        "report",
    )


def test_records(cases: DataFrame, model: TextClassifier, model_path: str) -> DataFrame:
    """One row per test-case document: accuracy and report of the model on its messages."""
    scored = score_messages(cases, "text", model)
    reports = report_text(classification_report(scored, by=["source"]), by=["source"])
    return reports.select(
        F.col("source").alias("test_path"),
        run_id(F.current_timestamp()).alias("run_id"),
        F.lit(model_path).alias("model_path"),
        "accuracy",
        "report",
    )


def score_messages(messages: DataFrame, text: str, model: TextClassifier, output: str = "prediction") -> DataFrame:
    """Add a prediction to every message, batch or streaming; row-wise, so nothing is shuffled."""
    # the message travels as one column, so that its column names can be any
    packed = messages.select(F.struct(*map(quoted, messages.columns)).alias("_message"), quoted(text).alias("_text"))
    scored = model.predict(with_tokens(packed, "_text"), "_predicted")
    return scored.select("_message.*", F.col("_predicted").alias(output))

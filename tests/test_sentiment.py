import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brightloom.operators.bayes import TextClassifier, class_priors
from brightloom.operators.features import TfidfModel, term_statistics, vocabulary
from brightloom.operators.splits import split_of
from brightloom.plans import text_jobs as J
from brightloom.workspace import fresh_path

DOCUMENTS = [
    (1, "good good film", 1), (2, "bad film", 0), (3, "good plot", 1), (4, "bad bad plot here", 0),
    (5, "fine film plot", 1), (6, "", 1), (7, "awful", None),
]


@pytest.fixture(scope="module")
def tokenised(spark):
    df = spark.createDataFrame(DOCUMENTS, "id int, text string, label int")
    return df.select("id", "label", F.expr("filter(split(text, ' '), w -> w <> '')").alias("tokens")).cache()


def by_hand(labelled, terms, alpha, fit_prior):
    """Weights, priors and likelihoods worked out from the definitions."""
    n = len(DOCUMENTS)
    bags = {i: Counter(t.split()) for i, t, _ in DOCUMENTS}
    idf = {t: math.log((1 + n) / (1 + sum(t in bag for bag in bags.values()))) + 1 for t in terms}
    weights = {}
    for i, bag in bags.items():
        raw = {t: bag[t] * idf[t] for t in terms if bag[t]}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        weights[i] = {t: v / norm for t, v in raw.items()}
    labels = sorted({label for _, _, label in labelled})
    sizes = Counter(label for _, _, label in labelled)
    priors = {c: math.log(sizes[c] / len(labelled) if fit_prior else 1 / len(labels)) for c in labels}
    sums = {c: {t: sum(weights[i].get(t, 0) for i, _, label in labelled if label == c) for t in terms} for c in labels}
    theta = {
        c: {t: math.log(sums[c][t] + alpha) - math.log(sum(sums[c].values()) + alpha * len(terms)) for t in terms}
        for c in labels
    }
    scores = {
        i: {c: priors[c] + sum(w * theta[c][t] for t, w in weights[i].items()) for c in labels} for i in weights
    }
    return idf, weights, priors, theta, scores


@pytest.mark.parametrize("alpha, fit_prior", [(1.0, True), (0.3, False)])
def test_against_the_definitions(spark, tokenised, alpha, fit_prior):
    features = TfidfModel.fit(tokenised, max_features=5, stop_words=["here"])
    model = TextClassifier.fit(tokenised, "label", features, alpha=alpha, fit_prior=fit_prior)
    labelled = [d for d in DOCUMENTS if d[2] is not None]
    idf, weights, priors, theta, scores = by_hand(labelled, features.terms, alpha, fit_prior)

    assert dict(zip(features.terms, features.idf)) == pytest.approx(idf)
    long = {(r["id"], r["term"]): r["weight"] for r in features.weights(tokenised).collect()}
    assert long == pytest.approx({(i, t): w for i, bag in weights.items() for t, w in bag.items()})
    assert {r["label"]: r["log_prior"] for r in model.priors(spark).collect()} == pytest.approx(priors)
    assert {(r["label"], r["term"]): r["theta"] for r in model.thetas(spark).collect()} == pytest.approx(
        {(c, t): v for c, row in theta.items() for t, v in row.items()}
    )
    found = {(r["id"], r["label"]): r["score"] for r in model.joint_log_likelihood(tokenised.drop("label")).collect()}
    assert found == pytest.approx({(i, c): s for i, row in scores.items() for c, s in row.items()})
    predicted = {r["id"]: r["prediction"] for r in model.predict(tokenised).collect()}
    assert predicted == {i: min(row, key=lambda c: (-row[c], c)) for i, row in scores.items()}


def test_vocabulary_order_and_size(tokenised):
    rows = vocabulary(tokenised, 4, []).collect()
    assert [(r["term"], r["term_count"], r["doc_count"]) for r in rows] == [
        ("bad", 3, 2), ("film", 3, 3), ("good", 3, 2), ("plot", 3, 3)
    ]
    assert term_statistics(tokenised, ["bad"]).where("term = 'bad'").count() == 0


def test_ties_go_to_the_lowest_label(spark):
    df = spark.createDataFrame([(5, ["a"]), (3, ["a"])], "label int, tokens array<string>")
    model = TextClassifier.fit(df, "label", TfidfModel.fit(df, stop_words=[]))
    assert {r["prediction"] for r in model.predict(df).collect()} == {3}


def test_unusable_training_data(spark, tokenised):
    with pytest.raises(ValueError, match="empty vocabulary"):
        TfidfModel.fit(tokenised, stop_words=[t for _, text, _ in DOCUMENTS for t in text.split()])
    with pytest.raises(ValueError, match="no labelled"):
        TextClassifier.fit(tokenised.where("label is null"), "label", TfidfModel.of(["a"], [1.0]))


def test_any_number_of_classes(spark):
    priors = class_priors(spark.range(1001), "id").collect()
    assert len(priors) == 1001 and {r["log_prior"] for r in priors} == {math.log(1 / 1001)}


def test_save_and_load(spark, tokenised):
    model = TextClassifier.fit(tokenised, "label", TfidfModel.fit(tokenised))
    path = fresh_path(spark, "model")
    model.save(spark, path)
    model.save(spark, path)  # overwrites
    loaded = TextClassifier.load(spark, path)
    assert loaded.labels == [0, 1] and loaded.features.terms == model.features.terms
    assert loaded.log_scores(tokenised).select("id", "scores").collect() == model.log_scores(tokenised).select(
        "id", "scores"
    ).collect()


def test_split_is_stable_and_about_a_fifth(spark):
    keys = spark.range(20_000)
    test = keys.where(split_of(F.col("id")) == "test").count()
    assert 3700 < test < 4300
    assert keys.repartition(3).where(split_of(F.col("id")) == "test").count() == test
    assert keys.where(split_of(F.col("id"), 0) == "test").count() == 0


def test_fit_scope(spark):
    rows = [(i, f"common word{i}", i % 2) for i in range(60)]
    prepared = J.prepare(spark.createDataFrame(rows, "id int, text string, label int"), "id", "text", "label")
    everything = J.fit_features(prepared, J.TrainingSettings(fit_scope="all"))
    assert len(everything.terms) == 61 > len(J.fit_features(prepared).terms)
    with pytest.raises(ValueError, match="fit_scope"):
        J.fit_features(prepared, J.TrainingSettings(fit_scope="test"))


def test_run_record_and_scoring(spark):
    rows = [(i, "fine film" if i % 2 else "awful plot", i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, text string, label int")
    model, report = J.train_and_evaluate(df, "id", "text", "label")
    record = J.run_record("run", J.TrainingSettings(), report, "somewhere").first()
    assert record["accuracy"] == 1.0 and record["alpha"] == 1.0 and record["fit_prior"]
    assert len(record["run_id"]) == 15 and "weighted avg" in record["report"]
    messages = spark.createDataFrame([("A FINE film!!",), ("@you awful",)], "message string")
    scored = J.score_messages(messages, "message", model).collect()
    assert [tuple(r) for r in scored] == [("A FINE film!!", 1), ("@you awful", 0)]


def test_scoring_needs_no_shuffle(spark, tokenised):
    model = TextClassifier.fit(tokenised, "label", TfidfModel.fit(tokenised))
    messages = spark.range(10).select(F.lit("good film").alias("message"))
    plan = J.score_messages(messages, "message", model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_any_column_names_and_label_types(spark):
    df = spark.createDataFrame([(i, ["odd" if i % 2 else "even"]) for i in range(20)], "id int, tokens array<string>")
    df = df.select(F.when(F.col("id") % 2 == 1, F.lit(7)).otherwise(9).cast("long").alias("label"), "tokens")
    model = TextClassifier.fit(df, "label", TfidfModel.fit(df, stop_words=[]))
    messages = spark.createDataFrame([("odd", 1, 2, 3, 4)], "text string, tokens int, features int, scores int, `a.b` int")
    scored = J.score_messages(messages, "text", model)
    assert dict(scored.dtypes)["prediction"] == "bigint"
    assert tuple(scored.first()) == ("odd", 1, 2, 3, 4, 7)

"""Split, TF-IDF and Naive Bayes.

The whole chain is checked from raw text on. ``labels.quality`` labels the likelihood
queries; the queries that predict use the language of a document, which the text does
tell, so that predictions differ from row to row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.operators.bayes import TextClassifier, class_priors
from brightloom.operators.features import TfidfModel, certified_vocabulary, vocabulary, with_idf, with_tokens
from brightloom.operators.splits import TEST, TRAIN, exact_train_test_split, train_test_split as split_rows
from brightloom.plans import text_jobs as J
from brightloom.operators.metrics import accuracy_by
from brightloom.plans.catalogue.metrics import SQL_REPORT_ROWS, report_rows, sql_report
from brightloom.plans.catalogue.registry import Register, rounded, table
from brightloom.plans.catalogue.texts import SQL_STOP_WORDS, sql_tokens
from brightloom.sources.readers import read_case_documents, read_split
from brightloom.sources.writers import write_split
from brightloom.workspace import fresh_path

register = Register()

SQL_SPLIT = (
    "CASE WHEN CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 20 THEN 'test' ELSE 'train' END"
)
SQL_LANG = "SELECT doc_id, lang AS label, text FROM documents"
SQL_QUALITY = "SELECT doc_id, quality AS label, text FROM documents JOIN labels USING (doc_id)"


def sql_chain(labelled: str, scope: str = "split = 'train'") -> str:
    """Common table expressions from labelled texts to term weights, fitted on the documents in scope."""
    return f"""
    docs AS MATERIALIZED (
        SELECT doc_id, label, {SQL_SPLIT} AS split, {sql_tokens("text")} AS tokens
        FROM ({labelled})),
    tf AS MATERIALIZED (
        SELECT doc_id, label, split, term, count(*) AS tf
        FROM (SELECT doc_id, label, split, unnest(tokens) AS term FROM docs) GROUP BY ALL),
    vocabulary AS MATERIALIZED (
        SELECT term, CAST(sum(tf) AS BIGINT) AS term_count, count(*) AS doc_count FROM tf
        WHERE {scope} AND term NOT IN ({SQL_STOP_WORDS})
        GROUP BY term ORDER BY term_count DESC, term LIMIT 5000),
    idf AS MATERIALIZED (
        SELECT term, doc_count,
            ln((1 + (SELECT count(*) FROM docs WHERE {scope}))::DOUBLE / (1 + doc_count)) + 1 AS idf
        FROM vocabulary),
    weights AS MATERIALIZED (
        SELECT doc_id, label, split, term,
            tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS weight
        FROM tf JOIN idf USING (term))
    """


SQL_MODEL = """
    priors AS MATERIALIZED (
        SELECT label, ln(count(*)::DOUBLE / sum(count(*)) OVER ()) AS log_prior
        FROM docs WHERE split = 'train' GROUP BY label),
    sums AS MATERIALIZED (
        SELECT label, term, sum(weight) AS s FROM weights WHERE split = 'train' GROUP BY label, term),
    theta AS MATERIALIZED (
        SELECT p.label, v.term,
            ln(coalesce(s, 0) + 1) - ln(sum(coalesce(s, 0) + 1) OVER (PARTITION BY p.label)) AS theta
        FROM priors p CROSS JOIN vocabulary v LEFT JOIN sums ON sums.label = p.label AND sums.term = v.term)
    """
SQL_JOINT = """
    joint AS MATERIALIZED (
        SELECT d.doc_id, d.label AS actual, p.label, p.log_prior + coalesce(sum(w.weight * t.theta), 0) AS score
        FROM docs d CROSS JOIN priors p
        LEFT JOIN weights w ON w.doc_id = d.doc_id
        LEFT JOIN theta t ON t.term = w.term AND t.label = p.label
        WHERE d.split = 'test' GROUP BY d.doc_id, d.label, p.label, p.log_prior),
    predicted AS MATERIALIZED (
        SELECT doc_id, actual AS label, label AS prediction
        FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS place FROM joint)
        WHERE place = 1)
    """
SQL_BY_LANG = f"WITH {sql_chain(SQL_LANG)}"
SQL_BY_QUALITY = f"WITH {sql_chain(SQL_QUALITY)}, {SQL_MODEL}"
SQL_PREDICTED = f"{SQL_BY_LANG}, {SQL_MODEL}, {SQL_JOINT}"


def by_lang(spark, folder) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text", F.col("lang").alias("label"))


def by_quality(spark, folder) -> DataFrame:
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return table(spark, folder, "documents").select("doc_id", "text").join(labels, "doc_id")


def prepared(labelled: DataFrame) -> DataFrame:
    return J.prepare(labelled, "doc_id", "text", "label")


def training_tokens(spark, folder) -> DataFrame:
    rows = split_rows(by_lang(spark, folder), "doc_id").where(F.col("split") == TRAIN)
    return with_tokens(rows.select("doc_id", "text"), "text")


@register.query(f"SELECT doc_id, {SQL_SPLIT} AS split FROM documents")
def train_test_split(spark, folder):
    return split_rows(table(spark, folder, "documents").select("doc_id"), "doc_id")


@register.query(f"SELECT doc_id, label, text, {SQL_SPLIT} AS split FROM ({SQL_LANG})")
def split_roundtrip(spark, folder):
    """Both sides of a saved split."""
    path = fresh_path(spark, "saved-split")
    write_split(split_rows(by_lang(spark, folder), "doc_id"), path)
    sides = [read_split(spark, path, part).withColumn("split", F.lit(part)) for part in (TRAIN, TEST)]
    return sides[0].unionByName(sides[1]).select("doc_id", "label", "text", "split")


@register.query(
    "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT, doc_id)"
    " <= (count(*) OVER () * 20 + 99) // 100 THEN 'test' ELSE 'train' END AS split FROM documents"
)
def train_test_split_exact(spark, folder):
    """A test side of exactly a fifth of the rows, rounded up."""
    return exact_train_test_split(table(spark, folder, "documents").select("doc_id"), "doc_id", few_rows=50)


@register.query(f"{SQL_BY_LANG} SELECT term, term_count FROM vocabulary")
def vocabulary_certified(spark, folder):
    """The vocabulary from a sketch and a recount, where that is proved to be all."""
    return certified_vocabulary(training_tokens(spark, folder)).select("term", "term_count")


@register.query(f"{SQL_BY_LANG} SELECT term, term_count FROM vocabulary")
def vocabulary_topk(spark, folder):
    return vocabulary(training_tokens(spark, folder)).select("term", "term_count")


@register.query(f"{SQL_BY_LANG} SELECT term, doc_count, round(idf, 6) AS idf FROM idf")
def idf_table(spark, folder):
    tokenised = training_tokens(spark, folder)
    terms = with_idf(vocabulary(tokenised), tokenised.count())
    return terms.select("term", "doc_count", rounded("idf").alias("idf"))


@register.query(f"{SQL_BY_LANG} SELECT doc_id, split, term, round(weight, 6) AS weight FROM weights")
def tfidf_weights(spark, folder):
    split = prepared(by_lang(spark, folder))
    weights = J.fit_features(split).weights(split.select("doc_id", "split", "tokens"))
    return weights.select("doc_id", "split", "term", rounded("weight").alias("weight"))


@register.query(
    f"WITH {sql_chain(SQL_LANG, 'TRUE')} SELECT doc_id, split, term, round(weight, 6) AS weight FROM weights"
)
def tfidf_weights_all(spark, folder):
    """Vocabulary and idf from test documents as well."""
    split = prepared(by_lang(spark, folder))
    features = J.fit_features(split, J.TrainingSettings(fit_scope="all"))
    weights = features.weights(split.select("doc_id", "split", "tokens"))
    return weights.select("doc_id", "split", "term", rounded("weight").alias("weight"))


def fitted(split: DataFrame) -> TextClassifier:
    return J.train(split, "label")


@register.query(f"{SQL_BY_QUALITY} SELECT label, round(log_prior, 6) AS log_prior FROM priors")
def nb_priors(spark, folder):
    training = split_rows(by_quality(spark, folder), "doc_id").where(F.col("split") == TRAIN)
    return class_priors(training, "label").select("label", rounded("log_prior").alias("log_prior"))


@register.query(f"{SQL_BY_QUALITY} SELECT label, term, round(theta, 6) AS theta FROM theta")
def nb_theta(spark, folder):
    thetas = fitted(prepared(by_quality(spark, folder))).thetas(spark)
    return thetas.select("label", "term", rounded("theta").alias("theta"))


@register.query(f"{SQL_BY_QUALITY}, {SQL_JOINT} SELECT doc_id, label, round(score, 6) AS score FROM joint")
def nb_joint_loglik(spark, folder):
    split = prepared(by_quality(spark, folder))
    test = J.side(split, "test").select("doc_id", "tokens")
    scores = fitted(split).joint_log_likelihood(test)
    return scores.select("doc_id", "label", rounded("score").alias("score"))


SQL_UNIFORM = SQL_MODEL.replace("ln(count(*)::DOUBLE / sum(count(*)) OVER ())", "ln(1.0::DOUBLE / count(*) OVER ())")
SQL_UNIFORM = SQL_UNIFORM.replace("coalesce(s, 0) + 1", "coalesce(s, 0) + 0.5")


@register.query(
    f"WITH {sql_chain(SQL_QUALITY)}, {SQL_UNIFORM}, {SQL_JOINT} SELECT doc_id, label, round(score, 6) AS score FROM joint"
)
def nb_joint_loglik_uniform(spark, folder):
    """Half a pseudo-count and equal priors."""
    split = prepared(by_quality(spark, folder))
    model = J.train(split, "label", J.TrainingSettings(alpha=0.5, fit_prior=False))
    scores = model.joint_log_likelihood(J.side(split, "test").select("doc_id", "tokens"))
    return scores.select("doc_id", "label", rounded("score").alias("score"))


@register.query(f"{SQL_PREDICTED} SELECT doc_id, label, prediction FROM predicted")
def nb_predict(spark, folder):
    split = prepared(by_lang(spark, folder))
    return J.predict_test(split, "label", fitted(split)).select("doc_id", "label", "prediction")


@register.query(f"{SQL_PREDICTED} SELECT doc_id, prediction FROM predicted")
def model_reload_scores(spark, folder):
    """A model that was saved and loaded again."""
    split, path = prepared(by_lang(spark, folder)), fresh_path(spark, "classifier")
    fitted(split).save(spark, path)
    return J.predict_test(split, "label", TextClassifier.load(spark, path)).select("doc_id", "prediction")


SQL_EVALUATED = f"{SQL_PREDICTED}, {sql_report('SELECT label, prediction FROM predicted')}"


@register.query(f"{SQL_EVALUATED} {SQL_REPORT_ROWS}")
def nb_train_evaluate(spark, folder):
    _, report = J.train_and_evaluate(by_lang(spark, folder), "doc_id", "text", "label")
    return report_rows(report)


@register.query(
    f"{SQL_EVALUATED} SELECT 'NAIVE_BAYES' AS name, 1.0::DOUBLE AS alpha, TRUE AS fit_prior, round(f1, 6) AS accuracy,"
    " (SELECT count(*) FROM report) AS report_lines FROM report WHERE class = 'accuracy'"
)
def run_record(spark, folder):
    settings, path = J.TrainingSettings(), fresh_path(spark, "classifier")
    model, report = J.train_and_evaluate(by_lang(spark, folder), "doc_id", "text", "label", settings)
    model.save(spark, path)
    record = J.run_record("NAIVE_BAYES", settings, report, path)
    lines = F.size(F.split("report", "\n")).cast("long")
    return record.select("name", "alpha", "fit_prior", rounded("accuracy").alias("accuracy"), lines.alias("report_lines"))


SQL_MESSAGE_SCORES = f"""
    messages AS MATERIALIZED (
        SELECT conv_id, turn, {sql_tokens("text")} AS tokens FROM conversations),
    message_weights AS (
        SELECT conv_id, turn, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY conv_id, turn)) AS weight
        FROM (SELECT conv_id, turn, term, count(*) AS tf
            FROM (SELECT conv_id, turn, unnest(tokens) AS term FROM messages) GROUP BY ALL)
        JOIN idf USING (term)),
    message_scores AS (
        SELECT m.conv_id, m.turn, p.label, p.log_prior + coalesce(sum(w.weight * t.theta), 0) AS score
        FROM messages m CROSS JOIN priors p
        LEFT JOIN message_weights w ON w.conv_id = m.conv_id AND w.turn = m.turn
        LEFT JOIN theta t ON t.term = w.term AND t.label = p.label
        GROUP BY m.conv_id, m.turn, p.label, p.log_prior)
    SELECT conv_id, turn, label AS prediction
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, label) AS place FROM message_scores)
    WHERE place = 1
    """
SQL_SCORED = f"{SQL_BY_LANG}, {SQL_MODEL}, {SQL_MESSAGE_SCORES}"


@register.query(SQL_SCORED)
def score_messages(spark, folder):
    model = fitted(prepared(by_lang(spark, folder)))
    messages = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return J.score_messages(messages, "text", model).select("conv_id", "turn", "prediction")


#: Labels of test cases are whole numbers; these keep the order of the languages' names.
LANG_CODE = "CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 WHEN 'fr' THEN 3 ELSE 4 END"
#: Neighbouring keys in a file, of which a fifth are test documents.
CASE_SIZE = 200
#: What is wrong with some of the documents, by the remainder of their number by ten.
CASE_FAULTS = {
    1: "no valid JSON",
    2: "no X",
    3: "no y",
    5: "other keys in X than in y",
    7: "a key that is no whole number",
    9: "a label that is no whole number",
}
SQL_FAULT = " ".join(f"WHEN {number} THEN '{reason}'" for number, reason in CASE_FAULTS.items())


@register.query(
    f"""{SQL_PREDICTED}, cases AS (
        SELECT doc_id, doc_id // {CASE_SIZE} AS number, p.label = p.prediction AS hit FROM predicted p)
    SELECT number, count(*) AS messages, CASE number % 10 {SQL_FAULT} END AS reason,
        CASE WHEN number % 10 NOT IN ({", ".join(map(str, CASE_FAULTS))}) THEN round(avg(CASE WHEN hit THEN 1.0::DOUBLE ELSE 0 END), 6) END AS accuracy
    FROM cases GROUP BY number"""
)
def evaluate_test_cases(spark, folder):
    """Accuracy of a fitted classifier on each test-case file, and the reason of each file that is rejected."""
    documents = table(spark, folder, "documents").select("doc_id", "text", F.expr(LANG_CODE).alias("label"))
    model = fitted(prepared(documents))
    held_out = split_rows(documents, "doc_id").where(F.col("split") == TEST)
    numbered = held_out.withColumn("number", F.expr(f"doc_id div {CASE_SIZE}"))
    path = fresh_path(spark, "test-cases")
    write_case_files(numbered, path)

    messages, rejects = read_case_documents(spark, path)
    scored = J.score_messages(messages, "text", model)
    number = F.regexp_extract("file", r"number=(\d+)", 1).cast("long").alias("number")
    accuracy = accuracy_by(scored.withColumn("number", number), "number").withColumn("reason", F.lit(None).cast("string"))
    both = accuracy.select("number", "reason", rounded("accuracy").alias("accuracy")).unionByName(
        rejects.select(number, "reason", F.lit(None).cast("double").alias("accuracy"))
    )
    return numbered.groupBy("number").agg(F.count(F.lit(1)).alias("messages")).join(both, "number", "left")


def write_case_files(numbered: DataFrame, path: str) -> None:
    """A file for each ``number``, of at most ``CASE_SIZE`` messages; some have the faults of ``CASE_FAULTS``."""
    fault = F.col("number") % 10
    key = F.when(fault == 7, F.concat(F.lit("k"), "doc_id")).otherwise(F.col("doc_id").cast("string"))
    other = F.when(fault == 5, F.concat(key, F.lit("0"))).otherwise(key)
    label = F.when(fault == 9, F.lit("positive")).otherwise(F.col("label").cast("string"))
    pairs = numbered.select("number", key.alias("key"), other.alias("other"), "text", label.alias("label"))
    grouped = pairs.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("key", "other", "text", "label"))).alias("rows"))

    def column(name: str):
        return F.transform("rows", lambda r: r[name])

    parts = grouped.select(
        "number",
        F.when(fault != 2, F.array(F.map_from_arrays(column("key"), column("text")))).alias("X"),
        F.when(fault != 3, F.array(F.map_from_arrays(column("other"), column("label")))).alias("y"),
    )
    whole = F.to_json(F.struct("X", "y"))
    value = F.when(fault == 1, F.substring(whole, 1, 20)).otherwise(whole)
    parts.select("number", value.alias("value")).repartition("number").write.partitionBy("number").text(path)

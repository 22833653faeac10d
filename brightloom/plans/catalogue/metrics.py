"""Label counts, label texts and classification metrics.

The two label columns of the same document stand in for label and prediction:
``quality`` is the label, the opposite of ``toxic`` the prediction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.functions.payloads import decode_label, encode_label
from brightloom.operators import metrics as M
from brightloom.plans.catalogue.registry import Register, rounded, table

register = Register()

SQL_OUTCOMES = "SELECT doc_id, quality AS label, 1 - toxic AS prediction FROM labels"
SQL_DECODED = (
    "SELECT doc_id, CASE quality + 2 * toxic WHEN 1 THEN 'Positive sentiment' WHEN 0 THEN 'Negative sentiment'"
    " ELSE 'Unknown sentiment' END AS sentiment FROM labels"
)


def outcomes(spark, folder) -> DataFrame:
    return table(spark, folder, "labels").select(
        "doc_id", F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction")
    )


def decoded(spark, folder) -> DataFrame:
    sentiment = decode_label(F.col("quality") + 2 * F.col("toxic"))
    return table(spark, folder, "labels").select("doc_id", sentiment.alias("sentiment"))


@register.query("SELECT quality, count(*) AS count FROM labels GROUP BY quality")
def label_counts(spark, folder):
    return M.label_counts(table(spark, folder, "labels"), "quality")


@register.query(SQL_DECODED)
def label_decode(spark, folder):
    return decoded(spark, folder)


@register.query(
    "SELECT doc_id, CASE WHEN contains(lower(sentiment), 'positive') THEN 1 ELSE 0 END AS label"
    f" FROM ({SQL_DECODED})"
)
def label_encode(spark, folder):
    return decoded(spark, folder).select("doc_id", encode_label(F.upper("sentiment")).alias("label"))


@register.query(
    "SELECT count(*) AS rows, round(avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy"
    f" FROM ({SQL_OUTCOMES})"
)
def accuracy(spark, folder):
    return M.accuracy(outcomes(spark, folder)).select("rows", rounded("accuracy").alias("accuracy"))


@register.query(
    "SELECT source, count(*) AS rows,"
    " round(avg(CASE WHEN label = prediction THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy"
    f" FROM ({SQL_OUTCOMES}) JOIN documents USING (doc_id) GROUP BY source"
)
def accuracy_by_source(spark, folder):
    sources = table(spark, folder, "documents").select("doc_id", "source")
    scored = M.accuracy_by(outcomes(spark, folder).join(sources, "doc_id"), "source")
    return scored.select("source", "rows", rounded("accuracy").alias("accuracy"))


@register.query(
    "SELECT label, count(*) FILTER (WHERE prediction = 0) AS predicted_0,"
    f" count(*) FILTER (WHERE prediction = 1) AS predicted_1 FROM ({SQL_OUTCOMES}) GROUP BY label"
)
def confusion_matrix(spark, folder):
    return M.confusion_matrix(outcomes(spark, folder))


def sql_report(outcome_rows: str) -> str:
    """The classification report of a query giving ``label, prediction``."""
    return f"""
    outcome AS ({outcome_rows}),
    classes AS (SELECT label AS c FROM outcome UNION SELECT prediction FROM outcome),
    tally AS (
        SELECT c,
            (SELECT count(*) FROM outcome WHERE label = c)::DOUBLE AS support,
            (SELECT count(*) FROM outcome WHERE prediction = c)::DOUBLE AS predicted,
            (SELECT count(*) FROM outcome WHERE prediction = c AND label = c)::DOUBLE AS hits
        FROM classes),
    scores AS (
        SELECT c, support, hits,
            CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS p,
            CASE WHEN support = 0 THEN 0 ELSE hits / support END AS r,
            CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * hits / (predicted + support) END AS f
        FROM tally),
    report AS (
        SELECT CAST(c AS VARCHAR) AS class, p AS precision, r AS recall, f AS f1, support FROM scores
        UNION ALL SELECT 'accuracy', NULL, NULL, sum(hits) / sum(support), sum(support) FROM scores
        UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM scores
        UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
            sum(f * support) / sum(support), sum(support) FROM scores)
    """


SQL_REPORT_ROWS = (
    "SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,"
    " CAST(support AS BIGINT) AS support FROM report"
)


def report_rows(report: DataFrame, *by: str) -> DataFrame:
    return report.select(*by, "class", *(rounded(c).alias(c) for c in ("precision", "recall", "f1")), "support")


@register.query(f"WITH {sql_report(SQL_OUTCOMES)} {SQL_REPORT_ROWS}")
def classification_report(spark, folder):
    return report_rows(M.classification_report(outcomes(spark, folder)))


@register.query(
    f"""
    WITH outcome AS (SELECT source, label, prediction FROM ({SQL_OUTCOMES}) JOIN documents USING (doc_id)),
    classes AS (SELECT source, label AS c FROM outcome UNION SELECT source, prediction FROM outcome),
    tally AS (
        SELECT classes.source, c,
            count(*) FILTER (WHERE label = c)::DOUBLE AS support,
            count(*) FILTER (WHERE prediction = c)::DOUBLE AS predicted,
            count(*) FILTER (WHERE label = c AND prediction = c)::DOUBLE AS hits
        FROM classes JOIN outcome ON outcome.source = classes.source GROUP BY classes.source, c),
    scores AS (
        SELECT source, c, support, hits,
            CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS p,
            CASE WHEN support = 0 THEN 0 ELSE hits / support END AS r,
            CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * hits / (predicted + support) END AS f
        FROM tally),
    report AS (
        SELECT source, CAST(c AS VARCHAR) AS class, p AS precision, r AS recall, f AS f1, support FROM scores
        UNION ALL SELECT source, 'accuracy', NULL, NULL, sum(hits) / sum(support), sum(support)
        FROM scores GROUP BY source
        UNION ALL SELECT source, 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM scores GROUP BY source
        UNION ALL SELECT source, 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
            sum(f * support) / sum(support), sum(support) FROM scores GROUP BY source)
    {SQL_REPORT_ROWS.replace("SELECT", "SELECT source,", 1)}
    """
)
def report_by_source(spark, folder):
    sources = table(spark, folder, "documents").select("doc_id", "source")
    report = M.classification_report(outcomes(spark, folder).join(sources, "doc_id"), by=["source"])
    return report_rows(report, "source")

"""Command line: each job as one step.

    python -m brightloom count-words --input lines/ --output counts/
    spark-submit --py-files brightloom.zip brightloom/__main__.py count-words --input lines/ --output counts/

The master and all resources come from ``spark-submit`` or the Spark configuration.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from brightloom.functions.payloads import decode_label
from brightloom.functions.stopwords import ENGLISH
from brightloom.operators.bayes import TextClassifier
from brightloom.operators.clusters import DEFAULT_K, assembled, assign_clusters, sweep
from brightloom.operators.columns import coerce_double, fill_zero, numeric_only
from brightloom.operators.features import MAX_FEATURES
from brightloom.operators.predictions import split_rejects
from brightloom.operators.wordcount import SINGLE_SPACE, WHITESPACE_RUN
from brightloom.plans import table_jobs, text_jobs
from brightloom.sources.readers import read_delimited, read_latin1_csv, read_lines, read_test_cases
from brightloom.sources.writers import write_csv, write_delimited

# Column names of labelled text files.
TEXT, LABEL = "SentimentText", "Sentiment"


def count_words(spark: SparkSession, args: argparse.Namespace) -> None:
    separator = WHITESPACE_RUN if args.whitespace else SINGLE_SPACE
    counts = table_jobs.count_words_in_files(spark, args.input, args.output, separator)
    if args.output is None:
        counts.show()


def clean_table(spark: SparkSession, args: argparse.Namespace) -> None:
    table_jobs.clean_wide_file(
        spark, args.input, args.output, args.schema, args.first_column, exact=args.exact, single_file=args.single_file
    )


def train_clusters(spark: SparkSession, args: argparse.Namespace) -> None:
    table_jobs.train_clusters(read_delimited(spark, args.input, args.schema), args.model, args.k)


def predict_clusters(spark: SparkSession, args: argparse.Namespace) -> None:
    clustered = assign_clusters(read_delimited(spark, args.input, args.schema), table_jobs.load_clusters(args.model))
    if args.output is None:
        clustered.select("cluster").show(10, truncate=False)
    else:
        write_delimited(clustered, args.output)


def sweep_clusters(spark: SparkSession, args: argparse.Namespace) -> None:
    numeric = fill_zero(numeric_only(coerce_double(read_delimited(spark, args.input, args.schema))))
    results = sweep(assembled(numeric, numeric.columns), with_silhouette=True)
    if args.output is None:
        results.show(truncate=False)
    else:
        write_csv(results, args.output)


def train_text(spark: SparkSession, args: argparse.Namespace) -> None:
    # the key of the split is the text itself, so copies of a text stay on one side
    labelled = read_latin1_csv(spark, args.input).select(
        F.md5(F.coalesce(TEXT, F.lit(""))).alias("key"), TEXT, F.col(LABEL).try_cast("int").alias(LABEL)
    )
    stop_words = ENGLISH
    if args.stop_words is not None:
        stop_words = tuple(row["value"].strip() for row in read_lines(spark, args.stop_words).collect())
    settings = text_jobs.TrainingSettings(
        alpha=args.alpha, fit_prior=not args.uniform_prior, max_features=args.max_features,
        stop_words=stop_words, fit_scope=args.fit_scope,
    )
    model, report = text_jobs.train_and_evaluate(labelled, "key", TEXT, LABEL, settings)
    model.save(spark, args.model)
    record = text_jobs.run_record("NAIVE_BAYES", settings, report, args.model)
    record.coalesce(1).write.mode("append").json(args.runs)


def score_text(spark: SparkSession, args: argparse.Namespace) -> None:
    model = TextClassifier.load(spark, args.model)
    messages, rejected = split_rejects(read_lines(spark, args.input).withColumnRenamed("value", "message"))
    scored = text_jobs.score_messages(messages, "message", model, "label")
    predictions = scored.select("message", decode_label(F.col("label")).alias("prediction"))
    predictions.write.mode("overwrite").parquet(args.output)
    if args.rejects is not None:
        rejected.write.mode("overwrite").parquet(args.rejects)


def evaluate_text(spark: SparkSession, args: argparse.Namespace) -> None:
    model = TextClassifier.load(spark, args.model)
    cases = read_test_cases(spark, args.input, one_per_file=not args.json_lines)
    text_jobs.test_records(cases, model, args.model).coalesce(1).write.mode("append").json(args.runs)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="brightloom", description=__doc__.split("\n")[0])
    commands = top.add_subparsers(required=True)

    def command(run, *, schema: bool = False) -> argparse.ArgumentParser:
        added = commands.add_parser(run.__name__.replace("_", "-"))
        added.set_defaults(run=run)
        added.add_argument("-i", "--input", required=True)
        if schema:
            added.add_argument("--schema", help="column definitions; inferred with an extra pass if left out")
        return added

    words = command(count_words)
    words.add_argument("-o", "--output")
    words.add_argument("--whitespace", action="store_true", help="split at runs of white space")

    clean = command(clean_table, schema=True)
    clean.add_argument("-o", "--output", required=True)
    clean.add_argument("--first-column", type=int, default=table_jobs.FIRST_MEASURE)
    clean.add_argument("--exact", action="store_true", help="exact instead of approximate medians")
    clean.add_argument("--single-file", action="store_true", help="write through one task")

    train = command(train_clusters, schema=True)
    train.add_argument("--model", required=True)
    train.add_argument("--k", type=int, default=DEFAULT_K)

    predict = command(predict_clusters, schema=True)
    predict.add_argument("--model", required=True)
    predict.add_argument("-o", "--output")

    swept = command(sweep_clusters, schema=True)
    swept.add_argument("-o", "--output")

    text = command(train_text)
    text.add_argument("--model", required=True)
    text.add_argument("--runs", required=True, help="folder that collects run records")
    text.add_argument("--alpha", type=float, default=1.0)
    text.add_argument("--uniform-prior", action="store_true")
    text.add_argument("--max-features", type=int, default=MAX_FEATURES)
    text.add_argument("--stop-words", help="file with a word per line instead of the default list")
    text.add_argument("--fit-scope", choices=("train", "all"), default="train")

    score = command(score_text)
    score.add_argument("--model", required=True)
    score.add_argument("-o", "--output", required=True)
    score.add_argument("--rejects", help="folder for messages without text")

    evaluate = command(evaluate_text)
    evaluate.add_argument("--model", required=True)
    evaluate.add_argument("--runs", required=True)
    evaluate.add_argument("--json-lines", action="store_true", help="one document per line instead of per file")
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    args.run(SparkSession.builder.appName("brightloom").getOrCreate(), args)


if __name__ == "__main__":
    main()

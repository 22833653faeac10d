"""Word counts, text cleaning, text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.functions import text as T
from brightloom.functions.stopwords import ENGLISH
from brightloom.operators.wordcount import WHITESPACE_RUN, most_frequent, word_count as count_words
from brightloom.plans.catalogue.registry import Register, table
from brightloom.plans.table_jobs import count_words_in_files
from brightloom.sources.readers import (
    in_key_order,
    read_latin1_csv,
    read_lines,
    read_test_cases,
)
from brightloom.sources.writers import write_latin1_csv, write_lines
from brightloom.workspace import fresh_path

register = Register()

# DuckDB twins of the text functions
SQL_BLANKS = " || ".join(f"chr({code})" for code in T.BLANK_CODES)


def sql_clean(text: str) -> str:
    cleaned = f"coalesce({text}, 'nan')"
    for pattern in (T.URL, T.MENTION, T.HASHTAG, T.PUNCTUATION_CLASS):
        cleaned = f"regexp_replace({cleaned}, '{pattern}', '', 'g')"
    return f"trim(lower({cleaned}), {SQL_BLANKS})"


def sql_tokens(text: str) -> str:
    return f"regexp_extract_all(lower({sql_clean(text)}), '{T.TOKEN}')"


SQL_STOP_WORDS = ", ".join("'" + word.replace("'", "''") + "'" for word in ENGLISH)


def documents(spark, folder) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


def rewritten(spark, folder, function) -> DataFrame:
    return documents(spark, folder).select("doc_id", function(F.col("text")).alias("text"))


def sql_rewritten(expression: str) -> str:
    return f"SELECT doc_id, {expression} AS text FROM documents"


@register.query(
    "SELECT word, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word"
)
def word_count(spark, folder):
    return count_words(documents(spark, folder), "text")


@register.query(
    "SELECT word, count(*) AS count FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM documents)"
    " GROUP BY word"
)
def word_count_ws(spark, folder):
    return count_words(documents(spark, folder), "text", WHITESPACE_RUN)


@register.query(
    "SELECT word, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)"
    " GROUP BY word ORDER BY count DESC, word LIMIT 20"
)
def word_count_top(spark, folder):
    return most_frequent(count_words(documents(spark, folder), "text"), 20)


SQL_LINES = "SELECT unnest(string_split(text, chr(10))) AS line FROM documents"


@register.query(
    f"SELECT word, count(*) AS count FROM (SELECT unnest(string_split(line, ' ')) AS word FROM ({SQL_LINES}))"
    " GROUP BY word"
)
def word_count_written(spark, folder):
    """The file job: text files in, CSV files out."""
    source, target = fresh_path(spark, "lines"), fresh_path(spark, "words")
    write_lines(documents(spark, folder).select("text"), source)
    count_words_in_files(spark, source, target)
    return read_counts(spark, target)


def read_counts(spark, path) -> DataFrame:
    # an empty word is written as "", which only an empty-value setting tells from a null
    return spark.read.schema("word string, count bigint").options(header=True, emptyValue="").csv(path)


@register.query(f"SELECT line, count(*) AS count FROM ({SQL_LINES}) GROUP BY line")
def text_lines_roundtrip(spark, folder):
    path = fresh_path(spark, "lines")
    write_lines(documents(spark, folder).select("text"), path)
    return read_lines(spark, path).groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("count"))


@register.query("SELECT doc_id, text FROM documents")
def csv_latin1_roundtrip(spark, folder):
    path = fresh_path(spark, "latin1")
    write_latin1_csv(documents(spark, folder), path)
    return read_latin1_csv(spark, path, "doc_id bigint, text string")


def numbered_lines(text: Column) -> Column:
    """Lines of a text under their numbers as text keys."""
    lines = F.split(text, "\n")
    keys = F.transform(lines, lambda _, at: at.cast("string"))
    return F.map_from_arrays(keys, lines)


@register.query(
    "SELECT CAST(doc_id AS VARCHAR) AS source, CAST(n - 1 AS INT) AS id, lines[n] AS text, CAST(length(lines[n]) > 40 AS INT) AS label"
    " FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS n"
    " FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))"
)
def json_testcase_explode(spark, folder):
    """A test case per document, a message per line, labelled by whether the line is long."""
    cases = documents(spark, folder).select(
        F.col("doc_id").cast("string").alias("name"), numbered_lines(F.col("text")).alias("lines")
    )
    labels = F.transform_values("lines", lambda _, line: (F.length(line) > 40).cast("int"))
    path = fresh_path(spark, "cases")
    cases.select("name", F.array("lines").alias("X"), F.array(labels).alias("y")).write.json(path)
    return in_key_order(read_test_cases(spark, path, one_per_file=False))


@register.query(
    f"SELECT page_id, regexp_replace('see ' || url || ' now ' || html, '{T.URL}', '', 'g') AS text FROM pages"
)
def strip_urls(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    text = F.concat(F.lit("see "), F.col("url"), F.lit(" now "), F.col("html"))
    return pages.select("page_id", T.strip_urls(text).alias("text"))


@register.query(sql_rewritten(f"regexp_replace(text, '{T.MENTION}', '', 'g')"))
def strip_mentions(spark, folder):
    return rewritten(spark, folder, T.strip_mentions)


@register.query(sql_rewritten(f"regexp_replace(text, '{T.HASHTAG}', '', 'g')"))
def strip_hashtags(spark, folder):
    return rewritten(spark, folder, T.strip_hashtags)


@register.query(sql_rewritten(f"regexp_replace(text, '{T.PUNCTUATION_CLASS}', '', 'g')"))
def strip_punct(spark, folder):
    return rewritten(spark, folder, T.strip_punctuation)


@register.query(sql_rewritten(sql_clean("text")))
def clean_text(spark, folder):
    return rewritten(spark, folder, T.clean_text)


@register.query(
    f"SELECT doc_id, array_to_string({sql_tokens('text')}, ' ') AS tokens FROM documents"
)
def tokenize(spark, folder):
    words = T.tokens(T.clean_text(F.col("text")))
    return documents(spark, folder).select("doc_id", F.array_join(words, " ").alias("tokens"))


@register.query(
    "SELECT doc_id, array_to_string([word FOR word IN words IF word NOT IN (" + SQL_STOP_WORDS + ")], ' ') AS tokens"
    f" FROM (SELECT doc_id, {sql_tokens('text')} AS words FROM documents)"
)
def remove_stopwords(spark, folder):
    words = T.without_words(T.tokens(T.clean_text(F.col("text"))), ENGLISH)
    return documents(spark, folder).select("doc_id", F.array_join(words, " ").alias("tokens"))

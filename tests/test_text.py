import pytest
from pyspark.sql import functions as F

from brightloom.functions import text as T
from brightloom.functions.stopwords import ENGLISH
from brightloom.operators.wordcount import WHITESPACE_RUN, most_frequent, word_count


def apply(spark, function, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row[1] for row in df.select("i", function(F.col("v"))).orderBy("i").collect()]


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        ("See the page https://t.example/x @friend #fun", "see the page"),
        ("Hi, you! How's it going?", "hi you hows it going"),
        ("   wide   open \t\n", "wide   open"),
        ("www.example.com gone", "gone"),
        ("a@user_http://x.y z", "a z"),
        ("#@name stays empty", "stays empty"),
        ("@été #ñandú bien", "bien"),
        ("\x1ctrimmed\x1f ", "trimmed"),
        ("mid@name1#tag2end.", "mid"),
        ("ftp HTTP://kept", "ftp httpkept"),
        (None, "nan"),
        ("", ""),
    ],
)
def test_clean_text(spark, raw, cleaned):
    assert apply(spark, T.clean_text, raw) == [cleaned]


def test_one_scan_for_mentions_and_hashtags_equals_two(spark):
    samples = ["@a#b", "#a@b", "#@a", "@#a", "##a", "@@a@b", "x@a_#1 y#", "@²½ #名前", "@", "#", "a@-b#-c"]
    both = apply(spark, lambda c: T.strip_hashtags(T.strip_mentions(c)), *samples)
    assert apply(spark, T.strip_tagged, *samples) == both


def test_word_characters_are_letters_numbers_and_underscore(spark):
    characters = [chr(code) for code in (*range(0x20, 0x250), 0x300, 0x200D, 0x203F, 0x2160, 0xB2, 0x4E00, 0x0660)]
    stripped = apply(spark, T.strip_mentions, *("@" + c for c in characters))
    for character, rest in zip(characters, stripped):
        assert (rest == "") == (character.isalnum() or character == "_"), hex(ord(character))


def test_punctuation(spark):
    assert apply(spark, T.strip_punctuation, T.PUNCTUATION + "a«é»") == ["a«é»"]


def test_tokens(spark):
    assert apply(spark, T.tokens, "I am A b_1, l'été 42 x") == [["am", "b_1", "été", "42"]]


def test_stop_words(spark):
    kept = apply(spark, lambda c: T.without_words(F.split(c, " "), ENGLISH), "the cat and the hat the")
    assert kept == [["cat", "hat"]]
    assert apply(spark, lambda c: T.without_words(F.split(c, " "), []), "the cat") == [["the", "cat"]]


def test_stop_words_are_the_built_in_list(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert sorted(ENGLISH) == sorted(StopWordsRemover.loadDefaultStopWords("english"))


def test_word_count(spark):
    lines = spark.createDataFrame([("Sun moon Sun",), ("sun  star",), ("",)], "value string")
    counted = {row["word"]: row["count"] for row in word_count(lines, "value").collect()}
    assert counted == {"Sun": 2, "moon": 1, "sun": 1, "star": 1, "": 2}
    by_run = {row["word"]: row["count"] for row in word_count(lines, "value", WHITESPACE_RUN).collect()}
    assert by_run == {"Sun": 2, "moon": 1, "sun": 1, "star": 1, "": 1}
    top = most_frequent(word_count(lines, "value"), 3).collect()
    assert [tuple(row) for row in top] == [("", 2), ("Sun", 2), ("moon", 1)]

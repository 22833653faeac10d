"""Text cleaning and tokenising on native string expressions.

The patterns spell their character classes out, because ``\\w`` and ``\\s`` mean
different things to different regex engines: a word character is a letter, a number
or an underscore of any script, white space is every Unicode space plus the four
ASCII separators U+001C to U+001F.
"""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes and patterns of the cleaning rules.
WORD = r"\p{L}\p{N}_"
BLANK = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
URL = rf"(?:http|www)[^{BLANK}]+"
MENTION = rf"@[{WORD}]+"
HASHTAG = rf"#[{WORD}]+"
TAGGED = rf"[@#][{WORD}]+"
TOKEN = rf"[{WORD}]{{2,}}"
PUNCTUATION = string.punctuation
PUNCTUATION_CLASS = r"[!-/:-@\[-`{-~]"
BLANK_CODES = (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
BLANK_CHARACTERS = "".join(map(chr, BLANK_CODES))


def _erase(text: Column, pattern: str, *marks: str) -> Column:
    """Remove ``pattern``; texts without any of its marks skip the regex engine."""
    present = F.lit(False)
    for mark in marks:
        present = present | F.contains(text, F.lit(mark))
    return F.when(present, F.regexp_replace(text, pattern, "")).otherwise(text)


def strip_urls(text: Column) -> Column:
    return _erase(text, URL, "http", "www")


def strip_mentions(text: Column) -> Column:
    return _erase(text, MENTION, "@")


def strip_hashtags(text: Column) -> Column:
    return _erase(text, HASHTAG, "#")


def strip_tagged(text: Column) -> Column:
    """Mentions, then hashtags, in one scan.

    One scan is enough: a removed run ends before a character that is no word
    character, so removing it can never complete another mention or hashtag.
    """
    return _erase(text, TAGGED, "@", "#")


def strip_punctuation(text: Column) -> Column:
    """Delete the 32 ASCII marks without leaving a space."""
    return F.regexp_replace(text, PUNCTUATION_CLASS, "")


def trim_blank(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANK_CHARACTERS))


def clean_text(text: Column) -> Column:
    """URLs, mentions, hashtags and punctuation out, lower case, trimmed; null reads ``nan``."""
    named = F.coalesce(text, F.lit("nan"))
    return trim_blank(F.lower(strip_punctuation(strip_tagged(strip_urls(named)))))


def tokens(text: Column) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def without_words(words: Column, unwanted: Iterable[str]) -> Column:
    listed = sorted(set(unwanted))
    return F.filter(words, lambda word: ~word.isin(listed)) if listed else words

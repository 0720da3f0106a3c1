"""Text column functions (all JVM-side except the stemmer, which runs once
per distinct word through an Arrow pandas UDF)."""

from __future__ import annotations

import string
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

STOP_WORDS_FILE = Path(__file__).with_name("stopwords_en.txt")

# Fixed values that must equal the reference's for the same results:
# the email header/body marker and Python's 32 ASCII punctuation characters.
MARKER = "X-FileName:"
PUNCTUATION = string.punctuation          # !"#$%&'()*+,-./:;<=>?@[\]^_`{|}~
# whitespace that separates words (space, tab, newline, return, form feed, vertical tab)
WS_PATTERN = "[ \\t\\n\\r\\f\\x0B]+"
# word tokens: two or more letters, digits or underscores
TOKEN_PATTERN = "[\\p{L}\\p{N}_]{2,}"


def after_marker(text: Column, marker: str = MARKER) -> Column:
    """Text between the first and the second marker; null when absent."""
    parts = F.split(text, marker.replace("-", "\\-"))
    return F.when(F.size(parts) > 1, F.get(parts, 1))


def strip_punct(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, "")


def split_ws(text: Column) -> Column:
    """Words separated by whitespace runs, no empty strings."""
    return F.filter(F.split(text, WS_PATTERN), lambda w: w != "")


def tokens(text: Column) -> Column:
    """Lower-cased word tokens of at least two word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0)


def english_stop_words() -> list[str]:
    """Spark's English stop list (Apache Spark, ml/feature/stopwords/english.txt,
    Apache License 2.0), kept as a package data file so that importing the
    catalog needs neither a jar nor a JVM."""
    return STOP_WORDS_FILE.read_text("utf-8").split()

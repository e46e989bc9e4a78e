"""Text: tokens, cleaning, stop words and the wildcard search box."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
# Patterns and marks that fix which characters make a word. \p{Alnum} is
# a-z, A-Z and 0-9 only; spelled as a POSIX class the JVM matches it several
# times faster, and on all cores, than as three ranges.
NOT_WORD = r"[^\p{Alnum}\s]+"
NOT_CLEAN = r"(?!@)[^\p{Alnum}\s]"
MARKS = r"""[@#/'"]"""
LINK = "http"
BLANKS = " \t\n\r\x0b\x0c"
# Filler words left out of the plain corpus count.
FILLER_WORDS = (
    "umm", "us", "you", "i", "and", "what", "the", "fuck", "shit", "crap",
    "omg", "ditto", "of", "sort", "as", "are", "is", "should", "shall",
    "else", "then", "not", "it", "stuff", "for", "if", "so", "wasn't",
    "isn't", "to", "that", "on", "at", "my", "in", "a", "fucking", "about", "your",
    "would", "could", "but", "yet", "did", "it.", "sure", "with", "this", "just",
    "have", "was", "when", "from", "they", "how", "really", "will", "too", "even", "only",
    "had", "his", "her", "wanna", "off", "gonna", "them", "being", "someone", "some",
    "somebody", "its", "an",
)
# -----------------------------------------------------------------------------


def word_list(text: Column) -> Column:
    """Lower-case, drop everything but ASCII letters, digits and blanks, and cut
    at runs of blanks. May hold empty strings; readers drop them after explode."""
    return F.split(F.regexp_replace(F.lower(text), NOT_WORD, ""), r"\s+")


def clean_text(text: Column) -> Column:
    """Keep letters, digits and ``@``; one space between words, none around."""
    kept = F.regexp_replace(text, NOT_CLEAN, "")
    return F.trim(F.regexp_replace(kept, r"\s+", " "))


def digits_only(c: Column) -> Column:
    """Keep digits and dots of an id."""
    return F.regexp_replace(c, r"[^0-9.]+", "")


def has_mark(word: Column) -> Column:
    return word.rlike(MARKS)


def stop_words(words: Iterable[str]) -> list[str]:
    """A stop list in the form tokens have, so that ``isn't`` can match."""
    return sorted({re.sub(r"[^a-z0-9]", "", w.lower()) for w in words} - {""})


def default_stop_words() -> list[str]:
    """Spark's own English list, in token form."""
    return stop_words(StopWordsRemover.loadDefaultStopWords("english"))


def match_text(c: Column, pattern: str | None) -> Column:
    """Search box: case-insensitive substring; ``*`` stands for one letter and
    every other character for itself. An empty pattern matches every row."""
    if not pattern:
        return F.lit(True)
    body = "".join("[A-Za-z]" if ch == "*" else re.escape(ch) for ch in pattern)
    return F.coalesce(c.rlike("(?i)" + body), F.lit(False))


def match_all(patterns: dict[str, str]) -> Column:
    """All fields must match their pattern."""
    out = F.lit(True)
    for name, pattern in patterns.items():
        out = out & match_text(F.col(name), pattern)
    return out

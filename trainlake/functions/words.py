"""Text cleaning expressions.

The single steps are separate functions; letter_words is the one-pass form used
for counting. A run of characters that are no ASCII letters separates words, and
so does an address that starts with lower-case 'http'. Digits and punctuation
are no letters, so the one-pass pattern needs only those two alternatives.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that decide what a word is.
URL = r"http\S+"
PUNCTUATION = r"\p{Punct}"
DIGIT = r"[0-9]"
LETTERS = {"ascii": "[^a-zA-Z]", "unicode": r"[^\p{L}]"}


def _blank(c: Column, pattern: str) -> Column:
    return F.trim(F.regexp_replace(c, pattern, " "))


def strip_urls(c: Column, ignore_case: bool = False) -> Column:
    return _blank(c, ("(?i)" if ignore_case else "") + URL)


def strip_punct(c: Column) -> Column:
    return _blank(c, PUNCTUATION)


def strip_digits(c: Column) -> Column:
    return _blank(c, DIGIT)


def letters_only(c: Column, letters: str = "ascii") -> Column:
    return _blank(c, LETTERS[letters])


def clean_steps(c: Column, letters: str = "ascii", ignore_case: bool = False) -> Column:
    """The cleaned text with one blank for each removed character."""
    bare = strip_punct(strip_urls(c, ignore_case))
    return F.lower(letters_only(strip_digits(bare), letters))


def letter_words(c: Column, letters: str = "ascii", ignore_case: bool = False) -> Column:
    """Array of lower-case words: the words of clean_steps without its empty ones.

    One regex pass over the text. Lower-casing comes after the replacement, since
    some non-ASCII characters have an ASCII lower-case form.
    """
    url = f"(?i:{URL})" if ignore_case else URL
    spaced = F.lower(F.regexp_replace(c, f"{url}|{LETTERS[letters]}+", " "))
    return F.split(spaced, " ")

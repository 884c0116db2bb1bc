"""Comment text expressions; all built-in JVM functions, no UDFs.

clean      non letters other than ``? ! .`` become one space
sentences  after cleaning only ``. ? !`` can end a sentence
tokens     letter runs and the marks themselves, as a tokenizer keeps them
words      lower-cased ASCII letter runs (marks dropped)

Words are taken from the raw text: cleaning only rewrites runs of
non-letters, so the letter runs of a text and of its cleaned form are the
same.  Word extraction skips the cleaning.  Each run is
lower-cased on its own: lower-casing the whole raw text first would turn
some non-ASCII letters into ASCII ones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What cleaning keeps, and the splitting patterns.
KEPT_PATTERN = "[A-Za-z?!.]+"
SENTENCE_PATTERN = "[^.?!]+[.?!]*"
TOKEN_PATTERN = "[A-Za-z]+|[.?!]"
WORD_PATTERN = "[A-Za-z]+"


def clean_comment(c: Column) -> Column:
    """Non-letter runs as one space: the runs between them, joined, with a
    space where the text begins or ends with such a run.  (To find runs by
    the negated class takes some ten times as long.)"""
    joined = F.array_join(F.regexp_extract_all(c, F.lit(KEPT_PATTERN), 0), " ")

    def edge(at: int, no_space: Column) -> Column:
        return F.when(no_space | F.substring(c, at, 1).rlike(KEPT_PATTERN), "").otherwise(" ")

    return F.concat(edge(1, c == ""), joined, edge(-1, ~has_content(c)))


def has_content(c: Column) -> Column:
    """Whether the cleaned comment is not blank, from the raw text."""
    return c.rlike(KEPT_PATTERN)


def sentence_array(cleaned: Column) -> Column:
    """Sentences of an already cleaned comment, untrimmed."""
    return F.regexp_extract_all(cleaned, F.lit(SENTENCE_PATTERN), 0)


def token_array(sentence: Column) -> Column:
    return F.regexp_extract_all(sentence, F.lit(TOKEN_PATTERN), 0)


def word_array(text: Column) -> Column:
    """Lower-case words of a raw or cleaned text (same result for both)."""
    return F.transform(F.regexp_extract_all(text, F.lit(WORD_PATTERN), 0), lambda w: F.lower(w))


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text (``size(null)`` is -1 when ANSI
    mode is off)."""
    return F.size(word_array(F.coalesce(text, F.lit("")))).cast("bigint")

"""Text normalisation and tokenisation as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the whitespace class of Python's str.split()/str.strip() (Unicode-aware), spelled
# out so Java regex and RE2 (the SQL oracle) agree:
# U+0009-U+000D, U+001C-U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A, U+2028, U+2029, U+202F,
# U+205F, U+3000.
WHITESPACE_RUN = (
    r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)

# Word tokens for TF-IDF: maximal runs of two or more letters, digits or underscores.
WORD_TOKEN = r"[\p{L}\p{N}_]{2,}"


def normalize(text: Column) -> Column:
    """lower -> strip -> collapse every whitespace run to one space."""
    return F.trim(F.regexp_replace(F.lower(text), WHITESPACE_RUN, " "))


def tokens(norm: Column) -> Column:
    """Space tokens of an already normalised text; the empty text has no tokens."""
    return F.when(norm == F.lit(""), F.array().cast("array<string>")).otherwise(
        F.split(norm, " "))


def word_tokens(text: Column) -> Column:
    """Lower-cased word tokens (TF-IDF vocabulary units)."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_TOKEN), 0)


def capitalize(text: Column) -> Column:
    """First character upper, rest lower; NULL stays NULL."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 1 << 30)))

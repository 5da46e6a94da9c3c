"""Text expressions: keyword tokens (U1) and comma tokens (A5).

The shop's keyword function runs a dictionary segmenter per row. Here it is re-aimed as a plain JVM
expression: lower-case runs of letters and digits, of any alphabet, which is what the segmenter yields on text with blanks between words.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token pattern (letters and digits) and the separator of the running token count.
KEYWORD_PATTERN = r"[\p{L}\p{N}]+"
COMMA = ","


def keyword_tokens(text) -> Column:
    """Array of keyword tokens of a text column; whole text, no truncation."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(c), F.lit(KEYWORD_PATTERN), 0)


def comma_tokens(text) -> Column:
    """Array of the non-empty comma-separated pieces of a text column."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(c, COMMA), lambda t: F.length(t) > 0)

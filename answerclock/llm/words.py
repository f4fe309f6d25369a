"""Word expressions of the native operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word is a run of anything but space and \t to \r.
WORD = r"[^\x20\x09-\x0D]+"


def word_array(text: str | Column) -> Column:
    """Words of a text in order; null has none."""
    value = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.coalesce(value, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: str) -> Column:
    """Number of words as a long; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: str) -> Column:
    """A to Z lowered, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

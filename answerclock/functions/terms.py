"""Term counts of one document as an array expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sorted_tokens(tokens) -> Column:
    return F.sort_array(F.col(tokens) if isinstance(tokens, str) else tokens)


def run_starts(words: str) -> Column:
    """Positions (from 0) in the sorted array column ``words`` where a new term begins."""
    items = F.col(words)
    places = F.sequence(F.lit(0), F.size(items) - 1)
    first = F.filter(
        places, lambda i: (i == 0) | (F.get(items, i) != F.get(items, i - 1))
    )
    return F.when(F.size(items) > 0, first).otherwise(F.array().cast("array<int>"))


def run_lengths(words: str, starts: str) -> Column:
    """``array<struct<term, n>>`` from the sorted array ``words`` and its ``starts``."""
    items, begin = F.col(words), F.col(starts)
    ends = F.array_append(F.slice(begin, 2, F.greatest(F.size(begin), F.lit(1))), F.size(items))
    return F.when(F.size(begin) == 0, F.array().cast("array<struct<term:string,n:int>>")).otherwise(
        F.zip_with(
            begin, ends, lambda i, j: F.struct(F.get(items, i).alias("term"), (j - i).alias("n"))
        )
    )

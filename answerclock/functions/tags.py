"""Expressions on tag strings such as ``<a><b>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tag_array(tags) -> Column:
    """``<a><b>`` to ``['a', 'b']``; repeats stay, ``<>`` and the empty text give one empty tag."""
    text = F.col(tags) if isinstance(tags, str) else tags
    inner = F.substring(text, F.lit(2), F.length(text) - 2)
    return F.split(inner, "><", -1)


def response_count(answers, comments, each_null_as_zero: bool = False) -> Column:
    """Answers plus comments. By default a null on either side makes the whole sum 0."""
    a, c = F.col(answers), F.col(comments)
    if each_null_as_zero:
        return F.coalesce(a, F.lit(0)) + F.coalesce(c, F.lit(0))
    return F.coalesce(a + c, F.lit(0))

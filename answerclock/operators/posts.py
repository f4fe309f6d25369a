"""Filters and selections on the post table (columns as in ``schemas.POSTS``).

Bounds compare the raw timestamp with a literal, so they reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerclock.functions.times import epoch_seconds, timestamp, year_start

QUESTION = 1  # fixed value: post type of a question


def since(df: DataFrame, ts_col: str, ts: str) -> DataFrame:
    return df.filter(F.col(ts_col) >= timestamp(ts))


def since_year(df: DataFrame, year: int, ts_col: str = "creation_date") -> DataFrame:
    return df.filter(F.col(ts_col) >= year_start(year))


def between_years(
    df: DataFrame, first: int, last: int, ts_col: str = "creation_date"
) -> DataFrame:
    """Rows of the years ``first`` to ``last``, both included."""
    ts = F.col(ts_col)
    return df.filter((ts >= year_start(first)) & (ts < year_start(last + 1)))


def questions(df: DataFrame) -> DataFrame:
    """Posts of the question type."""
    return df.filter(F.col("post_type_id") == QUESTION)


def split_posts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(questions, answers) by whether a post has a parent."""
    parent = F.col("parent_id")
    return df.filter(parent.isNull()), df.filter(parent.isNotNull())


def post_projection(posts: DataFrame, min_year: int = 2017) -> DataFrame:
    """The narrow export of a post: tags, id, time in epoch seconds, type and parent."""
    return since_year(posts, min_year).select(
        "tags", "id", epoch_seconds("creation_date").alias("time"), "post_type_id", "parent_id"
    )


def latest(df: DataFrame, ts_col: str, n: int = 10, key: str = "id") -> DataFrame:
    """The ``n`` newest rows; equal times go by ``key``. Each task keeps at most ``n`` rows."""
    return df.orderBy(F.col(ts_col).desc(), F.col(key)).limit(n)

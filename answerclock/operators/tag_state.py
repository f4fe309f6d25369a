"""Tag sums that can be merged, so that a new dump is added and not recomputed.

A state has one row per tag and month of the question, with sums only. States of disjoint sets
of posts are merged by adding them up, in any order. A post belongs to one dump for good.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerclock.functions.tags import response_count
from answerclock.functions.times import seconds_between, year_start
from answerclock.operators.posts import split_posts
from answerclock.operators.tags import (
    ACTIVITY_MIN_YEAR,
    ANSWERS_MIN_YEAR,
    FAST_HOURS,
    TOTAL_USERS,
    explode_tags,
)
from answerclock.schemas import TAG_FEATURES

SUMS = ("posts", "responses", "views", "answers", "active_seconds", "fast")


def _month(col: str):
    return F.date_trunc("month", col).cast("timestamp_ntz").alias("month")


def _fast(asked: DataFrame, answered: DataFrame, hours: float, min_year: int) -> DataFrame:
    """(tag, month, fast) of the fast answers among ``answered`` to the questions ``asked``."""
    start = year_start(min_year)
    left = asked.filter(F.col("tags").isNotNull() & (F.col("creation_date") >= start))
    left = left.select("id", "tags", F.col("creation_date").alias("_asked"))
    right = answered.filter(F.col("creation_date") >= start)
    right = right.select("parent_id", F.col("creation_date").alias("_answered"))
    pairs = left.join(right, F.col("id") == F.col("parent_id"))
    quick = pairs.filter(seconds_between("_asked", "_answered") < F.lit(hours * 3600))
    tagged = explode_tags(quick.select("tags", _month("_asked")))
    return tagged.groupBy("tag", "month").agg(F.count(F.lit(1)).alias("fast"))


def _activity(asked: DataFrame) -> DataFrame:
    active = seconds_between("creation_date", "last_activity_date")
    rows = asked.select(
        "tags",
        _month("creation_date"),
        F.lit(1).alias("posts"),
        response_count("answer_count", "comment_count").alias("responses"),
        F.coalesce("view_count", F.lit(0)).alias("views"),
        F.coalesce("answer_count", F.lit(0)).alias("answers"),
        F.coalesce(active, F.lit(0)).alias("active_seconds"),
    )
    return explode_tags(rows).groupBy("tag", "month").agg(*[F.sum(c).alias(c) for c in SUMS[:-1]])


def _state(*parts: DataFrame) -> DataFrame:
    full = [
        p.select("tag", "month", *[F.col(c) if c in p.columns else F.lit(0).alias(c) for c in SUMS])
        for p in parts
    ]
    rows = reduce(DataFrame.unionByName, full)
    return rows.groupBy("tag", "month").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in SUMS]
    )


def merged(*states: DataFrame) -> DataFrame:
    """The state of all posts that the ``states`` were made of."""
    return _state(*states)


def tag_state(
    posts: DataFrame,
    known: DataFrame | None = None,
    hours: float = FAST_HOURS,
    answers_min_year: int = ANSWERS_MIN_YEAR,
) -> DataFrame:
    """(tag, month, ``SUMS``) of ``posts``: what they add to the state of the ``known`` posts.

    Answers meet questions of their own dump; with ``known`` also those of earlier ones, and
    earlier answers the new questions. Only the narrow columns of known posts are read.
    """
    asked, answered = split_posts(posts)
    asked = asked.filter(F.col("tags").isNotNull())
    parts = [_activity(asked), _fast(asked, answered, hours, answers_min_year)]
    if known is not None:
        old_asked, old_answered = split_posts(known)
        parts.append(_fast(old_asked, answered, hours, answers_min_year))
        parts.append(_fast(asked, old_answered, hours, answers_min_year))
    return _state(*parts)


def state_features(
    state: DataFrame,
    total_users: int = TOTAL_USERS,
    activity_min_year: int = ACTIVITY_MIN_YEAR,
) -> DataFrame:
    """The merged tag table from a state, equal to ``tags.tag_features`` of its posts."""
    recent = F.col("month") >= year_start(activity_min_year)
    sums = state.groupBy("tag").agg(
        F.sum(F.when(recent, F.col("posts")).otherwise(0)).alias("recent"),
        F.sum(F.when(recent, F.col("responses")).otherwise(0)).alias("recent_responses"),
        *[F.sum(c).alias(c) for c in SUMS],
    )
    return (
        sums.filter((F.col("recent") > 0) & (F.col("fast") > 0))
        .select(
            "tag",
            (F.col("recent") / F.lit(total_users)).alias("PR"),
            (F.col("recent_responses") / F.lit(total_users)).alias("ASR"),
            F.col("posts").alias("TCF"),
            F.col("views").alias("VCF"),
            F.col("answers").alias("ACF"),
            (F.col("active_seconds") / F.lit(3600)).alias("latf_h"),
            F.col("fast").alias("RSR"),
        )
        .select("tag", *TAG_FEATURES)
    )

"""Posts written once, bucketed by question, so that questions meet their answers in place.

Questions are bucketed by id and answers by the question that they belong to, in the same
number of buckets. An accepted answer lies in its question's bucket too, as it is an answer to
it. Joins of the two tables then need no shuffle, however often they are run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerclock.functions.times import seconds_between
from answerclock.operators.posts import since_year, split_posts
from answerclock.operators.storage import bucketed
from answerclock.operators.tags import ANSWERS_MIN_YEAR, explode_tags

BUCKET_BYTES = 128 * 1024 * 1024
# Estimated bytes of one answer in a bucket; texts belong in a table of their own.
ANSWER_BYTES = 64


@dataclass(frozen=True)
class PostStore:
    """``questions`` (all columns, by ``id``) and ``answers`` (all columns, by ``question_id``)."""

    questions: DataFrame
    answers: DataFrame


def store_posts(posts: DataFrame, buckets: int | None = None) -> PostStore:
    """Write ``posts`` in ``buckets`` (by the number of posts if not given)."""
    asked, answered = split_posts(posts)
    if buckets is None:
        buckets = max(1, posts.count() * ANSWER_BYTES // BUCKET_BYTES)
    answers = answered.withColumnRenamed("parent_id", "question_id")
    return PostStore(bucketed(asked, "id", buckets), bucketed(answers, "question_id", buckets))


def stored_response_times(store: PostStore) -> DataFrame:
    """``response.response_times`` of a store: no shuffle.

    An accepted answer is looked for among the answers to its question; one that belongs to
    another question is no answer to it and not found.
    """
    asked = store.questions.filter(F.col("accepted_answer_id").isNotNull()).select(
        "id", "creation_date", "accepted_answer_id"
    )
    answered = store.answers.select(
        "question_id", F.col("id").alias("_answer"), F.col("creation_date").alias("_answered")
    )
    pairs = asked.join(answered, F.col("id") == F.col("question_id"))
    # Written as a range, so that it is no key of the join, by which nothing is bucketed.
    pairs = pairs.filter(F.col("accepted_answer_id").between(F.col("_answer"), F.col("_answer")))
    timed = pairs.select(
        "id", "creation_date", seconds_between("creation_date", "_answered").alias("response_seconds")
    )
    return timed.filter(F.col("response_seconds") >= 0).withColumn(
        "response_hours", F.col("response_seconds") / F.lit(3600)
    )


def stored_answer_delays(store: PostStore, min_year: int = ANSWERS_MIN_YEAR) -> DataFrame:
    """``tags.answer_delays`` of a store: no shuffle."""
    asked = since_year(store.questions, min_year).filter(F.col("tags").isNotNull())
    asked = asked.select("id", "tags", F.col("creation_date").alias("_asked"))
    answered = since_year(store.answers, min_year).select(
        "question_id", F.col("creation_date").alias("_answered")
    )
    pairs = asked.join(answered, F.col("id") == F.col("question_id"))
    delay = seconds_between("_asked", "_answered") / F.lit(3600)
    return explode_tags(pairs.select("tags", "id", delay.alias("delay_hours")))


def answers_per_question(store: PostStore) -> DataFrame:
    """(id, answers, first_hours) of every question: the answers are summed in place, no shuffle."""
    sums = store.answers.groupBy("question_id").agg(
        F.count(F.lit(1)).alias("_n"), F.min("creation_date").alias("_first")
    )
    joined = store.questions.select("id", "creation_date").join(
        sums, F.col("id") == F.col("question_id"), "left"
    )
    first = seconds_between("creation_date", "_first") / F.lit(3600)
    return joined.select("id", F.coalesce("_n", F.lit(0)).alias("answers"), first.alias("first_hours"))

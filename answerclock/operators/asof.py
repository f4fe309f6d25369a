"""Features of tags as they stood when a question was asked, free of what came later.

Everything that happens to a tag is an event at a second: a question is asked, or one of its
questions is answered. Events are summed per tag and second inside the tasks that read them,
so a tag has at most 86,400 rows a day however many posts it has. Their totals before a second
are the totals of all earlier days plus those of earlier seconds of its day: two running sums,
one over the days of a tag and one inside each of its days, so that no task holds a whole tag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from answerclock.functions.times import seconds_between
from answerclock.operators.posts import split_posts
from answerclock.operators.storage import stored
from answerclock.operators.tags import FAST_HOURS, explode_tags

BEFORE = ("asked_before", "views_before", "answered_before", "fast_before", "delay_hours_before")
_SUMS = ("asked", "views", "answered", "fast", "delay_seconds")


def _event(at: str, **sums: Column) -> list[Column]:
    """Columns of an event: its second, and the amounts that it adds."""
    second = F.date_trunc("second", at).cast("timestamp_ntz").alias("at")
    return [second] + [sums.get(c, F.lit(0)).cast("long").alias(c) for c in _SUMS]


def tag_events(posts: DataFrame, hours: float = FAST_HOURS) -> DataFrame:
    """(tag, at, sums): one row per tag and second at which something happened to it.

    A question counts, with its views, when it was asked, an answer when it was given. Views
    are the totals of the dump, as posts keep no dates of them; leave them out where that matters.
    """
    asked, answered = split_posts(posts.filter(F.col("creation_date").isNotNull()))
    asked = asked.filter(F.col("tags").isNotNull())
    questions = asked.select(
        "tags",
        *_event("creation_date", asked=F.lit(1), views=F.coalesce("view_count", F.lit(0))),
    )
    pairs = asked.select("id", "tags", F.col("creation_date").alias("_asked")).join(
        answered.select("parent_id", F.col("creation_date").alias("_answered")),
        F.col("id") == F.col("parent_id"),
    )
    delay = seconds_between("_asked", "_answered")
    fast = (delay < F.lit(hours * 3600)).cast("long")
    answers = pairs.select(
        "tags", *_event("_answered", answered=F.lit(1), fast=fast, delay_seconds=delay)
    )
    events = explode_tags(questions).unionByName(explode_tags(answers))
    return events.groupBy("tag", "at").agg(*[F.sum(c).alias(c) for c in _SUMS])


def totals_before(events: DataFrame) -> DataFrame:
    """``events`` with each sum replaced by its total over all earlier seconds of the tag."""
    dated = stored(events.withColumn("day", F.to_date("at")))
    by_day = dated.groupBy("tag", "day").agg(*[F.sum(c).alias(c) for c in _SUMS])
    earlier = (Window.unboundedPreceding, -1)
    days = Window.partitionBy("tag").orderBy("day").rowsBetween(*earlier)
    inside = Window.partitionBy("tag", "day").orderBy("at").rowsBetween(*earlier)
    none = F.lit(0)
    before_day = by_day.select(
        "tag", "day", *[F.coalesce(F.sum(c).over(days), none).alias(f"_{c}") for c in _SUMS]
    )
    joined = dated.join(before_day, ["tag", "day"])
    totals = [(F.coalesce(F.sum(c).over(inside), none) + F.col(f"_{c}")).alias(c) for c in _SUMS]
    return joined.select("tag", "at", *totals)


def post_tag_features_before(posts: DataFrame, hours: float = FAST_HOURS) -> DataFrame:
    """(id, ``BEFORE``): means over a question's tags of what the tags had before it was asked.

    Events of the same second do not count. A tag that never occurred before has zeros; a
    question without tags or without a date has no row.
    """
    totals = totals_before(tag_events(posts, hours))
    asked = split_posts(posts)[0].select(
        "id", "tags", F.date_trunc("second", "creation_date").cast("timestamp_ntz").alias("at")
    )
    joined = explode_tags(asked).join(totals, ["tag", "at"])
    values = dict(zip(BEFORE, _SUMS, strict=True))
    means = [F.avg(F.col(c)).alias(name) for name, c in values.items() if c != "delay_seconds"]
    hours_before = (F.avg("delay_seconds") / F.lit(3600)).alias("delay_hours_before")
    return joined.groupBy("id").agg(*means, hours_before)

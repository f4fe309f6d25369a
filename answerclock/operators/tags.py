"""Features of tags, and their means per post.

Tags are exploded inside the task that reads the post and pre-aggregated there,
so a tag on a third of all posts costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerclock.functions.tags import response_count, tag_array
from answerclock.functions.times import seconds_between, year_start
from answerclock.operators.lookups import BROADCAST_LIMIT, join_lookup
from answerclock.operators.posts import between_years, since_year, split_posts
from answerclock.schemas import TAG_FEATURES

# Size of the user base, first years that count, what a fast answer is.
TOTAL_USERS = 14_000_000
ACTIVITY_MIN_YEAR = 2008
ANSWERS_MIN_YEAR = 2017
FAST_HOURS = 1
RATIO_FACTOR = 1000


def explode_tags(df: DataFrame, col: str = "tags", name: str = "tag") -> DataFrame:
    """One row per tag of a row; rows without tags go, a repeated tag counts twice."""
    rest = [c for c in df.columns if c != col]
    tagged = df.filter(F.col(col).isNotNull())
    return tagged.select(F.explode(tag_array(col)).alias(name), *rest)


def _activity_sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("TCF"),
        F.sum(F.coalesce("view_count", F.lit(0))).alias("VCF"),
        F.sum(F.coalesce("answer_count", F.lit(0))).alias("ACF"),
        F.coalesce(F.sum("active_seconds"), F.lit(0)).alias("active_seconds"),
    ]


def _active_seconds() -> Column:
    return seconds_between("creation_date", "last_activity_date").alias("active_seconds")


def tag_asr_pr(
    posts: DataFrame,
    total_users: int = TOTAL_USERS,
    min_year: int = ACTIVITY_MIN_YEAR,
    each_null_as_zero: bool = False,
) -> DataFrame:
    """Per tag: posts (PR) and responses (ASR), both divided by the number of users."""
    responses = response_count("answer_count", "comment_count", each_null_as_zero)
    tagged = explode_tags(since_year(posts, min_year).select("tags", responses.alias("responses")))
    sums = tagged.groupBy("tag").agg(
        F.count(F.lit(1)).alias("posts"), F.sum("responses").alias("responses")
    )
    return sums.select(
        "tag",
        (F.col("posts") / F.lit(total_users)).alias("PR"),
        (F.col("responses") / F.lit(total_users)).alias("ASR"),
    )


def tag_four(posts: DataFrame) -> DataFrame:
    """Per tag: posts (TCF), views (VCF), answers (ACF), summed hours until last activity."""
    tagged = explode_tags(posts.select("tags", "view_count", "answer_count", _active_seconds()))
    sums = tagged.groupBy("tag").agg(*_activity_sums())
    return sums.select(
        "tag", "TCF", "VCF", "ACF", (F.col("active_seconds") / F.lit(3600)).alias("latf_h")
    )


def answer_delays(posts: DataFrame, min_year: int = ANSWERS_MIN_YEAR) -> DataFrame:
    """One row per tag of a question and answer to it: (tag, id, delay_hours).

    Questions meet answers before tags are exploded, so each side is shuffled
    once and narrow. Nothing after the join needs its partitioning, which lets
    adaptive execution split a question that draws a large share of all answers.
    """
    asked, answered = split_posts(since_year(posts, min_year))
    asked = asked.filter(F.col("tags").isNotNull()).select(
        "id", "tags", F.col("creation_date").alias("asked")
    )
    answered = answered.select("parent_id", F.col("creation_date").alias("answered"))
    pairs = asked.join(answered, asked["id"] == answered["parent_id"])
    delay = seconds_between("asked", "answered") / F.lit(3600)
    return explode_tags(pairs.select("tags", "id", delay.alias("delay_hours")))


def tag_rsr(
    delays: DataFrame, hours: float = FAST_HOURS, min_hours: float | None = None
) -> DataFrame:
    """Per tag: number of answers within ``hours``. Negative delays count unless ``min_hours``."""
    fast = delays.filter(F.col("delay_hours") < hours)
    if min_hours is not None:
        fast = fast.filter(F.col("delay_hours") >= min_hours)
    return fast.groupBy("tag").agg(F.count(F.lit(1)).alias("RSR"))


def merge_tag_features(
    asr_pr: DataFrame, four: DataFrame, rsr: DataFrame, how: str = "inner"
) -> DataFrame:
    """The seven features per tag from the three tag tables; ``inner`` keeps tags in all three."""
    merged = asr_pr.join(four, "tag", how).join(rsr, "tag", how)
    return merged.select("tag", *TAG_FEATURES)


def tag_features(
    posts: DataFrame,
    total_users: int = TOTAL_USERS,
    activity_min_year: int = ACTIVITY_MIN_YEAR,
    answers_min_year: int = ANSWERS_MIN_YEAR,
    hours: float = FAST_HOURS,
) -> DataFrame:
    """The merged tag table straight from posts.

    Same result as ``merge_tag_features`` of the three tables, with one scan and
    one aggregation for the six activity features instead of two.
    """
    recent = F.col("creation_date") >= year_start(activity_min_year)
    tagged = explode_tags(
        posts.select(
            "tags",
            "view_count",
            "answer_count",
            _active_seconds(),
            F.when(recent, 1).alias("recent"),
            F.when(recent, response_count("answer_count", "comment_count")).alias("responses"),
        )
    )
    sums = tagged.groupBy("tag").agg(
        *_activity_sums(),
        F.count("recent").alias("recent"),
        F.sum("responses").alias("responses"),
    )
    activity = sums.filter(F.col("recent") > 0).select(
        "tag",
        (F.col("recent") / F.lit(total_users)).alias("PR"),
        (F.col("responses") / F.lit(total_users)).alias("ASR"),
        "TCF",
        "VCF",
        "ACF",
        (F.col("active_seconds") / F.lit(3600)).alias("latf_h"),
    )
    rsr = tag_rsr(answer_delays(posts, answers_min_year), hours)
    return activity.join(rsr, "tag").select("tag", *TAG_FEATURES)


def scale_ratio(
    df: DataFrame,
    cols: tuple[str, ...] = ("PR", "ASR"),
    total_users: int = TOTAL_USERS,
    factor: int = RATIO_FACTOR,
) -> DataFrame:
    """Multiply ``cols`` by ``factor`` and divide them by the number of users.

    With ``factor=1`` and ``cols=("RSR",)`` the count of fast answers becomes a ratio.
    """
    scaled = {c: F.col(c) * F.lit(factor) / F.lit(total_users) for c in cols}
    return df.withColumns(scaled)


def post_tag_features(
    posts: DataFrame,
    tag_table: DataFrame,
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Per post: mean of each tag feature over the tags of the post found in ``tag_table``."""
    tagged = explode_tags(posts.select("id", "tags"))
    joined = join_lookup(tagged, tag_table, "tag", "TCF", broadcast_limit=broadcast_limit)
    return joined.groupBy("id").agg(*[F.avg(c).alias(c) for c in TAG_FEATURES])


def tags_in_use(tag_table: DataFrame, posts: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of ``tag_table`` whose tag is on a post of the years ``first`` to ``last``.

    The used tags are made distinct inside each task before the semi-join, so the
    shuffle carries tags and not posts.
    """
    used = explode_tags(between_years(posts, first, last).select("tags")).distinct()
    return tag_table.join(used, "tag", "left_semi")

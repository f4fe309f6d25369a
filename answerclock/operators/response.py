"""Response times: from question to accepted answer, with labels and statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from answerclock.functions.times import seconds_between
from answerclock.operators.storage import stored

# Label limit, interval edges and histogram settings.
LABEL_HOURS = 1
INTERVAL_EDGES = (0, 1, 4, 12)
HISTOGRAM_BINS = 100
HISTOGRAM_MAX_HOURS = 25


def accepted_pairs(posts: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Every question with the time of its accepted answer: (id, asked, answered, ``carry``...).

    Only answers (posts with a parent) are offered as answers, and both sides are cut to the
    columns needed before the shuffle.
    """
    asked = posts.filter(F.col("accepted_answer_id").isNotNull()).select(
        "id", F.col("creation_date").alias("asked"), "accepted_answer_id", *carry
    )
    answered = posts.filter(F.col("parent_id").isNotNull()).select(
        F.col("id").alias("answer_id"), F.col("creation_date").alias("answered")
    )
    pairs = asked.join(answered, asked["accepted_answer_id"] == answered["answer_id"])
    return pairs.select("id", "asked", "answered", *carry)


def response_times(posts: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Answered questions with their response time, negative times left out."""
    pairs = accepted_pairs(posts, carry)
    timed = pairs.select(
        "id",
        F.col("asked").alias("creation_date"),
        seconds_between("asked", "answered").alias("response_seconds"),
        *carry,
    )
    return timed.filter(F.col("response_seconds") >= 0).withColumn(
        "response_hours", F.col("response_seconds") / F.lit(3600)
    )


def fast_label(hours: str | Column = "response_hours", limit: float = LABEL_HOURS) -> Column:
    """0 when answered in [0, limit) hours, else 1."""
    value = F.col(hours) if isinstance(hours, str) else hours
    return F.when((value >= 0) & (value < limit), 0).otherwise(1)


def response_labels(times: DataFrame, limit: float = LABEL_HOURS) -> DataFrame:
    return times.withColumn("label", fast_label(limit=limit))


def answered_count(times: DataFrame) -> DataFrame:
    return times.agg(F.count(F.lit(1)).alias("answered"))


def histogram(
    df: DataFrame, col: str, bins: int = HISTOGRAM_BINS, maximum: float | None = None
) -> DataFrame:
    """Counts in ``bins`` equal-width bins from minimum to maximum, the last one closed.

    Null, NaN and infinite values are left out. The one narrow column is stored, so
    that what made it runs once; bounds and bins are two passes over it, each combined
    inside its tasks: at most ``bins`` rows per task are shuffled. A constant column
    gets a range of one around it. Empty bins show 0.
    """
    value = F.col(col).cast("double")
    kept = df.select(value.alias("value")).filter(
        F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf"))
    )
    if maximum is not None:
        kept = kept.filter(F.col("value") <= maximum)
    kept = stored(kept)
    low, high = F.min("value"), F.max("value")
    pad = F.when(low == high, 0.5).otherwise(0.0)
    bounds = kept.agg(F.struct((low - pad).alias("low"), (high + pad).alias("high"))).scalar()
    low, high = bounds.getField("low"), bounds.getField("high")
    place = F.floor((F.col("value") - low) / (high - low) * F.lit(bins)).cast("int")
    filled = (
        kept.select(F.least(place, F.lit(bins - 1)).alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    every_bin = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (high - low) / F.lit(bins)
    return every_bin.join(F.broadcast(filled), "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("bin_start"),
        (low + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def response_buckets(
    times: DataFrame, edges: Sequence[float] = INTERVAL_EDGES, col: str = "response_hours"
) -> DataFrame:
    """Posts and mean response time per interval [edge, next edge), the last one open."""
    value = F.col(col)
    bucket = F.lit(None).cast("int")
    for place, edge in enumerate(edges):
        bucket = F.when(value >= edge, place).otherwise(bucket)
    starts = F.array(*[F.lit(float(e)) for e in edges])
    ends = F.array(*[F.lit(float(e)) for e in edges[1:]], F.lit(None).cast("double"))
    grouped = (
        times.withColumn("bucket", bucket)
        .filter(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("posts"), F.sum("response_seconds").alias("seconds"))
    )
    return grouped.select(
        "bucket",
        F.get(starts, F.col("bucket")).alias("from_hours"),
        F.get(ends, F.col("bucket")).alias("to_hours"),
        "posts",
        (F.col("seconds") / F.col("posts") / F.lit(3600)).alias("mean_hours"),
    )


def response_trend(times: DataFrame, unit: str = "month") -> DataFrame:
    """Posts and mean response time per calendar ``unit`` of the question.

    Seconds are summed as integers and divided once, so the mean does not depend
    on the order of rows.
    """
    return (
        times.groupBy(F.date_trunc(unit, "creation_date").cast("timestamp_ntz").alias("period"))
        .agg(F.count(F.lit(1)).alias("posts"), F.sum("response_seconds").alias("seconds"))
        .select(
            "period",
            "posts",
            (F.col("seconds") / F.col("posts") / F.lit(3600)).alias("mean_hours"),
        )
    )


# Calendar steps of the units.
STEPS = {"day": "1 day", "week": "7 days", "month": "1 month", "quarter": "3 months", "year": "1 year"}


def rolling_trend(
    times: DataFrame, unit: str = "day", periods: int = 7, keys: Sequence[str] = ()
) -> DataFrame:
    """Every calendar ``unit`` from first to last with its posts, and sums over ``periods`` units.

    With ``keys`` each group has a calendar of its own, from its first unit to its last. Units
    without a post are there with zeros, and ``mean_hours`` is null where a whole span of units
    has none. A window holds one row per unit of a group, however many posts there are.
    ``unit`` is one of ``STEPS``. Rows without a date are left out.
    """
    period = F.date_trunc(unit, "creation_date").cast("timestamp_ntz").alias("period")
    dated = times.filter(F.col("creation_date").isNotNull())
    trend = stored(
        dated.groupBy(*keys, period).agg(
            F.count(F.lit(1)).alias("posts"), F.sum("response_seconds").alias("seconds")
        )
    )
    bounds = trend.groupBy(*keys).agg(F.min("period").alias("low"), F.max("period").alias("high"))
    step = F.expr(f"INTERVAL {STEPS[unit]}")
    calendar = bounds.filter(F.col("low").isNotNull()).select(
        *keys, F.explode(F.sequence("low", "high", step)).alias("period")
    )
    filled = calendar.join(trend, [*keys, "period"], "left")
    span = Window.partitionBy(*keys).orderBy("period").rowsBetween(1 - periods, 0)
    sums = filled.select(
        *keys,
        "period",
        F.coalesce("posts", F.lit(0)).alias("posts"),
        F.coalesce(F.sum("posts").over(span), F.lit(0)).alias("rolling_posts"),
        F.sum("seconds").over(span).alias("_seconds"),
    )
    mean = F.try_divide(F.col("_seconds"), F.col("rolling_posts")) / F.lit(3600)
    return sums.select(*keys, "period", "posts", "rolling_posts", mean.alias("mean_hours"))

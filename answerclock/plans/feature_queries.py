"""Registered queries on features in time, quantiles, importance, metrics and stored states."""

from __future__ import annotations

from pyspark.sql import functions as F

from answerclock.operators import (
    asof,
    explain,
    metrics,
    post_store,
    quantiles,
    response,
    tag_state,
    tags,
)
from answerclock.operators import sentences as learned
from answerclock.operators.storage import stored
from answerclock.plans import queries as base
from answerclock.plans.stand_in import posts
from answerclock.schemas import FEATURES

SHARES = {0.25: "q25", 0.5: "q50", 0.9: "q90", 1.0: "longest"}
RULE_FEATURES = ["answer_count", "comment_count", "view_count"]
STATE_SPLIT = "1995-07-01T00:00:00.000"


def post_tag_features_before(spark, sf_dir):
    """What a question's tags had seen before it was asked."""
    means = asof.post_tag_features_before(posts(spark, sf_dir), base.FAST_HOURS)
    return means.withColumns({c: F.round(c, base.DIGITS) for c in asof.BEFORE})


def _tagged_times(spark, sf_dir):
    return tags.explode_tags(response.response_times(posts(spark, sf_dir), ["tags"]))


def response_quantiles(spark, sf_dir):
    """Quartile, median, ninth decile and maximum of response times by tag and quarter."""
    timed = _tagged_times(spark, sf_dir)
    period = F.date_trunc("quarter", "creation_date").cast("timestamp_ntz").alias("period")
    rows = timed.select("tag", period, "response_seconds")
    found = quantiles.group_quantiles(rows, ["tag", "period"], "response_seconds", list(SHARES))
    return quantiles.wide(found, ["tag", "period"], "response_seconds", SHARES)


def overall_quantiles(spark, sf_dir):
    """The same of all answered questions by month."""
    period = F.date_trunc("month", "creation_date").cast("timestamp_ntz").alias("period")
    rows = base._times(spark, sf_dir).select(period, "response_seconds")
    found = quantiles.group_quantiles(rows, ["period"], "response_seconds", list(SHARES))
    return quantiles.wide(found, ["period"], "response_seconds", SHARES)


def _rule_rows(spark, sf_dir):
    return base._labels(spark, sf_dir, carry=RULE_FEATURES)


def _rule(df):
    """Fast if many answers and few comments; views do not count."""
    points = F.coalesce("answer_count", F.lit(0)) - F.coalesce("comment_count", F.lit(0))
    return df.withColumn("score", points).withColumn(
        "prediction", F.when(F.col("score") >= 3, 0.0).otherwise(1.0)
    )


def permutation_importance(spark, sf_dir):
    """Accuracy of a rule with each of its columns permuted."""
    found = explain.permutation_importance(_rule_rows(spark, sf_dir), _rule, RULE_FEATURES)
    return found.withColumns({c: F.round(c, base.DIGITS) for c in ("accuracy", "importance")})


def feature_information(spark, sf_dir):
    """Mutual information of each training feature with the label."""
    rows = base._all_features(spark, sf_dir)
    # Sums of doubles differ in their last digits by order, so equal values are made equal.
    rounded = base._rounded(rows)
    found = explain.mutual_information(rounded, FEATURES)
    return found.withColumn("information", F.round("information", base.DIGITS))


def rule_auc(spark, sf_dir):
    """Area under the curve of the rule's score for fast answers."""
    rows = _rule(_rule_rows(spark, sf_dir)).withColumn("fast", F.col("label") == 0)
    found = metrics.area_under_curve(rows, "score", "fast")
    return found.withColumn("auc", F.round("auc", base.DIGITS))


def rule_confusion(spark, sf_dir):
    return metrics.confusion(_rule(_rule_rows(spark, sf_dir)))


def rule_report(spark, sf_dir):
    report = metrics.class_report(rule_confusion(spark, sf_dir))
    digits = {c: F.round(c, base.DIGITS) for c in ("precision", "recall", "f1")}
    return report.withColumns(digits)


def merged_tag_state(spark, sf_dir):
    """The tag table from the state of early posts and what later posts add to it."""
    source = posts(spark, sf_dir)
    early = F.col("creation_date") < F.lit(STATE_SPLIT).cast("timestamp_ntz")
    old, new = source.filter(early), source.filter(~early)
    options = {"hours": base.FAST_HOURS, "answers_min_year": base.ANSWERS_MIN_YEAR}
    state = stored(tag_state.tag_state(old, **options))
    added = tag_state.tag_state(new, known=old, **options)
    both = tag_state.merged(state, added)
    return base._rounded(tag_state.state_features(both, activity_min_year=base.ACTIVITY_MIN_YEAR))


def bucketed_response_times(spark, sf_dir):
    store = post_store.store_posts(posts(spark, sf_dir))
    return post_store.stored_response_times(store)


def bucketed_answer_delays(spark, sf_dir):
    store = post_store.store_posts(posts(spark, sf_dir))
    return post_store.stored_answer_delays(store, base.ANSWERS_MIN_YEAR)


def answers_per_question(spark, sf_dir):
    found = post_store.answers_per_question(post_store.store_posts(posts(spark, sf_dir)))
    return found.withColumn("first_hours", F.round("first_hours", base.DIGITS))


def rolling_trend(spark, sf_dir):
    """Response times over seven days, for every day."""
    trend = response.rolling_trend(base._times(spark, sf_dir), "day", 7)
    return trend.withColumn("mean_hours", F.round("mean_hours", base.DIGITS))


def rolling_tag_trend(spark, sf_dir):
    """Response times of each tag over three months, for every month."""
    trend = response.rolling_trend(_tagged_times(spark, sf_dir), "month", 3, ["tag"])
    return trend.withColumn("mean_hours", F.round("mean_hours", base.DIGITS))


def _cells(vectors, *keys):
    parts = F.unwrap_udt("features")
    cells = F.explode(F.arrays_zip(parts["indices"].alias("place"), parts["values"].alias("weight")))
    rows = vectors.select(*keys, cells.alias("cell")).select(*keys, "cell.*")
    return rows.withColumn("weight", F.round("weight", base.DIGITS))


def tfidf_cells(spark, sf_dir):
    """The hashed vectors, read back as (document, place, weight)."""
    return _cells(base.tfidf_vectors(spark, sf_dir), "doc_id")


def doc_cells(spark, sf_dir):
    """The vectors of the whole text job, read back, with their labels."""
    return _cells(base.doc_vectors(spark, sf_dir), "doc_id", "label")


def abbreviations(spark, sf_dir):
    """Tokens that stand before a period far more often than chance has it."""
    found = learned.period_scores(base._documents(spark, sf_dir), "text")
    return found.withColumn("score", F.round("score", base.DIGITS))


def learned_sentences(spark, sf_dir):
    """Sentences that do not end at learned abbreviations, initials or numbers."""
    return learned.learned_sentences(base._documents(spark, sf_dir), "doc_id", "text")


_REGISTERED = [
    post_tag_features_before,
    response_quantiles,
    overall_quantiles,
    permutation_importance,
    feature_information,
    rule_auc,
    rule_confusion,
    rule_report,
    merged_tag_state,
    bucketed_response_times,
    bucketed_answer_delays,
    answers_per_question,
    rolling_trend,
    rolling_tag_trend,
    tfidf_cells,
    doc_cells,
    abbreviations,
    learned_sentences,
]


def queries() -> dict:
    return {query.__name__: query for query in _REGISTERED}

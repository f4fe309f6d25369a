"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

The given dates are whole days, so a fast answer is one within 720 hours here,
and year bounds lie inside the years of the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answerclock.functions import text
from answerclock.functions.times import is_weekend
from answerclock.operators import merge, ml, response, tags, textfeat, texts
from answerclock.operators import posts as post_ops
from answerclock.plans.stand_in import (
    post_dates,
    post_texts,
    posts,
    table,
    text_table,
)
from answerclock.schemas import FEATURES, TAG_FEATURES

Query = Callable[[SparkSession, str], DataFrame]

FAST_HOURS = 720
ACTIVITY_MIN_YEAR = 1996
ANSWERS_MIN_YEAR = 1997
USED_YEARS = (1996, 1998)
SINCE = "1998-01-16T12:00:00.000"
BUCKET_EDGES = (0, 168, 720, 4380)
HISTOGRAM_MAX_HOURS = 8760
SCRIPT = ("<script", "</script>")
PARAGRAPH = "<p"

# Ratios are multiples of 7e-8, scaled ones far smaller: round them finely. Sums of
# doubles in another order differ beyond these digits.
RATIO_DIGITS = 12
SCALED_DIGITS = 15
DIGITS = 6


def _rounded(df: DataFrame, ratio_digits: int = RATIO_DIGITS) -> DataFrame:
    digits = {c: ratio_digits if c in ("PR", "ASR") else DIGITS for c in TAG_FEATURES}
    return df.withColumns(
        {c: F.round(F.col(c).cast("double"), d) for c, d in digits.items() if c in df.columns}
    )


def _times(spark: SparkSession, sf_dir: str, carry=()) -> DataFrame:
    return response.response_times(posts(spark, sf_dir), carry)


def _labels(spark: SparkSession, sf_dir: str, carry=()) -> DataFrame:
    return response.response_labels(_times(spark, sf_dir, carry), FAST_HOURS)


def _tag_table(source: DataFrame) -> DataFrame:
    return tags.tag_features(
        source,
        activity_min_year=ACTIVITY_MIN_YEAR,
        answers_min_year=ANSWERS_MIN_YEAR,
        hours=FAST_HOURS,
    )


def _text_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the pages that belong to a question. Texts are read before the join."""
    features = textfeat.text_features(
        post_texts(spark, sf_dir),
        ts=None,
        code_open=SCRIPT[0],
        code_close=SCRIPT[1],
        image_open=PARAGRAPH,
        question_mark=".",
    )
    dates = post_dates(spark, sf_dir)
    weekend = is_weekend("creation_date").alias("is_weekend")
    return features.join(dates, "id").select(*features.columns, weekend)


def _all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = posts(spark, sf_dir)
    tag_means = tags.post_tag_features(source, _tag_table(source))
    labels = response.response_labels(response.response_times(source), FAST_HOURS)
    return merge.merge_all(tag_means, _text_table(spark, sf_dir), labels)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_table(spark, sf_dir, "documents")


def _clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts.token_arrays(_documents(spark, sf_dir), "doc_id", "text", stemmed=False)


# --- posts ---------------------------------------------------------------


def post_projection(spark, sf_dir):
    return post_ops.post_projection(posts(spark, sf_dir), ANSWERS_MIN_YEAR)


def posts_since(spark, sf_dir):
    return post_ops.since(posts(spark, sf_dir), "creation_date", SINCE).select(
        "id", "creation_date"
    )


def posts_between_years(spark, sf_dir):
    return post_ops.between_years(posts(spark, sf_dir), *USED_YEARS).select("id", "creation_date")


def questions(spark, sf_dir):
    return post_ops.questions(posts(spark, sf_dir)).select("id", "tags", "creation_date")


def answers(spark, sf_dir):
    return post_ops.split_posts(posts(spark, sf_dir))[1].select("id", "parent_id", "creation_date")


def latest_posts(spark, sf_dir):
    newest = post_ops.latest(posts(spark, sf_dir), "creation_date", 10)
    return newest.select("id", "post_type_id", "creation_date")


def explode_tags(spark, sf_dir):
    return tags.explode_tags(posts(spark, sf_dir).select("id", "tags"))


# --- tags ----------------------------------------------------------------


def tag_asr_pr(spark, sf_dir):
    return _rounded(tags.tag_asr_pr(posts(spark, sf_dir), min_year=ACTIVITY_MIN_YEAR))


def tag_four(spark, sf_dir):
    return tags.tag_four(posts(spark, sf_dir)).withColumn("latf_h", F.round("latf_h", DIGITS))


def answer_delays(spark, sf_dir):
    return tags.answer_delays(posts(spark, sf_dir), ANSWERS_MIN_YEAR)


def tag_rsr(spark, sf_dir):
    return tags.tag_rsr(tags.answer_delays(posts(spark, sf_dir), ANSWERS_MIN_YEAR), FAST_HOURS)


def merged_tag_tables(spark, sf_dir):
    source = posts(spark, sf_dir)
    merged = tags.merge_tag_features(
        tags.tag_asr_pr(source, min_year=ACTIVITY_MIN_YEAR),
        tags.tag_four(source),
        tags.tag_rsr(tags.answer_delays(source, ANSWERS_MIN_YEAR), FAST_HOURS),
    )
    return _rounded(merged)


def tag_features(spark, sf_dir):
    return _rounded(_tag_table(posts(spark, sf_dir)))


def tag_features_scaled(spark, sf_dir):
    scaled = tags.scale_ratio(_tag_table(posts(spark, sf_dir)))
    as_ratio = tags.scale_ratio(scaled, ("RSR",), factor=1).withColumnRenamed("RSR", "rsr_ratio")
    return _rounded(as_ratio, SCALED_DIGITS).withColumn(
        "rsr_ratio", F.round("rsr_ratio", SCALED_DIGITS)
    )


def post_tag_features(spark, sf_dir):
    source = posts(spark, sf_dir)
    return _rounded(tags.post_tag_features(source, _tag_table(source)))


def tags_in_use(spark, sf_dir):
    source = posts(spark, sf_dir)
    return _rounded(tags.tags_in_use(_tag_table(source), source, *USED_YEARS))


# --- response times ------------------------------------------------------


def response_times(spark, sf_dir):
    return _times(spark, sf_dir)


def response_labels(spark, sf_dir):
    return _labels(spark, sf_dir).select("id", "response_hours", "label")


def answered_count(spark, sf_dir):
    return response.answered_count(_times(spark, sf_dir))


def response_histogram(spark, sf_dir):
    recent = post_ops.since(_times(spark, sf_dir), "creation_date", SINCE)
    return response.histogram(recent, "response_hours", maximum=HISTOGRAM_MAX_HOURS)


def value_histogram(spark, sf_dir):
    return response.histogram(table(spark, sf_dir, "events"), "value")


def response_buckets(spark, sf_dir):
    buckets = response.response_buckets(_times(spark, sf_dir), BUCKET_EDGES)
    return buckets.withColumn("mean_hours", F.round("mean_hours", DIGITS))


def response_trend(spark, sf_dir):
    trend = response.response_trend(_times(spark, sf_dir), "month")
    return trend.withColumn("mean_hours", F.round("mean_hours", DIGITS))


# --- text features -------------------------------------------------------


def text_features(spark, sf_dir):
    return _text_table(spark, sf_dir)


def page_markers(spark, sf_dir):
    """The marker, span and title expressions over every page, paired to a post or not."""
    return text_table(spark, sf_dir, "pages").select(
        "page_id",
        text.count_marker("html", SCRIPT[0]).alias("scripts"),
        text.span_length("html", *SCRIPT).alias("script_len"),
        text.span_length("html", PARAGRAPH, "</p>").alias("paragraph_len"),
        text.count_marker("html", PARAGRAPH).alias("paragraphs"),
        text.ends_with("url", "x").alias("ends"),
        text.begins_with("url", "http").alias("begins"),
    )


def weekend_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", is_weekend("ts").alias("is_weekend"))


def strip_html(spark, sf_dir):
    pages = text_table(spark, sf_dir, "pages")
    return pages.select("page_id", text.strip_html("html").alias("plain"))


def strip_code(spark, sf_dir):
    without = F.regexp_replace("html", "<(/?)script", "<$1code")
    return text_table(spark, sf_dir, "pages").select(
        "page_id", text.strip_newlines(text.strip_code(without)).alias("plain")
    )


# --- texts ---------------------------------------------------------------


def sentences(spark, sf_dir):
    return texts.sentences(_documents(spark, sf_dir), "doc_id", "text")


def tokens(spark, sf_dir):
    return texts.tokens(_documents(spark, sf_dir), "doc_id", "text")


def clean_tokens(spark, sf_dir):
    return texts.remove_stopwords(tokens(spark, sf_dir))


def stem_vocab(spark, sf_dir):
    return texts.stem_tokens(clean_tokens(spark, sf_dir))


def token_arrays(spark, sf_dir):
    arrays = _clean_documents(spark, sf_dir)
    return arrays.select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens")
    )


def stem_arrays(spark, sf_dir):
    arrays = texts.token_arrays(_documents(spark, sf_dir), "doc_id", "text")
    return arrays.select("doc_id", F.array_join("tokens", " ").alias("stems"))


def vocabulary(spark, sf_dir):
    return texts.vocabulary(texts.term_counts(_clean_documents(spark, sf_dir), "doc_id"))


def tfidf(spark, sf_dir):
    weights = texts.tfidf(_clean_documents(spark, sf_dir), "doc_id")
    return weights.withColumn("weight", F.round("weight", DIGITS))


def count_vectors(spark, sf_dir):
    """The vectors, read back as (document, term, count) through the stored vocabulary."""
    vectors, places = texts.count_vectors(_clean_documents(spark, sf_dir), "doc_id")
    parts = F.unwrap_udt("features")
    cells = F.explode(F.arrays_zip(parts["indices"].alias("place"), parts["values"].alias("n")))
    rows = vectors.select("doc_id", cells.alias("cell")).select("doc_id", "cell.*")
    named = places.select(F.col("place").cast("int").alias("place"), "term")
    return rows.join(named, "place").select("doc_id", "term", F.col("n").cast("int").alias("n"))


def predict_text_nb(spark, sf_dir):
    """Naive Bayes on count vectors of the labelled documents: quality of the test part."""
    labels = table(spark, sf_dir, "labels").withColumnRenamed("quality", "label")
    docs = _clean_documents(spark, sf_dir).join(labels.select("doc_id"), "doc_id", "left_semi")
    vectors = texts.count_vectors(docs, "doc_id")[0].join(labels, "doc_id")
    train, test = ml.train_test_split(ml.checkpointed(vectors), key="doc_id")
    scored = ml.fit(train, "nb", cols=None).transform(test)
    return scored.select("doc_id", "label", "prediction")


def tfidf_vectors(spark, sf_dir):
    return texts.tfidf_vectors(_clean_documents(spark, sf_dir))


def doc_vectors(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").withColumnRenamed("quality", "label")
    return texts.doc_vectors(_documents(spark, sf_dir), labels, "doc_id", "text")


# --- training ------------------------------------------------------------


def all_features(spark, sf_dir):
    return _rounded(_all_features(spark, sf_dir))


def hash_split(spark, sf_dir):
    return ml.hash_split(_labels(spark, sf_dir).select("id", "label"))


def random_split(spark, sf_dir):
    """Every row with the number of parts that it is in, which is one."""
    train, test = ml.train_test_split(_labels(spark, sf_dir).select("id", "label"), key=None)
    parts = F.count(F.lit(1)).alias("parts")
    return train.unionByName(test).groupBy("id", "label").agg(parts)


def assembled(spark, sf_dir):
    """The assembled vectors, read back as one row per post and position."""
    vectors = ml.assemble(_all_features(spark, sf_dir))
    cells = vectors.select("id", F.posexplode(vector_to_array("features")).alias("place", "value"))
    digits = F.when(F.col("place") < 2, F.round("value", RATIO_DIGITS))
    return cells.withColumn("value", digits.otherwise(F.round("value", DIGITS)))


def _predictions(kind: str) -> Query:
    def run(spark, sf_dir):
        stored = ml.checkpointed(_all_features(spark, sf_dir))
        train, test = ml.train_test_split(stored)
        return ml.fit(train, kind).transform(test).select("id", "label", "prediction")

    return run


predict_rf = _predictions("rf")
predict_nb = _predictions("nb")
predict_lr = _predictions("lr")


def accuracy(spark, sf_dir):
    """Accuracy of a rule: questions with four answers or more are answered fast."""
    labels = _labels(spark, sf_dir, carry=["answer_count"])
    rule = F.when(F.col("answer_count") >= 4, 0.0).otherwise(1.0)
    return ml.evaluate(labels.withColumn("prediction", rule))


def feature_importance(spark, sf_dir):
    stored = ml.checkpointed(_all_features(spark, sf_dir))
    return ml.feature_importance(ml.fit(stored, "rf"), FEATURES)


def train_and_score(spark, sf_dir):
    return ml.train_and_score(_all_features(spark, sf_dir), "rf")


def train_and_score_nb(spark, sf_dir):
    return ml.train_and_score(_all_features(spark, sf_dir), "nb")


_REGISTERED = [
    post_projection,
    posts_since,
    posts_between_years,
    questions,
    answers,
    latest_posts,
    explode_tags,
    tag_asr_pr,
    tag_four,
    answer_delays,
    tag_rsr,
    merged_tag_tables,
    tag_features,
    tag_features_scaled,
    post_tag_features,
    tags_in_use,
    response_times,
    response_labels,
    answered_count,
    response_histogram,
    value_histogram,
    response_buckets,
    response_trend,
    text_features,
    page_markers,
    strip_html,
    strip_code,
    sentences,
    tokens,
    clean_tokens,
    stem_vocab,
    token_arrays,
    stem_arrays,
    vocabulary,
    tfidf,
    count_vectors,
    tfidf_vectors,
    doc_vectors,
    predict_text_nb,
    all_features,
    hash_split,
    random_split,
    assembled,
    accuracy,
    feature_importance,
    train_and_score,
    train_and_score_nb,
]


def queries() -> dict[str, Query]:
    named = {query.__name__: query for query in _REGISTERED}
    named["is_weekend"] = weekend_events
    named |= {"predict_rf": predict_rf, "predict_nb": predict_nb, "predict_lr": predict_lr}
    return named

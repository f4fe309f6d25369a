"""Features of one post from its title, body and creation time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerclock.functions import text
from answerclock.functions.times import is_weekend


def text_features(
    df: DataFrame,
    title: str = "title",
    body: str = "body",
    ts: str | None = "creation_date",
    key: str = "id",
    code_open: str = text.CODE_OPEN,
    code_close: str = text.CODE_CLOSE,
    image_open: str = text.IMAGE_OPEN,
    question_mark: str = text.QUESTION_MARK,
    question_prefix: str = text.QUESTION_PREFIX,
) -> DataFrame:
    """The eight text and time features per row, as built-in expressions in one projection.

    With ``ts=None`` the weekend flag is left out: for texts whose time is in another
    table, so that the join meets these narrow rows and not the texts.
    """
    time_features = [] if ts is None else [is_weekend(ts).alias("is_weekend")]
    return df.select(
        F.col(key),
        text.count_marker(body, code_open).alias("num_code_snippet"),
        text.span_length(body, code_open, code_close).alias("code_len"),
        text.count_marker(body, image_open).alias("num_image"),
        F.length(body).alias("body_len"),
        F.length(title).alias("title_len"),
        text.ends_with(title, question_mark).alias("end_que_mark"),
        text.begins_with(title, question_prefix).alias("begin_que_word"),
        *time_features,
    )

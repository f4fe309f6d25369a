"""One training row per post."""

from __future__ import annotations

from pyspark.sql import DataFrame

from answerclock.schemas import FEATURES


def merge_all(
    tag_means: DataFrame, text_table: DataFrame, labels: DataFrame, how: str = "inner"
) -> DataFrame:
    """Join tag means, text features and labels on ``id``; columns in training order.

    ``tag_means`` is already partitioned by id from its aggregation, so only the
    other two sides are shuffled.
    """
    merged = tag_means.join(text_table, "id", how).join(labels.select("id", "label"), "id", how)
    return merged.select(*FEATURES, "id", "label")

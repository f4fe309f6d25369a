"""How well predictions rank and separate two classes, exact with ties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerclock.operators.storage import running_totals


def confusion(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n) of the pairs that occur; null is a value of its own."""
    return predictions.groupBy(
        F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def class_report(table: DataFrame) -> DataFrame:
    """(class, n, precision, recall, f1) of every label or prediction of a confusion table.

    What would be divided by zero is null. Rows with a null label or prediction are left out.
    """
    known = table.filter(F.col("label").isNotNull() & F.col("prediction").isNotNull())
    right = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    truth = known.select(F.col("label").alias("class"), "n", F.lit(0).alias("said"), right.alias("right"))
    said = known.select(F.col("prediction").alias("class"), F.lit(0).alias("n"), F.col("n").alias("said"), F.lit(0).alias("right"))
    sums = truth.unionByName(said).groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("n", "said", "right")]
    )
    precision, recall = F.try_divide("right", "said"), F.try_divide("right", "n")
    f1 = F.try_divide(2 * F.col("right"), F.col("n") + F.col("said"))
    return sums.select(
        "class", "n", precision.alias("precision"), recall.alias("recall"), f1.alias("f1")
    )


def area_under_curve(scored: DataFrame, score: str, positive: str) -> DataFrame:
    """(positives, negatives, auc): share of pairs in which the positive row scores higher.

    Ties count half. Rows are summed per score, and the negatives below a score come from a
    running total over ranges of scores, so there is no task with all rows and no pair is made.
    Rows with a null score or class are left out; without both classes the area is null.
    """
    rows = scored.select(F.col(score).cast("double").alias("score"), F.col(positive).alias("positive"))
    rows = rows.filter(F.col("score").isNotNull() & F.col("positive").isNotNull())
    is_positive = F.col("positive").cast("boolean").cast("long")
    counts = rows.groupBy("score").agg(
        F.sum(is_positive).alias("pos"), F.sum(1 - is_positive).alias("neg")
    )
    ranked = running_totals(counts, "score", weight="neg", name="below")
    # Twice the number of ordered pairs is an integer, as ties count half.
    ordered = F.col("pos").cast("decimal(38,0)") * (2 * F.col("below") + F.col("neg"))
    sums = ranked.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"),
        F.sum(ordered.cast("decimal(38,0)")).cast("double").alias("_ordered"),
    )
    pairs = 2.0 * F.col("positives") * F.col("negatives")
    return sums.select("positives", "negatives", F.try_divide("_ordered", pairs).alias("auc"))

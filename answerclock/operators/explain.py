"""Which features matter, for any model: permutation importance, and mutual information."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerclock.operators.ml import SEED
from answerclock.operators.storage import numbered, running_totals, stored

BINS = 10


def _shuffled(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))


def permuted(df: DataFrame, cols: Sequence[str], key: str = "id", seed: int = SEED) -> DataFrame:
    """``df`` with a struct ``donor``: ``cols`` of another row, each row being donor once.

    Rows are numbered in two orders by digests of their key; the row with a number in the one
    gives to the row with that number in the other. The same for every partitioning, as long
    as keys are unique.
    """
    takes = numbered(df, _shuffled(key, seed), F.col(key), name="_take")
    gives = df.select(key, F.struct(*cols).alias("donor"))
    gives = numbered(gives, _shuffled(key, seed + 1), F.col(key), name="_take").drop(key)
    return takes.join(gives, "_take").drop("_take")


def permutation_importance(
    df: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    cols: Sequence[str],
    key: str = "id",
    label: str = "label",
    seed: int = SEED,
) -> DataFrame:
    """(feature, accuracy, importance): accuracy with one feature permuted, and what that costs.

    ``predict`` adds ``prediction`` to a frame: a fitted model's ``transform`` or an expression.
    The row with a null feature has the accuracy of the rows as they are, and importance 0.
    Each row is scored once for every feature, in one pass.
    """
    both = stored(permuted(df.select(key, label, *cols), cols, key, seed))
    which = F.explode(F.array(F.lit(None).cast("string"), *[F.lit(c) for c in cols]))
    versions = both.withColumn("feature", which)
    swapped = {
        c: F.when(F.col("feature") == c, F.col("donor").getField(c)).otherwise(F.col(c)) for c in cols
    }
    scored = predict(versions.withColumns(swapped).drop("donor"))
    right = (F.col("prediction").cast("double") == F.col(label).cast("double")).cast("long")
    sums = scored.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(right), F.lit(0)).alias("right")
    )
    whole = F.max(F.when(F.col("feature").isNull(), F.col("right")))
    base = sums.agg(whole.alias("_right"))  # one row
    joined = sums.join(F.broadcast(base))
    return joined.select(
        "feature",
        (F.col("right") / F.col("n")).alias("accuracy"),
        ((F.col("_right") - F.col("right")) / F.col("n")).alias("importance"),
    )


def mutual_information(
    df: DataFrame, cols: Sequence[str], label: str = "label", bins: int = BINS
) -> DataFrame:
    """(feature, n, information): mutual information of each feature with the label, in nats.

    A feature's rows are cut into ``bins`` of equal depth by the number of rows below their
    value, so equal values share a bin. All features go through one running total over their
    distinct values. Null features and labels are left out.
    """
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])
    )
    rows = df.select(F.col(label).alias("label"), cells.alias("cell")).select("label", "cell.*")
    rows = rows.filter(F.col("value").isNotNull() & F.col("label").isNotNull())
    counts = stored(rows.groupBy("feature", "value", "label").agg(F.count(F.lit(1)).alias("n")))
    values = counts.groupBy("feature", "value").agg(F.sum("n").alias("rows"))
    below = stored(running_totals(values, "feature", "value", weight="rows", name="below"))
    sizes = below.groupBy("feature").agg(
        F.min("below").alias("first"), F.sum("rows").alias("size")
    )  # one row per feature
    place = F.floor((F.col("below") - F.col("first")) * F.lit(bins) / F.col("size")).cast("int")
    binned = below.join(F.broadcast(sizes), "feature").select("feature", "value", "size", place.alias("bin"))
    joint = counts.join(binned, ["feature", "value"]).groupBy("feature", "size", "bin", "label")
    joint = stored(joint.agg(F.sum("n").alias("n")))  # features x bins x labels
    by_bin = joint.groupBy("feature", "bin").agg(F.sum("n").alias("of_bin"))
    by_label = joint.groupBy("feature", "label").agg(F.sum("n").alias("of_label"))
    cells = joint.join(by_bin, ["feature", "bin"]).join(by_label, ["feature", "label"])
    n, size = F.col("n").cast("double"), F.col("size").cast("double")
    part = n / size * F.log(n * size / (F.col("of_bin").cast("double") * F.col("of_label")))
    return cells.groupBy("feature", F.col("size").alias("n")).agg(F.sum(part).alias("information"))

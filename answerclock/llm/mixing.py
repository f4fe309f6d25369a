"""Mix sources to target weights by thresholds on a hash of the document.

Sizes are summed by source and by the leading bits of the hash. The running sum
finds the bucket in which a source's budget ends; only that bucket is looked at
again, by its next bits, until the threshold is one hash value. Documents below
it are taken: no sort of documents, no group larger than ``2**LEVEL_BITS`` sums.

The next larger document is taken too where that comes nearer to the budget.
Null texts have size 0, a null source is a source of its own (the last one), rows
with the same key share their hash and so their decision, and an empty table gives
an empty mix. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from answerclock.llm.cluster import unused
from answerclock.llm.words import word_count
from answerclock.operators.storage import numbered, stored

# Weights of the sources in order, their share of all sizes, and how
# often a source may be repeated.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_REPEATS = 2.0
SEED = "mix"

TARGET_DIGITS = 6
LEVEL_BITS = 15
LEVELS = 4  # 60 bits, 15 hexadecimal digits of the hash


def hash_place(key: str) -> Column:
    """The 60-bit hash of a document."""
    name = F.concat_ws(":", F.lit(SEED), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source"):
    """(key, source, size, place): words and the 60-bit hash of every document."""
    return docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(text).alias("size"),
        hash_place(key).alias("place"),
    )


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_repeats: float = MAX_REPEATS,
) -> DataFrame:
    """(source, source_size, target) of every source of ``sizes``.

    Budgets above ``max_repeats`` times a source's size are cut to that, and what is
    cut goes to the others by weight. Each round is one small aggregation.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(totals, F.col("source").asc_nulls_last(), name="rank")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int"))
    sources = stored(ranked.withColumn("weight", weight).drop("rank"))
    cap = F.col("source_size") * F.lit(float(max_repeats))
    whole = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    budget, level = share * (whole[0] or 0), 0.0
    if budget:
        level = budget / whole[1]
        while True:
            above = cap < F.col("weight") * F.lit(level)
            cut, free = sources.agg(
                F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)),
                F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)),
            ).first()
            new = (budget - cut) / free if free else level
            if new <= level:
                break
            level = new
    target = F.round(F.least(cap, F.col("weight") * F.lit(level)), TARGET_DIGITS)
    return sources.select("source", "source_size", target.alias("target"))


def _next_level(docs: DataFrame, found: DataFrame, level: int) -> DataFrame:
    """Narrow each source's boundary (``prefix``, with ``below`` words before it) by one level."""
    shift = LEVEL_BITS * (LEVELS - level)
    inside = F.shiftright("place", shift) == F.col("prefix") if level else F.lit(True)
    state = ["source", "prefix", "below", "rest"]
    same = docs["source"].eqNullSafe(found["source"])
    rows = docs.join(found, same).filter(inside).select(found["*"], "place", "size")
    bucket = F.shiftright("place", shift - LEVEL_BITS).bitwiseAND(F.lit(2**LEVEL_BITS - 1))
    sums = rows.groupBy(*state, bucket.alias("bucket")).agg(F.sum("size").alias("held"))
    upto = F.sum("held").over(Window.partitionBy("source").orderBy("bucket"))
    reached = sums.withColumn("upto", F.col("below") + upto).filter("upto > rest")
    return reached.groupBy(*state[:2], "rest").agg(
        F.min(F.struct("bucket", (F.col("upto") - F.col("held")).alias("below"))).alias("first")
    ).select(
        "source",
        (F.col("prefix") * 2**LEVEL_BITS + F.col("first.bucket")).alias("prefix"),
        F.col("first.below").alias("below"),
        "rest",
    )


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, repeats, threshold).

    Every document of a source is taken ``repeats`` times, and once more if its
    hash lies below ``threshold`` (null: none does).
    """
    size = F.col("source_size")
    repeats = F.coalesce(F.floor(F.try_divide("target", size)), F.lit(0))
    budgets = targets.withColumn("repeats", repeats).withColumn(
        "rest", F.col("target") - F.col("repeats") * size
    )
    found = budgets.filter("rest > 0").select(
        "source", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"), "rest"
    )
    for level in range(LEVELS):
        found = _next_level(sizes, found, level)
    at = sizes.join(
        found, sizes["source"].eqNullSafe(found["source"]) & (sizes["place"] == found["prefix"])
    )
    last = at.groupBy(found["source"], "prefix", "below", "rest").agg(F.sum("size").alias("held"))
    nearer = F.col("below") + F.col("held") - F.col("rest") < F.col("rest") - F.col("below")
    limits = last.select(
        F.col("source").alias("of"), (F.col("prefix") + nearer.cast("long")).alias("threshold")
    )
    joined = budgets.join(limits, budgets["source"].eqNullSafe(limits["of"]), "left")
    return joined.select("source", "source_size", "target", "repeats", "threshold")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **how):
    """(doc_id, source, size, source_size, target, copies, taken) of every document.

    ``how`` are the settings of ``source_targets``.
    """
    sizes = stored(sized(docs, key, text, source))
    limits = stored(thresholds(sizes, source_targets(sizes, **how)))
    joined = sizes.join(limits, sizes["source"].eqNullSafe(limits["source"]))
    below = F.coalesce(F.col("place") < F.col("threshold"), F.lit(False))
    copies = F.col("repeats") + below.cast("long")
    return joined.select(
        "doc_id",
        sizes["source"],
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (F.col("size") * copies).alias("taken"),
    )


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **how):
    """The mix itself: the rows of ``docs``, each as often as it is taken, in its own columns.

    Rows stay where they are; only the limits of their source come to them.
    """
    sizes = stored(sized(docs, key, text, source))
    of, repeats, threshold, copy = (
        unused(docs, name) for name in ("_mix_source", "_mix_repeats", "_mix_threshold", "_mix_copy")
    )
    limits = stored(thresholds(sizes, source_targets(sizes, **how))).select(
        F.col("source").alias(of), F.col("repeats").alias(repeats), F.col("threshold").alias(threshold)
    )
    joined = docs.join(limits, docs[source].eqNullSafe(limits[of]))
    below = F.coalesce(hash_place(key) < F.col(threshold), F.lit(False))
    numbers = F.array_repeat(F.lit(0), (F.col(repeats) + below.cast("long")).cast("int"))
    return joined.withColumn(copy, F.explode(numbers)).select(*docs.columns)

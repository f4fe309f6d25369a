"""Exact quantiles of many groups by radix selection.

Values are integers, read digit by digit from the top. A pass counts the next digit in each
group (at most ``1 << DIGIT_BITS`` rows for each group and task are shuffled), finds the digit
in which each quantile lies, and goes on with the rows that have it. After one pass per digit
the digits are the value. No task holds the values of a group, nor all rows a group's values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from answerclock.operators.lookups import BROADCAST_LIMIT, table_size
from answerclock.operators.storage import stored

DIGIT_BITS = 12


def _with_targets(rows: DataFrame, targets: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """Rows of the prefixes that some quantile lies in; the targets are broadcast if small."""
    wanted = targets.select(*keys, "_prefix").distinct()
    small = table_size(targets)[1] <= limit
    conditions = [rows[k].eqNullSafe(wanted[k]) for k in keys] + [rows["_prefix"] == wanted["_prefix"]]
    return rows.join(F.broadcast(wanted) if small else wanted, conditions, "left_semi")


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    shares: Sequence[float],
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """(keys, n, share, value): the least value that at least ``share`` of a group is at or under.

    ``value`` is an integer column; nulls are left out, groups of nulls only have no row. Null
    keys are a group. Shares lie in (0, 1]; 1 gives the maximum.
    """
    if not shares or any(not 0 < q <= 1 for q in shares):
        raise ValueError("shares lie above 0 and up to 1")
    keys = list(keys)
    kept = df.select(*keys, F.col(value).cast("long").alias("_value"))
    kept = stored(kept.filter(F.col("_value").isNotNull()))
    low, high = kept.agg(F.min("_value"), F.max("_value")).first()
    low, high = low or 0, high or 0
    digits = max(1, -(-(high - low).bit_length() // DIGIT_BITS))
    # Differences to the least value; where they need the sign's bit, values without a sign.
    wide_range = high - low >= 1 << 63
    plain = lambda c: c.bitwiseXOR(F.lit(-(1 << 63))) if wide_range else c
    rest = plain(F.col("_value")) if wide_range else F.col("_value") - F.lit(low)
    rows = kept.select(*keys, rest.alias("_rest"))
    n = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    share = F.explode(F.array(*[F.lit(float(q)) for q in shares])).alias("share")
    targets = n.select(*keys, "n", share).withColumn("_prefix", F.lit(0).cast("long"))
    targets = stored(targets.withColumn("_rank", F.ceil(F.col("n") * F.col("share")).cast("long")))
    for place in reversed(range(digits)):
        down = place * DIGIT_BITS
        if place == digits - 1:
            rows = rows.withColumn("_prefix", F.lit(0).cast("long"))
        else:
            rows = rows.withColumn("_prefix", F.shiftrightunsigned("_rest", down + DIGIT_BITS))
            # Each pass keeps what the last one's digits have left, so later ones read little.
            rows = stored(_with_targets(rows, targets, keys, broadcast_limit))
        digit = F.shiftrightunsigned("_rest", down).bitwiseAND((1 << DIGIT_BITS) - 1).alias("_digit")
        counts = rows.groupBy(*keys, "_prefix", digit).agg(F.count(F.lit(1)).alias("_n"))
        found = targets.alias("t").join(
            counts.alias("c"),
            [F.col(f"t.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
            + [F.col("t._prefix") == F.col("c._prefix")],
        )
        found = found.select(*[f"t.{k}" for k in keys], "n", "share", "t._prefix", "_rank", "_digit", "_n")
        upto = F.sum("_n").over(
            Window.partitionBy(*keys, "share").orderBy("_digit").rowsBetween(Window.unboundedPreceding, 0)
        )
        found = found.withColumn("_upto", upto).filter(
            (F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank"))
        )
        targets = stored(
            found.select(
                *keys,
                "n",
                "share",
                (F.shiftleft("_prefix", DIGIT_BITS) + F.col("_digit")).alias("_prefix"),
                (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_rank"),
            )
        )
    found = plain(F.col("_prefix")) if wide_range else F.col("_prefix") + F.lit(low)
    return targets.select(*keys, "n", "share", found.alias(value))


def wide(quantiles: DataFrame, keys: Sequence[str], value: str, names: dict[float, str]) -> DataFrame:
    """One row per group with a column for each share, named by ``names``."""
    columns = [F.max(F.when(F.col("share") == q, F.col(value))).alias(name) for q, name in names.items()]
    return quantiles.groupBy(*keys, "n").agg(*columns).select(*keys, "n", *names.values())

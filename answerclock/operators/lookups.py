"""Joins with a table that is usually small but has no fixed size.

The table is checkpointed once, its size is measured, and only then is the
join chosen: a broadcast under the limit, a split by hot keys above it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT = 64 * 1024 * 1024
HOT_SHARE = 0.001
# Least part of a large table that must fit a broadcast for more keys than the hot ones to go there.
LEAST_PART = 0.01


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the session's checkpoint folder, so lost executors cost no recomputation.

    The folder is the one named in ``spark.checkpoint.dir``. Where it is unset, a local
    session gets one in its warehouse; a cluster session is refused.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Take the folder from ``spark.checkpoint.dir``; only a local session may go without.

    It then gets a folder of its own in the warehouse, which is deleted when the driver ends.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        folder = f"{warehouse.rstrip('/')}/checkpoints-{uuid.uuid4().hex}"
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    context.setCheckpointDir(folder)


def table_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df``: text by its length, everything else 8 per column."""
    row = F.lit(8 * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            row = row + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
    measured = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row.cast("long")), F.lit(0))).first()
    return measured[0], measured[1]


def _frequent(lookup: DataFrame, frequency: str, size: int, limit: int, hot_share: float) -> DataFrame:
    """The hot keys of ``lookup``, or the most frequent ones that fit ``limit`` bytes, if more."""
    count = F.col(frequency)
    total = lookup.agg(F.sum(frequency)).first()[0]
    hot = lookup.filter(count > hot_share * (total or 0))
    part = limit / size
    if part < LEAST_PART:
        return hot
    least = lookup.approxQuantile(frequency, [1 - part], part / 10)
    if not least or least[0] >= hot_share * (total or 0):
        return hot
    frequent = lookup.filter(count > least[0])
    return frequent if table_size(frequent)[1] <= 2 * limit else hot


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    frequency: str,
    how: str = "inner",
    broadcast_limit: int = BROADCAST_LIMIT,
    hot_share: float = HOT_SHARE,
    rows_stored: bool = False,
) -> DataFrame:
    """Join ``rows`` with ``lookup`` (one row per ``key``), whatever the size or skew.

    ``frequency`` is a column of ``lookup`` that grows with the number of rows of
    its key. Up to ``broadcast_limit`` bytes the whole table is broadcast. A larger
    one is split: the keys with more than ``hot_share`` of all frequencies (no more
    than ``1 / hot_share`` of them can exist), or the most frequent ones that fit half of
    ``broadcast_limit`` (both parts broadcast them), are broadcast and leave the shuffle, the
    other keys meet their rows in a shuffle join. ``rows`` is checkpointed first, as
    both parts read it, unless ``rows_stored`` says that they are stored already. ``how``
    is ``inner``, ``left`` or ``left_semi``.
    """
    lookup = checkpointed(lookup)
    size = table_size(lookup)[1]
    if size <= broadcast_limit:
        return rows.join(F.broadcast(lookup), key, how)
    hot = _frequent(lookup, frequency, size, broadcast_limit // 2, hot_share)
    rows = rows if rows_stored else checkpointed(rows)
    hot_keys = F.broadcast(hot.select(key))
    hot_joined = rows.join(F.broadcast(hot), key, "inner" if how == "left" else how)
    cold_rows = rows.join(hot_keys, key, "left_anti")
    cold_lookup = lookup.join(hot_keys, key, "left_anti")
    return hot_joined.unionByName(cold_rows.join(cold_lookup, key, how))

"""Tables written once to a folder that all executors share, and ranks without one big task."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerclock.operators.lookups import ensure_checkpoint_dir


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below the session's checkpoint folder; nothing is created yet."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/answerclock-{uuid.uuid4().hex}"


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have the driver delete ``path``, on whatever file system it is, when it ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


def stored(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back, with ``schema`` if given.

    Like a checkpoint it cuts the lineage and survives lost executors, but it is
    compressed, and later readers take only the columns they need.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.option("compression", "zstd").parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(schema or df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` written once to the shared folder, in files bucketed and sorted by ``key``.

    Joins and aggregations on ``key`` then read it without a shuffle; only the other side
    moves. The table stands in the session's catalog under a name of its own. There are no
    fewer buckets than shuffle partitions, as Spark would else deal both sides out again.
    """
    spark = df.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    buckets = max(1, min(max(buckets, least), most))
    path = shared_folder(spark)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    writer = df.repartition(buckets, key).write.format("parquet").option("compression", "zstd")
    writer.option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    delete_at_exit(spark, path)
    return spark.table(name)


def running_totals(
    df: DataFrame, *order: Column | str, weight: Column | str, name: str = "before"
) -> DataFrame:
    """``df`` with ``name``, the sum of ``weight`` over all rows before it in ``order``.

    Rows are sorted by range and stored with the number of their range; only the sums per
    range (as many as there are partitions) meet in one place. Ties come in any order, so
    ``order`` should name each row where the weights differ.
    """
    part, amount = "_range", "_weight"
    weight = F.col(weight) if isinstance(weight, str) else weight
    ranged = df.withColumn(amount, weight.cast("long")).repartitionByRange(*order)
    kept = stored(ranged.withColumn(part, F.spark_partition_id()))
    sums = kept.groupBy(part).agg(F.sum(amount).alias("_sum"))
    before = F.sum("_sum").over(Window.orderBy(part)) - F.col("_sum")
    offsets = sums.select(part, before.alias("_before"))
    own = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(amount).over(own), F.lit(0))
    joined = kept.withColumn("_inside", inside).join(F.broadcast(offsets), part)
    return joined.withColumn(name, F.col("_before") + F.col("_inside")).drop(
        part, amount, "_before", "_inside"
    )


def numbered(df: DataFrame, *order: Column | str, name: str = "number") -> DataFrame:
    """``df`` with ``name``, 0 and up in the order of ``order``, ties in any order.

    Rows are sorted by range and stored with the number of their range; only the
    counts per range (as many as there are partitions) meet in one place.
    """
    part = "_range"
    ranged = df.repartitionByRange(*order).withColumn(part, F.spark_partition_id())
    kept = stored(ranged)
    sizes = kept.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy(part)) - F.col("_rows")
    offsets = sizes.select(part, before.alias("_before"))
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1
    joined = kept.withColumn("_place", place.cast("long")).join(F.broadcast(offsets), part)
    return joined.withColumn(name, F.col("_before") + F.col("_place")).drop(
        part, "_before", "_place"
    )

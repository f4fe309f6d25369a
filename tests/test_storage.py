from __future__ import annotations

from pyspark.sql import functions as F

from answerclock.operators import storage
from tests.conftest import plan_of, rows


def test_stored_rows_are_read_back_from_the_shared_folder(spark):
    df = spark.range(10).withColumn("a", F.array("id"))
    kept = storage.stored(df)
    assert rows(kept) == rows(df) and kept.schema.simpleString() == df.schema.simpleString()
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(folder in path for path in kept.inputFiles())
    assert storage.stored(df.limit(0)).count() == 0


def test_numbers_follow_the_order_across_partitions(spark):
    df = spark.range(1000, numPartitions=7).select((F.col("id") * 7919 % 1000).alias("x"))
    got = storage.numbered(df, F.col("x").desc(), name="place").collect()
    assert sorted((r.place, r.x) for r in got) == [(i, 999 - i) for i in range(1000)]
    assert storage.numbered(df.limit(0), "x").count() == 0


def test_bucketed_rows_join_without_a_shuffle(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    df = spark.range(100).select((F.col("id") % 40).alias("k"), F.lit("x").alias("text"))
    kept = storage.bucketed(df, "k", 2)
    assert rows(kept) == rows(df)
    other = storage.bucketed(spark.range(30).withColumnRenamed("id", "k"), "k", 2)
    joined = kept.join(other, "k")
    assert "Exchange" not in plan_of(joined) and joined.count() == rows(df.filter("k < 30")).__len__()
    assert storage.bucketed(df.limit(0), "k", 2).count() == 0

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from answerclock.operators import lookups
from tests.conftest import plan_of, rows


@pytest.fixture
def hot_rows(spark):
    """A third of the rows carries one key."""
    return spark.range(9000, numPartitions=6).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key")
    )


@pytest.fixture
def lookup(spark):
    """Keys with their number of rows; one key has none, ten keys of the rows are missing."""
    return spark.createDataFrame(
        [("hot", 3000), ("none", 0)] + [(f"k{i}", 120) for i in range(40)], "key string, n long"
    )


@pytest.mark.parametrize("how", ["inner", "left_semi", "left"])
@pytest.mark.parametrize("limit", [0, 200, 10**6])
def test_every_way_gives_the_same_rows(hot_rows, lookup, how, limit):
    plain = hot_rows.join(lookup, "key", how)
    joined = lookups.join_lookup(
        hot_rows, lookup, "key", "n", how, broadcast_limit=limit, hot_share=0.1
    )
    assert joined.columns == plain.columns
    assert rows(joined) == rows(plain)


def test_a_small_table_is_broadcast_whole(hot_rows, lookup):
    plan = plan_of(lookups.join_lookup(hot_rows, lookup, "key", "n"))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Union" not in plan


def test_the_hot_key_stays_out_of_the_shuffle(spark, settings, hot_rows, lookup):
    """One key has more than its share: it is broadcast and the rest is shuffled."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )
    joined = lookups.join_lookup(hot_rows, lookup, "key", "n", broadcast_limit=0, hot_share=0.1)
    plan = plan_of(joined)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
    tasks = joined.select(F.spark_partition_id().alias("task"), "key").distinct()
    shuffled = {r.task for r in tasks.filter("key <> 'hot'").collect()}
    broadcast = {r.task for r in tasks.filter("key = 'hot'").collect()}
    assert len(broadcast) == 6 and not shuffled & broadcast


def test_frequent_keys_that_fit_stay_out_of_the_shuffle(spark):
    """Just over the limit, nearly all rows have keys of the half that is broadcast."""
    held = spark.range(400).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"),
        F.when(F.col("id") < 100, 90).otherwise(1).alias("n"),
    )
    each = F.explode(F.sequence(F.lit(1), F.col("n"))).alias("place")
    found = held.select("key", each)
    limit = lookups.table_size(held)[1] - 1
    joined = lookups.join_lookup(found, held, "key", "n", broadcast_limit=limit, hot_share=0.5)
    assert rows(joined) == rows(found.join(held, "key"))
    hot = lookups._frequent(held, "n", limit + 1, limit // 2, 0.5)
    assert hot.count() == 100
    assert lookups._frequent(held, "n", limit + 1, 1, 0.005).count() == 100
    assert lookups._frequent(held, "n", limit + 1, 1, 0.5).count() == 0
    assert lookups._frequent(held.limit(0), "n", 10, 5, 0.5).count() == 0


def test_the_large_branch_reads_its_rows_once_and_sorts_nothing(spark, hot_rows, lookup):
    plan = plan_of(lookups.join_lookup(hot_rows, lookup, "key", "n", broadcast_limit=0))
    assert "TakeOrderedAndProject" not in plan
    assert "Range (" not in plan and plan.count("Scan ExistingRDD") >= 2


def test_a_cluster_needs_a_checkpoint_folder(monkeypatch):
    from types import SimpleNamespace

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(
        sparkContext=context, conf=SimpleNamespace(get=lambda name, default: default)
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        lookups.ensure_checkpoint_dir(session)


def test_table_size(lookup):
    assert lookups.table_size(lookup) == (42, sum(16 + len(r.key) for r in lookup.collect()))
    assert lookups.table_size(lookup.limit(0)) == (0, 0)


def test_checkpoints_go_to_the_folder_of_the_session(spark, lookup):
    stored = lookups.checkpointed(lookup)
    folder = spark.conf.get("spark.checkpoint.dir")
    assert spark.sparkContext.getCheckpointDir().removeprefix("file:").startswith(folder)
    assert rows(stored) == rows(lookup)
    assert "Scan ExistingRDD" in plan_of(stored)

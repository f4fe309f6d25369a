from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from answerclock.operators import posts as post_ops
from answerclock.operators import tags
from answerclock.schemas import TAG_FEATURES
from tests.conftest import plan_of, rows

BASE = "2018-01-16T12:00:00"


def question(id, tag_text, **more):
    return {"id": id, "post_type_id": 1, "creation_date": BASE, "tags": tag_text} | more


def answer(id, parent, date):
    return {"id": id, "post_type_id": 2, "parent_id": parent, "creation_date": date}


@pytest.fixture
def few(make_posts):
    return make_posts(
        question(
            1,
            "<a><b>",
            view_count=10,
            answer_count=2,
            comment_count=1,
            last_activity_date="2018-01-16T14:00:00",
        ),
        question(2, "<a><a>", view_count=None, answer_count=3, comment_count=None),
        question(3, None, view_count=5),
        question(4, "<old>", view_count=7, answer_count=1, creation_date="2007-06-01T00:00:00"),
        answer(11, 1, "2018-01-16T12:30:00"),
        answer(12, 1, "2018-01-16T13:00:00"),
        answer(13, 2, "2018-01-16T11:59:59"),
        answer(14, 4, "2007-06-01T00:10:00"),
    )


def test_filters(few):
    assert few.transform(post_ops.questions).count() == 4
    asked, answered = post_ops.split_posts(few)
    assert (asked.count(), answered.count()) == (4, 4)
    assert post_ops.since(few, "creation_date", "2018-01-16T12:00:00.000").count() == 5
    assert post_ops.since_year(few, 2008).count() == 6
    assert post_ops.between_years(few, 2007, 2007).count() == 2
    assert post_ops.between_years(few, 2007, 2018).count() == 8


def test_post_projection(few):
    out = post_ops.post_projection(few, 2018)
    assert out.columns == ["tags", "id", "time", "post_type_id", "parent_id"]
    assert ("<a><b>", 1, 1516104000, 1, None) in rows(out)


def test_latest_breaks_ties_by_id(few):
    newest = post_ops.latest(few, "creation_date", 4).select("id").collect()
    assert [r[0] for r in newest] == [12, 11, 1, 2]


def test_explode_tags_keeps_repeats_and_drops_nulls(few):
    got = rows(tags.explode_tags(few.select("id", "tags")))
    assert got == [("a", 1), ("a", 2), ("a", 2), ("b", 1), ("old", 4)]


def test_tag_asr_pr(few):
    users = 10
    got = rows(tags.tag_asr_pr(few, users))
    assert got == [("a", 0.3, 0.3), ("b", 0.1, 0.3)]
    spread = rows(tags.tag_asr_pr(few, users, each_null_as_zero=True))
    assert spread == [("a", 0.3, 0.9), ("b", 0.1, 0.3)]


def test_tag_four(few):
    assert rows(tags.tag_four(few)) == [
        ("a", 3, 10, 8, 2.0),
        ("b", 1, 10, 2, 2.0),
        ("old", 1, 7, 1, 0.0),
    ]


def test_delays_and_rsr(few):
    delays = tags.answer_delays(few, 2017)
    assert rows(delays) == [
        ("a", 1, 0.5),
        ("a", 1, 1.0),
        ("a", 2, -1 / 3600),
        ("a", 2, -1 / 3600),
        ("b", 1, 0.5),
        ("b", 1, 1.0),
    ]
    assert rows(tags.tag_rsr(delays)) == [("a", 3), ("b", 1)]
    assert rows(tags.tag_rsr(delays, min_hours=0)) == [("a", 1), ("b", 1)]


def test_one_pass_tag_table_equals_the_merged_tables(few):
    merged = tags.merge_tag_features(
        tags.tag_asr_pr(few), tags.tag_four(few), tags.tag_rsr(tags.answer_delays(few, 2000))
    )
    direct = tags.tag_features(few, answers_min_year=2000)
    assert direct.columns == merged.columns == ["tag", *TAG_FEATURES]
    assert rows(direct) == rows(merged)
    assert [r[0] for r in rows(direct)] == ["a", "b"]


def test_merge_how(few):
    outer = tags.merge_tag_features(
        tags.tag_asr_pr(few),
        tags.tag_four(few),
        tags.tag_rsr(tags.answer_delays(few)),
        how="full",
    )
    assert [r[0] for r in rows(outer)] == ["a", "b", "old"]


def test_scale_ratio(spark):
    df = spark.createDataFrame([("a", 14.0, 28.0, 7)], "tag string, PR double, ASR double, RSR long")
    assert rows(tags.scale_ratio(df)) == [("a", 0.001, 0.002, 7)]
    assert rows(tags.scale_ratio(df, ("RSR",), 14, 1)) == [("a", 14.0, 28.0, 0.5)]


@pytest.fixture
def tag_table(spark):
    values = [("a", *[float(i) for i in range(7)]), ("b", *[float(i + 2) for i in range(7)])]
    ddl = ", ".join(["tag string"] + [f"{c} double" for c in TAG_FEATURES])
    return spark.createDataFrame(values, ddl)


@pytest.mark.parametrize("limit", [10**9, 0])
def test_post_tag_features(few, tag_table, limit):
    got = rows(tags.post_tag_features(few, tag_table, broadcast_limit=limit))
    assert got == [
        (1, *[i + 1.0 for i in range(7)]),
        (2, *[float(i) for i in range(7)]),
    ]


def test_tags_in_use_equals_the_mean_over_its_posts(few, tag_table):
    used = tags.tags_in_use(tag_table, few, 2018, 2018)
    joined = tags.explode_tags(post_ops.between_years(few, 2018, 2018).select("tags"))
    means = joined.join(tag_table, "tag").groupBy("tag").agg(
        *[F.avg(c).alias(c) for c in TAG_FEATURES]
    )
    assert rows(used) == rows(means)


def test_tag_sums_combine_before_the_shuffle(few):
    plan = plan_of(tags.tag_four(few))
    assert plan.count("Exchange") == 1 and "partial_sum" in plan and "Python" not in plan


def test_a_question_with_most_answers_is_split(spark, settings, make_posts):
    """Adaptive execution splits the partition of one hot question in the answer join."""
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
    )
    asked = spark.range(1000, numPartitions=4).selectExpr(
        "id", "cast(null as long) parent_id", "'<a><b>' tags"
    )
    answers = spark.range(60000, numPartitions=8).selectExpr(
        "id + 100000 id", "if(id % 3 = 0, 7L, id % 1000) parent_id", "cast(null as string) tags"
    )
    posts = asked.unionByName(answers).selectExpr(
        "*", "timestamp_ntz'2018-01-01' + make_dt_interval(0, 0, cast(id % 50 as int)) creation_date"
    )
    counts = tags.tag_rsr(tags.answer_delays(posts, 2017), hours=0.25)
    got = rows(counts)
    assert "skew=true" in plan_of(counts)
    minutes = "(a.id % 50) - (q.id % 50)"
    posts.createOrReplaceTempView("hot_posts")
    want = spark.sql(
        f"SELECT count(*) FROM hot_posts q JOIN hot_posts a ON a.parent_id = q.id WHERE {minutes} < 15"
    ).first()[0]
    assert got == [("a", want), ("b", want)]

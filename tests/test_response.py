from __future__ import annotations

import numpy as np
import pytest

from answerclock.operators import response
from tests.conftest import rows

START = "2018-01-01T00:00:00"


@pytest.fixture
def times(make_posts):
    def asked(id, accepted, date=START):
        return {"id": id, "post_type_id": 1, "accepted_answer_id": accepted, "creation_date": date}

    def answered(id, parent, date):
        return {"id": id, "post_type_id": 2, "parent_id": parent, "creation_date": date}

    posts = make_posts(
        asked(1, 11),
        asked(2, 12),
        asked(3, 13),
        asked(4, 14),
        asked(5, None),
        asked(6, 99),
        asked(7, 17, "2018-02-03T00:00:00"),
        answered(11, 1, "2018-01-01T00:00:00"),
        answered(12, 2, "2018-01-01T00:59:59"),
        answered(13, 3, "2018-01-01T01:00:00"),
        answered(14, 4, "2017-12-31T23:59:59"),
        answered(17, 7, "2018-02-04T00:00:00"),
        answered(18, 7, "2018-02-03T00:00:00"),
    )
    return response.response_times(posts)


def test_labels(times):
    labels = response.response_labels(times).select("id", "response_seconds", "label")
    assert rows(labels) == [(1, 0, 0), (2, 3599, 0), (3, 3600, 1), (7, 86400, 1)]


def test_counts_buckets_and_trend(times):
    assert rows(response.answered_count(times)) == [(4,)]
    assert rows(response.response_buckets(times)) == [
        (0, 0.0, 1.0, 2, 3599 / 7200),
        (1, 1.0, 4.0, 1, 1.0),
        (3, 12.0, None, 1, 24.0),
    ]
    trend = response.response_trend(times).selectExpr("cast(period as string)", "posts")
    assert rows(trend) == [("2018-01-01 00:00:00", 3), ("2018-02-01 00:00:00", 1)]


def test_carry(make_posts):
    posts = make_posts(
        {"id": 1, "accepted_answer_id": 2, "creation_date": START, "answer_count": 9},
        {"id": 2, "parent_id": 1, "creation_date": START},
    )
    assert response.response_times(posts, ["answer_count"]).first()["answer_count"] == 9


@pytest.mark.parametrize(
    "values",
    [
        [0.0, 0.5, 1.0, 25.0, 24.99, 12.5],
        [3.0, 3.0, 3.0],
        list(np.random.default_rng(1).gamma(2.0, 3.0, 500)),
    ],
)
def test_histogram_equals_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (99.0,), (float("inf"),), (float("-inf"),), (float("nan"),)], "x double")
    got = rows(response.histogram(df, "x", bins=10, maximum=25).orderBy("bin"))
    counts, edges = np.histogram([v for v in values if v <= 25], bins=10)
    assert [r[3] for r in got] == counts.tolist()
    assert np.allclose([r[1] for r in got] + [got[-1][2]], edges)

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from answerclock.operators import asof, quantiles, response, tag_state, tags
from tests.conftest import plan_of, rows

START = datetime(2020, 1, 1)


def made(rng, n=60):
    """Questions and answers at few different seconds, so that many share one."""
    posts = []
    for i in range(n):
        at = START + timedelta(seconds=rng.choice([0, 1, 2, 86_399, 86_400, 200_000, 200_001, 900_000]))
        tagged = rng.choice(["<a>", "<a><b>", "<b><c>", "<a><a>", None, "<d>"])
        post = {"id": i, "post_type_id": 1, "creation_date": at, "tags": tagged, "view_count": rng.choice([None, 3, 10])}
        post |= {"answer_count": rng.choice([None, 2]), "comment_count": 1, "last_activity_date": at}
        posts.append(post)
        for k in range(rng.randrange(3)):
            later = at + timedelta(seconds=rng.choice([0, 1, 1800, 3600, 90_000, -50]))
            posts.append({"id": 1000 + 10 * i + k, "post_type_id": 2, "parent_id": i, "creation_date": later})
    return posts


def plain_before(posts, hours=1):
    """Every question against all earlier events."""
    split = lambda t: t[1:-1].split("><")
    asked = {p["id"]: p for p in posts if p["post_type_id"] == 1 and p["tags"]}
    events = []
    for p in posts:
        if p["id"] in asked:
            events += [(t, p["creation_date"], (1, p["view_count"] or 0, 0, 0, 0)) for t in split(p["tags"])]
        elif p.get("parent_id") in asked:
            q = asked[p["parent_id"]]
            delay = (p["creation_date"] - q["creation_date"]).total_seconds()
            one = (0, 0, 1, int(delay < hours * 3600), delay)
            events += [(t, p["creation_date"], one) for t in split(q["tags"])]
    out = []
    for q in asked.values():
        own = split(q["tags"])
        sums = [sum(e[2][i] for t in own for e in events if e[0] == t and e[1] < q["creation_date"]) / len(own) for i in range(5)]
        out.append((q["id"], *[round(s, 6) for s in sums[:4]], round(sums[4] / 3600, 6)))
    return sorted(out, key=repr)


def test_features_before_equal_brute_force(make_posts):
    for seed in range(2):
        posts = made(random.Random(seed))
        got = asof.post_tag_features_before(make_posts(*posts)).withColumns(
            {c: F.round(c, 6) for c in asof.BEFORE}
        )
        assert rows(got) == plain_before(posts)


def test_features_before_of_nothing(make_posts):
    assert asof.post_tag_features_before(make_posts()).count() == 0
    undated = make_posts({"id": 1, "post_type_id": 1, "tags": "<a>"})
    assert asof.post_tag_features_before(undated).count() == 0


def test_a_hot_tag_is_split_by_day(make_posts):
    plan = plan_of(asof.totals_before(asof.tag_events(make_posts(*made(random.Random(3))))))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert any("tag#" in w and "day#" in w.split("],")[1] for w in windows)
    assert "SinglePartition" not in plan


def nearest(values, share):
    ordered = sorted(values)
    place = next(i for i in range(len(ordered)) if (i + 1) >= share * len(ordered) - 1e-9)
    return ordered[place]


def test_quantiles_equal_sorting(spark):
    rng = random.Random(5)
    groups = {
        "one": [7],
        "same": [5] * 50,
        "wide": [rng.randrange(-(1 << 40), 1 << 40) for _ in range(200)],
        "edge": [-(1 << 62), (1 << 62), 0, 4095, 4096, -1],
        None: [rng.randrange(100) for _ in range(99)],
    }
    table = [(g, v) for g, values in groups.items() for v in values] + [("none", None), ("one", None)]
    df = spark.createDataFrame(table, "g string, v long").repartition(4)
    shares = [0.01, 0.25, 0.5, 0.9, 1.0]
    for limit in (1 << 20, 0):
        got = quantiles.group_quantiles(df, ["g"], "v", shares, broadcast_limit=limit)
        want = sorted(((g, len(v), q, nearest(v, q)) for g, v in groups.items() for q in shares), key=repr)
        assert rows(got) == want
    assert quantiles.group_quantiles(df.limit(0), ["g"], "v", shares).count() == 0


def test_quantiles_need_no_window_over_values(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    got = quantiles.wide(quantiles.group_quantiles(df, ["g"], "id", [0.5]), ["g"], "id", {0.5: "median"})
    assert rows(got) == [(0, 334, 498), (1, 333, 499), (2, 333, 500)]


def test_a_state_and_what_is_added_equal_the_whole(make_posts):
    posts = made(random.Random(8), 80)
    whole = make_posts(*posts)
    options = {"hours": 1, "answers_min_year": 2019}
    parts = [make_posts(*posts[i::3]) for i in range(3)]
    state, known = tag_state.tag_state(parts[0], **options), parts[0]
    for part in parts[1:]:
        state = tag_state.merged(state, tag_state.tag_state(part, known, **options))
        known = known.unionByName(part)
    assert rows(state) == rows(tag_state.tag_state(whole, **options))
    features = tag_state.state_features(state, activity_min_year=2019)
    assert rows(features) == rows(tags.tag_features(whole, activity_min_year=2019, answers_min_year=2019))


def test_days_without_posts_are_filled(spark):
    dates = ["2020-02-27 10:00:00", "2020-03-01 00:00:00", "2020-03-01 23:59:59", None]
    times = spark.createDataFrame([(d, 3600 * (i + 1)) for i, d in enumerate(dates)], "d string, response_seconds long")
    times = times.select(F.to_timestamp_ntz("d").alias("creation_date"), "response_seconds")
    got = [(r.period.day, r.posts, r.rolling_posts, r.mean_hours) for r in response.rolling_trend(times, "day", 2).orderBy("period").collect()]
    assert got == [(27, 1, 1, 1.0), (28, 0, 1, 1.0), (29, 0, 0, None), (1, 2, 2, 2.5)]
    assert response.rolling_trend(times.limit(0)).count() == 0
    grouped = response.rolling_trend(times.withColumn("tag", F.lit("x")), "day", 2, ["tag"])
    assert grouped.count() == 4

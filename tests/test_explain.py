from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from answerclock.operators import explain, metrics, ml, storage
from tests.conftest import plan_of, rows


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    table = []
    for i in range(400):
        useful, noise = rng.random(), rng.randrange(5)
        table.append((i, useful, float(noise), None if i % 50 == 0 else rng.random() < 0.5, int(useful > 0.5)))
    return spark.createDataFrame(table, "id long, useful double, noise double, flag boolean, label int").repartition(5)


def test_each_row_gives_once(labelled):
    got = explain.permuted(labelled, ["useful"]).select("id", "useful", "donor.useful").collect()
    assert sorted(r[1] for r in got) == sorted(r[2] for r in got)
    assert sum(r[1] == r[2] for r in got) < 20
    again = explain.permuted(labelled.coalesce(1), ["useful"]).select("id", "useful", "donor.useful").collect()
    assert sorted(got) == sorted(again)


def test_importance_of_a_rule_and_of_models(labelled):
    rule = lambda df: df.withColumn("prediction", F.when(F.col("useful") > 0.5, 1.0).otherwise(0.0))
    got = {r.feature: r for r in explain.permutation_importance(labelled, rule, ["useful", "noise"]).collect()}
    assert got[None].accuracy == 1 and got["noise"].importance == 0
    assert 0.3 < got["useful"].importance < 0.7
    for kind in ("nb", "lr", "rf"):
        model = ml.fit(labelled, kind, ["useful", "noise"])
        found = explain.permutation_importance(labelled, model.transform, ["useful", "noise"])
        by_name = {r.feature: r.importance for r in found.collect()}
        assert by_name["useful"] >= by_name["noise"] and by_name[None] == 0


def plain_information(values, labels, bins):
    pairs = [(v, x) for v, x in zip(values, labels) if v is not None]
    n = len(pairs)
    binned = [(int(sum(w < v for w, _ in pairs) * bins / n), x) for v, x in pairs]
    total = 0
    for b, x in set(binned):
        joint = binned.count((b, x)) / n
        total += joint * math.log(joint / (sum(p == b for p, _ in binned) / n) / (sum(y == x for _, y in binned) / n))
    return total


def test_information_equals_counting(labelled):
    cols = ["useful", "noise", "flag"]
    got = {r.feature: (r.n, r.information) for r in explain.mutual_information(labelled, cols, bins=7).collect()}
    table = labelled.collect()
    for c in cols:
        want = plain_information([r[c] for r in table], [r.label for r in table], 7)
        assert got[c][1] == pytest.approx(want, abs=1e-9)
        assert got[c][0] == sum(r[c] is not None for r in table)
    assert max(got, key=lambda c: got[c][1]) == "useful"
    assert explain.mutual_information(labelled.limit(0), cols).count() == 0


def plain_auc(table):
    known = [(s, p) for s, p in table if s is not None and p is not None]
    pos, neg = [s for s, p in known if p], [s for s, p in known if not p]
    won = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
    return len(pos), len(neg), won / len(pos) / len(neg) if pos and neg else None


@pytest.mark.parametrize("seed", range(3))
def test_area_with_ties_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    table = [(rng.choice([None, 0.1, 0.5, 0.5, 2.0, -1.0]), rng.choice([True, False, None])) for _ in range(150)]
    df = spark.createDataFrame(table, "s double, p boolean").repartition(6)
    (got,) = metrics.area_under_curve(df, "s", "p").collect()
    want = plain_auc(table)
    assert tuple(got)[:2] == want[:2] and got.auc == pytest.approx(want[2])


def test_area_without_both_classes(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, True)], "s double, p boolean")
    assert rows(metrics.area_under_curve(df, "s", "p")) == [(2, 0, None)]
    assert rows(metrics.area_under_curve(df.limit(0), "s", "p")) == [(0, 0, None)]


def test_area_has_no_single_task_with_all_rows(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("s"), (F.col("id") % 2 == 0).alias("p"))
    totals = storage.running_totals(df, "s", weight=F.lit(2), name="before")
    assert sorted((r.s, r.before) for r in totals.collect()) == [(float(i), 2 * i) for i in range(100)]
    windows = [w for w in plan_of(totals).splitlines() if "Window [" in w]
    assert any("_range" in w.split("],")[1] for w in windows)


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 1.0), (1, 1.0), (1, 1.0), (2, 1.0), (None, 1.0), (1, None)], "label int, prediction double")
    table = metrics.confusion(df)
    assert sum(r.n for r in table.collect()) == 7
    report = {r["class"]: r for r in metrics.class_report(table).collect()}
    assert (report[0.0].precision, report[0.0].recall) == (1.0, 0.5)
    assert (report[1.0].precision, report[1.0].recall) == (0.5, 1.0)
    assert report[2.0].precision is None and report[2.0].recall == 0 and report[2.0].f1 == 0


def test_a_model_written_and_read_scores_the_same(labelled, tmp_path):
    for kind in ("nb", "lr", "rf"):
        model = ml.fit(labelled, kind, ["useful", "noise"])
        ml.write_model(model, str(tmp_path / kind))
        read = ml.read_model(str(tmp_path / kind))
        score = lambda m: rows(m.transform(labelled).select("id", "prediction"))
        assert score(read) == score(model)

from __future__ import annotations

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from answerclock.operators import merge, ml
from answerclock.schemas import FEATURES, TAG_FEATURES, TEXT_FEATURES
from tests.conftest import rows


@pytest.fixture(scope="module")
def separable(spark):
    """400 posts whose label follows RSR and one flag."""
    columns = [
        F.when(F.col("id") % 2 == 0, 100.0).otherwise(1.0).alias(c)
        if c == "RSR"
        else (F.col("id") % 7 + 1).cast("double").alias(c)
        for c in TAG_FEATURES
    ]
    counts = [(F.col("id") % 5).cast("int").alias(c) for c in TEXT_FEATURES[:5]]
    flags = [(F.col("id") % 2 == 0).alias(c) for c in TEXT_FEATURES[5:]]
    label = (F.col("id") % 2).cast("int").alias("label")
    return spark.range(400).select(*columns, *counts, *flags, "id", label)


def test_assemble_takes_flags_and_refuses_nulls(spark, separable):
    first = ml.assemble(separable).filter("id = 0").first()
    assert list(first.features) == [1.0] * 6 + [100.0] + [0.0] * 5 + [1.0] * 3
    holed = separable.withColumn("PR", F.when(F.col("id") > 0, F.col("PR")))
    with pytest.raises(Exception, match="(?i)null"):
        ml.assemble(holed).collect()
    assert ml.assemble(holed, invalid="skip").count() == 399


def test_splits_are_whole_and_stable(separable):
    train, test = ml.train_test_split(separable)
    again, _ = ml.train_test_split(separable.repartition(13))
    assert train.count() + test.count() == 400
    assert rows(train.select("id")) == rows(again.select("id"))
    assert 280 < train.count() < 360
    assert not set(rows(train.select("id"))) & set(rows(test.select("id")))
    left, right = ml.train_test_split(separable, key=None)
    assert left.count() + right.count() == 400


@pytest.mark.parametrize("kind", ["rf", "nb", "lr"])
def test_models_learn_a_separable_label(separable, kind):
    score = ml.train_and_score(separable, kind).first()
    assert (score.model, score.accuracy) == (kind, 1.0)
    assert 40 < score.scored < 120


@pytest.mark.parametrize("kind", ["rf", "nb", "lr"])
def test_a_missing_label_is_never_predicted(separable, kind):
    """Naive Bayes alone would answer 0 when it has only seen label 1."""
    ones = separable.filter("label = 1")
    model = ml.fit(ones, kind)
    assert rows(model.transform(separable).select("prediction").distinct()) == [(1.0,)]
    unlabelled = separable.drop("label")
    assert model.transform(unlabelled).select("prediction").count() == 400


def test_unknown_model():
    with pytest.raises(ValueError, match="unknown model"):
        ml.classifier("svm")


def test_accuracy_equals_the_evaluator(spark):
    predictions = spark.createDataFrame(
        [(0.0, 0), (1.0, 0), (1.0, 1), (1.0, 1)], "prediction double, label int"
    )
    evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    assert rows(ml.evaluate(predictions)) == [(4, 3, evaluator.evaluate(predictions))]
    assert rows(ml.evaluate(predictions.limit(0))) == [(0, 0, None)]


def test_feature_importance(separable):
    weights = dict(rows(ml.feature_importance(ml.fit(separable))))
    assert set(weights) == set(FEATURES)
    telling = ["RSR", "end_que_mark", "begin_que_word", "is_weekend"]
    assert sum(weights[c] for c in telling) > 0.9


def test_merge_all(spark, separable):
    tag_means = separable.select("id", *TAG_FEATURES)
    text_table = separable.select("id", *TEXT_FEATURES).filter("id < 10")
    labels = separable.select("id", "label").filter("id > 5")
    merged = merge.merge_all(tag_means, text_table, labels)
    assert merged.columns == [*FEATURES, "id", "label"]
    assert [r[0] for r in rows(merged.select("id"))] == [6, 7, 8, 9]
    assert merge.merge_all(tag_means, text_table, labels, how="left").count() == 400

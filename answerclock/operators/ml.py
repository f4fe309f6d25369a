"""Split, assemble, train and score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from answerclock.operators.lookups import checkpointed
from answerclock.schemas import FEATURES

# Split and model settings.
TRAIN_SHARE = 0.8
SEED = 100
MAX_CLASSES = 1000
LOGISTIC = {"maxIter": 5, "regParam": 0.3, "elasticNetParam": 0.0}


def key_share(key: str, seed: int = SEED) -> Column:
    """A number in [0, 1) from the key alone, the same however rows are partitioned."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(2**32)


def hash_split(
    df: DataFrame, key: str = "id", share: float = TRAIN_SHARE, seed: int = SEED
) -> DataFrame:
    """``df`` with a boolean ``is_train``, true for about ``share`` of the keys."""
    return df.withColumn("is_train", key_share(key, seed) < share)


def train_test_split(
    df: DataFrame, share: float = TRAIN_SHARE, seed: int = SEED, key: str | None = "id"
) -> tuple[DataFrame, DataFrame]:
    """(train, test): by ``key`` when given, else a random split that follows partitions."""
    if key is None:
        df = checkpointed(df)  # each part reads it; the rows must not move in between
        train, test = df.randomSplit([share, 1 - share], seed=seed)
        return train, test
    in_train = key_share(key, seed) < share
    return df.filter(in_train), df.filter(~in_train)


def assembler(cols: Sequence[str] = FEATURES, invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid=invalid)


def assemble(df: DataFrame, cols: Sequence[str] = FEATURES, invalid: str = "error") -> DataFrame:
    """``df`` with a ``features`` vector of ``cols``; flags become 0 and 1."""
    return assembler(cols, invalid).transform(df)


def classifier(kind: str, seed: int = SEED):
    """``rf`` random forest, ``nb`` multinomial naive Bayes, ``lr`` logistic regression."""
    if kind == "rf":
        return RandomForestClassifier(featuresCol="features", labelCol="label", seed=seed)
    if kind == "nb":
        return NaiveBayes(featuresCol="features", labelCol="label", modelType="multinomial")
    if kind == "lr":
        return LogisticRegression(featuresCol="features", labelCol="label", **LOGISTIC)
    raise ValueError(f"unknown model {kind!r}: use rf, nb or lr")


def fit(
    df: DataFrame,
    kind: str = "rf",
    cols: Sequence[str] | None = FEATURES,
    seed: int = SEED,
) -> PipelineModel:
    """Train on ``df``. With ``cols=None`` the frame already has a ``features`` vector."""
    before = [] if cols is None else [assembler(cols)]
    model = classifier(kind, seed)
    if kind != "nb":
        return Pipeline(stages=[*before, model]).fit(df)
    # Naive Bayes predicts the place of a label among those it saw, which is the
    # label itself only when every label from 0 up is there. Translate both ways.
    label = F.col("label").cast("double")
    found = df.select(label.alias("label")).distinct().limit(MAX_CLASSES + 1).collect()
    if len(found) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} labels: this is no class column")
    seen = sorted(row[0] for row in found)
    place = F.array_position(F.array(*[F.lit(value) for value in seen]), label) - 1
    model = model.setLabelCol("label_place").setPredictionCol("label_place_predicted")
    fitted = Pipeline(stages=[*before, model]).fit(df.withColumn("label_place", place))
    labels = ", ".join(f"{value}D" for value in seen)
    translate = SQLTransformer(
        statement=f"SELECT *, element_at(array({labels}), 1 + CAST(label_place_predicted AS INT)) "
        "AS prediction FROM __THIS__"
    )
    return PipelineModel([*fitted.stages, translate])


def write_model(model: PipelineModel, path: str) -> None:
    """A fitted model as files, in place of what was there."""
    model.write().overwrite().save(path)


def read_model(path: str) -> PipelineModel:
    """A model that ``write_model`` has written; scores as the one that was fitted."""
    return PipelineModel.load(path)


def evaluate(predictions: DataFrame, label: str = "label") -> DataFrame:
    """One row: scored rows, right ones, accuracy."""
    right = F.col("prediction").cast("double") == F.col(label).cast("double")
    sums = predictions.agg(
        F.count(F.lit(1)).alias("scored"),
        F.coalesce(F.sum(right.cast("long")), F.lit(0)).alias("right"),
    )
    return sums.select("scored", "right", F.try_divide("right", "scored").alias("accuracy"))


def feature_importance(model: PipelineModel | Model, cols: Sequence[str] = FEATURES) -> DataFrame:
    """(feature, importance) of a trained forest."""
    forest = model.stages[-1] if isinstance(model, PipelineModel) else model
    weights = forest.featureImportances.toArray().tolist()
    rows = list(zip(cols, weights, strict=True))
    return SparkSession.active().createDataFrame(rows, "feature string, importance double")


def train_and_score(
    df: DataFrame,
    kind: str = "rf",
    cols: Sequence[str] | None = FEATURES,
    share: float = TRAIN_SHARE,
    seed: int = SEED,
    key: str | None = "id",
) -> DataFrame:
    """Split, train and score: one row with the model kind and its accuracy on the test part.

    Training reads its input several times, so the input is checkpointed first.
    """
    stored = checkpointed(df)
    train, test = train_test_split(stored, share, seed, key)
    model = fit(train, kind, cols, seed)
    return evaluate(model.transform(test)).withColumn("model", F.lit(kind))

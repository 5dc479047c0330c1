"""Random-forest pipeline, scoring and feature importance.

Training is MLlib's distributed tree learner; this module only assembles the
pipeline. Class weights are two scalars from one aggregate over the training
split (a model parameter, like the reference's), added as a literal column.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaic import config
from voltaic.functions.exprs import probability_of
from voltaic.operators.split import class_weights, with_class_weight


def build_pipeline(features: Sequence[str] = config.FEATURES, *, impute: bool = False,
                   weight_col: str | None = "class_weight", relative_error: float = 0.001,
                   **rf_params) -> Pipeline:
    """M4-M6: [Imputer(median)] -> VectorAssembler -> weighted RandomForest."""
    params = {**config.RF_PARAMS, **rf_params}
    stages = []
    cols = list(features)
    if impute:
        out = [f"{c}_imputed" for c in cols]
        stages.append(Imputer(inputCols=cols, outputCols=out, strategy="median", relativeError=relative_error))
        cols = out
    stages.append(VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="error"))
    rf = RandomForestClassifier(labelCol=config.LABEL, featuresCol="features", **params)
    if weight_col:
        rf.setWeightCol(weight_col)
    stages.append(rf)
    return Pipeline(stages=stages)


def train_rf(train: DataFrame, features: Sequence[str] = config.FEATURES, *, impute: bool = False,
             **rf_params) -> PipelineModel:
    """Fit the weighted forest on the training split (w1 = n0 / n1)."""
    _, w1 = class_weights(train)
    data = with_class_weight(train, w1)
    return build_pipeline(features, impute=impute, **rf_params).fit(data)


def score_rows(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ("vehicle_id", "time", config.LABEL)) -> DataFrame:
    """Prediction and class-1 probability (``vector_to_array``, no Python UDF)."""
    scored = model.transform(df)
    return scored.select(*[c for c in keep if c in df.columns], "prediction",
                         probability_of("probability").alias("risk_probability"))


def model_features(model: PipelineModel) -> list[str]:
    """The feature names a fitted pipeline was trained on, read from its
    assembler (``_imputed`` suffixes removed), so a saved model carries its
    own feature list and order."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    return [c[: -len("_imputed")] if c.endswith("_imputed") else c for c in assembler.getInputCols()]


def feature_importance(spark: SparkSession, model: PipelineModel,
                       features: Sequence[str] | None = None) -> DataFrame:
    """``(feature, importance)`` ordered by importance (ties by name);
    names come from the model unless given."""
    features = list(features) if features is not None else model_features(model)
    imp = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def model_summary(spark: SparkSession, model: PipelineModel) -> DataFrame:
    rf = model.stages[-1]
    return spark.createDataFrame(
        [(rf.getNumTrees, rf.totalNumNodes, rf.getOrDefault("maxDepth"), rf.numFeatures)],
        "num_trees int, total_nodes int, max_depth int, num_features int")


def save_model(model: PipelineModel, path: str) -> str:
    """K6: overwrite-save the fitted pipeline."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """S13."""
    return PipelineModel.load(path)

"""Regressors on feature tables, with Spark ML."""

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from hazeline.functions.aqi import clamp_index
from hazeline.models.predictors import TreePredictor, tree_predictor
from hazeline.operators.features import SERVE
from hazeline.operators.scaling import regression_metrics
from hazeline.schemas import TARGET

INPUTS = "features"


def feature_columns(df: DataFrame, target: str = TARGET, keys=("city", "timestamp", "split")) -> list[str]:
    """Every numeric column that is neither key, target nor bookkeeping."""
    numeric = [field.name for field in df.schema if isinstance(field.dataType, NumericType)]
    return [n for n in numeric if n != target and n not in keys and not n.startswith("_")]


def assembler(features) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=INPUTS, handleInvalid="error")


@dataclass(frozen=True)
class BoostSettings:
    """Defaults are the published training settings.

    ``reg_alpha`` and ``reg_lambda`` have no counterpart here; the row minimum
    stands in for the minimum child weight.
    """

    trees: int = 1000
    step: float = 0.05
    depth: int = 6
    row_share: float = 0.8
    column_share: str = "0.8"
    min_rows: int = 5
    patience: int = 50
    seed: int = 42


def booster(settings: BoostSettings, trees: int) -> GBTRegressor:
    return GBTRegressor(
        featuresCol=INPUTS,
        labelCol=TARGET,
        maxIter=trees,
        stepSize=settings.step,
        maxDepth=settings.depth,
        subsamplingRate=settings.row_share,
        featureSubsetStrategy=settings.column_share,
        minInstancesPerNode=settings.min_rows,
        seed=settings.seed,
    )


def best_iteration(errors, patience: int) -> tuple[int, bool]:
    """Index of the lowest error before ``patience`` rounds bring no better one.

    The flag says whether patience ran out, so that more rounds are pointless.
    """
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        if i - best >= patience:
            return best, True
    return best, False


def prefix_errors(df: DataFrame, predictor: TreePredictor, target: str = TARGET) -> DataFrame:
    """``trees, mae``: mean absolute error of the first n trees, for every n, from one pass.

    A task adds the errors of its rows up to one row of as many sums as there are trees.
    """
    sent = df.sparkSession.sparkContext.broadcast(predictor)  # a size set by the model alone
    inputs = [F.col(n).cast("double").alias(f"_x{i}") for i, n in enumerate(predictor.features)]

    def run(batches):
        predictor, sums, rows = sent.value, 0.0, 0
        for batch in batches:
            labels = batch["_y"].to_numpy(dtype=float)
            matrix = batch.drop(columns="_y").to_numpy(dtype=float)
            so_far, errors = np.zeros(len(matrix)), []
            for part in predictor.parts(matrix):
                so_far += part
                errors.append(np.abs(so_far - labels).sum())
            sums, rows = sums + np.array(errors), rows + len(matrix)
        if rows:
            yield pd.DataFrame({"sums": [sums], "n": [rows]})

    parts = df.select(*inputs, F.col(target).cast("double").alias("_y")).mapInPandas(run, "sums array<double>, n long")
    long = parts.select("n", F.posexplode("sums").alias("trees", "sum"))
    return long.groupBy((F.col("trees") + 1).alias("trees")).agg((F.sum("sum") / F.sum("n")).alias("mae"))


def first_trees(model: GBTRegressionModel, trees: int) -> GBTRegressionModel:
    """The model of the first trees of a boosted ensemble, which are what a shorter fit would give."""
    whole, context = model._java_obj, SparkSession.active().sparkContext
    regression = context._jvm.org.apache.spark.ml.regression
    kept = context._gateway.new_array(regression.DecisionTreeRegressionModel, trees)
    weights = context._gateway.new_array(context._jvm.double, trees)
    for i, (tree, weight) in enumerate(zip(whole.trees()[:trees], whole.treeWeights()[:trees])):
        kept[i], weights[i] = tree, weight
    short = GBTRegressionModel(regression.GBTRegressionModel(whole.uid(), kept, weights, whole.numFeatures()))
    for param in model.extractParamMap():
        if model.isSet(param):
            short.set(short.getParam(param.name), model.getOrDefault(param))
    short._transfer_params_to_java()
    return short


def fit_boosted(train: DataFrame, validation: DataFrame, features, settings: BoostSettings = BoostSettings()):
    """Boosted trees stopped at the best mean absolute error on ``validation``.

    All trees are fitted once. One pass over the validation rows scores every prefix of the
    ensemble, and the trees up to the best one before patience runs out are the model.
    Returns the pipeline model and the number of trees.
    """
    inputs = assembler(features)
    prepared = inputs.transform(train).select(INPUTS, TARGET).persist()
    try:
        model = booster(settings, settings.trees).fit(prepared)
    finally:
        prepared.unpersist()
    predictor = tree_predictor(train.sparkSession, model, features)
    errors = prefix_errors(validation, predictor).orderBy("trees").collect()  # one row per tree
    best, _ = best_iteration([row["mae"] for row in errors], settings.patience) if errors else (len(predictor.weights) - 1, False)
    return PipelineModel([inputs, first_trees(model, best + 1)]), best + 1


def baseline_estimators(trees: int = 100, depth: int = 10) -> dict:
    """The models the boosted trees are compared with."""
    return {
        "linear": LinearRegression(featuresCol="scaled", labelCol=TARGET, solver="normal"),
        "ridge": LinearRegression(featuresCol="scaled", labelCol=TARGET, regParam=1.0, elasticNetParam=0.0),
        "lasso": LinearRegression(featuresCol="scaled", labelCol=TARGET, regParam=1.0, elasticNetParam=1.0),
        "forest": RandomForestRegressor(
            featuresCol=INPUTS, labelCol=TARGET, numTrees=trees, maxDepth=depth, seed=42
        ),
    }


def fit_pipeline(train: DataFrame, features, estimator) -> PipelineModel:
    """Assembler, scaler where the estimator reads scaled inputs, and model."""
    stages = [assembler(features)]
    if estimator.getFeaturesCol() == "scaled":
        stages.append(StandardScaler(inputCol=INPUTS, outputCol="scaled", withMean=True, withStd=True))
    return Pipeline(stages=[*stages, estimator]).fit(train)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Batch scoring, clamped to the index range."""
    scored = model.transform(df).drop(INPUTS, "scaled")
    return scored.withColumn("prediction", clamp_index(F.col("prediction")))


def compare_models(models: dict[str, PipelineModel], test: DataFrame) -> DataFrame:
    """One metrics row per model, ranked by mean absolute error."""
    rows = [regression_metrics(predict(m, test)).withColumn("model", F.lit(n)) for n, m in models.items()]
    return reduce(DataFrame.unionByName, rows).orderBy("mae")


def save_model(model: PipelineModel, path: str) -> None:
    """One artifact holds the feature list, the scaler and the model."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_features(spark: SparkSession, path: str | None = None) -> list[str]:
    """Inputs of the saved model, or the serving preset's when none is saved."""
    if path is None:
        return SERVE.names
    try:
        spark.read.text(f"{path}/metadata").schema  # resolves the path
    except AnalysisException:
        return SERVE.names
    return load_model(path).stages[0].getInputCols()


def check_width(model: PipelineModel) -> bool:
    """Whether the model takes as many inputs as the stored list names."""
    return model.stages[-1].numFeatures == len(model.stages[0].getInputCols())

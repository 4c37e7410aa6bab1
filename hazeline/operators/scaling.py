"""Splitting, standardising and scoring with plain aggregates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline import series
from hazeline.functions.aqi import clamp_index
from hazeline.operators.projection import align_features
from hazeline.series import DEFAULT, POS, ROWS, Layout


def chronological_split(numbered: DataFrame, ratio: float = 0.8) -> DataFrame:
    """Label the first ``int(n * ratio)`` rows of each city train, the rest test.

    Positions are known, so no window and no shuffle is needed.
    """
    cut = F.floor(F.col(ROWS) * F.lit(ratio))
    return numbered.withColumn("split", F.when(F.col(POS) < cut, "train").otherwise("test"))


def split_ranges(split: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    day = F.to_date(F.col(layout.time))
    return split.groupBy(layout.key, "split").agg(
        F.count("*").alias("rows"), F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )


def fit_scaler(train: DataFrame, features, by=()) -> DataFrame:
    """Mean and population deviation per feature, a constant feature divided by 1."""
    picks = []
    for name in features:
        spread = F.stddev_pop(F.col(name).cast("double"))
        picks.append(F.avg(F.col(name).cast("double")).alias(f"{name}_mean"))
        picks.append(F.when(spread == 0, F.lit(1.0)).otherwise(spread).alias(f"{name}_scale"))
    return train.groupBy(*by).agg(*picks)


def scale(df: DataFrame, scaler: DataFrame, features, layout: Layout = DEFAULT) -> DataFrame:
    """Standardise a blocked series by its city's scaler, or by one global row."""
    if layout.key in scaler.columns:
        joined = series.join_per_city(df, scaler, layout)
    else:
        # A grouping without keys is one row by construction.
        wanted = {f"{n}_{p}" for n in features for p in ("mean", "scale")}
        if not wanted <= set(scaler.columns) or any(not c.endswith(("_mean", "_scale")) for c in scaler.columns):
            raise ValueError(f"a scaler by another key than {layout.key} cannot be joined")
        joined = df.join(F.broadcast(scaler.limit(1)))
    scaled = {n: (F.col(n).cast("double") - F.col(f"{n}_mean")) / F.col(f"{n}_scale") for n in features}
    return joined.withColumns(scaled).drop(*[f"{n}_{p}" for n in features for p in ("mean", "scale")])


def regression_metrics(scored: DataFrame, label: str = "aqi", prediction: str = "prediction", by=()) -> DataFrame:
    """MAE, RMSE and R2 in one pass of combinable aggregates.

    The total sum of squares is the population variance times the row count,
    which stays accurate where a difference of large sums would not.
    """
    actual, guess = F.col(label).cast("double"), F.col(prediction).cast("double")
    error = actual - guess
    total = F.var_pop(actual) * F.count(actual)
    return scored.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(error * error), total)).alias("r2"),
    )


def linear_score(coefficients: dict[str, float], intercept: float, columns) -> Column:
    """A linear model as one expression; inputs the table lacks count as 0."""
    score = F.lit(float(intercept))
    for name, weight in coefficients.items():
        if name in columns:
            score = score + F.lit(float(weight)) * F.col(name).cast("double")
    return score


def score_linear(df: DataFrame, coefficients: dict[str, float], intercept: float, keep=()) -> DataFrame:
    """Align inputs to the model, score and clamp to the index range."""
    aligned = align_features(df, list(coefficients), keep)
    return aligned.withColumn("prediction", clamp_index(linear_score(coefficients, intercept, aligned.columns)))

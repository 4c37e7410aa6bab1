"""Forecasts, attributions and fitted models."""

from pyspark.sql import functions as F

from catalog.features import FeatureSql
from catalog.fixture import HOURLY, cleaned, features, readings, with_tables
from catalog.registry import query, r, rounded
from hazeline import series
from hazeline.models import attribution, fit
from hazeline.models.forecast import forecast
from hazeline.models.predictors import LinearPredictor, tree_predictor
from hazeline.operators import scaling
from hazeline.operators.features import TRAIN
from hazeline.schemas import POLLUTANTS
from hazeline.session import scratch_path

STEPS = LinearPredictor(
    ("aqi_lag_1h", "aqi_lag_24h", "pm2_5_lag_1h", "aqi_roll_mean_6h", "aqi_rate_1h", "hour", "no2"),
    (0.5, 0.2, 0.05, 0.2, 0.1, 0.3, 0.01),
    2.0,
)


@query("M7 M10", with_tables(
    f"SELECT city, cast(horizon AS INTEGER) AS horizon, last_time + to_hours(horizon) AS timestamp, {r('aqi')} "
    "FROM walk WHERE horizon > 0", "cleaned", recursive=True, extra={
        "newest": """SELECT city, list(aqi::DOUBLE ORDER BY timestamp) AS past, max(timestamp) AS last_time,
            arg_max(pm2_5, timestamp) AS pm, arg_max(no2, timestamp) AS no2 FROM (
              SELECT *, row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) AS back FROM cleaned)
            WHERE back <= 200 GROUP BY city""",
        "walk": """SELECT city, last_time, pm, no2, past, 0 AS horizon, NULL::DOUBLE AS aqi FROM newest UNION ALL
            SELECT city, last_time, pm, no2, list_append(past, guess), horizon + 1, guess FROM (
              SELECT *, least(greatest(2 + 0.5::DOUBLE * past[-1] + 0.2::DOUBLE * past[-24] + 0.05::DOUBLE * pm
                + 0.2::DOUBLE * list_avg(past[-6:]) + 0.1::DOUBLE * (past[-1] - past[-2])
                + 0.3::DOUBLE * hour(last_time + to_hours(horizon + 1)) + 0.01::DOUBLE * no2, 0), 500) AS guess
              FROM walk WHERE horizon < 72)""",
    }))
def linear_forecast(spark, sf_dir):
    """72 hours ahead, each prediction the next step's lag."""
    rows = series.drop_bookkeeping(cleaned(spark, sf_dir))
    return rounded(forecast(rows, STEPS, layout=HOURLY))


WEIGHTS = {"pm2_5": 0.5, "co": 0.02, "no2": 0.3}
_PHI = " UNION ALL ".join(
    f"SELECT city, timestamp, '{c}' AS feature, {w}::DOUBLE * ({c} - avg({c}) OVER ()) AS phi FROM readings"
    for c, w in WEIGHTS.items()
)


@query("M13", with_tables(f"SELECT city, timestamp, feature, {r('phi')} FROM ({_PHI})", "readings"))
def linear_contributions(spark, sf_dir):
    return rounded(attribution.linear_attributions(readings(spark, sf_dir), WEIGHTS))


@query("M13 A10", with_tables(
    f"SELECT city, feature, {r('avg(abs(phi))', 'importance')} FROM ({_PHI}) GROUP BY 1, 2", "readings"))
def linear_feature_importance(spark, sf_dir):
    return rounded(attribution.linear_importance(readings(spark, sf_dir), WEIGHTS, ("city",)))


@query("M13 M12", with_tables(
    "SELECT city, timestamp, feature, " + r("phi") + " FROM (" + " UNION ALL ".join(
        f"SELECT city, timestamp, '{c}' AS feature, {w}::DOUBLE * ({c} - (SELECT avg({c}) FROM known)) AS phi FROM cleaned"
        for c, w in WEIGHTS.items()) + ")",
    "cleaned", extra={"known": "SELECT * FROM cleaned ORDER BY timestamp, city LIMIT 50"}))
def background_contributions(spark, sf_dir):
    """The attributions of any model, here of one whose exact values are known."""
    rows = cleaned(spark, sf_dir).select("city", "timestamp", *WEIGHTS)
    linear = LinearPredictor(tuple(WEIGHTS), tuple(WEIGHTS.values()), 7.0)
    explained = attribution.interventional_attributions(rows, linear, rows.orderBy("timestamp", "city").limit(50))
    return rounded(attribution.to_long(explained, linear.features))


_SPLIT = """SELECT *, row_number() OVER (PARTITION BY city ORDER BY timestamp)
    <= floor(count(*) OVER (PARTITION BY city) * 0.8) AS train FROM cleaned"""


@query("M1 M2 M5 M6", with_tables(
    "SELECT city, timestamp, round(least(greatest(slope * pm2_5 + height, 0), 500), 4) + 0.0 AS prediction FROM split, line WHERE NOT train",
    "cleaned", extra={
        "split": _SPLIT,
        "line": "SELECT regr_slope(aqi, pm2_5) AS slope, regr_intercept(aqi, pm2_5) AS height FROM split WHERE train",
    }))
def straight_line(spark, sf_dir):
    """A linear model of one scaled input, fitted, saved, loaded and scored."""
    split = scaling.chronological_split(series.number_rows(cleaned(spark, sf_dir), HOURLY))
    linear = fit.baseline_estimators()["linear"]
    model, path = fit.fit_pipeline(split.where("split = 'train'"), ["pm2_5"], linear), scratch_path(spark, "line")
    fit.save_model(model, path)
    scored = fit.predict(fit.load_model(path), split.where("split = 'test'"))
    return rounded(scored.select("city", "timestamp", "prediction"), 4)


_NAMES = {"saved": ["pm2_5", "co", "o3"], "default": [*POLLUTANTS, *FeatureSql().columns("serve")]}
_LISTED = " UNION ALL ".join(f"SELECT '{k}' AS list, unnest({names}) AS feature" for k, names in _NAMES.items())
_MEANS = " UNION ALL ".join(f"SELECT '{p}' AS feature, avg({p}) AS mean FROM cleaned" for p in POLLUTANTS)


@query("S9 S10 M14 P7", with_tables(
    f"SELECT list, feature, {r('mean')}, true AS width_fits FROM ({_LISTED}) LEFT JOIN ({_MEANS}) USING (feature)", "cleaned"))
def model_inputs(spark, sf_dir):
    """The inputs a saved model names, those taken where none is saved, and the mean of each that is measured."""
    rows, path = cleaned(spark, sf_dir), scratch_path(spark, "inputs")
    fit.save_model(fit.fit_pipeline(rows, _NAMES["saved"], fit.baseline_estimators()["ridge"]), path)
    fits = fit.check_width(fit.load_model(path))
    lists = {"saved": fit.model_features(spark, path), "default": fit.model_features(spark, f"{path}-none")}
    listed = spark.createDataFrame([(k, n) for k, names in lists.items() for n in names], "list string, feature string")
    means = rows.agg(*[F.avg(p).alias(p) for p in POLLUTANTS]).unpivot([], list(POLLUTANTS), "feature", "mean")
    return rounded(listed.join(means, "feature", "left").select("list", "feature", "mean", F.lit(fits).alias("width_fits")))


def training_parts(spark, sf_dir):
    """Training features cut by time, and the names of the model's inputs."""
    numbered = series.stage_numbered(features(spark, sf_dir, TRAIN), HOURLY, "training")
    split = scaling.chronological_split(numbered)
    return split.where("split = 'train'"), split.where("split = 'test'"), TRAIN.names


@query("M2 M6")
def model_comparison(spark, sf_dir):
    """Errors of the baseline models on the last fifth of each city's rows."""
    train, test, names = training_parts(spark, sf_dir)
    estimators = fit.baseline_estimators(trees=20, depth=5)
    fitted = {name: fit.fit_pipeline(train, names, estimator) for name, estimator in estimators.items()}
    return rounded(fit.compare_models(fitted, test).withColumn("inputs", F.lit(len(names))))


@query("M3 M4 M5 S9")
def boosted_errors(spark, sf_dir):
    """Boosted trees stopped early on the last fifth, saved, loaded and scored."""
    train, test, names = training_parts(spark, sf_dir)
    model, trees = fit.fit_boosted(train, test, names, fit.BoostSettings(trees=20, depth=4, patience=5))
    path = scratch_path(spark, "model")
    fit.save_model(model, path)
    scored = fit.predict(fit.load_model(path), test)
    return rounded(scaling.regression_metrics(scored, by=("city",)).withColumn("trees", F.lit(trees)))


@query("M12 A10")
def tree_contributions(spark, sf_dir):
    """Each row's prediction taken apart: base plus contributions gives it back."""
    train, test, names = training_parts(spark, sf_dir)
    forest = fit.fit_pipeline(train, names, fit.baseline_estimators(trees=10, depth=4)["forest"])
    predictor = tree_predictor(spark, forest.stages[-1], names)
    rows = attribution.tree_attributions(test, predictor)
    total = F.aggregate("phi", F.lit(0.0), lambda a, x: a + x)
    largest = F.array_max(F.transform("phi", F.abs))
    return rows.select("city", "timestamp", "base", "prediction", total.alias("contributions"), largest.alias("largest"))

"""Forecasts, attributions and fits against brute force and their own laws."""

import datetime as dt
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazeline.functions.calendar import add_hours
from hazeline.models import attribution, fit
from hazeline.models.forecast import forecast
from hazeline.models.predictors import LinearPredictor, TreePredictor, tree_predictor
from hazeline.operators import scaling
from hazeline.operators.features import SERVE, TRAIN

START = dt.datetime(2024, 1, 1)
SCHEMA = "city string, timestamp timestamp, aqi int, pm2_5 double, pm10 double, no2 double, so2 double, o3 double, co double"


@pytest.fixture(scope="module")
def history(spark):
    rows = [("a", START + dt.timedelta(hours=i), (i * 37) % 101, *[float((i * 7 + k) % 53) for k in range(6)]) for i in range(90)]
    return spark.createDataFrame(rows, SCHEMA)


def one(name):
    return LinearPredictor((name,), (1.0,), 0.0)


def test_forecast_forms_the_training_inputs(history):
    rows = history.orderBy("timestamp").toPandas()
    past, pm = rows["aqi"].astype(float), rows["pm2_5"]
    wanted = {
        "aqi_lag_72h": past.iloc[-72], "aqi_roll_std_6h": past.iloc[-6:].std(), "pm2_5_roll_mean_24h": pm.iloc[-24:].mean(),
        "aqi_diff_24h": max(0.0, past.iloc[-1] - past.iloc[-25]), "aqi_trend": max(0.0, np.sign(past.iloc[-1] - past.iloc[-2])),
        "pm25_lag_24h": pm.iloc[-24], "no2": rows["no2"].iloc[-1], "hour": (START + dt.timedelta(hours=90)).hour,
    }
    for name, value in wanted.items():
        assert forecast(history, one(name), TRAIN, hours=1).first().aqi == pytest.approx(value), name


def test_forecast_of_unknown_inputs_raises(history):
    with pytest.raises(ValueError, match="wind"):
        forecast(history, one("wind"))
    assert forecast(history, one("wind"), zero_absent=True).agg(F.max("aqi")).first()[0] == 0


def test_forecast_covers_short_and_empty_histories(spark, history):
    short = history.orderBy("timestamp").limit(1)
    assert forecast(short, one("aqi_roll_mean_24h"), SERVE).count() == 72
    assert forecast(history.where("false"), one("aqi_lag_1h"), SERVE).count() == 0


def all_orders(value, players):
    """Shapley values from every order of the players."""
    out = np.zeros(players)
    for order in permutations(range(players)):
        known = set()
        for i in order:
            out[i] += (value(known | {i}) - value(known)) / factorial(players)
            known.add(i)
    return out


@pytest.mark.parametrize("share", [[0.2, 0.7, 0.5], [0.4], [1.0, 0.1, 0.6, 0.9, 0.3]])
def test_shapley_values_equal_all_orders(share):
    d = len(share)
    inside = np.array([[(code >> i) & 1 for i in range(d)] for code in range(2**d)], dtype=float)
    got = attribution.shapley_values(inside, np.broadcast_to(np.array(share), inside.shape))
    for mine, own in zip(got, inside):
        value = lambda s: np.prod([own[j] if j in s else share[j] for j in range(d)])
        assert mine == pytest.approx(all_orders(value, d))


@pytest.mark.parametrize("trees,depth", [(5, 4), (200, 6)])
def test_tree_contributions_add_up(spark, history, trees, depth):
    names = ["pm2_5", "no2", "co", "o3", "so2", "pm10"]
    forest = fit.fit_pipeline(history, names, fit.baseline_estimators(trees=trees, depth=depth)["forest"])
    predictor = tree_predictor(spark, forest.stages[-1], names)
    assert isinstance(predictor, TreePredictor)
    explained = attribution.tree_attributions(history, predictor).toPandas().sort_values("timestamp")
    spark_says = forest.transform(history).orderBy("timestamp").toPandas()["prediction"]
    assert explained["prediction"].to_numpy() == pytest.approx(spark_says.to_numpy())
    assert (explained["base"] + explained["phi"].map(sum)).to_numpy() == pytest.approx(explained["prediction"].to_numpy())


def test_leaves_beyond_the_limit_are_refused(spark, history, monkeypatch):
    forest = fit.fit_pipeline(history, ["co"], fit.baseline_estimators(trees=2, depth=3)["forest"])
    predictor = tree_predictor(spark, forest.stages[-1], ["co"])
    monkeypatch.setattr(attribution, "MOST_BYTES", 10)
    with pytest.raises(ValueError, match="bytes"):
        attribution.tree_attributions(history, predictor)


def test_interventional_contributions(spark, history):
    names = ["pm2_5", "no2", "co"]
    background = history.orderBy("timestamp").limit(20)
    sample = background.toPandas()[names].to_numpy()
    forest = fit.fit_pipeline(history, names, fit.baseline_estimators(trees=5, depth=4)["forest"])
    trees = tree_predictor(spark, forest.stages[-1], names)
    linear = LinearPredictor(tuple(names), (0.5, -0.2, 0.1), 3.0)
    for predictor in (trees, linear):
        got = attribution.interventional_attributions(history, predictor, background).toPandas().sort_values("timestamp")
        matrix = history.orderBy("timestamp").toPandas()[names].to_numpy()
        assert got["base"].iloc[0] == pytest.approx(predictor.predict(sample).mean())
        assert (got["base"] + got["phi"].map(sum)).to_numpy() == pytest.approx(predictor.predict(matrix))
    assert np.stack(got["phi"]) == pytest.approx((matrix - sample.mean(axis=0)) * np.array(linear.weights))
    with pytest.raises(ValueError, match="background"):
        attribution.interventional_attributions(history, linear, history.limit(0))
    # a single feature pair: all orders are two, and both are taken
    two = tree_predictor(spark, fit.fit_pipeline(history, names[:2], fit.baseline_estimators(trees=3)["forest"]).stages[-1], names[:2])
    got = attribution.interventional_attributions(history, two, background).toPandas().sort_values("timestamp")
    for row, phi in zip(matrix[:5, :2], got["phi"]):
        value = lambda s: np.mean(two.predict(np.array([[row[j] if j in s else z[j] for j in range(2)] for z in sample])))
        assert phi == pytest.approx(all_orders(value, 2))


def parted(spark):
    rows = [(START + dt.timedelta(hours=i), 50.0 + 40.0 * ((i // 6) % 2) + i % 5, float((i // 6) % 2), float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "timestamp timestamp, aqi double, x double, y double")
    cut = add_hours(F.lit(START), F.lit(160))
    return df.where(F.col("timestamp") < cut), df.where(F.col("timestamp") >= cut)


def test_one_fit_keeps_the_trees_of_a_shorter_fit(spark, monkeypatch):
    train, test = parted(spark)
    settings = fit.BoostSettings(trees=25, patience=4, depth=2, step=0.3)
    fits = []
    whole_fit = fit.booster
    monkeypatch.setattr(fit, "booster", lambda s, n: fits.append(n) or whole_fit(s, n))
    model, trees = fit.fit_boosted(train, test, ["x", "y"], settings)
    assert fits == [25] and model.stages[-1].getNumTrees == trees < 25
    # Spark's own scores of each iteration name the same tree, and a fit of that many gives the same model
    inputs = fit.assembler(["x", "y"])
    long = whole_fit(settings, 25).fit(inputs.transform(train))
    errors = long.evaluateEachIteration(inputs.transform(test), "absolute")
    assert fit.best_iteration(errors, 4)[0] + 1 == trees
    mine = fit.prefix_errors(test, tree_predictor(spark, long, ["x", "y"])).orderBy("trees").collect()
    assert [r.mae for r in mine] == pytest.approx(errors)
    short = whole_fit(settings, trees).fit(inputs.transform(train))
    score = lambda m: [r.prediction for r in m.transform(inputs.transform(test)).orderBy("timestamp").collect()]
    assert score(short) == pytest.approx(score(model.stages[-1])) and fit.check_width(model)


def test_a_cut_model_is_saved_and_loaded(spark, tmp_path):
    train, test = parted(spark)
    model, trees = fit.fit_boosted(train, test, ["x", "y"], fit.BoostSettings(trees=6, patience=2, depth=2))
    fit.save_model(model, str(tmp_path / "cut"))
    loaded = fit.load_model(str(tmp_path / "cut"))
    assert loaded.stages[-1].getNumTrees == trees
    assert fit.predict(loaded, test).select("prediction").collect() == fit.predict(model, test).select("prediction").collect()


def test_boosted_trees_beat_persistence(spark):
    rows = [(START + dt.timedelta(hours=i), 50.0 + 40.0 * ((i // 6) % 2), float((i // 6) % 2), 0.0) for i in range(200)]
    df = spark.createDataFrame(rows, "timestamp timestamp, aqi double, x double, y double")
    train, test = df.where(F.col("timestamp") < add_hours(F.lit(START), F.lit(160))), df.where(F.col("timestamp") >= add_hours(F.lit(START), F.lit(160)))
    model, trees = fit.fit_boosted(train, test, ["x", "y"], fit.BoostSettings(trees=30, patience=5, depth=2))
    assert 1 <= trees <= 30
    mae = scaling.regression_metrics(fit.predict(model, test)).first().mae
    values = pd.Series([r.aqi for r in test.orderBy("timestamp").collect()])
    assert mae < values.diff().abs().mean()


def test_saved_model_keeps_its_inputs(spark, history, tmp_path):
    path = str(tmp_path / "model")
    assert fit.model_features(spark, path) == SERVE.names
    model = fit.fit_pipeline(history, ["pm2_5", "co"], fit.baseline_estimators()["ridge"])
    fit.save_model(model, path)
    assert fit.model_features(spark, path) == ["pm2_5", "co"]
    assert fit.check_width(fit.load_model(path))


def test_feature_columns_are_numeric(history):
    assert fit.feature_columns(history.withColumn("source", F.lit("x"))) == ["pm2_5", "pm10", "no2", "so2", "o3", "co"]


def test_scaler_of_another_key_is_refused(history):
    by_hour = scaling.fit_scaler(history.withColumn("hour", F.hour("timestamp")), ["co"], by=("hour",))
    with pytest.raises(ValueError):
        scaling.scale(history, by_hour, ["co"])
    scaled = scaling.scale(history, scaling.fit_scaler(history, ["co"]), ["co"])
    assert scaled.agg(F.avg("co")).first()[0] == pytest.approx(0, abs=1e-9)

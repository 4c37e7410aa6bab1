"""Hand-made rows for the index and for gap filling, and rolling frames against pandas."""

import datetime as dt
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazeline import series
from hazeline.functions import aqi
from hazeline.operators.cleaning import interpolate_time, nan_to_null
from hazeline.operators.features import TRAIN, add_features
from hazeline.series import Layout

NAN = float("nan")
#: Pollutant, amount in μg/m³ and the index worked out by hand.
SCORES = [
    ("pm2_5", 0.0, 0), ("pm2_5", 6.0, 25), ("pm2_5", 12.0, 50), ("pm2_5", 12.05, 500), ("pm2_5", 12.1, 51),
    ("pm2_5", 35.4, 100), ("pm2_5", 500.5, 500), ("pm2_5", -1.0, 500), ("pm2_5", NAN, 500), ("pm10", 27.0, 25),
    ("pm10", 54.5, 500), ("pm10", 100.0, 73), ("no2", 100.0, 500), ("o3", 106.0, 300), ("o3", 500.0, 300),
    ("o3", NAN, 300), ("so2", 40.0, 22), ("so2", 92.5, 500), ("co", 600.0, 6), ("co", 5100.0, 500), ("co", 60000.0, 500),
]
START = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("pollutant", sorted({s[0] for s in SCORES}))
def test_sub_index(spark, pollutant):
    wanted = [(v, w) for p, v, w in SCORES if p == pollutant]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(wanted)], "i int, v double")
    got = df.select("i", aqi.sub_index(pollutant, F.col("v")).alias("s")).orderBy("i").collect()
    assert [r.s for r in got] == [w for _, w in wanted]


def test_composite_of_nothing_is_zero(spark):
    df = spark.range(1).select(*[F.lit(None).cast("double").alias(p) for p in ("pm2_5", "pm10", "no2", "so2", "o3", "co")])
    assert aqi.with_aqi(df).first().aqi == 0


GAPS = [
    ([10, None, None, 40], [10, 20, 30, 40]),
    ([0, None, None, None, None, None, 60], [0, 10, 20, 30, None, None, 60]),
    ([None, None, 5], [None, None, 5]),
    ([5, None, None, None, None], [5, 5, 5, 5, None]),
    ([10, NAN, 30], [10, 20, 30]),
]


@pytest.mark.parametrize("values,wanted", GAPS)
def test_gap_filling(spark, values, wanted):
    rows = [("x", START + dt.timedelta(hours=i), None if v is None else float(v)) for i, v in enumerate(values)]
    df = nan_to_null(spark.createDataFrame(rows, "city string, timestamp timestamp, pm2_5 double"), ["pm2_5"])
    got = interpolate_time(df, ["pm2_5"], 3, Layout(block_rows=3)).orderBy("timestamp").collect()
    assert [r.pm2_5 for r in got] == wanted


def test_gap_filling_by_time(spark):
    rows = [("x", START + dt.timedelta(hours=h), v) for h, v in ((0, 0.0), (1, None), (4, 40.0))]
    df = spark.createDataFrame(rows, "city string, timestamp timestamp, pm2_5 double")
    got = interpolate_time(df, ["pm2_5"], 3, Layout()).orderBy("timestamp").collect()
    assert [r.pm2_5 for r in got] == [0, 10, 40]


def test_training_frames_equal_pandas(spark):
    values = [float((i * 37) % 101) for i in range(160)]
    rows = [("x", START + dt.timedelta(hours=i), int(v), *[v + k for k in range(6)]) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "city string, timestamp timestamp, aqi int, pm2_5 double, pm10 double, no2 double, so2 double, o3 double, co double")
    layout = Layout(block_rows=80)
    got = add_features(series.number_rows(df, layout), TRAIN, layout).orderBy("timestamp").toPandas()
    s = pd.Series(values)
    wanted = {
        "aqi_lag_24h": s.shift(24), "aqi_roll_mean_6h": s.shift(1).rolling(6).mean(),
        "aqi_roll_std_24h": s.shift(1).rolling(24).std(), "aqi_diff_24h": s.shift(1).diff(24),
        "pm25_lag_3h": s.shift(3),
    }
    for name, column in wanted.items():
        for mine, theirs in zip(got[name], column):
            assert (pd.isna(mine) and math.isnan(theirs)) or mine == pytest.approx(theirs, abs=1e-9), name

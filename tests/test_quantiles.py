"""Exact quantiles against numpy, with bins split down to single values."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazeline.operators import quantiles

P = (0.0, 0.25, 0.5, 0.9, 1.0)


def found(spark, groups, most):
    rows = [(g, float(v) if v is not None else None) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "city string, x double")
    return {(r["city"], r["p"]): r["quantile"] for r in quantiles.exact_quantiles(df, ["x"], P, most=most).collect()}


@pytest.mark.parametrize("most", [1, 3, 100_000])
def test_quantiles_equal_numpy(spark, most):
    rng = np.random.default_rng(1)
    groups = {
        "fine": 5 + rng.random(300) * 1e-9, "mixed": rng.standard_normal(200) * 10.0 ** rng.integers(-300, 300, 200),
        "copies": [2.5] * 400 + [2.5000000001] * 3, "one": [-7.0], "signs": [-1.0, 0.0, 1.0, 0.0, -0.5, 1e-320, -1e-320],
        None: rng.integers(-3, 3, 50).astype(float),
    }
    got = found(spark, groups, most)
    for g, values in groups.items():
        for p in P:
            assert got[g, p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=0), (g, p)
    assert len(got) == len(groups) * len(P)


def test_no_values_have_no_quantiles(spark):
    assert found(spark, {"a": [None, float("nan")], "b": [1.0, None, float("nan"), 3.0]}, 1)[("b", 0.5)] == 2.0
    assert found(spark, {}, 1) == {}
    assert found(spark, {"a": [float("inf"), 1.0, float("-inf")]}, 1)[("a", 1.0)] == float("inf")


def test_no_task_orders_more_than_the_stated_number(spark, monkeypatch):
    """After the last round every bin is small or holds one value."""
    kept = []
    write = quantiles.write_and_reread
    monkeypatch.setattr(quantiles, "write_and_reread", lambda df, label: kept.append(write(df, label)) or kept[-1])
    df = spark.range(20_000).select(F.lit("a").alias("city"), (F.col("id") / 1e12).alias("x"))
    quantiles.exact_quantiles(df, ["x"], (0.5,), most=10).collect()
    assert len(kept) > 1 and kept[-1].where("n > 10 AND low < high").isEmpty()

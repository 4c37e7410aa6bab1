"""Recursive forecasts: every prediction becomes the next step's lag.

Spark cuts each city to its newest rows, turns them into one row of arrays and
computes the calendar inputs of all coming hours. One Arrow stage then walks the
horizon for all cities of a batch at once, so work is spread by city and a hot
city costs no more than any other.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline import series
from hazeline.functions.calendar import add_hours
from hazeline.operators.features import SERVE, FeatureSpec
from hazeline.schemas import POLLUTANTS, TARGET
from hazeline.series import DEFAULT, Layout

HISTORY = 200
HORIZON = 72


def histories(readings: DataFrame, rows: int = HISTORY, layout: Layout = DEFAULT) -> DataFrame:
    """One row per city: newest time, last reading and arrays, oldest first."""
    newest = series.last_rows(readings, rows, layout)
    columns = [F.col(c).cast("double").alias(c) for c in (TARGET, *POLLUTANTS)]
    entry = F.struct(*layout.order, *columns)
    return newest.groupBy(layout.key).agg(F.sort_array(F.collect_list(entry)).alias("h")).select(
        layout.key,
        F.element_at(f"h.{layout.time}", -1).alias("last_time"),
        F.col(f"h.{TARGET}").alias("past"),
        *[F.col(f"h.{c}").alias(f"{c}_past") for c in POLLUTANTS],
        *[F.element_at(f"h.{c}", -1).alias(c) for c in POLLUTANTS],
    )


def forecast(
    readings: DataFrame, predictor, spec: FeatureSpec = SERVE, hours: int = HORIZON, layout: Layout = DEFAULT,
    zero_absent: bool = False,
) -> DataFrame:
    """``city, horizon, timestamp, aqi`` for the coming hours of every city.

    ``predictor`` names its inputs and maps a matrix to predictions. All inputs of
    ``spec`` are formed; any other name raises, or is 0 with ``zero_absent``.
    Pollutants keep their last value. Windows and differences end at the row before
    the predicted one; deviations are of the sample where the spec's windows end
    there too, and of the population elsewhere.
    """
    absent = [name for name in predictor.features if name not in spec.names]
    if absent and not zero_absent:
        raise ValueError(f"the forecast cannot form {absent}")
    calendar_names = list(spec.time_features(F.lit(None).cast("timestamp")))
    ahead = F.transform(
        F.sequence(F.lit(1), F.lit(hours)),
        lambda h: F.array(
            *[e.cast("double") for e in spec.time_features(add_hours(F.col("last_time"), h)).values()]
        ),
    )
    states = histories(readings, HISTORY, layout).withColumn("calendar", F.flatten(ahead))
    walked = states.mapInPandas(
        _walker(predictor, spec, hours, calendar_names, layout.key),
        f"{layout.key} string, last_time timestamp, path array<double>",
    )
    return walked.select(layout.key, "last_time", F.posexplode("path").alias("step", TARGET)).select(
        layout.key,
        (F.col("step") + 1).alias("horizon"),
        add_hours(F.col("last_time"), F.col("step") + 1).alias(layout.time),
        TARGET,
    )


def _walker(predictor, spec, hours, calendar_names, key):
    side_columns = sorted({"pm2_5", "co", *spec.side_roll_columns})
    # the acceleration and the mean trend look back three and four rows
    reach = max(*spec.aqi_lags, *spec.side_lags, *spec.windows, *spec.side_windows, *[k + 1 for k in spec.differences], 4)

    def padded(lists):
        """Newest ``reach`` values, the oldest one repeated where there are fewer."""
        return np.array([np.r_[[v[0]] * (reach - len(v)), v[-reach:]] for v in lists], dtype=float)

    def rolled(past, known, width):
        """Mean and sum of squared differences over the newest rows there are."""
        rows = np.minimum(known, width)
        used = np.arange(width) >= (width - rows)[:, None]
        recent = past[:, -width:]
        mean = np.where(used, recent, 0.0).sum(axis=1) / rows
        return mean, np.where(used, (recent - mean[:, None]) ** 2, 0.0).sum(axis=1), rows

    def inputs(past, sides, known):
        """Everything that looks at earlier rows, named as the spec names it."""
        row = {f"aqi_lag_{k}h": past[:, -k] for k in spec.aqi_lags}
        for prefix, column in ((spec.pm_lag_prefix, "pm2_5"), ("co", "co")):
            row.update({f"{prefix}_lag_{k}h": sides[column][:, -k] for k in spec.side_lags})
        for width in spec.windows:
            mean, squares, rows = rolled(past, known, width)
            divisor = np.maximum(rows - 1, 1) if spec.skip else rows
            row[f"aqi_roll_mean_{width}h"] = mean
            row[f"aqi_roll_std_{width}h"] = np.sqrt(squares / divisor)
        for column in spec.side_roll_columns:
            row.update({f"{column}_roll_mean_{w}h": rolled(sides[column], known, w)[0] for w in spec.side_windows})

        def change(k):
            return np.where(known > k, past[:, -1] - past[:, -1 - k], 0.0)

        row.update({f"{spec.difference_prefix}_{k}h": change(k) for k in spec.differences})
        row["aqi_trend"] = change(3) / 3.0 if spec.trend == "mean" else np.sign(change(1))
        row["aqi_trend_dir"] = (change(1) > 0).astype(float)
        row["aqi_accel"] = np.where(known >= 3, change(1) - (past[:, -2] - past[:, -3]), 0.0)
        return row

    def walk(batches):
        for batch in batches:
            if batch.empty:
                continue
            n = len(batch)
            past = padded(batch["past"])
            sides = {c: padded(batch[f"{c}_past"]) for c in side_columns}
            known = batch["past"].str.len().to_numpy()
            clock = np.stack(batch["calendar"]).reshape(n, hours, len(calendar_names))
            fixed = {c: batch[c].to_numpy(dtype=float) for c in POLLUTANTS}
            path, absent = np.empty((n, hours)), np.zeros(n)
            for step in range(hours):
                row = fixed | inputs(past, sides, known)
                row.update({name: clock[:, step, i] for i, name in enumerate(calendar_names)})
                matrix = np.column_stack([row.get(name, absent) for name in predictor.features])
                path[:, step] = np.clip(predictor.predict(matrix), 0.0, 500.0)
                past = np.column_stack([past[:, 1:], path[:, step]])
                sides = {c: np.column_stack([x[:, 1:], x[:, -1]]) for c, x in sides.items()}
                known = np.minimum(known + 1, HISTORY)
            yield pd.DataFrame({key: batch[key], "last_time": batch["last_time"], "path": list(path)})

    return walk

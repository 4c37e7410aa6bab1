"""Lag, rolling, difference and calendar features from one specification.

Three feature sets exist (training, explaining, serving). They differ in window
alignment, peak hours, the season of September and null handling, so each is a
preset of :class:`FeatureSpec`. Lags and windows count rows, never hours.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline import series
from hazeline.functions import calendar
from hazeline.operators.cleaning import fill_edges
from hazeline.operators.projection import drop_incomplete
from hazeline.schemas import POLLUTANTS, TARGET
from hazeline.series import DEFAULT, Layout


@dataclass(frozen=True)
class FeatureSpec:
    aqi_lags: tuple = (1, 2, 3, 6, 12, 24, 48, 72)
    side_lags: tuple = (1, 3, 6, 24)
    pm_lag_prefix: str = "pm25"
    lags_by_column: bool = False
    windows: tuple = (3, 6, 12, 24)
    side_windows: tuple = (6, 24)
    side_roll_columns: tuple = ("pm2_5", "co", "no2")
    side_rolls_by_window: bool = False
    skip: int = 1                  # rows left out before a window or difference
    std_fill: float | None = None  # value for a rolling std that has too few rows
    differences: tuple = (1, 3, 24)
    difference_prefix: str = "aqi_diff"
    trend: str = "sign"            # sign | mean | flag
    acceleration: bool = False
    month_before_week: bool = True  # order of the cyclic columns
    year_cycle: bool = False
    morning: tuple = (6, 9)
    evening: tuple = (19, 22)
    september_is_summer: bool = True
    fill: bool = False             # fill edges instead of dropping warm-up rows

    @property
    def reach(self) -> int:
        """Rows of context before a row that its features look at."""
        trend_reach = 3 if self.trend == "mean" else 0
        return max(
            *self.aqi_lags,
            *self.side_lags,
            *[w + self.skip for w in (*self.windows, *self.side_windows)],
            *[k + self.skip for k in self.differences],
            trend_reach,
            2 if self.acceleration else 0,
        )

    @property
    def names(self) -> list[str]:
        """Model inputs in order: pollutants, then everything derived."""
        return [*POLLUTANTS, *self.row_features(DEFAULT), *self.time_features(F.lit(None).cast("timestamp"))]

    def row_features(self, layout: Layout) -> dict[str, Column]:
        """Features that look at earlier rows of the block."""
        rows = series.block_window(layout)
        target = F.col(TARGET).cast("double")

        def before(value, k):
            return value if k == 0 else F.lag(value, k).over(rows)

        def rolled(value, width, function):
            frame = rows.rowsBetween(-(width - 1) - self.skip, -self.skip)
            return F.when(F.count(value).over(frame) == width, function(value).over(frame))

        def difference(k):
            return before(target, self.skip) - before(target, self.skip + k)

        out = {f"aqi_lag_{k}h": before(target, k) for k in self.aqi_lags}
        sides = ((self.pm_lag_prefix, "pm2_5"), ("co", "co"))
        lagged = [(s, k) for k in self.side_lags for s in sides]
        if self.lags_by_column:
            lagged = [(s, k) for s in sides for k in self.side_lags]
        for (prefix, column), k in lagged:
            out[f"{prefix}_lag_{k}h"] = before(F.col(column), k)
        for width in self.windows:
            out[f"aqi_roll_mean_{width}h"] = rolled(target, width, F.avg)
            deviation = rolled(target, width, F.stddev_samp)
            if self.std_fill is not None:
                deviation = F.coalesce(deviation, F.lit(self.std_fill))
            out[f"aqi_roll_std_{width}h"] = deviation
        pairs = [(c, w) for c in self.side_roll_columns for w in self.side_windows]
        if self.side_rolls_by_window:
            pairs = [(c, w) for w in self.side_windows for c in self.side_roll_columns]
        for name, width in pairs:
            out[f"{name}_roll_mean_{width}h"] = rolled(F.col(name), width, F.avg)
        for k in self.differences:
            out[f"{self.difference_prefix}_{k}h"] = difference(k)
        if self.trend == "sign":
            out["aqi_trend"] = F.signum(difference(1))
        elif self.trend == "mean":
            # The mean of the last three one-step differences telescopes.
            known = F.count(target).over(rows.rowsBetween(-3, 0)) == 4
            out["aqi_trend"] = F.when(known, (target - before(target, 3)) / 3.0)
        else:
            out["aqi_trend_dir"] = F.coalesce((difference(1) > 0).cast("int"), F.lit(0))
        if self.acceleration:
            out["aqi_accel"] = (target - before(target, 1)) - (before(target, 1) - before(target, 2))
        return out

    def time_features(self, ts: Column) -> dict[str, Column]:
        """Features of the row's own timestamp."""
        parts = {
            "hour": F.hour(ts),
            "day_of_week": calendar.day_of_week(ts),
            "month": F.month(ts),
            "day_of_year": F.dayofyear(ts),
        }
        cycles = [("hour", "hour", 24)]
        week, month = ("dow", "day_of_week", 7), ("month", "month", 12)
        cycles += [month, week] if self.month_before_week else [week, month]
        if self.year_cycle:
            cycles.append(("doy", "day_of_year", 365))
        out = dict(parts)
        for name, part, period in cycles:
            out[f"{name}_sin"], out[f"{name}_cos"] = calendar.cyclic(parts[part], period)
        out["is_morning_peak"] = calendar.hour_flag(ts, *self.morning)
        out["is_evening_peak"] = calendar.hour_flag(ts, *self.evening)
        out["season"] = calendar.season(ts, self.september_is_summer)
        return out


TRAIN = FeatureSpec()

EXPLAIN = FeatureSpec(
    side_rolls_by_window=True,
    skip=0,
    trend="mean",
    morning=(7, 9),
    evening=(17, 20),
    september_is_summer=False,
)

SERVE = FeatureSpec(
    side_lags=(1, 2, 3),
    pm_lag_prefix="pm2_5",
    lags_by_column=True,
    side_windows=(),
    side_roll_columns=(),
    skip=0,
    std_fill=0.0,
    differences=(1, 3),
    difference_prefix="aqi_rate",
    trend="flag",
    acceleration=True,
    month_before_week=False,
    year_cycle=True,
    morning=(7, 10),
    evening=(17, 20),
    september_is_summer=False,
    fill=True,
)


def add_features(numbered: DataFrame, spec: FeatureSpec = TRAIN, layout: Layout = DEFAULT) -> DataFrame:
    """All feature columns on a numbered series, incomplete rows kept.

    One shuffle and one sort serve every lag, window and difference, because all
    expressions share the block window. The result is blocked, halo removed.
    """
    blocked = series.split_blocks(numbered, layout, back=spec.reach)
    with_rows = blocked.select("*", *[e.alias(n) for n, e in spec.row_features(layout).items()])
    own = series.drop_halo(with_rows)
    return own.select("*", *[e.alias(n) for n, e in spec.time_features(F.col(layout.time)).items()])


def build_features(numbered: DataFrame, spec: FeatureSpec = TRAIN, layout: Layout = DEFAULT) -> DataFrame:
    """Features of a numbered series, with the preset's treatment of nulls."""
    featured = add_features(numbered, spec, layout)
    columns = [TARGET, *spec.names]
    if spec.fill:
        featured = fill_edges(featured, columns, layout)
    return drop_incomplete(featured, columns)

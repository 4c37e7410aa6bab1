"""Forecasts walked in SQL and in Spark, and what is served from them."""

from pyspark.sql import functions as F

from catalog.fixture import HOURLY, cleaned, readings, with_tables
from catalog.models import training_parts
from catalog.registry import query, r, rounded
from catalog.scoring import category_sql
from hazeline import series
from hazeline.functions.aqi import with_category
from hazeline.models import fit
from hazeline.models.forecast import HISTORY, forecast, histories
from hazeline.models.predictors import LinearPredictor, tree_predictor
from hazeline.operators import reports
from hazeline.operators.features import TRAIN

#: A model whose inputs look back as far as the preset goes, means and deviations among them.
SWINGS = LinearPredictor(
    ("aqi_lag_1h", "aqi_lag_72h", "co_lag_3h", "aqi_roll_mean_24h", "aqi_roll_std_6h", "aqi_roll_std_24h", "aqi_accel", "month", "o3"),
    (0.4, 0.2, 0.001, 0.3, 0.5, -0.25, 0.05, 0.5, 0.02),
    4.0,
)
#: The same by hand; a lag beyond the rows there are takes the oldest.
_GUESS = """4 + 0.4::DOUBLE * past[-1] + 0.2::DOUBLE * coalesce(past[-72], past[1]) + 0.001::DOUBLE * coalesce(co[-3], co[1])
    + 0.3::DOUBLE * list_avg(past[-24:]) + 0.5::DOUBLE * list_aggregate(past[-6:], 'stddev_pop')
    - 0.25::DOUBLE * list_aggregate(past[-24:], 'stddev_pop')
    + 0.05::DOUBLE * CASE WHEN len(past) >= 3 THEN past[-1] - 2 * past[-2] + past[-3] ELSE 0 END
    + 0.5::DOUBLE * month(last_time + to_hours(horizon + 1)) + 0.02::DOUBLE * o3"""


def walked(body: str, rows: int = HISTORY) -> str:
    """``body`` over ``ahead``: 72 hours walked from each city's newest rows."""
    return with_tables(body, "cleaned", recursive=True, extra={
        "newest": f"""SELECT city, list(aqi::DOUBLE ORDER BY timestamp) AS past, list(co ORDER BY timestamp) AS co,
            max(timestamp) AS last_time, arg_max(o3, timestamp) AS o3 FROM (
              SELECT *, row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) AS back FROM cleaned)
            WHERE back <= {rows} GROUP BY city""",
        "walk": f"""SELECT city, last_time, o3, co, past, 0 AS horizon, NULL::DOUBLE AS aqi FROM newest UNION ALL
            SELECT city, last_time, o3, list_append(co, co[-1]), list_append(past, guess), horizon + 1, guess FROM (
              SELECT *, least(greatest({_GUESS}, 0), 500) AS guess FROM walk WHERE horizon < 72)""",
        "ahead": """SELECT city, cast(horizon AS INTEGER) AS horizon, last_time + to_hours(horizon) AS timestamp, aqi
            FROM walk WHERE horizon > 0""",
    })


def history(spark, sf_dir):
    return series.drop_bookkeeping(cleaned(spark, sf_dir))


def ahead(spark, sf_dir):
    return forecast(history(spark, sf_dir), SWINGS, layout=HOURLY)


_AHEAD = f"SELECT city, horizon, timestamp, {r('aqi')} FROM ahead"


@query("M7 M9 M10", walked(_AHEAD))
def swinging_forecast(spark, sf_dir):
    """72 hours ahead by a model that takes deviations, differences and far lags."""
    return rounded(ahead(spark, sf_dir))


@query("M7 M8 M9", walked(_AHEAD, rows=2))
def short_history_forecast(spark, sf_dir):
    """Two rows a city: lags take the oldest row, means and deviations the rows there are."""
    short = series.last_rows(history(spark, sf_dir), 2, HOURLY)
    return rounded(forecast(short, SWINGS, layout=HOURLY))


@query("M11 L3", walked(
    f"SELECT city, len(past) AS rows, last_time, {r('past[1]', 'oldest')}, {r('list_sum(past)', 'total')}, "
    f"{r('co[-1]', 'last_co')} FROM newest"))
def forecast_histories(spark, sf_dir):
    """What a forecast starts from: 200 rows at most, oldest first."""
    found = histories(history(spark, sf_dir), layout=HOURLY)
    total = F.aggregate("past", F.lit(0.0), lambda a, x: a + x)
    return rounded(found.select(
        "city", F.size("past").cast("long").alias("rows"), "last_time", F.col("past")[0].alias("oldest"), total.alias("total"),
        F.col("co").alias("last_co")))


@query("A2 A12", walked(
    f"SELECT city, {r('avg(aqi)', 'avg_aqi')}, {r('max(aqi)', 'peak_aqi')}, {r('min(aqi)', 'low_aqi')}, "
    f"{category_sql('avg(aqi)')} AS avg_category, {category_sql('max(aqi)')} AS peak_category, "
    f"{category_sql('min(aqi)')} AS low_category FROM ahead GROUP BY city"))
def forecast_outlook(spark, sf_dir):
    return rounded(reports.outlook(ahead(spark, sf_dir)))


#: Two days after the data, so that the forecast ends on the day after it.
TODAY = "2024-02-01"


@query("A3 A12 P8 P9 T12 Q11", walked(
    f"""SELECT city, k AS day_offset, concat(CASE WHEN k = 1 THEN 'Tomorrow' ELSE concat('Day ', k) END, ' · ',
          strftime(TIMESTAMP '{TODAY}' + to_days(k), '%a %d %b')) AS label,
        greatest(0, cast(trunc(avg(aqi)) AS INTEGER)) AS mean_shown, cast(trunc(min(aqi)) AS INTEGER) AS min_shown,
        cast(trunc(max(aqi)) AS INTEGER) AS max_shown, {category_sql('avg(aqi)')} AS category FROM (
          SELECT *, bool_or(on_day) OVER (PARTITION BY city, k) AS any_on_day FROM (
            SELECT city, aqi, k, horizon > 24 * k AND horizon <= 24 * (k + 1) AS in_slice,
                   timestamp >= TIMESTAMP '{TODAY}' + to_days(k) AND timestamp < TIMESTAMP '{TODAY}' + to_days(k + 1) AS on_day
            FROM ahead, (SELECT cast(unnest([1, 2, 3]) AS INTEGER) AS k)))
        WHERE on_day OR (in_slice AND NOT any_on_day) GROUP BY city, k"""))
def forecast_days(spark, sf_dir):
    """Day cards; the second day has no hour in the forecast, so a slice of the horizon stands in."""
    today = F.lit(TODAY).cast("timestamp")
    return reports.day_cards(reports.day_summaries(ahead(spark, sf_dir), today), today)


@query("W16 Q10", walked(
    f"""SELECT city, horizon, {r('segment', 'segment_aqi')}, {category_sql('segment', 'color')} AS color FROM (
        SELECT city, horizon, (aqi + lead(aqi) OVER (PARTITION BY city ORDER BY horizon)) / 2.0::DOUBLE AS segment FROM ahead)
        WHERE segment IS NOT NULL"""))
def forecast_colors(spark, sf_dir):
    return rounded(reports.segment_colors(ahead(spark, sf_dir)))


@query("W16 Q10", walked(f"SELECT city, horizon, {r('aqi')}, {category_sql('aqi', 'color')} AS color FROM ahead"))
def forecast_points(spark, sf_dir):
    return rounded(reports.point_colors(ahead(spark, sf_dir)))


@query("W15 Q10 Q11 T12", with_tables(
    f"""SELECT city, greatest(0, aqi) AS value, upper({category_sql('aqi')}) AS heading, {category_sql('aqi', 'message')} AS message,
        {category_sql('aqi', 'color')} AS color, {category_sql('aqi', 'icon')} AS icon, strftime(timestamp, '%d %b %Y, %H:%M PKT') AS updated
        FROM readings QUALIFY row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) = 1""", "readings"))
def city_advisory(spark, sf_dir):
    return reports.advisory(reports.latest_reading(readings(spark, sf_dir)))


@query("M3 M4 M7")
def tree_forecast(spark, sf_dir):
    """Boosted trees fitted on the training inputs walk 72 hours, and the outlook is read from that."""
    train, test, names = training_parts(spark, sf_dir)
    model, _ = fit.fit_boosted(train, test, names, fit.BoostSettings(trees=20, depth=4, patience=5))
    predictor = tree_predictor(spark, model.stages[-1], names)
    hours = forecast(history(spark, sf_dir), predictor, TRAIN, layout=HOURLY)
    return rounded(with_category(hours, "aqi", ("category", "color")))

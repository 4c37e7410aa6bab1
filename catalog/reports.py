"""Summaries, splits, metrics, rankings and quality checks."""

from pyspark.sql import functions as F

from catalog.fixture import HOURLY, events, readings, replay, samples, with_tables
from catalog.registry import query, r, rounded
from hazeline import series
from hazeline.functions.aqi import with_category
from hazeline.operators import quality, reports, scaling
from hazeline.schemas import POLLUTANTS


def category_sql(value: str) -> str:
    """Fixed values of the published scale, written out apart from the library's table."""
    shown = f"greatest(0, cast(trunc(coalesce({value}, 0)) AS INTEGER))"
    return (
        f"CASE WHEN {shown} <= 50 THEN 'Good' WHEN {shown} <= 100 THEN 'Moderate' "
        f"WHEN {shown} <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN {shown} <= 200 THEN 'Unhealthy' "
        f"WHEN {shown} <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END"
    )


DOW = "cast(isodow(timestamp) - 1 AS INTEGER)"
HOUR = "cast(hour(timestamp) AS INTEGER)"


@query("A4 Q10", with_tables(
    f"SELECT city, {DOW} AS dow_number, {HOUR} AS hour, {r('avg(aqi)', 'mean_aqi')}, count(*) AS rows, "
    f"{category_sql('avg(aqi)')} AS category FROM readings GROUP BY 1, 2, 3", "readings"))
def weekday_hour_category(spark, sf_dir):
    pattern = reports.weekday_hour_pattern(readings(spark, sf_dir))
    return rounded(with_category(pattern, "mean_aqi", ("category",)))


_CELLS = ", ".join(
    f"round(CASE WHEN count(*) FILTER ({HOUR} = {h}) = 0 THEN 0.0::DOUBLE ELSE avg(aqi) FILTER ({HOUR} = {h}) END, 6) AS h{h:02d}"
    for h in range(24)
)


@query("A4 A5", with_tables(
    f"SELECT city, {DOW} AS dow_number, ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][{DOW} + 1] AS dow, {_CELLS} "
    "FROM readings GROUP BY 1, 2", "readings"))
def weekday_hour_matrix(spark, sf_dir):
    return rounded(reports.weekday_hour_matrix(readings(spark, sf_dir)).orderBy("city", "dow_number"))


@query("A1", with_tables(
    f"SELECT city, count(*) AS rows, min(aqi) AS min_aqi, max(aqi) AS max_aqi, {r('avg(aqi)', 'mean_aqi')}, "
    "min(timestamp) AS first_time, max(timestamp) AS last_time FROM readings GROUP BY city", "readings"))
def series_profile(spark, sf_dir):
    return rounded(reports.profile(readings(spark, sf_dir)))


@query("A2 A12", with_tables(
    f"SELECT city, {r('avg(aqi)', 'avg_aqi')}, max(aqi) AS peak_aqi, min(aqi) AS low_aqi, "
    f"{category_sql('avg(aqi)')} AS avg_category, {category_sql('max(aqi)')} AS peak_category, "
    f"{category_sql('min(aqi)')} AS low_category FROM replay GROUP BY city", "replay"))
def horizon_outlook(spark, sf_dir):
    return rounded(reports.outlook(replay(spark, sf_dir)))


TODAY = "2024-01-28"


@query("A3 A12 P8 P9", with_tables(
    f"""SELECT city, k AS day_offset, {r('avg(aqi)', 'mean_aqi')}, min(aqi) AS min_aqi, max(aqi) AS max_aqi,
        {category_sql('avg(aqi)')} AS category FROM (
          SELECT *, bool_or(on_day) OVER (PARTITION BY city, k) AS any_on_day FROM (
            SELECT city, aqi, k, horizon > 24 * k AND horizon <= 24 * (k + 1) AS in_slice,
                   timestamp >= TIMESTAMP '{TODAY}' + to_days(k) AND timestamp < TIMESTAMP '{TODAY}' + to_days(k + 1) AS on_day
            FROM replay, (SELECT cast(unnest([1, 2, 3]) AS INTEGER) AS k)))
        WHERE on_day OR (in_slice AND NOT any_on_day) GROUP BY city, k""", "replay"))
def coming_days(spark, sf_dir):
    days = reports.day_summaries(replay(spark, sf_dir), F.lit(TODAY).cast("timestamp"))
    return rounded(days.drop("color"))


@query("W15", with_tables(
    f"SELECT city, timestamp, aqi, {', '.join(POLLUTANTS)} FROM readings "
    "QUALIFY row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) = 1", "readings"))
def latest_readings(spark, sf_dir):
    return reports.latest_reading(readings(spark, sf_dir)).select("city", "timestamp", "aqi", *POLLUTANTS)


@query("W16", with_tables(
    f"""SELECT city, horizon, {r('segment', 'segment_aqi')}, {category_sql('segment')} AS category FROM (
        SELECT city, horizon, (aqi + lead(aqi) OVER (PARTITION BY city ORDER BY horizon)) / 2.0::DOUBLE AS segment FROM replay)
        WHERE segment IS NOT NULL""", "replay"))
def forecast_segments(spark, sf_dir):
    segments = reports.segment_colors(replay(spark, sf_dir)).drop("color")
    with_names = with_category(segments, "segment_aqi", ("category",))
    return rounded(with_names.withColumn("horizon", F.col("horizon").cast("long")))


def _newest(n):
    return with_tables(
        "SELECT city, timestamp, aqi FROM readings "
        f"QUALIFY row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) <= {n}", "readings")


@query("L2", _newest(500))
def newest_per_city(spark, sf_dir):
    return series.last_rows(readings(spark, sf_dir), 500, HOURLY).select("city", "timestamp", "aqi")


@query("L3", _newest(168))
def weekly_trend(spark, sf_dir):
    return reports.weekly_trend(readings(spark, sf_dir), layout=HOURLY)


@query("L1 S4", with_tables("SELECT city, timestamp, aqi FROM readings ORDER BY timestamp, city", "readings"))
def ordered_history(spark, sf_dir):
    return readings(spark, sf_dir).select("city", "timestamp", "aqi").orderBy("timestamp", "city")


@query("L6", with_tables(
    f"SELECT event_id, {', '.join(POLLUTANTS)} FROM samples ORDER BY event_id LIMIT 1000", "samples"))
def bounded_sample(spark, sf_dir):
    return samples(spark, sf_dir).select("event_id", *POLLUTANTS).orderBy("event_id").limit(1000)


@query("M1 A9", with_tables(
    """SELECT city, split, count(*) AS rows, min(timestamp::DATE) AS first_day, max(timestamp::DATE) AS last_day FROM (
        SELECT city, timestamp, CASE WHEN row_number() OVER (PARTITION BY city ORDER BY timestamp)
          <= floor(count(*) OVER (PARTITION BY city) * 0.8) THEN 'train' ELSE 'test' END AS split FROM readings)
        GROUP BY city, split""", "readings"))
def split_ranges(spark, sf_dir):
    numbered = series.number_rows(readings(spark, sf_dir), HOURLY)
    return scaling.split_ranges(scaling.chronological_split(numbered), HOURLY)


@query("A7", with_tables(
    f"SELECT city, {r('avg(aqi)', 'aqi_mean')}, {r('stddev_pop(aqi)', 'aqi_scale')}, "
    f"{r('avg(co)', 'co_mean')}, {r('stddev_pop(co)', 'co_scale')} FROM readings GROUP BY city", "readings"))
def standard_scales(spark, sf_dir):
    return rounded(scaling.fit_scaler(readings(spark, sf_dir), ["aqi", "co"], by=("city",)))


@query("A8", with_tables(
    f"""SELECT city, count(*) AS rows, {r('avg(abs(co - guess))', 'mae')}, {r('sqrt(avg((co - guess) * (co - guess)))', 'rmse')},
        {r('1 - sum((co - guess) * (co - guess)) / (var_pop(co) * count(co))', 'r2')}
        FROM (SELECT city, co, co * 0.9::DOUBLE + 100 AS guess FROM samples) GROUP BY city""", "samples"))
def prediction_errors(spark, sf_dir):
    scored = samples(spark, sf_dir).withColumn("prediction", F.col("co") * 0.9 + 100)
    return rounded(scaling.regression_metrics(scored, label="co", by=("city",)))


@query("M6 P6 Q12", with_tables(
    f"SELECT event_id, {r('least(greatest(3 + 0.04::DOUBLE * co - 0.5::DOUBLE * coalesce(pm10, 0), 0), 500)', 'prediction')} "
    "FROM (SELECT event_id, co, pm10 FROM samples WHERE pm10 IS NOT NULL)", "samples"))
def linear_prediction(spark, sf_dir):
    rows = samples(spark, sf_dir).where(F.col("pm10").isNotNull())
    scored = scaling.score_linear(rows, {"co": 0.04, "pm10": -0.5}, 3.0, keep=("event_id",))
    return rounded(scored.select("event_id", "prediction"))


@query("M6 P6 P10 Q12", with_tables(
    f"SELECT event_id, {r('least(greatest(3 + 0.04::DOUBLE * co - 0.5::DOUBLE * coalesce(pm10, 0), 0), 500)', 'prediction')} FROM samples",
    "samples"))
def linear_prediction_with_gaps(spark, sf_dir):
    """All samples are scored; an amount that is missing counts as 0."""
    filled = samples(spark, sf_dir).na.fill(0.0, ["pm10"])
    scored = scaling.score_linear(filled, {"co": 0.04, "pm10": -0.5}, 3.0, keep=("event_id",))
    return rounded(scored.select("event_id", "prediction"))


_LONG = " UNION ALL ".join(f"SELECT city, '{p}' AS feature, abs({p}) AS size FROM readings" for p in POLLUTANTS)


@query("A10 A11 L4 L5", with_tables(
    f"""SELECT city, feature, {r('importance')}, cast(rank AS INTEGER) AS rank, {r('100.0::DOUBLE * importance / largest', 'percent')}, rank <= 3 AS top_three FROM (
        SELECT *, row_number() OVER (PARTITION BY city ORDER BY importance DESC, feature) AS rank,
               max(importance) OVER (PARTITION BY city) AS largest
        FROM (SELECT city, feature, avg(size) AS importance FROM ({_LONG}) GROUP BY city, feature)) WHERE rank <= 5""",
    "readings"))
def top_features(spark, sf_dir):
    long = readings(spark, sf_dir).unpivot(["city"], list(POLLUTANTS), "feature", "size")
    importance = long.groupBy("city", "feature").agg(F.avg(F.abs("size")).alias("importance"))
    return rounded(reports.rank_features(importance, 5, by=("city",)).drop("label"))


@query("D1", with_tables(
    "SELECT city, " + ", ".join(f"count(*) FILTER ({p} < 0) AS {p}_negative" for p in POLLUTANTS)
    + " FROM (SELECT city, " + ", ".join(f"{p} - 20 AS {p}" for p in POLLUTANTS) + " FROM readings) GROUP BY city", "readings"))
def negative_readings(spark, sf_dir):
    lowered = readings(spark, sf_dir).withColumns({p: F.col(p) - 20 for p in POLLUTANTS})
    return quality.negative_counts(lowered)


@query("D2", with_tables(
    "SELECT city, min(aqi) AS min_aqi, max(aqi) AS max_aqi, count(*) FILTER (aqi < 0 OR aqi > 500) AS out_of_range "
    "FROM (SELECT city, aqi * 2 - 60 AS aqi FROM readings) GROUP BY city", "readings"))
def index_out_of_range(spark, sf_dir):
    return quality.index_range(readings(spark, sf_dir).withColumn("aqi", F.col("aqi") * 2 - 60))


@query("D3", with_tables(
    "SELECT city, max(timestamp) AS newest, round((epoch(TIMESTAMP '2024-01-31') - epoch(max(timestamp))) / 3600.0, 6) AS age_hours, "
    "(epoch(TIMESTAMP '2024-01-31') - epoch(max(timestamp))) / 3600.0 < 24 AS fresh FROM readings GROUP BY city", "readings"))
def reading_age(spark, sf_dir):
    return rounded(quality.freshness(readings(spark, sf_dir), F.lit("2024-01-31").cast("timestamp")))
